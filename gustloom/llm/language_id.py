"""Language identification by Bayesian evidence fusion.

Text gives a likelihood for each language (naive Bayes over hashed byte trigrams). A declared markup language
gives a second one. The prior is the host's: languages of its other rows, smoothed by its domain's, its address
suffix's and all rows', each a grouped aggregation of what the texts alone say. A row's own evidence is left out
of its prior.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.llm.common import Workspace, map_arrow, rows_of

#: The labelled sample: about so many documents of each language. All languages that have labels are learned, at half a MB each.
TRAIN_DOCS = 1500
#: Hash places of the trigram model; a text counts for at most so many independent trigrams.
PLACES, WEIGHT = 1 << 16, 200.0
#: Chance that declared markup is right; pseudo-rows by which each level of the prior is drawn to the one above.
RELIABLE, KAPPA = 0.9, 5.0
#: Rows are rejected below this posterior, or without any letter.
CONFIDENT = 0.5
_MARKUP = re.compile(r"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*>?")
_LETTERS = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash places of the texts' byte trigrams around a letter, end to end, and how many each text has."""
    raw = [b" " + t.lower().encode("utf-8", "surrogatepass").translate(_LETTERS) + b" " for t in texts]
    data = np.frombuffer(b"".join(raw) + b"  ", np.uint8)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    owner = np.repeat(np.arange(len(raw)), size)
    middle = np.flatnonzero(data[1:-1] != 32) + 1
    middle = middle[middle < len(data) - 2]
    x = data.astype(np.uint32)
    places = (x[middle - 1] * np.uint32(0x9E3779B1) ^ x[middle] * np.uint32(0x85EBCA77) ^ x[middle + 1] * np.uint32(0xC2B2AE3D)) >> np.uint32(16)
    return places.astype(np.int64), np.bincount(owner[middle], minlength=len(raw))


class TextModel:
    """Log-probabilities of the places by language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.1
        self.logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32).T.copy()

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-likelihoods (tempered), the posteriors under equal priors, and the number of trigrams of each text."""
        places, n = trigrams(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        filled = np.flatnonzero(n)
        if len(filled):
            sums[filled] = np.add.reduceat(self.logs[places], (np.cumsum(n) - n)[filled], axis=0)
        likelihood = sums * np.minimum(1, WEIGHT / np.maximum(n, 1))[:, None]
        likelihood -= likelihood.max(axis=1, keepdims=True)
        weights = np.exp(likelihood)
        return likelihood, weights / weights.sum(axis=1, keepdims=True), n


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> TextModel:
    """Fit the trigram model on about TRAIN_DOCS labelled documents of each language, whole texts, drawn by a hash of their ids."""
    known = documents.where(F.col(lang_col).isNotNull() & (F.col(lang_col) != ""))
    common = known.groupBy(lang_col).count().collect()
    languages = sorted(r[0] for r in common) or ["und"]
    # A share of each language's ids by their hash: no ranking, so a common language needs no task of its own.
    share = F.create_map(*(F.lit(x) for r in common for x in (r[0], min(1.0, TRAIN_DOCS / r[1])))) if common else F.create_map().cast("map<string,double>")
    drawn = F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < 1_000_000 * F.try_element_at(share, F.col(lang_col))
    sample = known.where(drawn).select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for langs, texts in rows_of(batches, "lang", "text"):
            places, n = trigrams(texts)
            owner = np.repeat(np.arange(len(texts)), n)
            for lang in set(langs):
                mine = np.array([x == lang for x in langs])[owner] if len(owner) else np.zeros(0, bool)
                sums[lang] = sums.get(lang, 0) + np.bincount(places[mine], minlength=PLACES)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["lang", "place", "n"])

    counts = np.zeros((len(languages), PLACES))
    for lang, places, ns in map_arrow(sample, count, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.collect_list("place"), F.collect_list("n")).collect():
        counts[languages.index(lang), places] = ns
    return TextModel(languages, counts)


def domain(host: Column) -> Column:
    """The last two labels of a host name."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def identify(rows: DataFrame, model: TextModel, key_cols: list[str], text_col: str, host: Column, declared: Column, markup: bool = False) -> DataFrame:
    """One row per input row: the key columns, host, declared, language, confidence, text_language, n_trigrams, rejected.

    ``host`` and ``declared`` may be null: the prior is then that of rows without a host, and markup says nothing.
    ``markup``: the text column holds HTML, whose tags are stripped first. A null or empty text leaves the prior and
    the markup to decide, but a row without any letter is rejected, as is one whose posterior is below CONFIDENT.
    Ties go to the first language by name. An empty table gives no rows.
    """
    work = Workspace(rows.sparkSession, "language")
    languages, size = model.languages, len(model.languages)
    given = rows.select(*(F.col(c).alias(f"key{i}") for i, c in enumerate(key_cols)), F.coalesce(F.lower(host), F.lit("")).alias("host"), F.lower(declared).alias("declared"), F.col(text_col).cast("string").alias("text"))
    kept = [f for f in given.schema.fields if f.name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", likelihood array<double>, posterior array<double>, n_trigrams long"

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            carried = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in kept}
            at = 0
            for (texts,) in rows_of([batch], "text"):
                plain = [html_entities.unescape(_MARKUP.sub(" ", t)) for t in texts] if markup else texts
                likelihood, posterior, n = model.posteriors(plain)
                cut = [c.slice(at, len(texts)) for c in carried.values()]
                at += len(texts)
                arrays = [pa.array(list(x), pa.list_(pa.float64())) for x in (likelihood, posterior)]
                yield pa.RecordBatch.from_arrays([*cut, *arrays, pa.array(n, pa.int64())], [*carried, "likelihood", "posterior", "n_trigrams"])

    evidence = work.table("evidence", map_arrow(given, score, schema))
    # Only rows with text say anything about their host.
    says = evidence.where("n_trigrams > 0").select("host", *(F.get("posterior", i).alias(f"p{i}") for i in range(size)))
    sums = lambda of: [F.sum(f"{of}{i}").alias(f"{of}{i}") for i in range(size)]
    hosts = work.table("hosts", says.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *sums("p")).withColumn("domain", domain(F.col("host"))).withColumn("suffix", suffix(F.col("host"))))
    level = lambda frame, key, tag: frame.groupBy(key).agg(F.sum("n").alias(f"{tag}n"), *(F.sum(f"p{i}").alias(f"{tag}{i}") for i in range(size)))
    everything = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("gn"), *(F.coalesce(F.sum(f"p{i}"), F.lit(0.0)).alias(f"g{i}") for i in range(size)))
    total = everything.first()
    table = hosts.join(level(hosts, "domain", "d"), "domain").join(level(hosts, "suffix", "s"), "suffix")
    table = work.table("priors", table.select("host", F.array("n", "dn", "sn").alias("ns"), *(F.array(f"p{i}", f"d{i}", f"s{i}").alias(f"c{i}") for i in range(size))))

    work.drop("hosts")
    joined = evidence.join(table, "host", "left")
    own = F.when(F.col("n_trigrams") > 0, 1.0).otherwise(0.0)
    scores = []
    for i, language in enumerate(languages):
        mine = own * F.get("posterior", i)
        prior = (F.lit(total[f"g{i}"]) - mine + 1.0) / (F.lit(float(total["gn"])) - own + size)
        for k in (2, 1, 0):  # suffix, domain, host
            prior = (F.greatest(F.coalesce(F.get(f"c{i}", k), F.lit(0.0)) - mine, F.lit(0.0)) + KAPPA * prior) / (F.greatest(F.coalesce(F.get("ns", k), F.lit(0)) - own, F.lit(0.0)) + KAPPA)
        said = F.when(F.col("declared").isin(languages), F.when(F.col("declared") == language, RELIABLE).otherwise((1 - RELIABLE) / max(1, size - 1))).otherwise(1.0)
        scores.append(F.get("likelihood", i) + F.log(F.greatest(prior, F.lit(1e-9))) + F.log(said))
    fused = joined.withColumn("scores", F.array(*scores))
    top = F.array_max("scores")
    names = F.lit(languages)
    fused = fused.withColumn("confidence", 1 / F.aggregate("scores", F.lit(0.0), lambda s, x: s + F.exp(x - top)))
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return fused.select(
        *(F.col(f"key{i}").alias(c) for i, c in enumerate(key_cols)), "host", "declared", best("scores").alias("language"), "confidence",
        F.when(F.col("n_trigrams") > 0, best("posterior")).alias("text_language"), "n_trigrams", ((F.col("n_trigrams") == 0) | (F.col("confidence") < CONFIDENT)).alias("rejected"),
    )


def declared_language(page: Column) -> Column:
    """The language that a page's markup declares: on html (lang or xml:lang), else on body, else for its content in a meta tag; null if none.

    Comments and the contents of scripts, styles, templates and titles declare nothing; other attributes whose names end
    in ``lang``, and what stands in their values, don't either.
    """
    page = F.regexp_replace(F.coalesce(page, F.lit("")), r"(?s)<!--.*?(?:-->|\z)", " ")
    page = F.regexp_replace(page, r"(?is)<(script|style|template|textarea|title)\b.*?(?:</\1|\z)", " ")
    code = r"""\s*=\s*["']?\s*([a-z]{2,3})(?![a-z])"""
    begins = r"""(?i)(?<![^\s/"'])"""  # an attribute's name, after a space or another's value

    def on(tag: str) -> Column:
        attributes = F.regexp_extract(page, rf"(?i)<{tag}(?=[\s/])([^>]*)", 1)
        others = rf"""{begins}(?!(?:xml:)?lang\s*=)[^\s=/"']+\s*=\s*(?:"[^"]*"|'[^']*')"""
        return F.regexp_extract(F.regexp_replace(attributes, others, " "), rf"{begins}(?:xml:)?lang{code}", 1)

    name = r"""(?<![\w:-])(?:http-equiv|name)\s*=\s*["']?\s*(?:content-language|language)(?![\w-])"""
    meta = F.regexp_extract(page, rf"(?i)<meta\b(?=[^>]*?{name})[^>]*?(?<![\w:-])content{code}", 1)
    return F.coalesce(*(F.nullif(F.lower(found), F.lit("")) for found in (on("html"), on("body"), meta)))


def identify_pages(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Pages by their text, their declared language and their address; the text model learns from labelled documents. Rows as of identify()."""
    host = F.regexp_replace(F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit("")), r":\d+$", "")
    return identify(pages, train(documents), ["page_id"], "html", host, declared_language(F.col("html")), markup=True)
