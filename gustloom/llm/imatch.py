"""I-Match document fingerprints.

Terms within a band of inverse document frequency form the lexicon. A text's distinct lexicon terms are sorted and
hashed: once as a whole, and once for each of a fixed number of random subsets of the lexicon, the same for all texts.
Subsets are drawn at several densities, so that long and short texts alike have subsets that an edit leaves alone; a
subset that has none of a text's terms says nothing about it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustloom.llm.common import Workspace, text_of

#: The band: ln(documents / documents with the term).
IDF_LOW, IDF_HIGH = 1.6, 7.5
#: The random subsets: (tag, first bit, bits, subsets). A term's hash is its random draw: it is in subset k where the hash's
#: ``bits`` bits from ``first bit`` on are k. Densities are 1/4 to 1/4096; the two "dense" ones hold the terms where two bits aren't 0.
LADDER = (("1", 0, 2, 4), ("2", 2, 4, 8), ("3", 6, 6, 16), ("4", 12, 8, 16), ("5", 20, 10, 16), ("6", 30, 12, 16))
DENSE = (("8", 42), ("9", 44))
#: Terms (8 bytes each) that may be broadcast. The band bounds their number by e**IDF_HIGH times the mean number of terms of a text.
BROADCAST_TERMS = 1_000_000


def term_hashes(text: Column) -> Column:
    """Distinct terms (runs of letters and digits, lower case) as 64-bit hashes."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_distinct(F.filter(words, lambda w: w != "")), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, text: Column, low: float = IDF_LOW, high: float = IDF_HIGH) -> DataFrame:
    """Hashes (h) of the terms in the band, counted over all distinct texts, so that copies push no term out of it; a term of one text only is left out."""
    key = F.xxhash64(text).alias("key")
    n = docs.select(key).distinct().count()
    found = docs.select(key, term_hashes(text).alias("terms")).dropDuplicates(["key"]).select(F.explode("terms").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(float(max(n, 1))) / F.col("df"))
    return found.where((F.col("df") > 1) & idf.between(low, high)).select("h")


def _tokens(terms: str) -> Column:
    """Eight characters for each subset that holds any of the sorted terms: tag, subset, 24 bits of its terms' hash."""
    token = lambda tag, subset: f"if(size(own) = 0, '', concat('{tag}', {subset}, right(lpad(hex(xxhash64(own)), 16, '0'), 6)))"
    parts = []
    for tag, first, bits, subsets in LADDER:
        draw = f"(shiftrightunsigned(h, {first}) & {(1 << bits) - 1})"
        some = f"filter({terms}, h -> {draw} < {subsets})" if subsets < 1 << bits else terms
        each = f"transform(array(filter(some, h -> {draw} = k)), own -> {token(tag, 'lower(hex(k))')})[0]"
        parts.append(f"transform(array({some}), some -> transform(sequence(0L, {subsets - 1}L), k -> {each}))[0]")
    for tag, first in DENSE:
        parts.append(f"transform(array(filter({terms}, h -> (shiftrightunsigned(h, {first}) & 3) <> 0)), own -> {token(tag, chr(39) + '0' + chr(39))})")
    return F.expr(f"filter(flatten(array({', '.join(parts)})), t -> t <> '')")


def _split(tokens: Column) -> Column:
    """A fingerprint's tokens."""
    return F.filter(F.transform(F.sequence(F.lit(0), F.floor(F.length(tokens) / 8).cast("int")), lambda i: F.substring(tokens, i * 8 + 1, F.lit(8))), lambda t: t != "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the subsets that hold a term of either text on which both agree; 1 for equal fingerprints."""
    x, y = _split(a), _split(b)
    place = lambda t: F.substring(t, 1, 2)
    parts = F.size(F.array_union(F.transform(x, place), F.transform(y, place)))
    return F.when(a == b, 1.0).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(parts, F.lit(1))).cast("double")


def _signature(terms: str, others: str, whole: str) -> Column:
    """'00' and 24 bits of the whole's hash, then the subsets' tokens. Without a term in the band all terms, tagged '0w', take its place; without any term the characters do."""
    head = lambda tag, h: F.concat(F.lit(tag), F.right(F.lpad(F.hex(h), 16, "0"), F.lit(6)))
    parts = lambda t: F.array_join(_tokens(t), "")
    bare = F.concat(head("0w", F.col(whole)), head("0x", F.xxhash64(whole)))
    return F.when(F.size(terms) > 0, F.concat(head("00", F.xxhash64(terms)), parts(terms))).when(F.size(others) > 0, F.concat(head("0w", F.col(whole)), parts(others))).otherwise(bare)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint. Equal texts have equal fingerprints; a null text counts as empty."""
    return edited_fingerprints(docs, id_col, text_col).select(id_col, "fingerprint")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars/2) code points replaced by the first as many of the next document by
    ascending id, or all it has; the first document follows the last. Ids are numbers; null ids come first, and rows
    that share an id are ordered by a hash of their text. A single document is its own next one. A null text counts
    as empty; texts without terms are fingerprinted by their characters. An empty table gives no rows.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "imatch")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    words = work.table("lexicon", lexicon(docs, text_of(text_col))).select(F.col("h").alias("known"))
    small = F.broadcast if words.count() <= BROADCAST_TERMS else (lambda x: x)

    # Buckets of consecutive ids; the cuts are few and only balance the work.
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("id", [i / buckets for i in range(1, buckets)], 20 * buckets)).first()[0] or []
    cuts = sorted(set(cuts))
    bucket = _bucket(F.col("id"), cuts)
    placed = rows.select("id", "text", F.xxhash64("text").alias("tie"), bucket.alias("bucket"))
    # Each bucket also gets a copy of the document after its last one: the first of the next bucket that has any.
    firsts = placed.groupBy("bucket").agg(F.min(F.struct(F.col("id").isNotNull().alias("some"), "id", "tie")).alias("one"))
    order = Window.partitionBy(F.lit(0)).orderBy("bucket")  # one row per bucket
    after = firsts.select(F.col("bucket").alias("after"), F.coalesce(F.lead("one").over(order), F.first("one").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("one"))
    after = after.select("after", F.col("one.id").alias("at"), F.col("one.tie").alias("tie_at"))
    extra = placed.join(F.broadcast(after), placed["id"].eqNullSafe(F.col("at")) & (F.col("tie") == F.col("tie_at"))).dropDuplicates(["after"])
    both = placed.select("*", F.lit(0).alias("extra")).unionByName(extra.select("id", "text", "tie", F.col("after").alias("bucket"), F.lit(1).alias("extra")))

    line = Window.partitionBy("bucket").orderBy("extra", F.col("id").asc_nulls_first(), "tie")
    lined = both.select("bucket", "extra", "id", "text", F.row_number().over(line).alias("place"), F.lead("text").over(line).alias("next"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.coalesce(F.left("next", half), F.lit("")))
    lined = lined.select("bucket", "extra", "id", "place", F.length("text").cast("long").alias("n_chars"), "text", F.when(F.col("extra") == 0, edited).otherwise("").alias("edited"))
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), term_hashes(F.col(c)).alias("terms"), F.xxhash64(c).alias("raw")) for k, c in enumerate(("text", "edited"))))
    split = lined.select("bucket", "extra", "id", "place", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.explode(kinds).alias("x"))
    whole = F.when(F.size("x.terms") == 0, F.col("x.raw")).otherwise(F.xxhash64(F.sort_array("x.terms")))
    carried = ("extra", "id", "n_chars", "edited_sha256", "whole")
    split = split.select("bucket", "place", "extra", "id", "n_chars", "edited_sha256", F.col("x.kind").alias("kind"), whole.alias("whole"), "x.terms")
    # Term 0 holds the place of texts without any other.
    spread = split.select("bucket", "place", "kind", *carried, F.explode(F.concat(F.array(F.lit(0).cast("long")), "terms")).alias("h"))
    marked = spread.join(small(words), F.col("h") == F.col("known"), "left")
    some = lambda which: F.sort_array(F.collect_list(F.when(which & (F.col("h") != 0), F.col("h"))))
    lists = (some(F.col("known").isNotNull()).alias("terms"), some(F.col("known").isNull()).alias("others"))
    signed = marked.groupBy("bucket", "place", "kind").agg(*lists, *(F.first(c).alias(c) for c in carried)).withColumn("signature", _signature("terms", "others", "whole"))
    pick = lambda k: F.max(F.when(F.col("kind") == k, F.col("signature")))
    paired = signed.groupBy("bucket", "place").agg(*(F.first(c).alias(c) for c in ("extra", "id", "n_chars", "edited_sha256")), pick(0).alias("fingerprint"), pick(1).alias("edited_fingerprint"))
    ordered = Window.partitionBy("bucket").orderBy("place")
    out = paired.withColumn("next", F.lead("fingerprint").over(ordered)).where("extra = 0")
    return out.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )


def _bucket(key: Column, cuts: list) -> Column:
    """How many cuts are at most the key, by halving; null is in the first bucket."""
    if not cuts:
        return F.lit(0)
    values, steps = F.lit(cuts), len(cuts).bit_length()
    powers = F.lit([1 << i for i in reversed(range(steps))])
    step = lambda at, p: F.when((at + p <= len(cuts)) & (F.get(values, at + p - 1) <= key), at + p).otherwise(at)
    return F.coalesce(F.aggregate(powers, F.lit(0), step), F.lit(0))
