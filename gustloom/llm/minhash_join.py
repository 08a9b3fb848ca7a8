"""Near-duplicate detection by an inverted join on signature coordinates.

Each distinct shingle set gets a MinHash signature. Its coordinate-value pairs are tokens; two sets whose
Jaccard similarity is s agree on each token with probability s. Only pairs that agree on at least MATCHES of
COORDINATES tokens are kept, so a set is posted under a prefix only: its s-MATCHES+1 rarest shared tokens
(of s tokens that any other set has). Two sets with MATCHES common tokens meet in some posting. Pairs whose
sizes can't reach the threshold are skipped, collisions are counted over the whole signatures, and what is
left is confirmed on the full shingle sets.

Postings are merged by components, not by all pairs: first every set against its posting's most central one,
then against its last one where the components still differ, then, exactly, all pairs of sets whose components
still differ and whose shingles leave a link possible. A posting whose sets are all connected yields no more
pairs, and no link between components is lost. The one risk is a pair at or above the threshold that agrees on fewer than MATCHES tokens: for 48
coordinates, similarity 0.75 and 20 matches, less than one pair in a million.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustloom.llm.common import Workspace, arrow_type, map_arrow, rows_of, text_of

COORDINATES, MATCHES = 48, 20
#: Ids (8 bytes each) that may be broadcast to pick the texts to read again; beyond it, a shuffle picks them.
BROADCAST_IDS = 1_000_000


class Shingler:
    """Distinct word shingles of texts as sorted 64-bit hashes, and their signatures."""

    def __init__(self, words: int = 5, coordinates: int = COORDINATES):
        draw = np.random.default_rng(20240817)
        self.words = words
        self.factors = draw.integers(1, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.whole = draw.integers(1, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.masks = draw.integers(0, 2**63, coordinates, dtype=np.uint64)
        self.odd = draw.integers(1, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def shingles(self, text: str) -> np.ndarray:
        """Lower-cases A-Z; words are runs of other bytes than space and \\t to \\r. Fewer words than a shingle has are one shingle."""
        found = text.encode("utf-8", "surrogatepass").lower().split()
        w = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
        if not len(w):
            return w
        if len(w) < self.words:
            out = self.whole[1:] * np.uint64(len(w))
            for x in w:
                out = (out ^ x) * self.whole[:1]
        else:
            n = len(w) - self.words + 1
            out = w[:n] * self.factors[0]
            for i in range(1, self.words):
                out += w[i : i + n] * self.factors[i]
        out ^= out >> np.uint64(32)
        out *= self.whole[0]
        out ^= out >> np.uint64(29)
        return np.unique(out)

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of 32-bit minima per non-empty set."""
        data = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets[:-1])])
        out = np.empty((len(sets), len(self.odd)), np.uint32)
        for k, (mask, odd) in enumerate(zip(self.masks, self.odd)):
            out[:, k] = np.minimum.reduceat(((data ^ mask) * odd) >> np.uint64(32), starts)
        return out.view(np.int32)


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, words: int = 5, coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept, text_hash (xxhash64 of the text, to tell rows with one id apart).

    Sets A and B are linked when 100*|A&B| >= percent*|A|B|; component_id is the least id of the component. A null
    or empty text, or one without words, has no shingles, is linked with nothing and keeps its own id. Equal sets
    are one class and need no pairs. Rows with a null id take part; they are kept only if no row of their component
    has an id. Rows that share an id share its fate only through their texts. An empty table gives no rows.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "near")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    signed = work.table("signed", _signed(rows, words, coordinates))
    filled = signed.where("n_shingles > 0")
    classes = filled.groupBy("digest").agg(F.min("id").alias("least"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
    classes = work.table("classes", classes.withColumn("node", F.monotonically_increasing_id()))
    links = _links(rows, classes, work, percent, words, matches)

    roots = _components(links, work, "all")
    work.drop("postings", "live", "rest", "open", "links0", "links1", "links2")
    member = classes.select("node", "digest", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    known = member.join(least, "root").select("digest", "component_id")
    out = filled.select("id", "n_shingles", "digest", "text_hash").join(known, "digest").select("id", "n_shingles", "component_id", "text_hash")
    out = out.unionByName(signed.where("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"), "text_hash"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")


def _signed(rows: DataFrame, words: int, coordinates: int) -> DataFrame:
    id_name = dict(rows.dtypes)["id"]
    id_type = arrow_type(rows, "id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words, coordinates)
        for ids, hashes, texts in rows_of(batches, "id", "text_hash", "text"):
            sets = [shingler.shingles(t) for t in texts]
            filled = [s for s in sets if len(s)]
            minima = iter(shingler.signatures(filled) if filled else ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(hashes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) for s in sets], pa.binary()), pa.array([next(minima) if len(s) else None for s in sets], pa.list_(pa.int32()))],
                ["id", "text_hash", "n_shingles", "digest", "signature"],
            )

    return map_arrow(rows, run, f"id {id_name}, text_hash long, n_shingles long, digest binary, signature array<int>")


def _sets(rows: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for (texts,) in rows_of(batches, "text"):
            sets = [shingler.shingles(t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array([digest(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["digest", "shingles"])

    return map_arrow(rows.select("text"), run, "digest binary, shingles array<long>")


def _links(rows: DataFrame, classes: DataFrame, work: Workspace, percent: int, words: int, matches: int) -> DataFrame:
    """Confirmed links that connect what all links connect."""
    token = F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    tokens = classes.select("node", F.posexplode("signature").alias("pos", "value")).select("node", token.alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = tokens.join(shared, "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("held")).where(F.size("held") >= matches)
    prefix = F.expr(f"slice(held, 1, size(held) - {matches} + 1)")
    # The weight is high for sets that agree with many others: good centres of their postings.
    weight = F.aggregate("held", F.lit(0.0), lambda total, x: total + F.log(x["df"])).alias("weight")
    postings = held.select("node", weight, F.explode(prefix).alias("x")).select("node", "weight", F.col("x.token").alias("token"))
    postings = work.table("postings", postings.join(classes.select("node", "n"), "node"))

    # The texts of posted classes are read again for their full sets.
    posted = classes.join(postings.select("node").distinct(), "node", "left_semi")
    ids = posted.select(F.col("least").alias("id")).distinct()
    small = F.broadcast if ids.count() <= BROADCAST_IDS else (lambda x: x)
    texts = rows.join(small(ids), rows["id"].eqNullSafe(ids["id"]), "left_semi")
    sets = _sets(texts, words).dropDuplicates(["digest"])
    live = work.table("live", posted.select("node", "digest", "n", "signature").join(sets, "digest").select("node", "n", "signature", "shingles"))

    first = postings.groupBy("token").agg(F.max(F.struct("weight", "node", "n")).alias("one"))
    pairs = postings.join(first, "token").select(F.col("one.node").alias("a"), F.col("one.n").alias("an"), F.col("node").alias("b"), F.col("n").alias("bn"))
    links = work.table("links0", _confirmed(pairs, live, percent, matches))

    roots = _components(links, work, "first")
    placed = postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    last = placed.groupBy("token").agg(F.max(F.struct("node", "n", "root")).alias("one"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    pairs = placed.join(last.select("token", "one"), "token").where("root <> one.root").select(F.col("node").alias("a"), F.col("n").alias("an"), F.col("one.node").alias("b"), F.col("one.n").alias("bn"))
    links = work.table("links1", links.unionByName(_confirmed(pairs, live, percent, matches)))

    # What the two rounds left apart: every pair of sets of a posting whose components differ, unless a bound rules it out.
    roots = _components(links, work, "second")
    placed = postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    rest = work.table("rest", placed.join(apart, "token", "left_semi").select("token", "node", "n", "root"))
    pairs = _open_pairs(rest.select("node", "n", "root").distinct(), live, work, percent)
    return work.table("links2", links.unionByName(_confirmed(pairs, live, percent, matches)))


def _open_pairs(nodes: DataFrame, live: DataFrame, work: Workspace, percent: int) -> DataFrame:
    """Pairs (a, an, b, bn) of different components that their full sets may still link, by exact bounds.

    A link to another component needs percent of a set's own shingles in common with one set there, so a set that
    shares fewer with all of them together is out; such sets support no others, so the bound is taken again until it
    rules out few. Each set then posts its rarest shingles, those that no other component has ranking first; a pair
    whose first common shingle comes too late in either order has too few left and is skipped.
    """
    turn, before = 0, None
    while True:
        spread = nodes.join(live.select("node", "shingles"), "node").select("node", "n", "root", F.explode("shingles").alias("s"))
        counted = spread.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("df")).where("low <> high").select("s", "df")
        mixed = work.table(f"mixed{turn}", counted)
        kept = spread.join(mixed, "s").groupBy("node").agg(F.first("n").alias("n"), F.first("root").alias("root"), F.array_sort(F.collect_list(F.struct("df", "s"))).alias("held"))
        able = work.table(f"able{turn}", kept.where(100 * F.size("held") >= percent * F.col("n")))
        left = able.count()
        if not left or before is not None and left > 0.9 * before:
            break
        before, turn, nodes = left, turn + 1, able.select("node", "n", "root")
    alone = F.col("n") - F.size("held")
    prefix = F.expr(f"slice(held, 1, greatest(0, cast(floor(n - {percent} * n / 100D) as int) + 1 - (cast(n as int) - size(held))))")
    posted = work.table("open", able.select("node", "n", "root", alone.alias("alone"), F.posexplode(prefix).alias("at", "x")).select("node", "n", "root", (F.col("alone") + F.col("at")).alias("at"), F.col("x.s").alias("s")))
    other = posted.select("s", F.col("node").alias("b"), F.col("n").alias("bn"), F.col("root").alias("broot"), F.col("at").alias("bat"))
    enough = (100 + percent) * F.least(F.col("n") - F.col("at"), F.col("bn") - F.col("bat")) >= percent * (F.col("n") + F.col("bn"))
    pairs = posted.join(other, (posted.s == other.s) & (posted.root < other.broot) & enough)
    return pairs.select(F.col("node").alias("a"), F.col("n").alias("an"), "b", "bn")


def _confirmed(pairs: DataFrame, live: DataFrame, percent: int, matches: int) -> DataFrame:
    """Pairs (a < b) whose signatures collide often enough and whose full sets are similar enough."""
    able = pairs.where((F.col("a") != F.col("b")) & (100 * F.least("an", "bn") >= percent * F.greatest("an", "bn")))
    able = able.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = live.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    right = live.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    hits = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda z: z))
    near = able.join(left, "a").join(right, "b").where(hits >= matches).select("a", "b")
    left = live.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("xa"))
    right = live.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("xb"))
    common = F.size(F.array_intersect("xa", "xb")).cast("long")
    full = near.join(left, "a").join(right, "b").withColumn("common", common)
    return full.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _components(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(node, root) of every linked node; root is the least node of its component. Alternates large and small stars."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    state, turn = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = work.table(f"{name}{turn}", small)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if turn:
            work.drop(f"{name}{turn - 1}")
        if tuple(now) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state, turn = tuple(now), turn + 1
