"""Importance resampling towards a target distribution of hashed word runs.

Two passes of Arrow batches. The first turns every partition into one vector of bucket counts; the vectors, as long as
there are buckets, are added up by a tree of tasks. The second looks each run's bucket up in the gains (a broadcast of
as many numbers as there are buckets) and sums them up for each document.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustloom.llm.common import Workspace, arrow_type, map_arrow, rows_of, text_of

#: Bytes of a text that are split into words at once.
SLICE = 4_000_000
#: Runs whose buckets a worker keeps.
CACHE = 300_000
#: A-Z in lower case; bytes that are no part of a word become spaces. Bytes from 0x80 belong to words.
_LOWER = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def word_slices(text: str, slice_bytes: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size (a longer word is whole in one of them)."""
    data = text.encode("utf-8", "surrogatepass").translate(_LOWER)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + slice_bytes) if len(data) - start > slice_bytes else -1
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end + 1


class Hasher:
    """Buckets of the runs of ``least`` to ``most`` consecutive words; keeps the buckets of runs it has met lately."""

    def __init__(self, buckets: int, least: int, most: int, slice_bytes: int = SLICE):
        self.buckets, self.least, self.most, self.slice_bytes = buckets, least, most, slice_bytes
        self.known: dict[bytes, int] = {}

    def runs(self, text: str) -> Iterator[list[bytes]]:
        """Lists of the text's runs; one that goes from a slice to the next is met once."""
        tail: list[bytes] = []
        for words in word_slices(text, self.slice_bytes):
            if self.least == self.most == 1:
                yield words
                continue
            held, words = len(tail), tail + words
            for n in range(self.least, self.most + 1):
                first = max(0, held - n + 1)  # runs that end before it were in the slice before
                yield [b" ".join(words[i : i + n]) for i in range(first, len(words) - n + 1)]
            tail = words[max(0, len(words) - self.most + 1) :] if self.most > 1 else []

    def of(self, runs: Iterable[bytes]) -> Iterator[int]:
        """The bucket of each run."""
        known, buckets = self.known, self.buckets
        if len(known) > CACHE:
            known.clear()
        for run in runs:
            b = known.get(run)
            if b is None:
                b = zlib.crc32(run) % buckets
                if len(run) <= 64:
                    known[run] = b
            yield b


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = 10_000, least: int = 1, most: int = 1) -> np.ndarray:
    """How many runs of all whole texts fall into each bucket: a vector for each partition, merged by treeReduce.

    Null texts have none; an empty table gives zeros.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(buckets, least, most), np.zeros(buckets, np.int64)
        for (texts,) in rows_of(batches, "text"):
            met: Counter[bytes] = Counter()
            for text in texts:
                for runs in hasher.runs(text):
                    met.update(runs)
                if len(met) > CACHE:
                    total += _counted(hasher, met)
                    met.clear()
            total += _counted(hasher, met)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    parts = map_arrow(docs.select(text_of(text_col).alias("text")), run, "counts binary")
    vectors = parts.rdd.map(lambda row: np.frombuffer(row[0], np.int64))
    parted = vectors.getNumPartitions()
    # About a hundred vectors meet in a task of the tree, however many partitions there are.
    depth = max(2, math.ceil(math.log(max(parted, 2), 100)))
    return vectors.treeReduce(lambda a, b: a + b, depth) if parted else np.zeros(buckets, np.int64)


def _counted(hasher: Hasher, met: Counter) -> np.ndarray:
    if not met:
        return np.zeros(hasher.buckets, np.int64)
    at = np.fromiter(hasher.of(met), np.int64, len(met))
    # Weights are doubles: whole numbers below 2^53 stay exact.
    return np.bincount(at, np.fromiter(met.values(), np.float64, len(met)), hasher.buckets).astype(np.int64)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of how much likelier a bucket is in the target than in the source), with one added to each count."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1) * (s_all + n)) / ((s + 1) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", least: int = 1, most: int = 1) -> DataFrame:
    """One row per input row: id, n_words, n_features, weight (the floored mean of its runs' gains; 0 without runs).

    A null text counts as empty. Long texts are read in slices of words. Null and repeated ids pass through, each row by itself.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    id_type, buckets = arrow_type(rows, "id"), len(gain)
    shared = docs.sparkSession.sparkContext.broadcast(gain.astype(np.float64))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, gained = Hasher(buckets, least, most), shared.value
        for ids, texts in rows_of(batches, "id", "text"):
            n = len(ids)
            n_words, n_features, sums = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
            held: list[bytes] = []
            owners: list[tuple[int, int]] = []  # document, runs

            def add() -> None:
                nonlocal sums
                owner = np.repeat(np.array([o for o, _ in owners], np.int64), np.array([k for _, k in owners], np.int64))
                sums += np.bincount(owner, gained[np.fromiter(hasher.of(held), np.int64, len(held))], n)
                held.clear()
                owners.clear()

            for i, text in enumerate(texts):
                if least != 1:
                    n_words[i] = sum(map(len, word_slices(text)))
                for k, runs in enumerate(hasher.runs(text)):
                    n_features[i] += len(runs)
                    if least == 1 and k % most == 0:  # the first list of each slice are its words
                        n_words[i] += len(runs)
                    held += runs
                    owners.append((i, len(runs)))
                    if len(held) > CACHE:
                        add()
            if held:
                add()
            weight = np.floor_divide(sums.astype(np.int64), np.maximum(n_features, 1))
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(n_words), pa.array(n_features), pa.array(weight)], ["id", "n_words", "n_features", "weight"])

    return map_arrow(rows, run, f"id {dict(rows.dtypes)['id']}, n_words long, n_features long, weight long").withColumnRenamed("id", id_col)


def noise(key: Column, seed: int) -> Column:
    """A Gumbel variate in thousandths, the same for a key in every run."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    buckets: int = 10_000, least: int = 1, most: int = 1, least_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """One row per input row: id, n_features, weight, score, rank (from 1 among the drawn; null for the others).

    Of the N rows with ``least_words`` words or more, the floor(percent * N / 100) highest scores are drawn, which is a
    draw without replacement in proportion to exp(weight / 1000). Ties go to the smaller id; a null id comes after all
    others and has the noise of an empty one; of rows that repeat id and score any order holds. A null text counts as
    empty: no words, weight 0. Long texts are read whole. An empty table gives no rows, an empty target even gains.
    Other columns are not read.

    A score is a whole number of thousandths between the logarithms' bounds, so there are at most some 100,000 of them
    at any size; their counts, not the rows, are what the driver ranks.
    """
    work = Workspace(docs.sparkSession, "importance")
    gain = gains(bucket_counts(docs, text_col, buckets, least, most), bucket_counts(target, target_col, buckets, least, most))
    scored = weights(docs, gain, id_col, text_col, least, most).withColumn("score", F.col("weight") + noise(F.col(id_col), seed))
    scored = work.table("scored", scored.withColumn("fit", F.col("n_words") >= least_words).withColumnRenamed(id_col, "id"))

    by_score = scored.where("fit").groupBy("score").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("score", ascending=False)
    n = by_score["n"].to_numpy(np.int64)
    draw = percent * int(n.sum()) // 100
    above = np.cumsum(n) - n
    reached = above < draw
    cut = int(by_score["score"][reached].min()) if draw else None
    out = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select(*out, undrawn)
    before = docs.sparkSession.createDataFrame(pd.DataFrame({"at": by_score["score"][reached].to_numpy(np.int64), "before": above[reached]}), "at long, before long")
    high = F.col("fit") & (F.col("score") >= cut)
    # A score's rows differ in their ids' noise, so that the rows of one score stay a small share at any size.
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last()))
    drawn = scored.where(high).join(F.broadcast(before), F.col("score") == F.col("at")).withColumn("rank", F.col("before") + place)
    return drawn.select(*out, F.when(F.col("rank") <= draw, F.col("rank")).alias("rank")).unionByName(scored.where(~high).select(*out, undrawn))


#: CRC-32 of each distinct word, byte by byte, is worked out in SQL too.
ORACLE_SQL = """
WITH steps AS (SELECT range AS i FROM range(256)),
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i::BIGINT], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM steps)),
words AS (
  SELECT 0 AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT 1, NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark),
counted AS (SELECT side, id, word, count(*) AS n FROM words GROUP BY ALL),
hexed AS (SELECT DISTINCT word, hex(encode(word)) AS x FROM counted),
hashed AS (
  SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(x), 2), lambda k: ('0x' || substr(x, k, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM hexed, crc_table),
placed AS (SELECT side, id, bucket, n FROM counted JOIN hashed USING (word)),
sums AS (SELECT range AS bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM range(10000)
  LEFT JOIN (SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM placed GROUP BY bucket) p ON p.bucket = range),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM sums),
weighed AS (SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weighed ON id = doc_id),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS fit FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * fit // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (doc_id)"""
