"""Exact top-k search by inner product: columnar branch-and-bound.

Vectors are stored in blocks, dimension by dimension. A query meets a block a few dimensions at a time, its own largest
ones first. After each step a candidate's score is at most what it has gathered plus the product of what is left of
both lengths (Cauchy and Schwarz); candidates whose bound is below the query's k-th best score are compacted away.

Queries come in blocks as well. A pass broadcasts query blocks of bounded size and scans the candidate blocks once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustloom.llm.common import Workspace, map_arrow

#: Bytes of a candidate block while it is searched (doubles), and of the query blocks that a pass broadcasts.
BLOCK_BYTES, PASS_BYTES = 4 << 20, 16 << 20
#: Queries in a block, dimensions in a step.
QUERY_ROWS, STEP = 512, 8
_NONE = np.iinfo(np.int64).min
_TOP = (1 << 31) - 1


def quantised(vectors: DataFrame, id_col: str, vector_col: str, asked: Column, scale: int) -> DataFrame:
    """id, asked, v: floor(scale * x) of each component, of rows whose vector and components are there and finite."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.greatest(F.least(F.floor(scale * c), F.lit(_TOP)), F.lit(-_TOP)))
    return vectors.where(x.isNotNull() & whole).select(F.col(id_col).cast("long").alias("id"), F.coalesce(asked, F.lit(False)).alias("asked"), v.alias("v"))


def _blocks(rows: DataFrame, dims: int, limit: int, kind: str, size: int) -> DataFrame:
    """Rows in vertical blocks: block, ids, asked (positions), matrix (dims x n). A shorter vector's missing components are 0."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, asked, vectors = [], [], []

        def block() -> pa.RecordBatch:
            nonlocal number
            matrix = np.zeros((len(vectors), dims), kind)
            for i, v in enumerate(vectors):
                matrix[i, : len(v)] = np.clip(v, -limit, limit)
            out = pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), pa.array([[i for i, a in enumerate(asked) if a]], pa.list_(pa.int32())), pa.array([np.ascontiguousarray(matrix.T).tobytes()], pa.binary())],
                ["block", "ids", "asked", "matrix"],
            )
            number += 1
            ids.clear(), asked.clear(), vectors.clear()
            return out

        for batch in batches:
            ends = batch.column("v").offsets.to_numpy()
            values = batch.column("v").values.to_numpy()
            for i, (key, ask) in enumerate(zip(batch.column("id").to_pylist(), batch.column("asked").to_pylist())):
                ids.append(key)
                asked.append(ask)
                vectors.append(values[ends[i] : ends[i + 1]].copy())
                if len(ids) == size:
                    yield block()
        if ids:
            yield block()

    return map_arrow(rows, pack, "block long, ids array<long>, asked array<int>, matrix binary")


class Candidates:
    """A block, ready to be searched."""

    def __init__(self, block: int, ids: list, matrix: bytes, kind: str, dims: int, exact_doubles: bool):
        self.block = block
        self.null = np.array([x is None for x in ids])
        self.ids = np.array([x or 0 for x in ids], np.int64)
        # Whole numbers in doubles are exact below 2^53, and are multiplied faster.
        self.m = np.frombuffer(matrix, kind).reshape(dims, len(ids)).astype(np.float64 if exact_doubles else np.int64)
        self.squares = self.m * self.m
        self.mass = self.squares.sum(0)

    def search(self, q: np.ndarray, floor: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of all candidates that may reach ``floor``; those whose bound is below it are left out."""
        order = np.argsort(-np.abs(q), kind="stable")
        left = int((q.astype(object) ** 2).sum()) if self.m.dtype == np.int64 else float((q * q).sum())
        at = np.arange(self.m.shape[1])
        score, mass = np.zeros(len(at), self.m.dtype), self.mass
        whole = True  # nothing is compacted yet
        for start in range(0, len(order), STEP):
            dims = order[start : start + STEP]
            part = self.m[dims] if whole else self.m[dims[:, None], at]
            score = score + q[dims] @ part
            mass = mass - (self.squares[dims] if whole else self.squares[dims[:, None], at]).sum(0)
            left -= sum(int(x) ** 2 for x in q[dims])
            if floor == _NONE:
                continue
            # One more than the rounded bound: rounding never drops a candidate.
            keep = score + (np.sqrt(mass.astype(np.float64)) * (math.sqrt(left) * (1 + 1e-9)) + 1) >= floor
            if not keep.all():
                at, score, mass, whole = at[keep], score[keep], mass[keep], False
                if not len(at):
                    break
        exact = score.astype(np.int64)
        keep = exact >= floor
        if skip >= 0:
            keep &= at != skip
        return at[keep], exact[keep]


class Best:
    """The k best of what a query has met: highest score first, ties to the smaller id, null ids last."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.score, self.null, self.id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        score, null, ids = np.concatenate([self.score, score]), np.concatenate([self.null, null]), np.concatenate([self.id, ids])
        if len(score) > self.k:
            least = np.partition(score, len(score) - self.k)[len(score) - self.k]
            near = score >= least
            score, null, ids = score[near], null[near], ids[near]
        first = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.null, self.id = score[first], null[first], ids[first]
        if len(self.score) == self.k:
            self.floor = max(self.floor, int(self.score[-1]))


def _query_blocks(asked: DataFrame, seed: dict | None, k: int, kind: str, dims: int, doubles: bool) -> DataFrame:
    """Blocks of queries with a floor for each: its k-th best score over the seed block, which the final one can't be below."""
    rows_each = QUERY_ROWS

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        known = Candidates(seed["block"], seed["ids"], seed["matrix"], kind, dims, doubles) if seed else None
        held: list[dict] = []

        def block() -> pa.RecordBatch:
            nonlocal number
            floors = []
            for row in held:
                best = Best(k, _NONE)
                if known:
                    at, score = known.search(np.frombuffer(row["q"], kind).astype(known.m.dtype), _NONE, row["place"] if row["block"] == known.block else -1)
                    best.add(score, known.null[at], known.ids[at])
                floors.append(best.floor)
            out = pa.RecordBatch.from_arrays(
                [pa.array([number]), *(pa.array([[row[c] for row in held]], pa.list_(pa.int64())) for c in ("id", "block", "place")), pa.array([floors], pa.list_(pa.int64())), pa.array([b"".join(row["q"] for row in held)], pa.binary())],
                ["query_block", "query_ids", "of_blocks", "places", "floors", "queries"],
            )
            number += 1
            held.clear()
            return out

        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == rows_each:
                    yield block()
        if held:
            yield block()

    return map_arrow(asked, pack, "query_block long, query_ids array<long>, of_blocks array<long>, places array<long>, floors array<long>, queries binary")


def _asked(blocks: DataFrame, kind: str, dims: int) -> DataFrame:
    """The queries of all blocks, one a row: id, block, place, q."""

    def take(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = row["asked"]
                if at:
                    matrix = np.frombuffer(row["matrix"], kind).reshape(dims, len(row["ids"]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["ids"][i] for i in at], pa.int64()), pa.array([row["block"]] * len(at), pa.int64()), pa.array(at, pa.int64()), pa.array([np.ascontiguousarray(matrix[:, i]).tobytes() for i in at], pa.binary())],
                        ["id", "block", "place", "q"],
                    )

    return map_arrow(blocks, take, "id long, block long, place long, q binary")


def _scan(pairs: DataFrame, k: int, kind: str, dims: int, doubles: bool) -> DataFrame:
    """Pairs of a candidate and a query block to the k best of each query that a task has met."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, list[Best]] = {}
        names: dict[int, tuple[list, list, list]] = {}
        here: Candidates | None = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                block, group = row["block"].as_py(), row["query_block"].as_py()
                if here is None or here.block != block:
                    here = Candidates(block, row["ids"].as_py(), row["matrix"].as_py(), kind, dims, doubles)
                if group not in met:
                    met[group] = [Best(k, f) for f in row["floors"].as_py()]
                    names[group] = tuple(row[c].as_py() for c in ("query_ids", "of_blocks", "places"))
                qs = np.frombuffer(row["queries"].as_py(), kind).reshape(-1, dims).astype(here.m.dtype)
                for q, best, of, place in zip(qs, met[group], *names[group][1:]):
                    at, score = here.search(q, best.floor, place if of == block else -1)
                    if len(at):
                        best.add(score, here.null[at], here.ids[at])
        for group, bests in met.items():
            out: list[list] = [[], [], [], [], []]
            for key, of, place, best in zip(*names[group], bests):
                for score, null, vec in zip(best.score.tolist(), best.null.tolist(), best.id.tolist()):
                    for column, value in zip(out, (key, of, place, None if null else vec, score)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["query_id", "of_block", "place", "vec_id", "score"])

    return map_arrow(pairs, run, "query_id long, of_block long, place long, vec_id long, score long")


def top_k(vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", asked: Column | None = None, scale: int = 1024) -> DataFrame:
    """The k highest scores of each query over all other rows: query_id, rank (from 1), vec_id, score; all, if there are fewer.

    Queries are the rows where ``asked`` holds (ids divisible by 100), candidates all rows but the query's own. Ids are
    whole numbers; a null one is no query by default, and as a candidate comes after all others of its score. Of rows
    that repeat an id each is a query and a candidate by itself. Vectors that are null or hold null or non-finite
    components take no part; one that is shorter than others counts as zero beyond its end. Components saturate where
    scores wouldn't fit in 64 bits (at sqrt(2^63 / dimensions), 2^31 at most). Without vectors, or with one alone, there
    are no rows. Other columns aren't read.
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "topk")
    asked = (F.col(id_col).cast("long") % 100 == 0) if asked is None else asked
    rows = quantised(vectors, id_col, vector_col, asked, scale)
    most = rows.agg(F.max(F.size("v")).alias("dims"), F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x)))).alias("top")).first()
    dims = max(1, most["dims"] or 0)
    limit = math.isqrt(((1 << 63) - 1) // dims)
    top = min(limit, most["top"] or 0)
    kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"
    doubles = dims * top * top < 1 << 53
    size = max(64, min(8192, BLOCK_BYTES // (8 * dims)))
    blocks = work.table("blocks", _blocks(rows, dims, limit, kind, size))

    queries = work.table("queries", _asked(blocks.where(F.size("asked") > 0), kind, dims))
    count = queries.count()
    seed = blocks.orderBy("block").limit(1).collect()  # one block of BLOCK_BYTES at most
    groups = -(-count // QUERY_ROWS)
    dealt = queries.repartition(max(1, groups), "block", "place")
    packed = work.table("query_blocks", _query_blocks(dealt, seed[0].asDict() if seed else None, k, kind, dims, doubles))
    row_bytes = np.dtype(kind).itemsize * dims + 32
    slots = packed.agg(F.sum(F.size("query_ids")).alias("n"), F.count(F.lit(1)).alias("blocks")).first()
    passes = max(1, -(-int(slots["n"] or 0) * row_bytes // PASS_BYTES))
    packed = packed.withColumn("pass", F.pmod(F.xxhash64("query_block"), F.lit(passes)))
    candidates = blocks.select("block", "ids", "matrix")
    for p in range(passes):
        asking = F.broadcast(packed.where(F.col("pass") == p).drop("pass"))
        # The stated query set against all rows, in blocks.
        _scan(candidates.crossJoin(asking), k, kind, dims, doubles).write.mode("overwrite").parquet(work.path(f"found/pass={p}"))
    found = spark.read.schema("query_id long, of_block long, place long, vec_id long, score long").parquet(*(work.path(f"found/pass={p}") for p in range(passes)))
    place = F.row_number().over(Window.partitionBy("of_block", "place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH ints AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.row AS row, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM ints q JOIN ints c ON q.row <> c.row WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""
