"""Best-fit packing by a grouping genetic algorithm.

Documents are tokenized and cut into pieces of at most one sequence. Pieces are dealt into blocks by hash;
each block is evolved on several islands, a task each: crossover injects whole well-filled bins of one parent
into the other, bins with duplicates are removed, and their displaced pieces are best-fitted. Between rounds
each island's best packing migrates to the next island of the ring. The least-filled bins of all blocks are
then opened and packed again across blocks, until one block holds what is open.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.llm.bpe_arrays import Vocabulary, ragged
from gustloom.llm.common import Lately, Workspace, arrow_type, map_arrow, rows_of

SEQUENCE, END = 4096, 1
#: Pieces per block, islands per block, rounds of migration, packings per island, crossovers per round.
BLOCK, ISLANDS, ROUNDS, POPULATION, CROSSOVERS = 2048, 2, 2, 4, 16
#: Of each block's bins, one in so many at most (and one at least) is opened for packing across blocks, if it isn't as full as FULL.
OPENED, FULL = 4, 0.99
#: Pre-tokens that a worker keeps, in two halves; characters that it encodes at once.
CACHE, RANGE = 300_000, 2_000_000


class Encoder:
    """Token ids of texts; keeps the pre-tokens it has met lately."""

    def __init__(self, path: str, cache: int = CACHE):
        self.vocabulary, self.known = Vocabulary(path), Lately(cache)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the number of each. Special strings inside a text are special tokens, as the library has them."""
        which, distinct, sizes = self.vocabulary.split(texts)
        return ragged(self.known.of(distinct, self._learn), which, sizes, "<u4")

    def _learn(self, new: list[str]) -> list[bytes]:
        special = self.vocabulary.special
        plain = [x for x in new if x not in special]
        ids, counts = self.vocabulary.encode_pieces(plain) if plain else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        own = dict(zip(plain, (data[a:b] for a, b in zip([0, *ends], ends))))
        return [own[x] if x in own else special[x].to_bytes(4, "little") for x in new]


_encoders: dict[str, Encoder] = {}


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = SEQUENCE, end: int = END) -> DataFrame:
    """id, piece, start, length and token_ids (binary, little-endian 32-bit) of every document's pieces.

    A null text is empty: one piece, its end. Long texts are encoded whole and cut. Null and repeated ids pass through,
    each row by itself; an empty table gives no rows. Other columns aren't read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_name = dict(rows.dtypes)["id"]
    id_type = arrow_type(rows, "id")
    last = np.array([end], "<u4")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        for keys, texts in rows_of(batches, "id", "text", limit=RANGE):
            ids, counts = _encoders[path].encode(texts)
            ends = np.cumsum(counts)
            ids, counts = np.insert(ids, ends, last), counts + 1
            # Each text's pieces: full ones, then the rest.
            cut = -(-counts // capacity)
            owner = np.repeat(np.arange(len(texts)), cut)
            number = np.arange(len(owner)) - (np.cumsum(cut) - cut)[owner]
            start = number * capacity
            length = np.minimum(counts[owner] - start, capacity)
            offsets = pa.array(np.concatenate([[0], 4 * np.cumsum(length)]), pa.int32())
            data = pa.Array.from_buffers(pa.binary(), len(owner), [None, offsets.buffers()[1], pa.py_buffer(ids.astype("<u4"))])
            yield pa.RecordBatch.from_arrays([pa.array(keys, id_type).take(pa.array(owner)), pa.array(number, pa.int32()), pa.array(start), pa.array(length), data], ["id", "piece", "start", "length", "token_ids"])

    return map_arrow(rows, run, f"id {id_name}, piece int, start long, length long, token_ids binary")


def best_fit(order: Iterable[int], sizes: list[int], bins: list[list[int]], free: list[int], capacity: int) -> None:
    """Put each piece into the bin that it fills best; open a bin where none has room."""
    room = sorted((f, i) for i, f in enumerate(free) if f > 0)
    for x in order:
        k = bisect.bisect_left(room, (sizes[x], -1))
        if k < len(room):
            f, i = room.pop(k)
            bins[i].append(x)
            free[i] = f - sizes[x]
        else:
            i = len(bins)
            bins.append([x])
            free.append(capacity - sizes[x])
        if free[i]:
            bisect.insort(room, (free[i], i))


def fitness(free: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the mean square of the fill: full bins beside empty ones beat even ones."""
    fill = 1 - np.asarray(free) / capacity
    return -len(free), float(np.mean(fill * fill))


def crossover(a: tuple[list, list], b: tuple[list, list], sizes: list[int], capacity: int, draw: np.random.Generator) -> tuple[list, list]:
    """Inject some of b's best-filled bins into a; bins of a with duplicates go, and their other pieces are best-fitted."""
    order = np.argsort(b[1], kind="stable")[: max(1, len(b[0]) // 2)]
    chosen = order[draw.random(len(order)) < 0.5]
    injected = [b[0][i] for i in chosen]
    taken = {x for bin_ in injected for x in bin_}
    bins, free, displaced = [list(x) for x in injected], [b[1][i] for i in chosen], []
    for bin_, f in zip(*a):
        if taken.isdisjoint(bin_):
            bins.append(list(bin_))
            free.append(f)
        else:
            displaced += [x for x in bin_ if x not in taken]
    best_fit(sorted(displaced, key=sizes.__getitem__, reverse=True), sizes, bins, free, capacity)
    return bins, free


def evolve(sizes: list[int], capacity: int, seed: int, starts: list[list[int]]) -> list[int]:
    """The bin of each piece in the best packing found. ``starts``: packings that migrated here."""
    draw, n = np.random.default_rng(seed), len(sizes)
    bound = -(-sum(sizes) // capacity)
    population = []
    for given in starts:
        bins: list[list[int]] = [[] for _ in range(max(given) + 1)]
        for x, i in enumerate(given):
            bins[i].append(x)
        population.append((bins, [capacity - sum(sizes[x] for x in b) for b in bins]))
    spread = 0.0 if not starts else 0.1
    while len(population) < POPULATION and not any(len(p[0]) <= bound for p in population):
        noise = 1 + spread * draw.standard_normal(n)
        bins, free = [], []
        best_fit(np.argsort(-(np.asarray(sizes) * noise), kind="stable").tolist(), sizes, bins, free, capacity)
        population.append((bins, free))
        spread += 0.05
    population.sort(key=lambda p: fitness(p[1], capacity), reverse=True)
    for _ in range(CROSSOVERS):
        if len(population[0][0]) <= bound:  # no packing has fewer bins
            break
        a, b = draw.choice(len(population), 2, replace=False)
        child = crossover(population[a], population[b], sizes, capacity, draw)
        if fitness(child[1], capacity) > fitness(population[-1][1], capacity):
            population[-1] = child
            population.sort(key=lambda p: fitness(p[1], capacity), reverse=True)
    out = [0] * n
    for i, bin_ in enumerate(population[0][0]):
        for x in bin_:
            out[x] = i
    return out


def _pack_blocks(items: DataFrame, blocks: int, capacity: int, work: Workspace, name: str) -> DataFrame:
    """(block, bin, row, length) of the best island of each block."""
    dealt = items.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
    state = dealt.select("*", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.lit(None).cast("int").alias("bin"), F.lit(0).alias("origin"))

    def island(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block, number = key
        rows = rows.sort_values(["origin", "row"])
        own = rows[rows["origin"] == 0]
        starts = [g["bin"].astype(int).tolist() for _, g in rows.groupby("origin") if g["bin"].notna().all()]
        sizes = own["length"].tolist()
        bins = evolve(sizes, capacity, 1_000_003 * int(block) + int(number), starts)
        fill = np.bincount(bins, sizes)
        score = -len(fill) + float(np.mean((fill / capacity) ** 2)) / 2
        return pd.DataFrame({"block": block, "island": number, "row": own["row"].to_numpy(), "length": own["length"].to_numpy(), "bin": np.asarray(bins, np.int32), "score": score})

    schema = "block long, island int, row long, length long, bin int, score double"
    for turn in range(ROUNDS):
        if turn:
            settled = ["row", "length", "block", "island", "bin"]
            migrants = packed.select("row", "length", "block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), "bin", F.lit(1).alias("origin"))
            state = packed.select(*settled, F.lit(0).alias("origin")).unionByName(migrants)
        packed = work.table(f"{name}-{turn}", state.groupBy("block", "island").applyInPandas(island, schema))
        if turn:
            work.drop(f"{name}-{turn - 1}")
    best = packed.groupBy("block").agg(F.max(F.struct("score", -F.col("island"))).alias("x")).select("block", (-F.col("x.col2")).alias("island"))
    return packed.join(best, ["block", "island"]).select("block", "bin", "row", "length")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = SEQUENCE, end: int = END, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per piece: id, piece, start, length, token_ids (binary, little-endian 32-bit), sequence_id, offset.

    ``carry`` names what each piece has in place of its token_ids, as expressions over them.

    Only documents longer than a sequence are cut; no two pieces of a sequence overlap and none leaves a gap. A null
    or empty text is one piece, its end token. Repeated rows are packed each. An empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "pack")
    carry = {"token_ids": F.col("token_ids")} if carry is None else carry
    cut = pieces(docs, path, id_col, text_col, capacity, end).select("id", "piece", "start", "length", *(c.alias(f"carry{i}") for i, c in enumerate(carry.values())))
    table = work.table("pieces", cut.withColumn("row", F.monotonically_increasing_id()))
    whole = table.where(F.col("length") == capacity).select("row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed, items, level = [whole], table.where(F.col("length") < capacity).select("row", "length"), 0
    while (count := items.count()) > 0:
        blocks = -(-count // BLOCK)
        best = work.table(f"best{level}", _pack_blocks(items, blocks, capacity, work, f"level{level}"))
        work.drop(f"level{level}-{ROUNDS - 1}")
        bins = best.groupBy("block", "bin").agg(F.sum("length").alias("fill"))
        if blocks > 1:
            # The least-filled bins of each block go on; a block has a bounded number of bins.
            sizes = bins.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("fill", "bin"))).alias("all"))
            opened = sizes.select("block", F.explode(F.expr(f"slice(all, 1, greatest(1, size(all) div {OPENED}))")).alias("x")).where(F.col("x.fill") < FULL * capacity).select("block", F.col("x.bin").alias("bin"))
            closed, items = best.join(opened, ["block", "bin"], "left_anti"), best.join(opened, ["block", "bin"], "left_semi").select("row", "length")
        else:
            closed, items = best, items.limit(0)
        # A bin's pieces lie one after the other; a bin holds at most ``capacity`` of them.
        held = closed.groupBy("block", "bin").agg(F.array_sort(F.collect_list(F.struct("row", "length"))).alias("held"))
        spot = F.expr("transform(held, (x, i) -> named_struct('row', x.row, 'offset', aggregate(slice(held, 1, i), 0L, (s, y) -> s + y.length)))")
        number = (F.lit(level).cast("long") * (1 << 56) + F.col("block") * (1 << 16) + F.col("bin")).alias("sequence_id")
        placed.append(held.select(number, F.explode(spot).alias("x")).select("x.row", "sequence_id", F.col("x.offset").alias("offset")))
        level += 1
    places = placed[0]
    for part in placed[1:]:
        places = places.unionByName(part)
    return table.join(places, "row").select(F.col("id").alias(id_col), "piece", "start", "length", *(F.col(f"carry{i}").alias(n) for i, n in enumerate(carry)), "sequence_id", "offset")
