"""Class-based n-gram language model by exchange clustering.

Exchange clustering starts on types: the commonest words, the commonest endings of the rest, and one type for what
is left. It moves types between classes while the class bigram likelihood grows. Then a distributed round lets every
other word of the training texts leave its ending's class for the one that its own neighbours make likeliest, so that
all words have a class of their own and what is gathered grows with the vocabulary. A token's probability is that of
its class after the previous token's class and of the word in the class; both are smoothed. Common words' counts and
classes go to every task, all other words meet theirs in a join; words not met in training are in their ending's class.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.llm.common import Workspace, arrow_type, map_arrow, rows_of

#: Types that are words, types that are endings of other words, classes (at most 64), passes of exchange. They bound the bigram matrix, not the words that get a class.
WORD_TYPES, ENDING_TYPES, CLASSES, PASSES = 1000, 500, 64, 6
#: Words whose counts every task holds: so many at most, of at most so many bytes each.
COUNTED, WORD_BYTES = 50_000, 64
#: Distinct words that a task gathers before it passes their counts on.
HELD = 300_000
#: Neighbours of words that a task gathers before it passes their counts on: fewer than 2^24, as a count and a key share 31 bits.
NEIGHBOURS = 2_000_000
END = b""  # no word is empty


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def words(text: str) -> list[bytes]:
    """Runs of other bytes than space and \\t to \\r, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """The class of each type. Starts with types dealt out by frequency; each pass lets every type choose its best class."""
    n = len(bigrams)
    classes = max(1, min(classes, n))
    order = np.argsort(-(bigrams.sum(axis=0) + bigrams.sum(axis=1)), kind="stable")
    at = np.empty(n, np.int64)
    at[order] = np.arange(n) % classes
    member = np.zeros((n, classes))
    member[np.arange(n), at] = 1
    right, left = bigrams @ member, bigrams.T @ member  # of each type: counts with the class after it, before it
    table = member.T @ right
    for _ in range(passes):
        moved = 0
        for w in order:
            c, own = at[w], bigrams[w, w]
            a, b = right[w].copy(), left[w].copy()
            a[c] -= own
            b[c] -= own
            if not (a.any() or b.any() or own):
                continue
            table[c] -= a
            table[:, c] -= b
            table[c, c] -= own
            # Wherever w goes, its neighbours' classes keep its counts with them.
            rows, columns = table.sum(axis=1) + b, table.sum(axis=0) + a
            r, q = a.sum() + own, b.sum() + own
            base = _xlogx(table)
            corner = np.diagonal(table)
            gain = (_xlogx(table + a) - base).sum(axis=1) + (_xlogx(table + b[:, None]) - base).sum(axis=0)
            gain += _xlogx(corner + a + b + own) - _xlogx(corner + a) - _xlogx(corner + b) + _xlogx(corner)
            gain -= _xlogx(rows + r) - _xlogx(rows) + _xlogx(columns + q) - _xlogx(columns)
            d = int(np.argmax(gain))
            if gain[d] <= gain[c] + 1e-9:
                d = c
            table[d] += a
            table[:, d] += b
            table[d, d] += own
            if d != c:
                moved += 1
                at[w] = d
                right[:, c] -= bigrams[:, w]
                right[:, d] += bigrams[:, w]
                left[:, c] -= bigrams[w]
                left[:, d] += bigrams[w]
        if not moved:
            break
    return at


class Types:
    """The type of each word: 0 is the end of a text, then words, endings, and the rest."""

    def __init__(self, common: list[bytes], endings: list[bytes]):
        self.of_word = {END: 0} | {w: i + 1 for i, w in enumerate(common)}
        self.of_ending = {e: i + 1 + len(common) for i, e in enumerate(endings)}
        self.rest = 1 + len(common) + len(endings)
        self.size = self.rest + 1

    def of(self, found: list[bytes]) -> np.ndarray:
        out = list(map(self.of_word.get, found, repeat(-1)))
        ending, rest = self.of_ending.get, self.rest
        for i, t in enumerate(out):
            if t < 0:
                out[i] = ending(found[i][-3:], rest)
        return np.array(out, np.int64)


def _sequence(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """All tokens with an end after each text, and the number of each text's tokens."""
    found, n = [], []
    for text in texts:
        own = words(text)
        found += own
        found.append(END)
        n.append(len(own) + 1)
    return found, np.array(n, np.int64)


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()
    names = ["word", "c"]
    out = lambda: pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names)
    for (texts,) in rows_of(batches, "text"):
        held.update(_sequence(texts)[0])
        if len(held) > HELD:
            yield out()
            held.clear()
    yield out()


def _count_neighbours(batches: Iterable[pa.RecordBatch], types: Types, at: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
    """Of each word that isn't a type of its own: how often each class comes before it (keys from 0) and after it (from CLASSES), as count * 2 * CLASSES + key."""
    index: dict[bytes, int] = {}
    codes: list[np.ndarray] = []

    def out() -> Iterator[pa.RecordBatch]:
        code, n = np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        names, offsets = list(index), np.searchsorted(code, 2 * CLASSES * np.arange(len(index) + 1))
        packed = (n * 2 * CLASSES + code % (2 * CLASSES)).astype(np.int32)
        for i in range(0, len(names), 20_000):
            cut = offsets[i : i + 20_001]
            lists = pa.ListArray.from_arrays(pa.array(cut - cut[0], pa.int32()), pa.array(packed[cut[0] : cut[-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(names[i : i + 20_000], pa.binary()), lists], ["word", "near"])

    held = 0
    for (texts,) in rows_of(batches, "text"):
        found, _ = _sequence(texts)
        t = types.of(found)
        classes = at[t]
        inner = np.flatnonzero(t >= first)  # never the last token, which is an end
        own = np.fromiter((index.setdefault(found[i], len(index)) for i in inner), np.int64, len(inner)) * 2 * CLASSES
        codes += [own + np.concatenate([at[:1], classes[:-1]])[inner], own + CLASSES + classes[np.minimum(inner + 1, len(found) - 1)]]
        held += 2 * len(inner)
        if held > NEIGHBOURS or len(index) > HELD:
            yield from out()
            index.clear()
            codes.clear()
            held = 0
    yield from out()


def _choose(batches: Iterable[pa.RecordBatch], gain: np.ndarray) -> Iterator[pa.RecordBatch]:
    """word, c, class of each word; its rows follow each other. ``gain``: log-likelihood by neighbour's key and own class."""
    last, carried = None, np.zeros(2 * CLASSES)

    def rows(names: list[bytes], near: np.ndarray) -> pa.RecordBatch:
        c = near[:, :CLASSES].sum(axis=1)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(c.astype(np.int64)), pa.array(np.argmax(near @ gain, axis=1).astype(np.int32))], ["word", "c", "class"])

    for batch in batches:
        if not batch.num_rows:
            continue
        names, lists = batch.column(0).to_pylist(), batch.column(1)
        starts = [i for i, w in enumerate(names) if i == 0 or w != names[i - 1]]
        group = np.cumsum(np.isin(np.arange(len(names)), starts)) - 1
        values, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        key = np.repeat(group, sizes) * 2 * CLASSES + values % (2 * CLASSES)
        near = np.bincount(key, values // (2 * CLASSES), len(starts) * 2 * CLASSES).reshape(-1, 2 * CLASSES)
        if last == names[0]:
            near[0] += carried
        elif last is not None:
            yield rows([last], carried[None])
        if len(starts) > 1:
            yield rows([names[i] for i in starts[:-1]], near[:-1])
        last, carried = names[-1], near[-1]
    if last is not None:
        yield rows([last], carried[None])


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: Column | None = None) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    The model learns from rows that aren't held out (by default: crc32 of the id as text, mod 7, is 2; null ids are
    learned from). A null or empty text has one token, its end. Scores are log10 probabilities; perplexity is
    10 ** (-score / n_tokens). With nothing to learn from, base_score is 0 and n_known too. An empty table gives no rows.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "brown")
    out_mark = held_out(F.col(id_col)) if held is None else held
    rows = docs.select(F.col(id_col).alias("id"), out_mark.alias("held"), F.col(text_col).cast("string").alias("text"))
    texts = rows.where("not held").select("text")
    counts = work.table("counts", map_arrow(texts, _count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()

    common, common_c, _ = (x[:WORD_TYPES] for x in _commonest(counts.withColumn("class", F.lit(0))))
    named = F.broadcast(spark.createDataFrame([(bytearray(w),) for w in common], "word binary"))
    others = counts.where("length(word) > 0").join(named, "word", "left_anti")
    ending = F.when(F.length("word") <= 3, F.col("word")).otherwise(F.expr("substring(word, -3)")).alias("ending")
    by_ending = work.table("endings", others.groupBy(ending).agg(F.sum("c").alias("c")))
    best = by_ending.orderBy(F.desc("c"), "ending").limit(ENDING_TYPES).collect()
    types = Types(common, [bytes(r["ending"]) for r in best])

    def count_bigrams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(types.size * types.size, np.int64)
        for (some,) in rows_of(batches, "text"):
            found, sizes = _sequence(some)
            t = types.of(found)
            total += np.bincount(np.concatenate([[0], t[:-1]]) * types.size + t, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["pair", "n"])

    pairs = map_arrow(texts, count_bigrams, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    bigrams = np.zeros(types.size * types.size)
    bigrams[pairs["pair"].to_numpy()] = pairs["n"].to_numpy()
    del pairs
    bigrams = bigrams.reshape(types.size, types.size)
    at = exchange(bigrams)

    first = 1 + len(common)
    table = np.zeros((CLASSES, CLASSES))
    np.add.at(table, (at[:, None], at[None, :]), bigrams)
    log_move = _log_moves(table)
    log_in = np.log10(table.sum(axis=0) + 1)  # a word's share of its class shrinks as the class grows
    gain = np.concatenate([log_move - log_in, log_move.T])
    del bigrams
    found = map_arrow(texts, lambda batches: _count_neighbours(batches, types, at, first), "word binary, near array<int>")
    found = map_arrow(found.repartition("word").sortWithinPartitions("word"), lambda batches: _choose(batches, gain), "word binary, c long, class int")
    own = [(bytearray(w), int(c), int(at[i + 1])) for i, (w, c) in enumerate(zip(common, common_c))]
    if n_end := _end_count(counts):
        own.append((bytearray(END), int(n_end), int(at[0])))
    vocabulary = work.table("vocabulary", found.unionByName(spark.createDataFrame(own, found.schema)))
    work.drop("counts", "endings")

    # A class holds its words, each counted once more, and a place for words not met by each ending that is in it.
    mass = np.bincount(at[first:], minlength=CLASSES).astype(float)
    for r in vocabulary.groupBy("class").agg(F.sum(F.col("c") + 1).alias("c")).collect():
        mass[r["class"]] += r["c"]
    log_mass = np.log10(np.maximum(mass, 1))
    words_, counts_, classes_ = _commonest(vocabulary)
    if n_end:
        words_, counts_, classes_ = [*words_, END], [*counts_, n_end], [*classes_, int(at[0])]
    model = spark.sparkContext.broadcast((types, at, {w: i for i, w in enumerate(words_)}, np.array([*counts_, 0], np.float64), np.array([*classes_, 0], np.uint8)))

    id_name = dict(rows.dtypes)["id"]
    id_type = arrow_type(rows, "id")

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, at, index, counted, classed = model.value
        for ids, flags, some in rows_of(batches, "id", "held", "text"):
            found, sizes = _sequence(some)
            place = np.array(list(map(index.get, found, repeat(-1))), np.int64)
            logs, classes = np.log10(counted[place] + 1), classed[place]
            rare = np.flatnonzero(place < 0)
            missing = [found[i] for i in rare]
            classes[rare] = at[types.of(missing)]
            ends = np.cumsum(sizes)
            starts = ends - sizes
            add = lambda x: np.add.reduceat(x, starts)
            row = np.searchsorted(ends, rare, side="right")
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(some)))]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (pa.array(missing, pa.binary()), pa.array(rare - starts[row], pa.int32()))]
            data = classes.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(flags, pa.bool_()), pa.array(sizes, pa.int64()), pa.array(add((place >= 0).astype(np.int64)), pa.int64()), pa.array(add(logs)), pa.array([data[a:b] for a, b in zip(starts, ends)], pa.binary()), *lists],
                ["id", "held", "n_tokens", "known", "logs", "classes", "rare", "spots"],
            )

    schema = f"id {id_name}, held boolean, n_tokens long, known long, logs double, classes binary, rare array<binary>, spots array<int>"
    scored = work.table("scored", map_arrow(rows, apply, schema).withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "spots")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.spots").alias("spot"))
    met = rare.join(vocabulary, "word").select("row", F.log10(F.col("c") + 1).alias("log"), (F.col("spot").cast("long") * CLASSES + F.col("class")).alias("at"))
    more = met.groupBy("row").agg(F.count(F.lit(1)).alias("more"), F.sum("log").alias("more_logs"), F.collect_list("at").alias("spots"))
    both = scored.drop("rare", "spots").join(more, "row", "left")
    both = both.select("id", "held", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("known"), (F.col("logs") + F.coalesce("more_logs", F.lit(0.0))).alias("logs"), "spots", "classes")

    def patch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spots, classes in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist()):
                if spots:
                    own, x = np.frombuffer(classes, np.uint8).copy(), np.array(spots, np.int64)
                    own[x // CLASSES] = x % CLASSES
                    classes = own.tobytes()
                out.append(classes)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(out, pa.binary())], ["id", "held", "n_tokens", "known", "logs", "classes"])

    lines = work.table("lines", map_arrow(both, patch, f"id {id_name}, held boolean, n_tokens long, known long, logs double, classes binary"))
    work.drop("scored", "vocabulary")

    def count_moves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            seen = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).astype(np.int64)
            total += np.bincount(np.concatenate([at[:1], seen[:-1]]) * CLASSES + seen, minlength=len(total)) if len(seen) else 0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["pair", "n"])

    table = np.zeros(CLASSES * CLASSES)
    for r in map_arrow(lines.where("not held").select("classes"), count_moves, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        table[r["pair"]] = r["n"]
    step = _log_moves(table.reshape(CLASSES, CLASSES)) - log_mass

    def total_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for logs, classes in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                own = np.frombuffer(classes, np.uint8)
                sums.append(logs + float(step[np.concatenate([at[:1], own[:-1]]), own].sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sums, pa.float64())], ["id", "held", "n_tokens", "known", "logs", "score"])

    done = map_arrow(lines, total_of, f"id {id_name}, held boolean, n_tokens long, known long, logs double, score double")
    total = float(np.log10(n + v + 1))
    return done.select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", F.col("known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * total).alias("base_score"), "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def _log_moves(table: np.ndarray) -> np.ndarray:
    """Smoothed log10 shares of classes after a class, drawn to the classes' own shares."""
    share = (table.sum(axis=0) + 1) / (table.sum() + len(table))
    return np.log10((table + share) / (table.sum(axis=1, keepdims=True) + 1))


def _commonest(counts: DataFrame) -> tuple[list[bytes], list[int], list[int]]:
    """The commonest words, their counts and classes, largest count first. A histogram of the counts finds from which on they are few enough."""
    real = counts.where(F.length("word").between(1, WORD_BYTES)).withColumn("step", F.floor(20 * F.log("c")))
    total, least = 0, 0
    for step, n in real.groupBy("step").count().orderBy(F.desc("step")).collect():  # at most 20 ln(largest count) rows
        if total + n > COUNTED:
            break
        total, least = total + n, step
    if not total:
        return [], [], []
    found = real.where(F.col("step") >= least).select("word", "c", "class").toArrow()
    order = sorted(zip(*(found[x].to_pylist() for x in ("word", "c", "class"))), key=lambda x: (-x[1], x[0]))
    return tuple(map(list, zip(*order)))


def _end_count(counts: DataFrame) -> int:
    row = counts.where("length(word) = 0").first()
    return row["c"] if row else 0
