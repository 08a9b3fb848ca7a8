"""Top-k search, importance resampling and the filter audit against brute force and on odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gustloom.llm import filter_audit, importance, topk

VECTORS = "vec_id long, embedding array<float>, id int, block string, score double, rank int, v int"


def brute_top(rows, k=10, ask=lambda i: i is not None and i % 100 == 0):
    ints = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = []
    for a, (i, q) in enumerate(ints):
        if ask(i):
            scored = sorted((-sum(x * y for x, y in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(ints) if a != b)
            out += [(i, r + 1, None if null else j, -s) for r, (s, null, j) in enumerate(scored[:k])]
    return sorted(out, key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.5, 2, 3) for i, v in rows], VECTORS)


def top_rows(df):
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()), key=str)


def test_top_k_on_odd_vectors(spark):
    """Nulls, non-finite values, ties, repeated ids and copies, null ids, empty and short vectors."""
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(12)]) for i in range(400)]
    rows += [(i, [0.5] * 12) for i in range(1000, 1300)]  # ties: a group of copies
    rows += [(100, rows[7][1]), (100, rows[100][1]), (None, [0.5] * 12), (None, rows[3][1]), (2000, None), (2100, [None] * 12), (2200, [1.0] * 11 + [float("nan")]), (2300, [float("inf")] * 12), (2400, []), (2500, [2.0, 3.0]), (2600, [0.0] * 12), (2700, [-9.0] * 12)]
    assert top_rows(topk.top_k(vectors(spark, rows))) == brute_top(rows)


def test_top_k_in_small_blocks_and_passes(spark, monkeypatch):
    """The result doesn't depend on the sizes of blocks and passes."""
    rnd = random.Random(6)
    rows = [(i, [rnd.gauss(0, 1) * (3 if d < 4 else 0.3) for d in range(20)]) for i in range(3000)]
    monkeypatch.setattr(topk, "BLOCK_BYTES", 20 * 8 * 100)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk, "PASS_BYTES", 600)
    assert top_rows(topk.top_k(vectors(spark, rows).repartition(3), k=7)) == brute_top(rows, 7)


def test_top_k_bounds_leave_candidates_out():
    """With a floor only candidates that reach it come back, and compaction reads less than all products."""
    rng = np.random.default_rng(1)
    m = np.floor(1024 * rng.normal(size=(64, 4096))).astype("<i4")
    block = topk.Candidates(0, list(range(4096)), m.tobytes(), "<i4", 64, True)
    q = m[:, 5].astype(np.float64)
    score = (q @ m).astype(np.int64)
    floor = int(np.sort(score)[-10])
    at, got = block.search(q, floor)
    assert sorted(at) == sorted(np.flatnonzero(score >= floor)) and (score[at] == got).all()
    assert len(block.search(q, topk._NONE)[0]) == 4096 and 5 not in block.search(q, floor, skip=5)[0]


def test_top_k_of_large_components_and_few_rows(spark):
    big = [(0, [2.0e6, -2.0e6]), (100, [1.0e6, 5.0]), (1, [-1.5e6, 1.0])]
    assert top_rows(topk.top_k(vectors(spark, big))) == brute_top(big)
    assert topk.top_k(vectors(spark, big[:1])).count() == 0 and topk.top_k(vectors(spark, [])).count() == 0
    assert topk.top_k(vectors(spark, [(0, [1.0e30]), (1, [1.0])])).first()["score"] == ((1 << 31) - 1) * 1024


# --- resampling


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs_of(text, least, most):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)], len(words)


def brute_resample(rows, target, percent=10, buckets=10_000, least=1, most=1, least_words=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, runs_of(text, least, most)[0]))
    for text in target:
        t.update(map(bucket, runs_of(text, least, most)[0]))
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (s.total() + buckets)) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out, fit = [], []
    for key, text in rows:
        runs, n_words = runs_of(text, least, most)
        weight = sum(gain[bucket(f)] for f in runs) // max(1, len(runs))
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((key, len(runs), weight, score))
        if n_words >= least_words:
            fit.append((-score, key is None, key or 0))
    draw = percent * len(fit) // 100
    rank = {}
    for r, x in enumerate(sorted(fit)[:draw]):
        rank.setdefault(x, []).append(r + 1)
    full = []
    for key, n, weight, score in out:
        left = rank.get((-score, key is None, key or 0))
        full.append((key, n, weight, score, left.pop(0) if left else None))
    return sorted(full, key=str)


def resampled(df):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()), key=str)


def odd_texts(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(80).collect()]
    rows += [(9001, None), (9002, ""), (None, "only one word here " * 9), (9003, "Ünï ß日本 \x7f{}9a " * 30), (9004, "x" * 50_000), (9005, "long Text 7 " * 30_000), (9006, "🙂 ok".encode("utf-16", "surrogatepass").decode("utf-16")), rows[0], rows[1]]
    return rows


@pytest.mark.parametrize("slice_bytes", [1, 7, 64, 4_000_000])
@pytest.mark.parametrize(("least", "most"), [(1, 1), (1, 3), (2, 2), (3, 5)])
def test_runs_across_slices(spark, sf, slice_bytes, least, most):
    hasher = importance.Hasher(10_000, least, most, slice_bytes)
    for _, text in odd_texts(spark, sf)[::7]:
        text = (text or "")[:3000]
        assert Counter(f.decode() for runs in hasher.runs(text) for f in runs) == Counter(runs_of(text, least, most)[0])


@pytest.mark.parametrize(("least", "most"), [(1, 1), (1, 3), (2, 2)])
def test_resampling_by_brute_force(spark, sf, least, most):
    rows = odd_texts(spark, sf)
    target = [None, "", *(r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect())]
    docs = spark.createDataFrame([(k, t, 1, 2, "x", 0) for k, t in rows], "doc_id long, text string, id int, rank int, score string, n int")
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(docs, bench, 30, least=least, most=most)
    assert resampled(got) == brute_resample(rows, target, 30, least=least, most=most)


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c " * 10), (2, None)], "doc_id int, text string")
    none = docs.limit(0)
    assert resampled(importance.resample(docs, none, 100)) == brute_resample([(1, "a b c " * 10), (2, None)], [], 100)
    assert importance.resample(none, docs).count() == 0 and importance.resample(none, none).columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_partition_vectors_merge_to_the_whole(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one, many = importance.bucket_counts(docs.coalesce(1)), importance.bucket_counts(docs.repartition(150))
    assert (one == many).all() and one.sum() == sum(len(runs_of(r["text"], 1, 1)[0]) for r in docs.collect())


# --- filter audit


def brute_audit(docs, labels):
    """Every order applied filter by filter to every document."""
    quality, toxic = {d for d, q, t in labels if q == 1}, {d for d, q, t in labels if t == 1}
    texts = [(i, p or "", t or "") for i, p, t in docs]
    least = {}
    for i, _, t in texts:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    fails = []
    for i, p, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i})
    out, shapley = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        left = set(range(len(texts)))
        for step, f in enumerate(order, 1):
            gone = {d for d in left if fails[d][f]}
            for p in {x[1] for x in texts}:
                of = [d for d in range(len(texts)) if texts[d][1] == p]
                here = [d for d in of if d in gone]
                out[p, order, step] = [
                    sum(d in left - gone for d in of), len(here), sum(fails[d][f] and d not in left for d in of), sum(fails[d][f] and sum(fails[d].values()) == 1 for d in of),
                    sum(texts[d][0] in quality for d in here), sum(texts[d][0] in toxic for d in here),
                ]
                shapley[p, f] += len(here)
            left -= gone
    return sorted((p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items())


AUDITED = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_filter_audit_by_brute_force(spark, sf, monkeypatch, broadcast):
    monkeypatch.setattr(filter_audit, "BROADCAST_REPEATED", broadcast)
    rows = [(r["doc_id"], r["source"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    rows += [(700, None, None), (701, "", ""), (702, None, "A B"), (None, "src0", rows[0][2]), (703, "src0", rows[0][2]), (704, "new", "A B"), rows[5], (705, "clean", " ".join(f"w{i}" for i in range(60)))]
    rows.append((706, "src1", "many words | " * 20_000))
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()] + [(700, None, 1), (700, 1, None), (None, 1, 1), (703, 1, 0)]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "doc_id long, source string, text string, n int, A int, part int, digest int")
    tags = spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, toxic int, good int")
    got = filter_audit.audit(docs, tags)
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "int"] + ["bigint"] * 7
    assert sorted(tuple(r[c] for c in AUDITED) for r in got.collect()) == brute_audit(rows, labels)


def test_filter_audit_of_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(3)
    labels = spark.read.parquet(f"{sf}/labels.parquet").limit(0)
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert filter_audit.audit(docs, labels).agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)
