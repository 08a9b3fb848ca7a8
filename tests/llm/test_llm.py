"""The llm operators against brute force, the tokenizer libraries, round trips and held-out accuracy."""

import base64
import functools
import hashlib
import html
import math
import random
import time
import zlib
from collections import Counter
from html.parser import HTMLParser

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gustloom.llm import bpe_arrays, brown_lm, common, exact_dedup, html_render, imatch, importance, language_id, minhash_join, packing, prefix_bpe, queries, sharding, token_counts

BYTE, MULTI, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json"))
ODD = ["", "  a  b", "x\n y\n\n  z \t", "foo<|endoftext|>bar <|endoftext|> baz\n <|endoftext|>", "a" * 30 + " b'sx 'll I'm", "Σίσυφος ΟΔΟΣ İstanbul", "日本語 ñandú é", "\x1c\x1d a\x85b\xa0c", "ab" * 2000, "\n", "Ⅷ ½ ²x 🙂"]


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark, docs):
    """Nulls, empty and long texts, repeated rows, null ids, and columns whose names operators use themselves."""
    base = docs.limit(25)
    none = F.lit(None)
    parts = [base, base.limit(4), base.limit(2).withColumn("text", none.cast("string")), base.limit(2).withColumn("doc_id", none.cast("long")), base.limit(1).withColumns({"text": F.lit(""), "doc_id": F.lit(9001).cast("long"), "source": none.cast("string"), "lang": none.cast("string")}), base.limit(1).withColumns({"text": F.repeat(F.lit("word "), 60_000), "doc_id": F.lit(9002).cast("long")}), base.limit(1).withColumns({"text": F.repeat(F.lit("x"), 30_000), "doc_id": F.lit(9003).cast("long")})]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    names = ("id", "row", "digest", "h", "held", "host", "declared", "node", "token", "bucket", "length", "key", "d", "kept", "place", "n")
    out = out.withColumns({n: F.lit(1) for n in names})
    rows = out.collect()
    return spark.createDataFrame(rows, out.schema)


def test_every_operator_handles_odd_rows(odd, docs):
    n = odd.count()
    hp = odd.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"), F.lit(None).cast("string").alias("url"), "id", "host", "row")
    runs = {
        "html": lambda d: html_render.visible_text(d.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"), "id", "row")),
        "exact": exact_dedup.exact_dedup, "imatch": imatch.edited_fingerprints, "bpe": lambda d: prefix_bpe.round_trip(d, MULTI), "shards": sharding.extendible_shards,
        "brown": brown_lm.score, "count": lambda d: token_counts.token_counts(d, BYTE), "near": minhash_join.near_duplicates,
    }
    for name, run in runs.items():
        assert run(odd).count() == n, name
        assert run(odd.limit(0)).count() == 0, name
    assert language_id.identify_pages(hp, docs).count() == n
    packed = packing.pack(odd, WORD)
    assert packed.where("piece = 0").count() == n and packing.pack(odd.limit(0), WORD).count() == 0
    kept = exact_dedup.exact_dedup(odd).where("kept").count()
    assert kept == odd.select(F.coalesce("text", F.lit(""))).distinct().count()


@pytest.mark.parametrize("kind", ["int", "string", "decimal(12,2)"])
def test_ids_of_any_type(odd, docs, kind):
    """Ids come back as they were given, in their own type."""
    of = (lambda c: F.date_add(F.lit("2020-01-01").cast("date"), c.cast("int"))) if kind == "date" else lambda c: c.cast(kind)
    given = odd.withColumn("doc_id", of(F.col("doc_id"))).limit(30)
    want = sorted(str(r[0]) for r in given.select("doc_id").collect())
    runs = {
        "html": lambda d: html_render.visible_text(d.select("doc_id", F.col("text").alias("html")), "doc_id"), "bpe": lambda d: prefix_bpe.round_trip(d, MULTI), "brown": brown_lm.score, "count": lambda d: token_counts.token_counts(d, BYTE),
        "near": minhash_join.near_duplicates, "pack": lambda d: packing.pack(d, WORD).where("piece = 0"), "exact": exact_dedup.exact_dedup, "resample": lambda d: importance.resample(d, docs.limit(5)),
    }
    for name, run in runs.items():
        got = run(given)
        assert dict(got.dtypes)["doc_id"] == kind and sorted(str(r[0]) for r in got.select("doc_id").collect()) == want, name


def test_values_on_odd_rows(odd):
    """Nulls count as empty, repeated rows and rows without an id are treated each, whatever other columns there are."""
    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    key = lambda r: (r[0] is None, r)
    lib = Tokenizer.from_file(BYTE)
    got = sorted((tuple(r) for r in token_counts.token_counts(odd, BYTE).collect()), key=str)
    assert got == sorted(((i, len(t.encode()), n := len(lib.encode(t, add_special_tokens=False).ids), n > 512) for i, t in rows), key=str)
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in html_render.visible_text(odd.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"), "row")).collect()), key=str)
    assert got == sorted(((i, x := html_render.render(t), len(x)) for i, t in rows), key=str)
    shards = sharding.extendible_shards(odd, shard_bytes=40_000).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"]) for r in shards) == sorted((str(i), len(t.encode())) for i, t in rows)
    held = {}
    for r in shards:
        held.setdefault(r["shard"], []).append(r)
    assert all(sum(x["n_bytes"] for x in g) == g[0]["shard_bytes"] and len(g) == g[0]["shard_docs"] and (g[0]["shard_bytes"] <= 40_000 or len(g) == 1) for g in held.values())
    c = Counter(w for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for w in [*brown_lm.words(t), b""])
    n, v = sum(c.values()), len(c)
    score = lambda t: round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*brown_lm.words(t), b""]), 3)
    got = brown_lm.score(odd).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], round(r["base_score"], 3)) for r in got) == sorted((str(i), len(brown_lm.words(t)) + 1, score(t)) for i, t in rows)
    near = minhash_join.near_duplicates(odd).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"]) for r in near) == sorted((str(i), len(shingles(t))) for i, t in rows)
    assert all(r["component_id"] == r["doc_id"] for r in near if not r["n_shingles"])
    prints = imatch.edited_fingerprints(odd).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in prints) == sorted((str(i), len(t)) for i, t in rows)
    by = {}
    for r in exact_dedup.exact_dedup(odd).collect():
        by.setdefault(r["text_sha256"], []).append(r)
    assert all(sum(r["kept"] for r in g) == 1 and {r["group_size"] for r in g} == {len(g)} and len({r["keep_id"] for r in g}) == 1 for g in by.values())


def test_stages_handle_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, "")
        if name == "packing":
            ids = {(r["doc_id"], r["piece"]) for r in out.collect()}
            assert {i for i, _ in ids} == {r["doc_id"] for r in odd.collect()} and out.count() >= odd.count()
        else:
            assert out.columns == odd.columns and 0 < out.count() <= odd.count(), name
        assert stage(spark, odd.limit(0), "").count() == 0, name


def test_pipeline_by_brute_force(spark, sf, docs):
    """Each stage by hand on what the one before kept; the pieces of what is left are the library's."""
    out = corpus_pipeline.run(spark, sf)
    rows = [(r["doc_id"], r["source"], r["text"] or "") for r in docs.collect()]
    model = language_id.train(docs)
    evidence = [(i, source, t, *(x[0] for x in model.posteriors([t]))) for i, source, t in rows]
    known = fused([(i, source.lower(), None, likelihood, posterior, n) for i, source, _, likelihood, posterior, n in evidence], model.languages)
    kept = {i: t for i, _, t in rows if not known[i][3]}
    last = {}
    for i in sorted(kept):
        last[kept[i]] = i
    kept = {i: kept[i] for i in last.values()}
    roots = near_roots([(i, kept[i]) for i in sorted(kept)])
    kept = {i: kept[i] for i in kept if roots[i] == i}
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == set(kept) and len(kept) < len(rows)
    lib, want = Tokenizer.from_file(WORD), []
    for i, t in kept.items():
        ids = np.array([*lib.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want += [(i, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes())) for k in range(0, len(ids), 4096)]
    assert sorted(want) == sorted(tuple(r) for r in out.select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    fill = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["n"] == r["end"] <= 4096 for r in fill)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "packing"] and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    a, b = queries.QUERIES[name](spark, sf).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    c = sorted(a.columns)
    assert c == sorted(b.columns)
    assert sorted(a[c].itertuples(index=False, name=None)) == sorted(b[c].itertuples(index=False, name=None))


def test_exact_dedup_checks_bytes(docs, texts):
    """Under a digest that many texts share, groups are still those of equal bytes; small stream batches give the same."""
    weak = lambda text: F.substring(F.unhex(F.sha2(text, 256)), 1, 1)
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(docs, digest=weak, files_per_batch=1).collect()}
    by = {}
    for i, t in texts.items():
        by.setdefault(t, []).append(i)
    assert got == {(i, max(g), len(g), i == max(g)) for g in by.values() for i in g}


def test_shards_split_only_where_needed(spark, docs, texts):
    limit = 20_000
    rows = sharding.extendible_shards(docs, shard_bytes=limit).collect()
    size = {i: len(t.encode()) for i, t in texts.items()}
    bits = {i: format(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), "060b") for i in texts}

    def split(ids, depth):
        if sum(size[i] for i in ids) <= limit or len(ids) == 1:
            return {i: bits[i][:depth] for i in ids}
        out = {}
        for b in "01":
            own = [i for i in ids if bits[i][depth] == b]
            if own:
                out |= split(own, depth + 1)
        return out

    assert {r["doc_id"]: r["shard"] for r in rows} == split(list(texts), 0)
    assert all(r["oversize"] == (r["shard_bytes"] > limit) and r["depth"] == len(r["shard"]) for r in rows)
    hot = spark.range(300).select(F.lit(7).alias("doc_id"), F.repeat(F.lit("y"), 100).alias("text"))
    got = sharding.extendible_shards(hot, shard_bytes=1000).groupBy("shard").agg(F.sum("n_bytes").alias("b")).collect()
    assert sum(r["b"] for r in got) == 30_000 and max(r["b"] for r in got) <= 1000


@pytest.fixture(scope="module")
def ranks():
    with open(MULTI, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@pytest.fixture(scope="module")
def bpe():
    return prefix_bpe.PrefixBPE.from_file(MULTI)


def noise(seed, n=400):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(" \n\tabAB'sé1.<|>😀Σthe") for _ in range(rnd.randint(1, 60))) for _ in range(n)]


def test_prefix_bpe_is_tiktokens(ranks, texts):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = prefix_bpe.Codec(MULTI, cache=500)
    xs = [*ODD, *noise(1), *texts.values()]
    for k in range(0, len(xs), 60):
        ids, counts = codec.encode(xs[k : k + 60])
        want = [enc.encode_ordinary(x) for x in xs[k : k + 60]]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for own in want for i in own]
        assert codec.decode(ids, counts) == [x.encode() for x in xs[k : k + 60]]


def test_round_trip_digests(spark, ranks):
    """The query's columns on null, empty, repeated and long texts, and on null ids."""
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [*enumerate(ODD), (3, ODD[3]), (None, "one"), (50, None), (51, "of the " * 40_000)]
    got = prefix_bpe.digests(prefix_bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), MULTI)).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(ids := enc.encode_ordinary(t or "")), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())) for i, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F, exclude_categories=("Cs",)) | st.sampled_from("'sSſtTrvmlLdD \n\x1c\x85\u2003é²½ªＡ"), max_size=40))
def test_near_splitter_splits_alike(text):
    for pattern in (bpe_arrays.BYTE_LEVEL, bpe_arrays.WORD_END, public_tokenizers.PATTERN, r"(?i:'s|'ll)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"):
        assert bpe_arrays.Splitter(pattern).findall(text) == regex.findall(pattern, text)


def test_generations_keep_what_was_met_lately():
    lately, learnt = common.Lately(4), []
    learn = lambda new: learnt.extend(new) or [x.upper() for x in new]
    for keys in (["a", "b"], ["a", "c"], ["a", "d"], ["a", "x" * 65], ["a", "e", "f"], ["b", "x" * 65]):
        assert lately.of(keys, learn) == [k.upper() for k in keys]
    assert learnt.count("a") == 1 and learnt.count("b") == 2 and learnt.count("x" * 65) == 2 and len(lately.young) + len(lately.old) <= 6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 6), st.text(alphabet="theaionr", max_size=25)), min_size=1, max_size=12))
def test_edits_re_encode_exactly(bpe, edits):
    piece, data = prefix_bpe.EditablePiece(bpe, b"thereinthehationthe"), b"thereinthehationthe"
    for at, cut, new in edits:
        at = min(at, len(data))
        end = min(len(data), at + cut)
        piece.replace(at, end, new.encode())
        data = data[:at] + new.encode() + data[end:]
        fresh = prefix_bpe.EditablePiece(bpe, data)
        assert piece.data == data and piece.last == fresh.last
    piece.append(b"tion")
    assert piece.ids() == prefix_bpe.EditablePiece(bpe, data + b"tion").ids()


def test_token_counts_are_the_librarys(texts):
    lib, counter = Tokenizer.from_file(BYTE), token_counts.Counter(BYTE, cache=50)
    xs = [*ODD, *noise(2), *texts.values()]
    got = [n for k in range(0, len(xs), 97) for n in counter.count(xs[k : k + 97])]
    assert got == [len(e.ids) for e in lib.encode_batch(xs, add_special_tokens=False)]


def test_packing(spark, texts):
    lib = Tokenizer.from_file(WORD)
    rows = [(i, t) for i, t in enumerate([*ODD, *noise(3, 100), *texts.values(), "the cat " * 9000])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack(df, WORD).toPandas()
    got["ids_crc32"] = got.token_ids.map(zlib.crc32)
    want = []
    for (i, _), e in zip(rows, lib.encode_batch([t for _, t in rows], add_special_tokens=False)):
        ids = np.array([*e.ids, 1], "<u4")
        want += [(i, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes())) for k in range(0, len(ids), 4096)]
    assert sorted(want) == sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None))
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 4096
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 4096) + 1


def test_packing_across_blocks(spark, monkeypatch):
    """Several blocks, whose least-filled bins are opened and packed again."""
    monkeypatch.setattr(packing, "BLOCK", 50)
    df = spark.createDataFrame([(i, "the " * (37 * i % 900)) for i in range(400)], "doc_id long, text string")
    got = packing.pack(df, WORD, capacity=1000).toPandas()
    assert len(got) == 400 and got.groupby("sequence_id").length.sum().max() <= 1000
    assert got.sequence_id.nunique() <= 1.08 * -(-got.length.sum() // 1000)  # blocks of 50 pieces leave more room than those of 2048


def test_crossover_keeps_every_piece():
    draw = np.random.default_rng(5)
    sizes = [int(x) for x in draw.integers(1, 60, 80)]
    parents = []
    for order in (range(80), reversed(range(80))):
        bins, free = [], []
        packing.best_fit(order, sizes, bins, free, 100)
        parents.append((bins, free))
    for _ in range(20):
        bins, free = packing.crossover(*parents, sizes, 100, draw)
        assert sorted(x for b in bins for x in b) == list(range(80)) and [100 - sum(sizes[x] for x in b) for b in bins] == free and min(free) >= 0


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_roots(rows):
    """The least id of each row's component, by comparing all sets that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    for i in sets:
        for j, n in Counter(j for x in sets[i] for j in where[x] if j > i).items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in sets}


def check_near(spark, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    roots = near_roots(rows)
    assert got == {i: (len(shingles(t)), roots[i], roots[i] == i) for i, t in rows}


def test_near_duplicates_by_brute_force(spark, texts):
    check_near(spark, [*texts.items(), (5001, None), (5002, "  \n"), (5003, "one two"), (5004, "ONE two")])


def test_near_duplicates_in_a_large_group(spark):
    """Copies of one text with more and more words changed: links at all distances, in one hot posting."""
    rnd = random.Random(4)
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(150)]
    rows = []
    for i in range(250):
        w = list(base)
        for _ in range(rnd.randint(0, 9)):
            w[rnd.randrange(150)] = f"w{rnd.randint(0, 30)}"
        rows.append((i, " ".join(w)))
    check_near(spark, rows)


def test_imatch(docs, texts):
    got = imatch.edited_fingerprints(docs).toPandas().sort_values("doc_id").reset_index(drop=True)
    ids = sorted(texts)
    xs = [texts[i] for i in ids]
    after = xs[1:] + xs[:1]
    edited = [x[: len(x) - len(x) // 2] + y[: len(x) // 2] for x, y in zip(xs, after)]
    assert list(got.doc_id) == ids and list(got.n_chars) == list(map(len, xs))
    assert list(got.edited_sha256) == [hashlib.sha256(e.encode()).hexdigest() for e in edited]
    by = {}
    assert all(by.setdefault(x, f) == f for x, f in zip(xs, got.fingerprint))
    other = np.array([x != y for x, y in zip(xs, after)])
    e, n = got.near_edited.to_numpy(), got.near_next.to_numpy()[other]
    assert ((e[:, None] > n).mean() + 0.5 * (e[:, None] == n).mean()) > 0.95 and e.min() >= 0 and e.max() <= 1


def spark_hash(data: bytes | int, seed: int = 42) -> int:
    """What xxhash64() gives for a string or a long."""
    data = data if isinstance(data, bytes) else data.to_bytes(8, "little", signed=True)
    return int.from_bytes(xxhash.xxh64(data, seed=seed & (1 << 64) - 1).digest(), "big", signed=True)


def imatch_by_hand(xs: list[str]) -> list[tuple[str, str]]:
    """Fingerprints of the texts and of their edited texts, term by term."""
    terms = lambda t: {spark_hash(w.encode()) for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if w}
    fold = lambda hs: functools.reduce(lambda seed, h: spark_hash(h, seed), sorted(hs), 42)
    six = lambda h: format(h & 0xFFFFFF, "06X")
    signed = lambda h: h & (1 << 64) - 1
    df = Counter(h for t in set(xs) for h in terms(t))
    band = {h for h, n in df.items() if n > 1 and 1.6 <= math.log(len(set(xs)) / n) <= 7.5}

    def fingerprint(text):
        own = terms(text)
        used = own & band or own
        if not used:
            raw = spark_hash(text.encode())
            return "0w" + six(raw) + "0x" + six(spark_hash(raw))
        out = "00" + six(fold(used)) if own & band else "0w" + six(fold(own))
        for rung, first in enumerate((0, 2, 6, 12, 20, 30), 1):
            for k in range((4, 8, 16, 16, 16, 16)[rung - 1]):
                some = [h for h in used if (signed(h) >> first) % 4**rung == k]
                out += f"{rung}{k:x}{six(fold(some))}" if some else ""
        for tag, first in (("8", 42), ("9", 44)):
            some = [h for h in used if (signed(h) >> first) % 4]
            out += f"{tag}0{six(fold(some))}" if some else ""
        return out

    edited = [x[: len(x) - len(x) // 2] + y[: len(x) // 2] for x, y in zip(xs, xs[1:] + xs[:1])]
    return [(fingerprint(x), fingerprint(e)) for x, e in zip(xs, edited)]


def test_imatch_by_brute_force(spark, texts):
    xs = [t or "" for _, t in sorted(texts.items())][:120] + ["", "  ", "...", "zz qq", "zz qq", "ÉCOLE ñandú Ⅷ ½", "only once here", "x" * 50_000]
    got = imatch.edited_fingerprints(spark.createDataFrame(list(enumerate(xs)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r["fingerprint"], r["edited_fingerprint"]) for r in got] == imatch_by_hand(xs)
    split = lambda f: {f[i : i + 8] for i in range(0, len(f), 8)}
    for r, after in zip(got, got[1:] + got[:1]):
        for near, other in (("near_edited", r["edited_fingerprint"]), ("near_next", after["fingerprint"])):
            a, b = split(r["fingerprint"]), split(other)
            assert r[near] == pytest.approx(len(a & b) / len({t[:2] for t in a | b}))


def test_imatch_of_copies_and_rare_terms(spark, docs):
    """A third of the rows are copies of one text, and one text has only terms of its own: an edit leaves parts of both alike."""
    own = docs.select("doc_id", "text").collect()
    hot = max(own, key=lambda r: len(r["text"]))["text"]
    rare = " ".join(f"rare{i}q" for i in range(200))
    rows = [(r["doc_id"], r["text"]) for r in own] + [(10_000 + i, hot) for i in range(len(own) // 2)] + [(20_000, hot + " zzz"), (20_001, hot), (20_002, rare), (20_003, rare + " zzz")]
    got = {r["doc_id"]: r for r in imatch.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id >= 10000").collect()}
    assert got[20_001]["fingerprint"] == got[10_000]["fingerprint"] and got[20_001]["fingerprint"].startswith("00")
    assert got[20_000]["near_next"] > 0.5 and got[20_002]["near_next"] > 0.5


def test_brown(docs, texts):
    got = brown_lm.score(docs).toPandas().set_index("doc_id")
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter()
    for i, t in texts.items():
        if not held[i]:
            c.update([*brown_lm.words(t), "end"])
    n, v = sum(c.values()), len(c)
    for i, t in texts.items():
        w = [*brown_lm.words(t), "end"]
        r = got.loc[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
    out = got[got.held_out]
    assert out.score.sum() > out.base_score.sum() and (got.perplexity > 1).all()


def test_brown_score_by_brute_force(docs, texts, monkeypatch):
    """The score, token by token, from a classing of all words by hand on top of the exchange."""
    monkeypatch.setattr(brown_lm, "WORD_TYPES", 60)
    monkeypatch.setattr(brown_lm, "ENDING_TYPES", 20)
    got = {r["doc_id"]: r["score"] for r in brown_lm.score(docs).collect()}
    words = {i: [*brown_lm.words(t or ""), b""] for i, t in texts.items()}
    train = {i: w for i, w in words.items() if zlib.crc32(str(i).encode()) % 7 != 2}
    c = Counter(w for own in train.values() for w in own)
    common = sorted((w for w in c if 0 < len(w) <= 64), key=lambda w: (-c[w], w))[:60]
    endings = Counter()
    for w in c:
        if w and w not in common:
            endings[w[-3:]] += c[w]
    endings = sorted(endings, key=lambda e: (-endings[e], e))[:20]
    kind = lambda w: 0 if not w else 1 + common.index(w) if w in common else 61 + endings.index(w[-3:]) if w[-3:] in endings else 81
    kinds = {w: kind(w) for own in words.values() for w in own}
    bigrams = np.zeros((82, 82))
    for own in train.values():
        for a, b in zip([b"", *own], own):
            bigrams[kinds[a], kinds[b]] += 1
    at = brown_lm.exchange(bigrams)
    k = brown_lm.CLASSES

    def moves(pairs):
        table = np.zeros((k, k))
        for a, b in pairs:
            table[a, b] += pairs[a, b]
        share = (table.sum(axis=0) + 1) / (table.sum() + k)
        return np.array([[math.log10((table[a, b] + share[b]) / (table[a].sum() + 1)) for b in range(k)] for a in range(k)]), table

    pairs = Counter()
    for a in range(82):
        for b in range(82):
            pairs[at[a], at[b]] += bigrams[a, b]
    step, table = moves(pairs)
    entry = np.log10(table.sum(axis=0) + 1)
    before, after = {}, {}
    for own in train.values():
        for a, w, b in zip([b"", *own], own, [*own[1:], None]):
            if kinds[w] > 60:
                before.setdefault(w, Counter())[at[kinds[a]]] += 1
                after.setdefault(w, Counter())[at[kinds[b]]] += 1
    classed = {w: at[kinds[w]] for w in c}
    for w in before:
        gain = [sum(n * (step[a, own] - entry[own]) for a, n in before[w].items()) + sum(n * step[own, b] for b, n in after[w].items()) for own in range(k)]
        classed[w] = int(np.argmax(gain))
    mass = np.bincount(at[61:], minlength=k).astype(float)
    for w in c:
        mass[classed[w]] += c[w] + 1
    of = lambda w: classed[w] if w in classed else at[kinds[w]]
    pairs = Counter((of(a), of(b)) for own in train.values() for a, b in zip([b"", *own], own))
    step, _ = moves(pairs)
    for i, own in words.items():
        want = sum(step[of(a), of(b)] + math.log10(c[b] + 1) - math.log10(max(mass[of(b)], 1)) for a, b in zip([b"", *own], own))
        assert got[i] == pytest.approx(want, rel=1e-9), i


def test_brown_gives_every_word_a_class(spark, monkeypatch):
    """Words outside of the types, all with one ending, get the class of the types that have their neighbours: half of them may follow each common word."""
    monkeypatch.setattr(brown_lm, "WORD_TYPES", 12)
    monkeypatch.setattr(brown_lm, "ENDING_TYPES", 1)
    draw = random.Random(3)
    word = lambda k: f"{k}{draw.randrange(5) if draw.random() < 0.5 else draw.randrange(5, 40)}end"
    rows = [(i, f"to {word('n')} is {word('v')}") for i in range(4000)]
    got = brown_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), held=F.col("doc_id") < 400)
    mean = got.where("held_out").agg(F.avg("score")).first()[0]
    assert mean > -(1 + math.log10(70)) - 0.15  # with one class for all 70 words outside of the types, 0.3 less at best


def test_exchange_finds_classes():
    draw = np.random.default_rng(1)
    kind = np.arange(12) % 2  # words of two kinds that follow each other in turn
    counts = np.zeros((12, 12))
    for _ in range(4000):
        a, b = draw.integers(0, 12, 2)
        counts[a, b] += kind[a] != kind[b]
    at = brown_lm.exchange(counts, classes=2)
    assert len({(k, c) for k, c in zip(kind, at)}) == 2


def test_language_accuracy_held_out(docs):
    model = language_id.train(docs.where("doc_id % 2 = 0"))
    out = language_id.identify(docs.where("doc_id % 2 = 1"), model, ["doc_id", "lang"], "text", F.col("source"), F.lit(None).cast("string")).toPandas()
    assert (out.language == out.lang).mean() > 0.98 and not out.rejected.any()


def fused(evidence, languages):
    """(language, n_trigrams, confidence, rejected) of each key, row by row: likelihood, declared language and the host's smoothed prior without the row itself."""
    size, out = len(languages), {}
    level = [lambda h: h, lambda h: ".".join(h.split(".")[-2:]), lambda h: h.split(".")[-1], lambda h: ""]
    counts, sums = Counter(), {}
    for _, host, _, _, posterior, n in evidence:
        for k, of in enumerate(level) if n else ():
            counts[k, of(host)] += 1
            sums[k, of(host)] = sums.get((k, of(host)), 0) + posterior
    for key, host, declared, likelihood, posterior, n in evidence:
        own, mine = (1, posterior) if n else (0, 0 * posterior)
        prior = (sums[3, ""] - mine + 1) / (counts[3, ""] - own + size)
        for k in (2, 1, 0):
            prior = (np.maximum(sums.get((k, level[k](host)), 0) - mine, 0) + 5 * prior) / (max(counts[k, level[k](host)] - own, 0) + 5)
        said = np.array([1.0 if declared not in languages else 0.9 if x == declared else 0.1 / (size - 1) for x in languages])
        scores = likelihood + np.log(np.maximum(prior, 1e-9)) + np.log(said)
        share = 1 / np.exp(scores - scores.max()).sum()
        out[key] = languages[int(scores.argmax())], n, share, bool(n == 0 or share < 0.5)
    return out


def test_language_fusion_by_brute_force(spark, sf, docs):
    """Every page: likelihood, declared language and the host's smoothed prior, row by row."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()] + [(9001, None, None), (9002, "http://Own.example.net:80/", "<p>12"), (None, "http://own.example.net/a", "<body lang='de'>und die der das ist nicht")]
    model = language_id.train(docs)
    got = {(r["page_id"], r["host"]): r for r in language_id.identify_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()}
    evidence = []
    for key, url, page in rows:
        host = (regex.match(r"\w+://([^/:?#]*)", url)[1] if url else "").lower()
        likelihood, posterior, n = (x[0] for x in model.posteriors([html.unescape(language_id._MARKUP.sub(" ", page or ""))]))
        evidence.append((key, host, (regex.search(r"(?i)<(?:html|body)[^>]*?lang\s*=\s*[\"']?([a-z]+)", page or "") or [None, None])[1], likelihood, posterior, n))
    for (key, host, *_), (language, n, confidence, rejected) in zip(evidence, fused(evidence, model.languages).values()):
        r = got[key, host]
        assert (r["language"], r["n_trigrams"], r["rejected"]) == (language, n, rejected) and r["confidence"] == pytest.approx(confidence, rel=1e-6)
    assert len(got) == len(rows)


def test_language_ties_go_to_the_first_by_name(spark):
    same = spark.createDataFrame([(i, "alpha beta gamma", lang) for i in range(40) for lang in ("zz", "aa")], "doc_id long, text string, lang string")
    got = language_id.identify(same, language_id.train(same), ["doc_id"], "text", F.lit("h"), F.lit(None).cast("string")).select("language", "text_language").distinct().collect()
    assert [tuple(r) for r in got] == [("aa", "aa")]


def test_all_labelled_languages_are_learned(spark):
    rows = [(i, chr(97 + i % 26) * 3 + " " + chr(97 + i // 26) * 4, f"l{i:03}") for i in range(90)]
    assert language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string")).languages == [r[2] for r in rows]


def test_declared_languages(spark):
    cases = {"<html lang=en>": "en", '<HTML xml:lang="fr-CA">': "fr", "<html><body lang='de'>": "de", '<meta http-equiv="Content-Language" content="es">': "es", '<meta content="it" name=language>': "it", "<html><p lang=en>": None, "": None, None: None, '<meta name=x content="it">': None}
    cases |= {"<html data-lang='fr' lang=de>": "de", "<!-- <html lang=it> --><html lang=de>": "de", "<!-- <html lang=it> <html lang=de>": None, "<html title='lang=fr' lang=de>": "de", '<html lang="pt" data-lang=fr>': "pt", "<script>var x='<html lang=it>'</script><html lang=en>": "en"}
    cases |= {"<html hreflang=fr><body lang=es>": "es", "<html lang=english>": None, "<meta data-name=language content=it>": None, "<meta name=language-x content=it>": None, "<html" + " a=b" * 30_000 + " lang=de>": "de", "<htmlx lang=de>": None, "<html\nclass='a'\nLANG = 'NL-be'>": "nl"}
    got = spark.createDataFrame([(k,) for k in cases], "html string").select("html", language_id.declared_language(F.col("html"))).collect()
    assert {r[0]: r[1] for r in got} == cases


def test_language_evidence(spark, docs):
    """Without text the host's other pages and the declared language decide; without a letter a page is rejected."""
    en = docs.where("lang = 'en'").limit(6).collect()
    rows = [(i, f"http://a.example.org/{i}", f"<html lang=en><p>{r['text']}") for i, r in enumerate(en)]
    rows += [(10, "http://a.example.org/x", "<p>123</p>"), (11, None, "<html lang=fr><p>..."), (12, "http://b.example.org/x", "<script>var the = 'of';</script>")]
    got = {r["page_id"]: r for r in language_id.identify_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()}
    assert all(got[i]["language"] == "en" and got[i]["confidence"] > 0.99 for i in range(6))
    assert got[10]["language"] == "en" and got[10]["rejected"] and got[11]["language"] == "fr" and got[12]["rejected"] and got[12]["language"] == "en"


PAGE = """<!DOCTYPE html><html lang=en><head><title>T</title><style>p{}</style></head><body>Hello <b>bold</b>  world<p>para one<p>para two<br>line<ul><li>a<li>b<ol><li>x<li>y</ol><li>c</ul>
<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td rowspan=2>r<td>1<tr><td>2</table><div style="display:none">hid</div><span hidden>hid2</span><pre>  a
   b</pre>x &lt;tag&gt; &amp;</body></html>"""


def test_html_visibility():
    cases = {
        "İ" * 20 + "<style>p{}</style>visible text here": "İ" * 20 + "visible text here",
        "a<math><mi>x</mi><annotation>no</annotation></math>b<svg><title>no</title><text>lbl</text><text>two</text><path/></svg>c": "axb lbl two c",
        "<svg><g><p>out": "out", "<svg/>x": "x", "<svg><foreignObject><p>in</p></foreignObject></svg>x": "in\n\nx", "<object>fallback</object>": "fallback",
        "<body hidden>x": "", "<body style='display:none'>x": "", "<html hidden>x": "", "<body class=a>x": "x",
        "<div style='visibility:hidden'>a<b style='visibility:visible'>c</b><ul><li>d</ul></div>": "c",
        "<p hidden style='display:block'>x": "x", "<p style='display:none;display:block'>x": "x", "<p style='display:none!important;display:block'>x": "",
        "<details>x<summary>s</summary>y</details>z": "s\nz", "<details open>x<summary>s</summary>y</details>z": "x\ns\ny\nz", "<dialog>d</dialog>e<dialog open>f</dialog>": "e\nf",
        "<xmp><b>x</b>  y</XMP>z": "<b>x</b>  y\n\nz", "<script>a</scripty>b</SCRIPT >c": "c", "<listing>a\n b</listing>": "a\n b",
    }
    assert {k: html_render.render(k) for k in cases} == cases


def test_html_spans():
    table = lambda rows: html_render.render(f"<table>{rows}</table>").split("\n")
    assert table("<tr><td rowspan=2>r<td>1<tr><td>2<tr><td>a<td>b") == ["r  1", "   2", "a  b"]
    assert table("<tr><td rowspan=0>r<td>1<tr><td>2<tr><td>b") == ["r  1", "   2", "   b"]
    assert table("<tr><td>a<td rowspan=9>s<td>c<tr><td>d<td>f<tbody><tr><td>g<td>h<td>i") == ["a  s  c", "d     f", "g  h  i"]
    assert table("<tr><td colspan=2>wide cell<td>x<tr><td>a<td>b<td>c") == ["wide cell  x", "a  b       c"]
    assert table("<tr><td rowspan=2>a<td rowspan=3>b<td>c<tr><td>d<tr><td>e<td>f") == ["a  b  c", "      d", "e     f"]
    began = time.perf_counter()
    assert html_render.render("<table>" + "<tr>" + "<td rowspan=65000 colspan=1000>x" * 3000 + "<tr><td>y" * 50).count("x") == 3000
    assert time.perf_counter() - began < 10


class Words(HTMLParser):
    """An independent reading of well-formed pages: the visible words and list marks, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.words, self.lists = [], [], []

    def hidden(self):
        return any(h for _, h in self.open)

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        style = (a.get("style") or "").replace(" ", "").lower()
        if tag in html_render.VOID:
            return
        if tag == "li" and not self.hidden():
            top = self.lists[-1] if self.lists else None
            if top and top[0] == "ol":
                top[1] += 1
            self.words.append(f"{top[1]}." if top and top[0] == "ol" else "-")
        if tag in ("ul", "ol"):
            self.lists.append([tag, 0])
        self.open.append((tag, tag in html_render.HIDDEN or "hidden" in a or "display:none" in style or "visibility:hidden" in style))

    def handle_endtag(self, tag):
        if tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if not self.hidden():
            self.words += data.split()


def test_html_against_another_parser(spark, sf):
    """Every page of the table: the same visible words, whatever the layout. Cells of several lines interleave, so order isn't compared."""
    rows = html_render.visible_text(spark.read.parquet(f"{sf}/pages.parquet")).join(spark.read.parquet(f"{sf}/pages.parquet"), "page_id").collect()
    joined = lambda words: Counter("".join(words))  # inline tags may part a word
    for r in rows:
        other = Words()
        other.feed(r["html"] or "")
        other.close()
        assert joined(r["text"].split()) == joined(other.words), r["page_id"]
        assert (r["n_chars"], r["n_lines"]) == (len(r["text"]), r["text"].count("\n") + 1 if r["text"] else 0)
    assert len(rows) > 40


def test_html_implied_head_and_body():
    for page in ("<html><head><title>T</title><p>Hello<p>you", "<head><meta charset=utf-8><link rel=x><style>p{}</style><div>Hello</div><p>you", "<html><head><title>T</title></head><head><p>Hello<p>you", "<p>Hello<head><title>T</title><p>you", "Hello<head><p>you", "<html><head><noscript><img></noscript><p>Hello<p>you"):
        assert html_render.render(page).split() == ["Hello", "you"], page


def test_html_quotes():
    for stray in ('href="x""', "href='x''", 'href=x"', '"', "title=it's", 'href="x"\'', 'a="b>c""', 'x =  "a>b" y', '="'):
        assert html_render.render(f'<p>one <a {stray}>two</a> three <a href="y">four</a> five</p><p>six</p>').split() == "one two three four five six".split(), stray
    assert html_render.render('<p class="a"" style="display:none">no</p><p title=it\'s hidden>no</p><p title="a>b" hidden>no</p>yes') == "yes"


def test_html():
    assert html_render.render(PAGE).split("\n") == [
        "Hello bold world", "", "para one", "", "para two", "line", "", "- a", "- b", "  1. x", "  2. y", "- c", "", "Name       Qty", "Apple pie  3", "r          1", "           2", "", "  a", "   b", "", "x <tag> &",
    ]
    cases = {"": "", "<": "<", "a < b": "a < b", "<li>a<li>b": "- a\n- b", "<b><p>x</b>y": "xy", "a<br><br>b": "a\n\nb", "<ul><li><p>a</p><p>b</p></li></ul>": "- a\n\n  b", "<table><td>x": "x", "<!-- a": "", "<script>x": "", "<plaintext><b>x": "<b>x", "<p>  </p><p>x": "x", "<noscript>a</noscript>b": "b"}
    assert {k: html_render.render(k) for k in cases} == cases
    assert html_render.render("<div>" * 5000 + "x") == "x" and html_render.render("<table><tr><td>" * 300 + "z") == "z"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<table>", "<td>", "</table>", "<tr>", "<li>", "<ul>", "</ul>", "<pre>", "</pre>", "<b", ">", "<!--", "-->", "<script>", "</script>", "text", " ", "\n", "&amp;", "<td colspan=3>", "<h1>", "</h2>", "<br>", "</"]), max_size=30))
def test_html_never_fails(parts):
    assert isinstance(html_render.render("".join(parts)), str)
