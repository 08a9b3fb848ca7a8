"""What each filter removes, loses and repeats under every order of the filters.

Five failure flags a document are counted by part and flags. A SQL CUBE over those counts gives, for each subset of the
filters, the documents that none of them removes: the grouping set of the subset with all its flags false. Each step of
an order is a pair of subsets, before and after its filter.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustloom.llm.common import Workspace, text_of

FILTERS = "ABCDE"
#: Digests of repeated texts (40 bytes each) that may be broadcast; beyond it, a shuffled join marks their rows.
BROADCAST_REPEATED = 200_000
_FULL = (1 << len(FILTERS)) - 1


def text_flags(text: Column) -> dict[str, Column]:
    """Whether a text fails the filters A to D: under 50 words; under 65 distinct words of 100; over 5 of 100 characters in A-Z; a character of ``#$%&*|``."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": F.size(words) < 50, "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words), "C": 100 * capitals > 5 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def failures(docs: DataFrame, labels: DataFrame, part: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: part, A to E (whether it fails the filter), good, toxic (1 or 0).

    E: the text is identical to that of any smaller id. Null texts count as empty, null parts as the empty string. A row
    with a null id has no smaller id, and is none; it has no label. Rows that repeat an id and its text aren't smaller
    than each other. A document is good (toxic) if any of its labels is 1. Other columns aren't read.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "filters")
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), *(f.alias(k) for k, f in text_flags(text).items()))
    rows = work.table("rows", rows)
    # Partial aggregates combine a hot text before the shuffle. As a table, so that a join with it can split a hot digest.
    repeated = work.table("repeated", rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("digest", "least"))
    repeated = F.broadcast(repeated) if repeated.count() <= BROADCAST_REPEATED else repeated
    marked = rows.join(repeated, "digest", "left").select("id", "part", *FILTERS[:-1], F.coalesce(F.col("id") > F.col("least"), F.lit(False)).alias("E"))
    labelled = labels.where("quality = 1 or toxic = 1").groupBy(F.col(id_col).cast(dict(docs.dtypes)[id_col]).alias("of")).agg(F.max(F.coalesce((F.col("quality") == 1).cast("long"), F.lit(0))).alias("good"), F.max(F.coalesce((F.col("toxic") == 1).cast("long"), F.lit(0))).alias("toxic"))
    return marked.join(labelled, marked["id"] == labelled["of"], "left").select("part", *FILTERS, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")))


def survivors(cells: DataFrame) -> DataFrame:
    """part, kept_by (bits of a subset of the filters), n, good, toxic: what is left after the subset, for all 32 subsets; zeros included.

    ``cells`` has part, A to E, n, good, toxic. A grouping set has a row for each combination of its flags; the one with
    all false is what the subset leaves. A part that a subset leaves nothing of has no such row: its sum is zero.
    """
    flags = ", ".join(FILTERS)
    cube = cells.sparkSession.sql(
        f"SELECT part, {flags}, grouping_id({flags}, part) AS sets, sum(n) AS n, sum(good) AS good, sum(toxic) AS toxic FROM {{cells}} GROUP BY CUBE ({flags}, part)", cells=cells
    )
    # grouping_id has a set bit for each column that is rolled up; the last is the part's.
    subset = F.lit(_FULL) - F.shiftright("sets", 1)
    alive = F.lit(True)
    for f in FILTERS:
        alive = alive & ~F.coalesce(F.col(f), F.lit(False))
    left = cube.where((F.col("sets") % 2) == 0).withColumn("kept_by", subset)
    sums = [F.sum(F.when(alive, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")]
    return left.groupBy("part", "kept_by").agg(*sums)


def _steps() -> list[tuple]:
    """All orders and steps: the subsets before and after, and the filter's bit. 600 rows for five filters."""
    bit = {f: 1 << (len(FILTERS) - 1 - i) for i, f in enumerate(FILTERS)}
    out = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for k, f in enumerate(order):
            out.append(("".join(order), k + 1, before, before | bit[f], bit[f]))
            before |= bit[f]
    return out


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per part, filter_order (120) and step (1-5): kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    See ``failures`` for nulls, empty texts, ties, repeated rows and other columns. Long texts are read whole. A part
    whose documents fail nothing has rows of zeros; an empty table has no parts and gives no rows.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "filter-audit")
    cells = failures(docs, labels, part, id_col, text_col).groupBy("part", *FILTERS).agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    left = work.table("survivors", survivors(work.table("cells", cells)))
    pairs = spark.createDataFrame([(b, b | f, f) for f in (1 << i for i in range(len(FILTERS))) for b in range(_FULL + 1) if not b & f], "before int, after int, filter int")
    steps = spark.createDataFrame(_steps(), "filter_order string, step int, before int, after int, filter int")

    # 80 pairs of subsets a part that differ by one filter; every step of every order is one of them.
    first, then = left.alias("x"), left.alias("y")
    change = first.join(F.broadcast(pairs), F.col("x.kept_by") == F.col("before")).join(then, (F.col("y.part") == F.col("x.part")) & (F.col("y.kept_by") == F.col("after")))
    change = work.table("changes", change.select(
        F.col("x.part").alias("part"), "before", "after", "filter", F.col("y.n").alias("kept"), (F.col("x.n") - F.col("y.n")).alias("removed"),
        (F.col("x.good") - F.col("y.good")).alias("good_lost"), (F.col("x.toxic") - F.col("y.toxic")).alias("toxic_lost"),
    ))
    # A filter follows the same subset in |before|! * (4 - |before|)! orders.
    ways = F.lit(0)
    for size in range(len(FILTERS)):
        ways = F.when(F.bit_count("before") == size, math.factorial(size) * math.factorial(len(FILTERS) - 1 - size)).otherwise(ways)
    whole = change.groupBy(F.col("part").alias("p"), F.col("filter").alias("f")).agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed")).otherwise(0)).alias("fails"), F.sum(F.when(F.col("after") == _FULL, F.col("removed")).otherwise(0)).alias("unique_fails"), F.sum(F.col("removed") * ways).alias("shapley")
    )
    stepped = change.join(F.broadcast(steps), ["before", "after", "filter"]).join(whole, F.col("part").eqNullSafe(F.col("p")) & (F.col("filter") == F.col("f")))
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return stepped.withColumn("redundant", F.col("fails") - F.col("removed")).select("part", "filter_order", "step", *(F.col(c).cast("long").alias(c) for c in counts))


#: Worked out order by order: a cell of flags goes at the first of its failing filters.
ORACLE_SQL = """
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
cut AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM texts),
flagged AS (
  SELECT part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
    100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    doc_id > min(doc_id) OVER (PARTITION BY text) AS e, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
  FROM cut LEFT JOIN labels USING (doc_id)),
cells AS (SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM flagged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT v.f || w.f || x.f || y.f || z.f AS filter_order FROM letters v, letters w, letters x, letters y, letters z
  WHERE len(list_distinct([v.f, w.f, x.f, y.f, z.f])) = 5),
gone AS (
  SELECT part, filter_order, n, good, toxic, a::INT + b::INT + c::INT + d::INT + e::INT AS fails, map(['A', 'B', 'C', 'D', 'E'], [a, b, c, d, e]) AS flags,
    least(CASE WHEN a THEN instr(filter_order, 'A') ELSE 9 END, CASE WHEN b THEN instr(filter_order, 'B') ELSE 9 END, CASE WHEN c THEN instr(filter_order, 'C') ELSE 9 END,
      CASE WHEN d THEN instr(filter_order, 'D') ELSE 9 END, CASE WHEN e THEN instr(filter_order, 'E') ELSE 9 END) AS gone_at
  FROM cells, orders),
steps AS (
  SELECT part, filter_order, step::INT AS step, substr(filter_order, step, 1) AS f,
    sum(CASE WHEN gone_at > step THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN gone_at = step THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN gone_at < step AND flags[substr(filter_order, step, 1)] THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails = 1 AND flags[substr(filter_order, step, 1)] THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN gone_at = step THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN gone_at = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM gone, (SELECT unnest(range(1, 6)) AS step) GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM steps"""
