"""Every registered query of the engine against DuckDB on the same tables."""

import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from gustloom.plans import audits, catalog, history, inputs  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v) or str(v) in ("NaT", "<NA>"):
        return "null"
    try:
        return repr(float(v)) if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


def same_rows(df, other):
    columns = sorted(df.columns)
    assert columns == sorted(other.columns)
    rows = [sorted(tuple(map(plain, r)) for r in x[columns].itertuples(index=False)) for x in (df, other)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    same_rows(catalog.QUERIES[name](spark, sf).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry_without_the_llm_folders(tmp_path):
    """The other queries are there when the llm subpackage, with or without the pipeline, has been taken away."""
    root = Path(__file__).parent.parent
    shutil.copytree(root / "gustloom", tmp_path / "gustloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    check = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'audit_svg' in q and 'audit_svg' in o and not any(n.startswith('op') or n == 'pipeline' for n in [*q, *o])"
    for name in ("", "corpus_pipeline.py"):
        if name and (root / name).exists():
            shutil.copy(root / name, tmp_path)
        subprocess.run([sys.executable, "-c", check], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_bundles_that_many_steps_read_are_made_once(spark, sf):
    for made in (audits._model_bundles(spark, sf, "test", "0"), audits._archive_bundles(spark, sf)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert made.storageLevel.useDisk and "collect_list" not in plan and "InMemoryTableScan" in plan
        made.unpersist()
