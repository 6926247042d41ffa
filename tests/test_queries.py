"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import datetime as dt
import decimal

import duckdb
import pytest

from tests.conftest import DATA
from tidewater import queries as q
from tidewater.plans.bronze import TABLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(" ")
    if isinstance(v, dt.date):
        return f"{v.isoformat()} 00:00:00"
    return str(v)


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = q.QUERIES[name](spark, DATA)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    cursor = duck.execute(q.ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in sorted(columns)]
    want = sorted(tuple(plain(r[i]).replace(" 00:00:00 00:00:00", " 00:00:00") for i in order) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - set(q.ORACLE_SQL)))
def test_other_queries_run(spark, name):
    assert q.QUERIES[name](spark, DATA).collect()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("gone", [("llm", "corpus_pipeline.py"), ("llm",)])
def test_the_library_stands_without_its_optional_part(tmp_path, gone):
    """A copy without the corpus operators, with or without their pipeline, still imports, with all other queries."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", *gone, "__pycache__", "tests"))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), sum(k.startswith('op') and k[2].isdigit() for k in e.queries()))"], cwd=tmp_path / "repo", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.stdout.split() == [str(len(q.QUERIES)), "0"], out.stderr
