"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from tests.conftest import DATA
from tests.test_queries import plain
from tidewater.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "sale_lines", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    df = queries.QUERIES[name](spark, DATA)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    cursor = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    order = [columns.index(c) for c in sorted(columns)]
    assert sorted(columns) == sorted(df.columns)
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
