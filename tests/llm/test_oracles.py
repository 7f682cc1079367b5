"""The queries with SQL against DuckDB on the whole tables."""

import sys

import duckdb
import pytest

from basketry.llm import queries

sys.path.insert(0, "tools")
from oracle_check import _rows  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "pages", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, got) == _rows(columns, res.fetchall())
