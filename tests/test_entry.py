"""Driver contract: entry(), queries() and oracle_sql() agree; a sample of
queries matches DuckDB on the smallest scale."""

import sys

import duckdb
import pytest

import __spark_entry__ as entry

sys.path.insert(0, "tools")
from oracle_check import TABLES, _rows  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "clv_cumulative" in df.columns and "monetary_90d" in df.columns


def test_every_query_has_oracle_sql():
    from basketry.plans import catalog, oracle

    assert set(oracle.oracle_sql()) == set(catalog.queries())
    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_works_without_the_optional_operators():
    """In a fresh interpreter that cannot find them."""
    import subprocess

    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("basketry.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
from basketry.plans import catalog
assert set(e.queries()) == set(catalog.queries()) == set(e.oracle_sql())
"""
    subprocess.run([sys.executable, "-c", code], check=True)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize(
    "name",
    [
        "silver_fact_orders",
        "gold_fact_customer",
        "gold_location_ranked",
        "insight_rfm_users_events",
        "insight_churn_counts",
        "profile_iqr_outliers",
    ],
)
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert _rows(sdf.columns, s_rows) == _rows(d_cols, d_rows)
