"""Location-days built in passes: same rows, and the shuffle files of stored steps are gone."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from basketry.operators import gold
from basketry.plans import fixtures as fx
from basketry.plans import pipeline as pl
from basketry.session import SHUFFLE_CLEANUP, materialize_parts, remove_path, scratch_path


def shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def settled_shuffle_files(spark, most: int) -> int:
    """Files are removed in the background: wait until there are at most ``most``."""
    for _ in range(100):
        if (n := shuffle_files(spark)) <= most:
            break
        time.sleep(0.1)
    return n


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture()
def tables(spark, tmp_out):
    """Order lines with repeated and NULL keys, repeated orders and options, orders and parts that are missing."""
    rnd = random.Random(11)
    day = dt.datetime(2021, 3, 1)
    orders = [(k, k % 9, "F", day + dt.timedelta(days=k % 5), "4-NOT SPECIFIED" if k % 7 == 0 else "1-URGENT") for k in range(1, 120)]
    parts = [(k, f"p{k}", f"t{k % 4}", k % 15, 10.0 + k / 100) for k in range(90, 215)]
    lines = [
        (
            rnd.choice([None, *range(1, 125)]),
            rnd.choice([None, 101, 202, *range(85, 210)]),
            rnd.randint(1, 6),
            rnd.choice([None, 1, 2, 3]),
            float(rnd.randint(1, 9)),
            rnd.choice([0.0, 0.05, 0.1, None]),
            rnd.choice(["A", "R", "N", None]),
            rnd.choice(["O", "F"]),
        )
        for _ in range(1500)
    ]
    lines += lines[:200]
    for name, rows, schema in (
        ("orders", orders + orders[:3], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        ("part", parts, "p_partkey long, p_name string, p_type string, p_size int, p_retailprice double"),
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_returnflag string, l_linestatus string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_out}/{name}.parquet")
    return tmp_out


def rows_of(df):
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())


def test_passes_give_the_same_location_days(spark, tables):
    want = rows_of(pl.location_daily(spark, tables))
    assert len(want) > 20
    for passes in (None, 1, 3):
        got = pl.stored_location_daily(spark, tables, passes=passes)
        assert got.dtypes == pl.location_daily(spark, tables).dtypes
        assert rows_of(got) == want


def test_pass_filter_reaches_the_scan(spark, tables, no_broadcast):
    dealt = F.pmod(F.xxhash64("LINEITEM_ID"), F.lit(3)) == 1
    for bronze in (fx.order_items(spark, tables), fx.order_item_options(spark, tables)):
        text = bronze.where(dealt)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        at = [i for i, line in enumerate(text) if "xxhash64" in line]
        joins = [i for i, line in enumerate(text) if "Join" in line]
        assert at and all(a > j for a in at for j in joins), text


@pytest.mark.parametrize("name", ["gold_location_ranked", "gold_location_ranked_by_year"])
def test_ranked_leaves_no_shuffle_files_of_stored_steps(spark, tables, no_broadcast, monkeypatch, name):
    """Nor do the passes: the queries keep as many lines on disk as one pass has."""
    from basketry.plans import catalog

    calls = []
    monkeypatch.setattr(pl, "PASS_LINES", 1000)
    monkeypatch.setattr(gold, "enrich_orders", lambda *a, _own=gold.enrich_orders: calls.append(a) or _own(*a))
    before = shuffle_files(spark)
    df = catalog.queries()[name](spark, tables)
    assert len(calls) == 2  # 1,700 lines
    assert settled_shuffle_files(spark, before) <= before
    assert df.count() > 20


def test_parts_are_stored_one_after_the_other(spark, no_broadcast):
    path, before, seen = scratch_path(spark, "parts"), shuffle_files(spark), []

    def parts():
        for i in range(3):
            seen.append(settled_shuffle_files(spark, before))
            yield spark.range(200).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")).where(F.col("k") % 3 == i)

    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    out = materialize_parts(spark, parts(), path)
    assert {r.k: r.n for r in out.collect()} == {k: len(range(k, 200, 7)) for k in range(7)}
    assert all(n <= before for n in seen) and settled_shuffle_files(spark, before) <= before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == old
    remove_path(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_location_days_need_only_their_input_columns(spark, tables):
    lines = pl.enriched_orders(spark, tables)
    assert rows_of(gold.location_daily(lines.select(*gold.LOCATION_INPUT))) == rows_of(gold.location_daily(lines))
