"""Behaviours of the original pipeline kept on purpose; each test
fails if someone "fixes" the behaviour silently."""

import datetime as dt

from pyspark.sql import functions as F

from basketry.functions import display_number
from basketry.operators import gold, metrics, profile, silver

ITEM_SCHEMA = (
    "LINEITEM_ID string, ORDER_ID string, USER_ID string, RESTAURANT_ID string, "
    "ITEM_PRICE double, ITEM_QUANTITY int, IS_LOYALTY boolean, CREATION_TIME_UTC string"
)


def enriched(spark, rows):
    orders = silver.fact_orders(spark.createDataFrame(rows, ITEM_SCHEMA), order_by="all")
    return gold.enrich_orders(orders, None)


def test_q6_avg_order_value_averages_lines(spark):
    rows = [
        ("L1", "o1", "u", "r", 10.0, 1, True, "2021-01-01T00:00:00.000Z"),
        ("L2", "o1", "u", "r", 20.0, 1, True, "2021-01-01T00:00:00.000Z"),
        ("L3", "o2", "u", "r", 30.0, 1, True, "2021-01-01T00:00:00.000Z"),
    ]
    loc = gold.location_daily(enriched(spark, rows)).first()
    assert loc.total_orders == 2
    assert loc.avg_order_value == 20.0  # 60 / 3 lines, not 60 / 2 orders


def test_q7_null_loyalty_is_neither(spark):
    rows = [
        ("L1", "o1", "u", "r", 10.0, 1, None, "2021-01-01T00:00:00.000Z"),
        ("L2", "o2", "u", "r", 5.0, 1, True, "2021-01-01T00:00:00.000Z"),
    ]
    loc = gold.location_daily(enriched(spark, rows)).first()
    assert loc.loyalty_revenue + loc.non_loyalty_revenue != loc.total_revenue
    assert (loc.loyalty_orders, loc.non_loyalty_orders) == (1, 0)


def test_q11_total_orders_counts_per_user_day(spark):
    rows = [
        ("L1", "o1", "u1", "r", 1.0, 1, True, "2021-01-01T23:00:00.000Z"),
        ("L2", "o1", "u1", "r", 1.0, 1, True, "2021-01-02T01:00:00.000Z"),
    ]
    e = enriched(spark, rows)
    fc, loc = gold.fact_customer(e), gold.location_daily(e)
    ov = metrics.overview(fc, loc).first()
    assert ov.total_orders == 2  # one order over two days counts twice
    assert ov.total_customers == 1 and ov.total_restaurants == 1


def test_q13_frequency_counts_days_not_orders_h6_grain(spark):
    rows = [
        ("L1", "o1", "u1", "r", 1.0, 1, True, "2021-01-01T01:00:00.000Z"),
        ("L2", "o2", "u1", "r", 1.0, 1, True, "2021-01-01T02:00:00.000Z"),
        ("L3", "o3", "u1", "r", 1.0, 1, True, "2021-01-03T02:00:00.000Z"),
    ]
    fc = {r.creation_date: r for r in gold.fact_customer(enriched(spark, rows)).collect()}
    last = fc[dt.date(2021, 1, 3)]
    assert last.frequency_7d == 2  # two active days, three orders
    assert last.monetary_7d == 3.0


def test_q10_discount_flag_ignores_prices(spark):
    loc = spark.createDataFrame(
        [(5.0, 5.0), (5.0, 0.0), (None, 1.0)], "total_revenue double, non_loyalty_revenue double"
    )
    got = {r.discount_applied: r.total_revenue for r in metrics.discount_revenue(loc).collect()}
    assert got == {False: 5.0, True: 5.0}


def test_d5_duplicate_column_names(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "a"])
    assert profile.has_duplicate_columns(df)


def test_a8_shape_and_f19_display(spark):
    df = spark.createDataFrame([(1234.5, "x"), (2.0, "y")], "v double, t string")
    sh = profile.shape(df).first()
    assert (sh.rows, sh.columns, list(sh.column_names)) == (2, 2, ["v", "t"])
    assert df.select(display_number("v").alias("s")).first().s == "1,234.50"
    # half-to-even, like Python's f"{1234.5:,.0f}"
    assert df.select(display_number(F.col("v"), 0).alias("s")).first().s == f"{1234.5:,.0f}"


def test_q16_overwrite_mode_needs_partitions(spark, tmp_out):
    """Dynamic overwrite without partition columns replaces the whole table."""
    from basketry.sources import write_parquet

    path = f"{tmp_out}/t"
    write_parquet(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path)
    write_parquet(spark.createDataFrame([(3, "a")], "v int, p string"), path, dynamic_overwrite=True)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(3, "a")]


def test_q18_dim_date_is_built_but_not_joined(spark):
    import contextlib
    import io

    from basketry.plans import pipeline as pl

    sf = "/root/testdata/sf0.001"
    assert pl.silver_dim_date(spark, sf).count() > 0
    for df in (pl.fact_customer(spark, sf), pl.location_daily(spark, sf)):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        assert "date_key" not in buf.getvalue()
