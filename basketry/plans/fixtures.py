"""Driver tables -> reference-shaped Bronze tables (see FIXTURES.md).

The order source of the original pipeline (order lines, options, calendar)
is not shipped; these deterministic projections of the TPC-H-like test
tables have the same columns, types and data-quality problems (NULL keys,
duplicate keys, guests, NULL loyalty flags, unparsable times, negative
option prices), so Spark and the DuckDB oracle compute from the same
Parquet files. Raw column names are upper-case, as in the source database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture definition.
NULL_KEY_PARTKEY_MOD = 101
GUEST_PRIORITY = "4-NOT SPECIFIED"
NULL_ITEM_PART_SIZE = 13
BAD_TIME_ORDERKEY_MOD = 97
NAN_PRICE_ORDERKEY_MOD = 89
BAD_TIME_TEXT = "bad"
ISO_OUT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
NEW_YEAR_HOLIDAY = "New Year"
EVENT_RESTAURANTS = 20


# Tables to repartition by the given columns right after the scan. Empty, so
# that a scan adds no shuffle; bench.py fills it, because the single row group
# of each test file would otherwise run in one task.
SPREAD: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in SPREAD:
        df = df.repartition(*SPREAD[name])
    return df


def _line_key(orderkey, linenumber):
    return F.concat_ws("-", orderkey.cast("string"), linenumber.cast("string"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ``order_items`` from ``lineitem ⋈ orders ⋈ part``."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    # what depends on the order alone is derived once per order, not once per line
    created = F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate"))
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == GUEST_PRIORITY, F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("user_id"),
        F.when(F.col("o_orderkey") % BAD_TIME_ORDERKEY_MOD == 0, F.lit(BAD_TIME_TEXT))
        .otherwise(F.date_format(created, ISO_OUT_PATTERN))
        .alias("creation_time_utc"),
    )
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(pt, li.l_partkey == pt.p_partkey)
    no_item = F.col("p_size") == NULL_ITEM_PART_SIZE
    return j.select(
        F.when(F.col("l_partkey") % NULL_KEY_PARTKEY_MOD == 0, F.lit(None).cast("string"))
        .otherwise(_line_key(F.col("l_orderkey"), F.col("l_linenumber")))
        .alias("LINEITEM_ID"),
        F.col("l_orderkey").cast("string").alias("ORDER_ID"),
        F.col("user_id").alias("USER_ID"),
        F.col("l_suppkey").cast("string").alias("RESTAURANT_ID"),
        F.col("o_orderstatus").alias("APP_NAME"),
        F.lit("USD").alias("CURRENCY"),
        F.when(no_item, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("ITEM_CATEGORY"),
        F.when(no_item, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("ITEM_NAME"),
        F.col("p_retailprice").cast("double").alias("ITEM_PRICE"),
        F.floor("l_quantity").cast("int").alias("ITEM_QUANTITY"),
        F.when(F.col("l_returnflag") == "A", F.lit(True))
        .when(F.col("l_returnflag") == "R", F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
        .alias("IS_LOYALTY"),
        F.col("creation_time_utc").alias("CREATION_TIME_UTC"),
    )


def profile_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`order_items` with NaN prices on some orders (profiling only)."""
    items = order_items(spark, sf_dir)
    nan = F.col("ORDER_ID").cast("bigint") % NAN_PRICE_ORDERKEY_MOD == 0
    return items.withColumn("ITEM_PRICE", F.when(nan, F.lit(float("nan"))).otherwise(F.col("ITEM_PRICE")))


def order_item_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ``order_item_options`` from discounted ``lineitem`` rows."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_discount") > 0)
    return li.select(
        F.when(F.col("l_partkey") % NULL_KEY_PARTKEY_MOD == 0, F.lit(None).cast("string"))
        .otherwise(_line_key(F.col("l_orderkey"), F.col("l_linenumber")))
        .alias("LINEITEM_ID"),
        F.col("l_orderkey").cast("string").alias("ORDER_ID"),
        F.col("l_returnflag").alias("OPTION_GROUP_NAME"),
        F.col("l_linestatus").alias("OPTION_NAME"),
        ((F.col("l_partkey") % 500 - 50) / 100).cast("double").alias("OPTION_PRICE"),
        (F.col("l_suppkey") % 3 + 1).cast("int").alias("OPTION_QUANTITY"),
    )


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ``date_dim``: one row per order date, every row present twice."""
    d = (
        table(spark, sf_dir, "orders")
        .select(F.to_date("o_orderdate").alias("d"))
        .distinct()
    )
    once = d.select(
        F.date_format("d", "yyyy-MM-dd").alias("date_key"),
        F.year("d").alias("year"),
        F.month("d").alias("month"),
        F.weekofyear("d").alias("week"),
        F.date_format("d", "EEEE").alias("day_of_week"),
        F.when((F.month("d") == 1) & (F.dayofmonth("d") == 1), F.lit(NEW_YEAR_HOLIDAY))
        .otherwise(F.lit(None).cast("string"))
        .alias("holiday_name"),
    )
    return once.unionAll(once)


def event_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped order lines from ``events`` (short gaps between days)."""
    ev = table(spark, sf_dir, "events")
    ts_ms = F.date_trunc("millisecond", F.col("ts"))
    day = F.date_format("ts", "yyyy-MM-dd")
    return ev.select(
        F.col("event_id").cast("string").alias("LINEITEM_ID"),
        F.concat_ws(
            "-", F.col("user_id").cast("string"), day, (F.col("event_id") % 3).cast("string")
        ).alias("ORDER_ID"),
        F.col("user_id").cast("string").alias("USER_ID"),
        (F.col("event_id") % EVENT_RESTAURANTS).cast("string").alias("RESTAURANT_ID"),
        F.col("event_type").alias("APP_NAME"),
        F.lit("USD").alias("CURRENCY"),
        F.col("event_type").alias("ITEM_CATEGORY"),
        F.col("event_type").alias("ITEM_NAME"),
        F.col("value").cast("double").alias("ITEM_PRICE"),
        F.lit(1).cast("int").alias("ITEM_QUANTITY"),
        F.when(F.col("event_type") == "purchase", F.lit(True))
        .when(F.col("event_type") == "error", F.lit(None).cast("boolean"))
        .otherwise(F.lit(False))
        .alias("IS_LOYALTY"),
        F.date_format(ts_ms, ISO_OUT_PATTERN).alias("CREATION_TIME_UTC"),
    )
