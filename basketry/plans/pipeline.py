"""End-to-end plans over the fixture tables: Bronze -> Silver -> Gold.

Each function rebuilds the lazy plan from the Parquet files; nothing is
collected. Survivors of every dedupe are deterministic (``order_by="all"``)
so results can be compared with an independent SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import gold, silver
from basketry.plans import fixtures as fx
from basketry.session import materialize_parts, remove_path, scratch_path

DEDUPE_ORDER = "all"
# stored_location_daily: order lines beyond which another pass is made, and passes at most
PASS_LINES = 1_000_000
MOST_PASSES = 3


def silver_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_date(fx.date_dim(spark, sf_dir), order_by=DEDUPE_ORDER)


def silver_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.fact_orders(fx.order_items(spark, sf_dir), order_by=DEDUPE_ORDER)


def silver_fact_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.fact_options(fx.order_item_options(spark, sf_dir), order_by=DEDUPE_ORDER)


def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.enrich_orders(silver_fact_orders(spark, sf_dir), silver_fact_options(spark, sf_dir))


def event_enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines derived from ``events`` (no options)."""
    orders = silver.fact_orders(fx.event_order_items(spark, sf_dir), order_by=DEDUPE_ORDER)
    return gold.enrich_orders(orders, None)


def fact_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_customer(enriched_orders(spark, sf_dir))


def event_fact_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_customer(event_enriched_orders(spark, sf_dir))


def location_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.location_daily(enriched_orders(spark, sf_dir))


def stored_location_daily(spark: SparkSession, sf_dir: str, passes: int | None = None) -> DataFrame:
    """:func:`location_daily`, stored, with the shuffle files of one step on disk at a time.

    All dedupes and joins up to an enriched line have ``lineitem_id`` among
    their keys, so the lines are dealt into passes by its hash; the filter
    reaches the scan. What a location-day needs of its lines is stored pass by
    pass and deleted once the location-days are stored. Every pass reads the
    sources again, so there are ``MOST_PASSES`` at most.
    """
    days_path = scratch_path(spark, "location-days")
    if passes is None:
        passes = min(MOST_PASSES, 1 + fx.table(spark, sf_dir, "lineitem").count() // PASS_LINES)
    if passes == 1:
        return materialize_parts(spark, [location_daily(spark, sf_dir)], days_path)

    def enriched(i: int) -> DataFrame:
        dealt = F.pmod(F.xxhash64("LINEITEM_ID"), F.lit(passes)) == i
        orders = silver.fact_orders(fx.order_items(spark, sf_dir).where(dealt), order_by=DEDUPE_ORDER)
        options = silver.fact_options(fx.order_item_options(spark, sf_dir).where(dealt), order_by=DEDUPE_ORDER)
        return gold.enrich_orders(orders, options).select(*gold.LOCATION_INPUT)

    lines_path = scratch_path(spark, "location-lines")
    lines = materialize_parts(spark, (enriched(i) for i in range(passes)), lines_path)
    days = materialize_parts(spark, [gold.location_daily(lines)], days_path)
    remove_path(spark, lines_path)
    return days


def fact_orders_location(spark: SparkSession, sf_dir: str, money_precision: int | None = None) -> DataFrame:
    return gold.add_revenue_ranks(stored_location_daily(spark, sf_dir), money_precision=money_precision, stored=True)
