"""Silver -> Gold: enriched order lines, customer-day facts, location-day facts.

Plan shape (see README "Plans"):

* options are aggregated to one row per (order, line) *before* the join, so
  the left join never multiplies order lines;
* customer metrics are computed on the customer-day grain: the daily
  aggregate bounds every user's window partition by the number of distinct
  days, however many lines a hot user has;
* recency, cumulative value and the 7/30/90-day rolling metrics share one
  window specification (user, ``unix_date``), i.e. one shuffle and one sort.
  The rolling metrics use a RANGE frame instead of the original self-join,
  which is O(days x window) per user;
* location ranks over day-of-month / ISO week / month have only 31 / 53 / 12
  groups, so no window sees a whole group: rows are counted per value and
  combination of periods, dealt into ranges of values once, and get all three
  ranks from one join (:func:`basketry.operators.ranking.rank_within_few`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.rules import (
    CHURN_HIGH_AFTER_DAYS,
    CHURN_MEDIUM_AFTER_DAYS,
    churn_flag,
    period_part,
    round_half_up,
)
from basketry.operators.ranking import rank_within_few
from basketry.session import materialize_parts, scratch_path

ROLLING_WINDOWS = (7, 30, 90)
CUSTOMER_DAY = ["user_id", "creation_date"]
LOCATION_DAY = ["creation_date", "restaurant_id"]
LOCATION_INPUT = [*LOCATION_DAY, "order_id", "is_loyalty", "total_item_revenue"]  # what location_daily reads
PERIODS = ("day", "week", "month")


def options_revenue(fact_options: DataFrame) -> DataFrame:
    """Options revenue per (order, line): ``sum(price * quantity)``, NULLs skipped."""
    return fact_options.groupBy("order_id", "lineitem_id").agg(
        F.sum(F.col("option_price") * F.col("option_quantity")).alias("options_revenue")
    )


def enrich_orders(
    fact_orders: DataFrame,
    fact_options: DataFrame | None,
    drop_guests: bool = True,
) -> DataFrame:
    """Order lines with ``options_revenue`` (0.0 if none) and ``total_item_revenue``.

    ``total_item_revenue = item_price * item_quantity + options_revenue``;
    a NULL price or quantity leaves it NULL. Guest lines (NULL ``user_id``)
    are dropped by default, before location metrics too.
    """
    orders = fact_orders.where(F.col("user_id").isNotNull()) if drop_guests else fact_orders
    if fact_options is None:
        joined = orders.withColumn("options_revenue", F.lit(None).cast("double"))
    else:
        joined = orders.join(options_revenue(fact_options), ["order_id", "lineitem_id"], "left")
    opt = F.coalesce(F.col("options_revenue"), F.lit(0.0))
    return joined.withColumns(
        {
            "options_revenue": opt,
            "total_item_revenue": F.col("item_price") * F.col("item_quantity") + opt,
        }
    )


def _loyalty_sum(flag, value):
    return F.sum(F.when(flag, value).otherwise(F.lit(0)))


def customer_daily(enriched: DataFrame) -> DataFrame:
    """Customer-day aggregate (NULL date kept as its own day).

    ``loyalty_orders`` counts loyalty *lines*, as in the original job.
    """
    loyal = F.col("is_loyalty")
    return enriched.groupBy(*CUSTOMER_DAY).agg(
        F.count_distinct("order_id").alias("orders_daily"),
        F.sum("total_item_revenue").alias("revenue_daily"),
        _loyalty_sum(loyal, F.col("total_item_revenue")).alias("loyalty_revenue"),
        F.count_if(loyal).alias("loyalty_orders"),
    )


_DAY = "_day"  # unix_date(creation_date): the one order column of all user windows


def _with_day(daily: DataFrame) -> tuple[DataFrame, bool]:
    if _DAY in daily.columns:
        return daily, False
    return daily.withColumn(_DAY, F.unix_date("creation_date")), True


def _user_window():
    # One spec (same partition and order attribute) for lag, running sum and
    # range frames: Spark evaluates them in one Window operator after one sort.
    return Window.partitionBy("user_id").orderBy(F.col(_DAY))


def add_recency_churn(
    daily: DataFrame,
    medium_after: int = CHURN_MEDIUM_AFTER_DAYS,
    high_after: int = CHURN_HIGH_AFTER_DAYS,
) -> DataFrame:
    """``recency_days`` = days since the user's previous active day (0 for the
    first; NULL dates sort first) and ``churn_risk_flag`` from it."""
    df, added = _with_day(daily)
    prev = F.lag("creation_date").over(_user_window())
    recency = F.coalesce(F.datediff(F.col("creation_date"), prev), F.lit(0))
    out = df.withColumn("recency_days", recency)
    out = out.withColumn("churn_risk_flag", churn_flag("recency_days", medium_after, high_after))
    return out.drop(_DAY) if added else out


def add_clv_cumulative(daily: DataFrame) -> DataFrame:
    """Running sum of ``revenue_daily`` per user, ROWS unbounded preceding."""
    df, added = _with_day(daily)
    w = _user_window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumn("clv_cumulative", F.sum("revenue_daily").over(w))
    return out.drop(_DAY) if added else out


def add_rolling_metrics(daily: DataFrame, windows: Sequence[int] = ROLLING_WINDOWS) -> DataFrame:
    """``frequency_Nd`` (active days) and ``monetary_Nd`` (revenue) over the
    N days ending at each row's date.

    Requires one row per (user, date) — the customer-day grain guarantees it.
    Rows with a NULL date get NULL metrics (they match no date range).
    """
    out, added = _with_day(daily)
    dated = F.col("creation_date").isNotNull()
    cols = {}
    for n in windows:
        if n < 1:
            raise ValueError("rolling window must be >= 1 day")
        w = _user_window().rangeBetween(-(n - 1), 0)
        cols[f"frequency_{n}d"] = F.when(dated, F.count(F.lit(1)).over(w))
        cols[f"monetary_{n}d"] = F.when(dated, F.sum("revenue_daily").over(w))
    out = out.withColumns(cols)
    return out.drop(_DAY) if added else out


def fact_customer(
    enriched: DataFrame,
    windows: Sequence[int] = ROLLING_WINDOWS,
    medium_after: int = CHURN_MEDIUM_AFTER_DAYS,
    high_after: int = CHURN_HIGH_AFTER_DAYS,
) -> DataFrame:
    """Gold ``fact_customer``: customer-day metrics, recency, churn, CLV, rolling."""
    daily, _ = _with_day(customer_daily(enriched))
    daily = add_recency_churn(daily, medium_after, high_after)
    daily = add_clv_cumulative(daily)
    return add_rolling_metrics(daily, windows).drop(_DAY)


def location_daily(enriched: DataFrame) -> DataFrame:
    """Location-day aggregate plus ``period_day/week/month`` and ``year`` (0 if no date)."""
    loyal = F.col("is_loyalty")
    rev = F.col("total_item_revenue")
    agg = enriched.groupBy(*LOCATION_DAY).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum(rev).alias("total_revenue"),
        F.avg(rev).alias("avg_order_value"),
        _loyalty_sum(loyal, rev).alias("loyalty_revenue"),
        F.count_if(loyal).alias("loyalty_orders"),
        _loyalty_sum(~loyal, rev).alias("non_loyalty_revenue"),
        F.count_if(~loyal).alias("non_loyalty_orders"),
    )
    return agg.withColumns(
        {
            "period_day": period_part("creation_date", "day"),
            "period_week": period_part("creation_date", "week"),
            "period_month": period_part("creation_date", "month"),
            "year": period_part("creation_date", "year"),
        }
    )


def add_revenue_ranks(
    location: DataFrame,
    with_year: bool = False,
    money_precision: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """``revenue_rank_day/week/month``: rank of ``total_revenue`` (desc) within
    day-of-month, ISO week and month.

    Like the original job the periods ignore the year unless ``with_year``.
    Ranks are on the raw double; ``money_precision`` rounds it first, so that
    ties do not depend on floating-point summation order. The input is stored
    once (``stored`` vouches that it already is) and all three ranks come from
    one frame of counts per value.
    """
    value = F.col("total_revenue")
    if money_precision is not None:
        value = round_half_up(value, money_precision)
    year = ["year"] if with_year else []
    if not stored:
        spark = location.sparkSession
        location = materialize_parts(spark, [location], scratch_path(spark, "location-days"))
    return rank_within_few(
        location, {f"revenue_rank_{p}": [*year, f"period_{p}"] for p in PERIODS}, value, descending=True
    )


def fact_orders_location(
    enriched: DataFrame,
    with_year: bool = False,
    money_precision: int | None = None,
) -> DataFrame:
    """Gold ``fact_orders_location``."""
    return add_revenue_ranks(location_daily(enriched), with_year, money_precision)
