"""Business metrics over the Gold tables (overview, CLV, RFM, churn, trends,
loyalty, locations, discounts).

Every function is ``DataFrame(s) -> DataFrame`` and runs in Spark; results
are small, the Gold tables never reach the driver. Only scalars (a quantile,
a count) are read back where a later step needs them as a threshold.

pandas-compatibility rules kept from the original dashboard: NULL group keys
are dropped where it grouped by a nullable key, sums of nothing are 0, and
comparisons with NULL count as False.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.rules import (
    CHURN_LEVELS,
    SEGMENT_CHURN,
    SEGMENT_NEW,
    SEGMENT_VIP,
    churn_from_rank,
    churn_rank,
    clv_group,
    null_safe_flag,
    rfm_segment,
    round_half_up,
)
from basketry.operators.ranking import grouped_quantiles, null_safe_join, tercile_scores_many
from basketry.session import materialize

RFM_WINDOWS = (7, 30, 90)
CLV_QUANTILES = (0.20, 0.80)
CLV_BINS = 50


def _sum0(c) -> F.Column:
    return F.coalesce(F.sum(c), F.lit(0))


_NULL_DATE_IS_LATEST = 1 << 62


def _latest_first_key():
    # "Latest" row per user with dates ascending and NULL dates sorted last,
    # as the dashboard did. One long (day number, NULL date largest) keeps the
    # max_by buffer primitive, so Spark can hash-aggregate instead of sorting.
    return F.coalesce(F.unix_date("creation_date").cast("long"), F.lit(_NULL_DATE_IS_LATEST))


# ------------------------------------------------------------------ overview
def overview(fact_customer: DataFrame, fact_orders_location: DataFrame) -> DataFrame:
    """One row: distinct restaurants, distinct customers, total orders, revenue.

    Both tables feed one global aggregate over a tagged union (no join).
    """
    loc = fact_orders_location.select(
        F.col("restaurant_id").alias("_r"),
        F.lit(None).cast("string").alias("_u"),
        F.lit(None).cast("bigint").alias("_o"),
        F.lit(None).cast("double").alias("_v"),
    )
    cust = fact_customer.select(
        F.lit(None).cast("string").alias("_r"),
        F.col("user_id").cast("string").alias("_u"),
        F.col("orders_daily").cast("bigint").alias("_o"),
        F.col("revenue_daily").cast("double").alias("_v"),
    )
    return loc.unionByName(cust).agg(
        F.count_distinct("_r").alias("total_restaurants"),
        F.count_distinct("_u").alias("total_customers"),
        _sum0("_o").cast("bigint").alias("total_orders"),
        _sum0("_v").cast("double").alias("total_revenue"),
    )


# ------------------------------------------------------------------ CLV
def user_clv(
    fact_customer: DataFrame,
    probs: tuple[float, float] = CLV_QUANTILES,
    money_precision: int | None = None,
) -> tuple[DataFrame, float | None, float | None]:
    """Lifetime value per user (max cumulative) and its CLV group.

    Returns ``(frame, q_low, q_high)``; the frame has ``user_id``,
    ``clv_cumulative`` and ``CLV_Group`` (<= q_low Low, >= q_high High, else
    Medium; NULL -> Medium). Quantiles interpolate linearly over users.
    ``money_precision`` rounds values first so group boundaries do not depend
    on floating-point summation order.
    """
    clv = F.max("clv_cumulative")
    if money_precision is not None:
        clv = round_half_up(clv, money_precision)
    users = materialize(fact_customer.groupBy("user_id").agg(clv.alias("clv_cumulative")))
    q = grouped_quantiles(users, [], "clv_cumulative", list(probs)).first()
    q_low = None if q is None else q["q_0"]
    q_high = None if q is None else q["q_1"]
    lo = F.lit(q_low).cast("double")
    hi = F.lit(q_high).cast("double")
    return users.withColumn("CLV_Group", clv_group("clv_cumulative", lo, hi)), q_low, q_high


def clv_tagged(fact_customer: DataFrame, users: DataFrame) -> DataFrame:
    """Customer-day rows with their user's ``CLV_Group`` (left join on user)."""
    return fact_customer.join(users.select("user_id", "CLV_Group"), "user_id", "left")


def clv_kpis(users: DataFrame, q_high: float | None) -> DataFrame:
    """Total lifetime revenue, mean CLV and users with CLV >= the high quantile."""
    hi = F.lit(q_high).cast("double")
    return users.agg(
        _sum0("clv_cumulative").cast("double").alias("total_lifetime_revenue"),
        F.avg("clv_cumulative").alias("avg_clv"),
        F.count_if(null_safe_flag(F.col("clv_cumulative") >= hi)).alias("high_value_customers"),
    )


def histogram_bins(value, lo, hi, bins: int):
    """Equal-width bin index in [0, bins-1] over [lo, hi] (last bin closed).

    A degenerate range (lo == hi) is widened to lo-0.5 .. hi+0.5.
    """
    if bins < 1:
        raise ValueError("bins must be >= 1")
    same = lo == hi
    start = F.when(same, lo - 0.5).otherwise(lo)
    width = F.when(same, F.lit(1.0)).otherwise(hi - lo)
    idx = F.floor((value - start) / width * bins).cast("int")
    return F.least(F.greatest(idx, F.lit(0)), F.lit(bins - 1)), start, width


def clv_distribution(users: DataFrame, bins: int = CLV_BINS) -> DataFrame:
    """Customers per (CLV bin, CLV group); bins span all users' min..max.

    Every (group present, bin) pair is listed, empty ones with 0.
    """
    stats = users.agg(F.min("clv_cumulative").alias("lo"), F.max("clv_cumulative").alias("hi")).first()
    if stats is None or stats["lo"] is None:
        return users.select(
            F.lit(None).cast("int").alias("bin"),
            "CLV_Group",
            F.lit(None).cast("double").alias("bin_start"),
            F.lit(None).cast("double").alias("bin_end"),
            F.lit(0).cast("bigint").alias("customers"),
        ).limit(0)
    lo, hi = F.lit(float(stats["lo"])), F.lit(float(stats["hi"]))
    idx, start, width = histogram_bins(F.col("clv_cumulative"), lo, hi, bins)
    counts = (
        users.where(F.col("clv_cumulative").isNotNull())
        .groupBy("CLV_Group", idx.alias("bin"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    domain = (
        users.select("CLV_Group").distinct()
        .select("CLV_Group", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    )
    return (
        domain.join(counts, ["CLV_Group", "bin"], "left")
        .select(
            "bin",
            "CLV_Group",
            (start + width * F.col("bin") / bins).alias("bin_start"),
            (start + width * (F.col("bin") + 1) / bins).alias("bin_end"),
            F.coalesce("customers", F.lit(0)).cast("bigint").alias("customers"),
        )
    )


def nice_step(lo: float, hi: float, max_bins: int) -> float:
    """The least step of 1, 2 or 5 times a power of ten whose aligned bins cover ``lo`` .. ``hi`` in at most ``max_bins``.

    Bins are half open and start at multiples of the step. A single value gets
    a step of 1.
    """
    if max_bins < 2:
        raise ValueError("max_bins must be >= 2: a range around a bin's edge needs two")
    if lo == hi:
        return 1.0
    exponent = math.floor(math.log10((hi - lo) / max_bins)) - 1
    while True:
        for digit in (1, 2, 5):
            # one rounding only, so that another engine gets the same double
            step = digit * 10.0**exponent if exponent >= 0 else digit / 10.0**-exponent
            if math.floor(hi / step) - math.floor(lo / step) + 1 <= max_bins:
                return step
        exponent += 1


def nice_histogram(df: DataFrame, value: str, by: str, max_bins: int = CLV_BINS) -> DataFrame:
    """Rows per (aligned bin, ``by``): ``bin``, ``by``, ``bin_start``, ``bin_end``, ``n``.

    Bins are those of :func:`nice_step` over the whole range, numbered from
    the first; every pair of a bin and a present value of ``by`` (NULL is one)
    is listed, empty ones with 0. Missing values are left out.
    """
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    ends = known.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    if ends["lo"] is None:
        return df.select(
            F.lit(0).alias("bin"), by, F.lit(0.0).alias("bin_start"), F.lit(0.0).alias("bin_end"), F.lit(0).cast("bigint").alias("n")
        ).limit(0)
    step = nice_step(float(ends["lo"]), float(ends["hi"]), max_bins)
    first, last = (math.floor(float(ends[k]) / step) for k in ("lo", "hi"))
    place = (F.floor(F.col(value) / F.lit(step)) - F.lit(first)).cast("int")
    counts = known.groupBy(by, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    domain = df.select(by).distinct().select(by, F.explode(F.sequence(F.lit(0), F.lit(last - first))).alias("bin"))
    start = (F.col("bin") + F.lit(first)) * F.lit(step)
    return null_safe_join(domain, counts, [by, "bin"], "left").select(
        "bin", by, start.alias("bin_start"), (start + F.lit(step)).alias("bin_end"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def clv_distribution_nice(users: DataFrame, max_bins: int = CLV_BINS) -> DataFrame:
    """Customers per (aligned CLV bin, CLV group), in at most ``max_bins`` bins, as charts pick them."""
    return nice_histogram(users, "clv_cumulative", "CLV_Group", max_bins).withColumnRenamed("n", "customers")


def clv_summary(users: DataFrame) -> DataFrame:
    """Per CLV group: customers, revenue, mean CLV (rounded to 2), by mean desc."""
    return (
        users.groupBy("CLV_Group")
        .agg(
            F.count("user_id").alias("Total_Customers"),
            round_half_up(_sum0("clv_cumulative"), 2).alias("Total_Revenue"),
            round_half_up(F.avg("clv_cumulative"), 2).alias("Avg_CLV"),
        )
        .orderBy(F.col("Avg_CLV").desc_nulls_last(), "CLV_Group")
    )


# ------------------------------------------------------------------ RFM
def rfm_users(
    fact_customer: DataFrame,
    window_days: int = 30,
    scores: str = "codes",
    recency: str = "min",
    money_precision: int | None = None,
) -> DataFrame:
    """Per-user Recency / Frequency / Monetary, tercile scores and segment.

    * Recency = min ``recency_days`` (``recency="latest"``: the latest day's gap);
      Frequency / Monetary = max of ``frequency_Nd`` / ``monetary_Nd``.
    * Scores are tercile codes 0/1/2 of the rank (ties by ``user_id``); a
      column with <= 1 distinct value gets the default (R 3, F and M 1), so do
      NULLs. ``scores="labels"`` maps codes to R 3/2/1 and F, M 1/2/3.
    * Segment: any High churn -> Churn Risk; R=3, F>=2, M>=2 -> VIP; else New Customer.
    """
    if window_days not in RFM_WINDOWS:
        raise ValueError(f"window_days must be one of {RFM_WINDOWS}")
    if scores not in ("codes", "labels"):
        raise ValueError("scores must be 'codes' or 'labels'")
    if recency == "min":
        rec = F.min("recency_days")
    elif recency == "latest":
        rec = F.max_by("recency_days", _latest_first_key())
    else:
        raise ValueError("recency must be 'min' or 'latest'")
    users = fact_customer.groupBy("user_id").agg(
        rec.alias("Recency"),
        F.max(f"frequency_{window_days}d").alias("Frequency"),
        F.max(f"monetary_{window_days}d").alias("Monetary"),
        F.max(churn_rank("churn_risk_flag")).alias("churn_rank"),
    )
    users = materialize(users.withColumn("Churn_Risk", churn_from_rank("churn_rank")))
    money = F.col("Monetary")
    if money_precision is not None:
        money = round_half_up(money, money_precision)
    # Default scores and, for scores="labels", the labels of
    # codes 0/1/2 (recency is reversed: the lowest gap scores highest).
    spec = [
        (F.col("Recency"), "R_Score", 3, (3, 2, 1)),
        (F.col("Frequency"), "F_Score", 1, (1, 2, 3)),
        (money, "M_Score", 1, (1, 2, 3)),
    ]
    users = tercile_scores_many(
        users,
        [(c, name, default, labels if scores == "labels" else None) for c, name, default, labels in spec],
        "user_id",
    )
    users = users.withColumn("RFM_Score", F.col("R_Score") + F.col("F_Score") + F.col("M_Score"))
    return users.withColumn(
        "Segment", rfm_segment("Churn_Risk", "R_Score", "F_Score", "M_Score")
    )


def rfm_kpis(rfm: DataFrame) -> DataFrame:
    """Users, VIP, New Customer and Churn Risk counts (one row)."""
    seg = F.col("Segment")
    return rfm.agg(
        F.count(F.lit(1)).alias("Total_Customers"),
        F.count_if(seg == SEGMENT_VIP).alias("VIP_Customers"),
        F.count_if(seg == SEGMENT_NEW).alias("New_Customers"),
        F.count_if(seg == SEGMENT_CHURN).alias("Churn_Risk_Customers"),
    )


def rfm_segment_counts(rfm: DataFrame) -> DataFrame:
    """Users per segment."""
    return rfm.groupBy("Segment").agg(F.count("user_id").alias("Customers"))


def rfm_summary(rfm: DataFrame) -> DataFrame:
    """Per segment: users and mean R, F, M (rounded to 2)."""
    return rfm.groupBy("Segment").agg(
        F.count("user_id").alias("Customers"),
        round_half_up(F.avg("Recency"), 2).alias("Avg_Recency"),
        round_half_up(F.avg("Frequency"), 2).alias("Avg_Frequency"),
        round_half_up(F.avg("Monetary"), 2).alias("Avg_Monetary"),
    )


# ------------------------------------------------------------------ churn
def latest_churn(fact_customer: DataFrame) -> DataFrame:
    """Each user's churn flag on their latest row (NULL date counts as latest)."""
    latest = fact_customer.groupBy("user_id").agg(
        F.max_by(churn_rank("churn_risk_flag"), _latest_first_key()).alias("_rank")
    )
    return latest.select("user_id", churn_from_rank("_rank").alias("churn_risk_flag"))


def churn_counts(fact_customer: DataFrame) -> DataFrame:
    """Users per latest churn flag, always the three rows Low, Medium, High."""
    flag = F.col("churn_risk_flag")
    one = latest_churn(fact_customer).agg(
        *[F.count_if(flag == level).alias(level) for level in CHURN_LEVELS]
    )
    pairs = ", ".join(f"'{level}', `{level}`" for level in CHURN_LEVELS)
    return one.selectExpr(f"stack({len(CHURN_LEVELS)}, {pairs}) AS (Churn_Risk, Count)")


# ------------------------------------------------------------------ sales
def total_revenue(fact_customer: DataFrame) -> DataFrame:
    return fact_customer.agg(_sum0("revenue_daily").cast("double").alias("total_revenue"))


def daily_revenue(fact_orders_location: DataFrame) -> DataFrame:
    """Revenue per day (rows without a date dropped)."""
    return (
        fact_orders_location.where(F.col("creation_date").isNotNull())
        .groupBy("creation_date")
        .agg(_sum0("total_revenue").cast("double").alias("total_revenue"))
    )


def monthly_revenue(fact_orders_location: DataFrame) -> DataFrame:
    """Revenue per month number, years pooled; month 0 = no date."""
    return fact_orders_location.groupBy("period_month").agg(
        _sum0("total_revenue").cast("double").alias("total_revenue")
    )


def loyalty_spend(fact_customer: DataFrame) -> DataFrame:
    """Mean daily revenue of customer-days with and without loyalty lines."""
    flag = null_safe_flag(F.col("loyalty_orders") > 0)
    return fact_customer.groupBy(flag.alias("is_loyalty")).agg(
        F.avg("revenue_daily").alias("revenue_daily")
    )


# ------------------------------------------------------------------ locations
def top_locations(
    fact_orders_location: DataFrame,
    measure: str = "revenue",
    n: int = 5,
    ascending: bool = False,
    order_precision: int | None = None,
) -> DataFrame:
    """Top (or, with ``ascending``, bottom) ``n`` restaurants.

    ``measure="revenue"``: sum of ``total_revenue``; ``"aov"``: unweighted
    mean of the daily ``avg_order_value``. Ties are broken by restaurant id
    (``order_precision`` compares the measure rounded to that many decimals);
    Spark plans this as a per-partition top-n followed by one small merge.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    loc = fact_orders_location.where(F.col("restaurant_id").isNotNull())
    if measure == "revenue":
        agg = loc.groupBy("restaurant_id").agg(_sum0("total_revenue").cast("double").alias("total_revenue"))
        col = "total_revenue"
    elif measure == "aov":
        agg = loc.groupBy("restaurant_id").agg(F.avg("avg_order_value").alias("avg_order_value"))
        col = "avg_order_value"
    else:
        raise ValueError("measure must be 'revenue' or 'aov'")
    key = F.col(col) if order_precision is None else round_half_up(F.col(col), order_precision)
    order = key.asc_nulls_last() if ascending else key.desc_nulls_last()
    return agg.orderBy(order, F.col("restaurant_id").asc()).limit(n)


def discount_revenue(fact_orders_location: DataFrame) -> DataFrame:
    """Revenue split by "discount applied" = non-loyalty revenue < total revenue."""
    flag = null_safe_flag(F.col("non_loyalty_revenue") < F.col("total_revenue"))
    return fact_orders_location.groupBy(flag.alias("discount_applied")).agg(
        _sum0("total_revenue").cast("double").alias("total_revenue")
    )
