"""Business rules as Column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Churn levels in priority order (rank 1, 2, 3), the recency
# thresholds in days, the CLV group labels and the RFM segment labels.
CHURN_LEVELS = ("Low", "Medium", "High")
CHURN_MEDIUM_AFTER_DAYS = 20
CHURN_HIGH_AFTER_DAYS = 45
CLV_LOW, CLV_MEDIUM, CLV_HIGH = "Low CLV", "Medium CLV", "High CLV"
SEGMENT_CHURN, SEGMENT_VIP, SEGMENT_NEW = "Churn Risk", "VIP", "New Customer"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def churn_flag(
    recency_days: Column | str,
    medium_after: int = CHURN_MEDIUM_AFTER_DAYS,
    high_after: int = CHURN_HIGH_AFTER_DAYS,
) -> Column:
    """> high_after -> High, > medium_after -> Medium, otherwise (incl. NULL) Low."""
    r = _c(recency_days)
    return (
        F.when(r > high_after, F.lit("High"))
        .when(r > medium_after, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def churn_rank(flag: Column | str) -> Column:
    """Low/Medium/High -> 1/2/3; anything else NULL (dictionary map)."""
    f = _c(flag)
    expr = F.when(f == CHURN_LEVELS[0], F.lit(1))
    for i, level in enumerate(CHURN_LEVELS[1:], start=2):
        expr = expr.when(f == level, F.lit(i))
    return expr


def churn_from_rank(rank: Column | str) -> Column:
    """Inverse of :func:`churn_rank`."""
    r = _c(rank)
    expr = F.when(r == 1, F.lit(CHURN_LEVELS[0]))
    for i, level in enumerate(CHURN_LEVELS[1:], start=2):
        expr = expr.when(r == i, F.lit(level))
    return expr


def clv_group(clv: Column | str, q_low: Column | float, q_high: Column | float) -> Column:
    """<= q_low -> Low, >= q_high -> High, else Medium (NULL falls to Medium)."""
    v = _c(clv)
    lo = q_low if isinstance(q_low, Column) else F.lit(q_low)
    hi = q_high if isinstance(q_high, Column) else F.lit(q_high)
    return (
        F.when(F.coalesce(v <= lo, F.lit(False)), F.lit(CLV_LOW))
        .when(F.coalesce(v >= hi, F.lit(False)), F.lit(CLV_HIGH))
        .otherwise(F.lit(CLV_MEDIUM))
    )


def rfm_segment(churn_risk: Column | str, r: Column | str, f: Column | str, m: Column | str) -> Column:
    """High churn -> Churn Risk; R == 3 and F >= 2 and M >= 2 -> VIP; else New Customer."""
    vip = (_c(r) == 3) & (_c(f) >= 2) & (_c(m) >= 2)
    return (
        F.when(F.coalesce(_c(churn_risk) == "High", F.lit(False)), F.lit(SEGMENT_CHURN))
        .when(F.coalesce(vip, F.lit(False)), F.lit(SEGMENT_VIP))
        .otherwise(F.lit(SEGMENT_NEW))
    )


def tercile_code(k: Column, n: Column | int) -> Column:
    """Equal-count tercile code (0, 1, 2) of 0-based position ``k`` among ``n``.

    Reproduces quantile cuts over ranks 1..n with edges at 1/3 and 2/3 of
    (n - 1): code 0 if 3k < n-1, 1 if 3k < 2(n-1), else 2. This is not
    ``ntile(3)``, which puts the remainder rows in the first buckets.
    """
    nn = n if isinstance(n, Column) else F.lit(n)
    return (
        F.when(k * 3 < nn - 1, F.lit(0))
        .when(k * 3 < (nn - 1) * 2, F.lit(1))
        .otherwise(F.lit(2))
    )


def period_part(date: Column | str, part: str) -> Column:
    """day / week (ISO) / month / year of a date, 0 for a NULL date, as int."""
    d = _c(date)
    fn = {
        "day": F.dayofmonth,
        "week": F.weekofyear,
        "month": F.month,
        "year": F.year,
    }[part]
    return F.when(d.isNotNull(), fn(d)).otherwise(F.lit(0)).cast("int")


def null_safe_flag(cond: Column) -> Column:
    """Boolean condition where NULL counts as False (pandas comparison semantics)."""
    return F.coalesce(cond, F.lit(False))


def display_number(value: Column | str, decimals: int = 2) -> Column:
    """Thousands separators and fixed decimals (``1,234.50``) for display at the
    edge; metric operators themselves return numbers."""
    return F.format_number(_c(value), decimals)


def round_half_up(value: Column | str, scale: int) -> Column:
    """Round half away from zero on the decimal value, returned as double.

    The double is first taken to ``DECIMAL(38,10)`` (its shortest decimal form
    up to 10 places), so an exact decimal tie such as ``x.xxxx5`` rounds the
    same way however the binary value happens to fall; ``round`` on the raw
    double would depend on that last bit. Values that do not fit the decimal
    (1e28 and more, infinities, NaN) have no such digits and stay as they are.

    Only values near a tie, or too large for whole units, need the decimal.
    For all others the nearest whole number of units is certain, and its
    quotient by the power of ten is the double nearest to the decimal result.
    """
    v = _c(value)
    exact = F.coalesce(F.round(v.try_cast("decimal(38,10)"), scale).cast("double"), v.cast("double"))
    if not 0 <= scale <= 6:
        return exact
    unit = F.lit(10.0**scale)
    units = F.abs(v.cast("double")) * unit
    whole = F.floor(units + 0.5).cast("double") / unit
    # below 1e11 the product is off by less than 2e-5, and ten places shift it by less than 1e-4
    certain = (units < 1e11) & (F.abs(units - F.floor(units) - 0.5) > 1e-3)
    return F.when(certain, F.when(v < 0, F.lit(0.0) - whole).otherwise(whole)).otherwise(exact)
