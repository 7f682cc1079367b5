"""Incremental Gold ``fact_customer``: new days from a carry-in state, late days by user.

The state has one row per user: running value, last active day and the daily
revenue of the last ``max(windows)`` days before the state's cut. A load of new
days joins it to the users that are active in the load; the windows then run
over at most those days plus the new ones, whatever the length of the history.
Values are added in the order of a full rebuild, so results are equal to it to
the last bit.

A load may also change days before the cut (late lines, corrections, days that
vanish). The users with rows on such days are rebuilt from their own daily
rows; everybody else's history is not computed again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.rules import CHURN_HIGH_AFTER_DAYS, CHURN_MEDIUM_AFTER_DAYS, churn_flag
from basketry.operators.gold import ROLLING_WINDOWS, add_clv_cumulative, add_recency_churn, add_rolling_metrics
from basketry.session import materialize

DAILY = ("user_id", "creation_date", "orders_daily", "revenue_daily", "loyalty_revenue", "loyalty_orders")


def carry_state(fact_customer: DataFrame, through: date, windows: Sequence[int] = ROLLING_WINDOWS) -> DataFrame:
    """(user_id, clv, last_day, tail): the state after all days up to ``through``.

    ``tail`` holds (day, revenue) of the last ``max(windows) - 1`` days up to
    ``through``, so it is bounded. Rows of later days are ignored; rows without
    a date come before all days.
    """
    first = F.date_sub(F.lit(through), max(windows) - 2)
    known = fact_customer.where(F.col("creation_date").isNull() | (F.col("creation_date") <= F.lit(through)))
    day = F.coalesce(F.unix_date("creation_date").cast("long"), F.lit(-(1 << 62)))
    recent = F.when(F.col("creation_date") >= first, F.struct(F.col("creation_date").alias("day"), F.col("revenue_daily").alias("revenue")))
    return known.groupBy("user_id").agg(
        F.max_by("clv_cumulative", day).alias("clv"),
        F.max("creation_date").alias("last_day"),
        F.sort_array(F.collect_list(recent)).alias("tail"),
    )


def advance_state(state: DataFrame, new_rows: DataFrame, through: date, windows: Sequence[int] = ROLLING_WINDOWS) -> DataFrame:
    """The state after ``new_rows`` (of :func:`forward_rows`), with days up to ``through``."""
    first = F.date_sub(F.lit(through), max(windows) - 2)
    fresh = carry_state(new_rows, through, windows).withColumnsRenamed({"clv": "new_clv", "last_day": "new_day", "tail": "new_tail"})
    both = state.join(fresh, "user_id", "full")
    none = F.array().cast("array<struct<day:date,revenue:double>>")
    tail = F.concat(F.coalesce("tail", none), F.coalesce("new_tail", none))
    return both.select(
        "user_id",
        F.when(F.col("new_day").isNotNull(), F.col("new_clv")).otherwise(F.col("clv")).alias("clv"),
        F.coalesce("new_day", "last_day").alias("last_day"),
        F.filter(tail, lambda x: x["day"] >= first).alias("tail"),
    )


def forward_rows(
    daily: DataFrame,
    state: DataFrame,
    windows: Sequence[int] = ROLLING_WINDOWS,
    medium_after: int = CHURN_MEDIUM_AFTER_DAYS,
    high_after: int = CHURN_HIGH_AFTER_DAYS,
) -> DataFrame:
    """``fact_customer`` rows of ``daily``, whose days all lie after the state's cut."""
    active = state.join(daily.select("user_id").distinct(), "user_id", "left_semi")
    # what the state knows of a user, as rows before the new ones: the tail's days, and the last day even if it is older
    last = F.struct(F.col("last_day").alias("day"), F.lit(None).cast("double").alias("revenue"), F.lit(False).alias("counts"))
    held = F.exists("tail", lambda x: x["day"].eqNullSafe(F.col("last_day")))
    tail = F.transform("tail", lambda x: F.struct(x["day"].alias("day"), x["revenue"].alias("revenue"), F.lit(True).alias("counts")))
    known = F.when(held, tail).otherwise(F.concat(F.array(last), tail))
    before = active.select("user_id", "clv", "last_day", F.explode(known).alias("d")).select(
        "user_id",
        F.col("d.day").alias("creation_date"),
        F.col("d.revenue").alias("revenue_daily"),
        F.when(F.col("d.day").eqNullSafe(F.col("last_day")), F.col("clv")).alias("_add"),
        F.lit(False).alias("_new"),
        F.col("d.counts").alias("_counts"),
    )
    new = daily.select(*DAILY, F.col("revenue_daily").alias("_add"), F.lit(True).alias("_new"), F.lit(True).alias("_counts"))
    rows = new.unionByName(before, allowMissingColumns=True).withColumn("_day", F.unix_date("creation_date"))
    user = Window.partitionBy("user_id").orderBy("_day")
    gap = F.datediff(F.col("creation_date"), F.lag("creation_date").over(user))
    cols = {
        "recency_days": F.coalesce(gap, F.lit(0)),
        "clv_cumulative": F.sum("_add").over(user.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    }
    for n in windows:
        frame = user.rangeBetween(-(n - 1), 0)
        cols[f"frequency_{n}d"] = F.count_if("_counts").over(frame)
        cols[f"monetary_{n}d"] = F.sum("revenue_daily").over(frame)
    out = rows.withColumns(cols).where("_new")
    out = out.withColumn("churn_risk_flag", churn_flag("recency_days", medium_after, high_after))
    measures = [f"{m}_{n}d" for n in windows for m in ("frequency", "monetary")]
    return out.select(*DAILY, "recency_days", "churn_risk_flag", "clv_cumulative", *measures)


def rebuilt_users(fact_customer: DataFrame, daily: DataFrame, days: DataFrame, windows: Sequence[int] = ROLLING_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """(users, rows): users with a row on one of the changed ``days``, and all their rows anew.

    ``daily`` is the customer-day aggregate of the changed days as they are
    now; ``days`` has one column ``creation_date`` (NULL: rows without a date).
    """
    changed = days.select(F.col("creation_date").alias("_changed")).distinct()
    on = F.col("creation_date").eqNullSafe(F.col("_changed"))
    users = fact_customer.join(changed, on, "left_semi").select("user_id").union(daily.select("user_id")).distinct()
    kept = fact_customer.join(users, "user_id", "left_semi").join(changed, on, "left_anti").select(*DAILY)
    rows = add_clv_cumulative(add_recency_churn(kept.unionByName(daily.select(*DAILY))))
    return users, add_rolling_metrics(rows, windows)


@dataclass
class Update:
    """What a load does to ``fact_customer``: ``users`` whose rows all go, ``rows`` that come, and the new state."""

    users: DataFrame | None
    rows: DataFrame
    state: DataFrame
    through: date

    def apply(self, fact_customer: DataFrame) -> DataFrame:
        kept = fact_customer if self.users is None else fact_customer.join(self.users, "user_id", "left_anti")
        return kept.unionByName(self.rows)


def update_fact_customer(
    fact_customer: DataFrame,
    state: DataFrame,
    through: date,
    daily: DataFrame,
    days: DataFrame,
    windows: Sequence[int] = ROLLING_WINDOWS,
) -> Update:
    """The update for one load.

    ``daily`` is the customer-day aggregate of the load's ``days`` as they are
    now (a day without rows has vanished). Days after ``through`` are computed
    from ``state`` alone; only earlier ones, and rows without a date, read
    ``fact_customer``, for the users they touch.
    """
    ends = days.agg(F.max("creation_date").alias("last"), F.count_if(F.col("creation_date").isNull() | (F.col("creation_date") <= F.lit(through))).alias("late")).first()
    last = through if ends["last"] is None else max(through, ends["last"])
    ahead = F.col("creation_date") > F.lit(through)
    if not ends["late"]:
        rows = materialize(forward_rows(daily, state, windows), "gold-new-rows")  # feeds the table and the state
        return Update(None, rows, advance_state(state, rows, last, windows), last)
    late = F.coalesce(~ahead, F.lit(True))
    daily = materialize(daily, "gold-daily")
    users, rebuilt = rebuilt_users(fact_customer, daily.where(late), days.where(late), windows)
    users, rebuilt = materialize(users, "gold-late-users"), materialize(rebuilt, "gold-late-rows")
    # the users' states start over from their rebuilt rows; new days then follow as in any load
    current = carry_state(rebuilt, through, windows)
    state = state.join(users, "user_id", "left_anti").unionByName(current)
    rows = materialize(forward_rows(daily.where(ahead), state, windows), "gold-new-rows")
    return Update(users, rebuilt.unionByName(rows), advance_state(state, rows, last, windows), last)
