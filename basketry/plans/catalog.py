"""Query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Outputs are rounded for comparison (money to 2 decimals, averages to 4, bin
edges and IQR fences to 6, all half-up on the decimal value) and every
computed column carries the same alias as in :mod:`basketry.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import round_half_up
from basketry.operators import dedupe, gold, incremental, metrics, profile, sketches, validate
from basketry.plans import fixtures as fx
from basketry.plans import partitions
from basketry.plans import pipeline as pl
from basketry.session import materialize, scratch_path
from basketry.sources import csv, drift, layout

Query = Callable[[SparkSession, str], DataFrame]

MONEY = 2
AVERAGE = 4
EDGE = 6  # bin edges and IQR fences


def rounded(
    df: DataFrame,
    money: tuple[str, ...] = (),
    averages: tuple[str, ...] = (),
    edges: tuple[str, ...] = (),
) -> DataFrame:
    """Round the named double columns in place, keeping column order."""
    exprs = []
    for c in df.columns:
        if c in edges:
            exprs.append(round_half_up(c, EDGE).alias(c))
        elif c in money:
            exprs.append(round_half_up(c, MONEY).alias(c))
        elif c in averages:
            exprs.append(round_half_up(c, AVERAGE).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


CUSTOMER_MONEY = (
    "revenue_daily",
    "loyalty_revenue",
    "clv_cumulative",
    "monetary_7d",
    "monetary_30d",
    "monetary_90d",
)
LOCATION_MONEY = ("total_revenue", "loyalty_revenue", "non_loyalty_revenue")


# ---------------------------------------------------------------- silver
def q_silver_dim_date(spark, d):
    return pl.silver_dim_date(spark, d)


def q_silver_fact_orders(spark, d):
    return pl.silver_fact_orders(spark, d)


def q_silver_fact_options(spark, d):
    return pl.silver_fact_options(spark, d)


# ---------------------------------------------------------------- gold
def q_gold_options_revenue(spark, d):
    return rounded(gold.options_revenue(pl.silver_fact_options(spark, d)), money=("options_revenue",))


def q_gold_enriched_orders(spark, d):
    return rounded(pl.enriched_orders(spark, d), money=("options_revenue", "total_item_revenue"))


def q_gold_customer_daily(spark, d):
    return rounded(gold.customer_daily(pl.enriched_orders(spark, d)), money=CUSTOMER_MONEY)


def q_gold_recency_churn(spark, d):
    daily = gold.add_recency_churn(gold.customer_daily(pl.enriched_orders(spark, d)))
    return daily.select("user_id", "creation_date", "recency_days", "churn_risk_flag")


def q_gold_clv_cumulative(spark, d):
    daily = gold.add_clv_cumulative(gold.customer_daily(pl.enriched_orders(spark, d)))
    return rounded(daily.select("user_id", "creation_date", "clv_cumulative"), money=CUSTOMER_MONEY)


def q_gold_rolling_metrics(spark, d):
    daily = gold.add_rolling_metrics(gold.customer_daily(pl.enriched_orders(spark, d)))
    cols = ["user_id", "creation_date"] + [
        f"{m}_{n}d" for n in gold.ROLLING_WINDOWS for m in ("frequency", "monetary")
    ]
    return rounded(daily.select(*cols), money=CUSTOMER_MONEY)


def q_gold_fact_customer(spark, d):
    return rounded(pl.fact_customer(spark, d), money=CUSTOMER_MONEY)


def q_gold_location_daily(spark, d):
    return rounded(pl.location_daily(spark, d), money=LOCATION_MONEY, averages=("avg_order_value",))


def q_gold_location_ranked_by_year(spark, d):
    ranked = gold.add_revenue_ranks(pl.stored_location_daily(spark, d), with_year=True, money_precision=MONEY, stored=True)
    return rounded(ranked, money=LOCATION_MONEY, averages=("avg_order_value",))


def q_gold_location_ranked(spark, d):
    return rounded(
        pl.fact_orders_location(spark, d, MONEY), money=LOCATION_MONEY, averages=("avg_order_value",)
    )


# ---------------------------------------------------------------- metrics
def _users(spark, d):
    users, _, q_high = metrics.user_clv(pl.fact_customer(spark, d), money_precision=MONEY)
    return users, q_high


def q_insight_overview(spark, d):
    return rounded(
        metrics.overview(pl.fact_customer(spark, d), pl.location_daily(spark, d)),
        money=("total_revenue",),
    )


def q_insight_user_clv(spark, d):
    return rounded(_users(spark, d)[0], money=("clv_cumulative",))


def q_insight_clv_tagged(spark, d):
    customer = materialize(pl.fact_customer(spark, d))  # feeds the users and the join
    users, _, _ = metrics.user_clv(customer, money_precision=MONEY)
    return rounded(metrics.clv_tagged(customer, users), money=CUSTOMER_MONEY)


def q_insight_clv_kpis(spark, d):
    users, q_high = _users(spark, d)
    return rounded(
        metrics.clv_kpis(users, q_high), money=("total_lifetime_revenue",), averages=("avg_clv",)
    )


def q_insight_clv_distribution(spark, d):
    return rounded(
        metrics.clv_distribution(_users(spark, d)[0]), edges=("bin_start", "bin_end")
    )


def q_insight_clv_summary(spark, d):
    return metrics.clv_summary(_users(spark, d)[0])


RFM_MONEY = ("Monetary",)


def _rfm(fact_customer_fn, window):
    def users(spark, d):
        return rounded(metrics.rfm_users(fact_customer_fn(spark, d), window, money_precision=MONEY), money=RFM_MONEY)

    def kpis(spark, d):
        return metrics.rfm_kpis(metrics.rfm_users(fact_customer_fn(spark, d), window, money_precision=MONEY))

    def summary(spark, d):
        return metrics.rfm_summary(metrics.rfm_users(fact_customer_fn(spark, d), window, money_precision=MONEY))

    return users, kpis, summary


q_insight_rfm_users, q_insight_rfm_kpis, q_insight_rfm_summary = _rfm(pl.fact_customer, 30)
q_insight_rfm_users_events, _, _ = _rfm(pl.event_fact_customer, 30)
_, q_insight_rfm_kpis_events, _ = _rfm(pl.event_fact_customer, 7)
_, _, q_insight_rfm_summary_events = _rfm(pl.event_fact_customer, 90)


def q_insight_rfm_users_labels_events(spark, d):
    users = metrics.rfm_users(pl.event_fact_customer(spark, d), 30, scores="labels", money_precision=MONEY)
    return rounded(users, money=RFM_MONEY)


def q_insight_rfm_users_latest(spark, d):
    users = metrics.rfm_users(pl.fact_customer(spark, d), 90, recency="latest", money_precision=MONEY)
    return rounded(users, money=RFM_MONEY)


def q_insight_rfm_segment_counts(spark, d):
    return metrics.rfm_segment_counts(metrics.rfm_users(pl.fact_customer(spark, d), 90, money_precision=MONEY))


def q_insight_churn_counts(spark, d):
    return metrics.churn_counts(pl.fact_customer(spark, d))


def q_insight_daily_revenue(spark, d):
    return rounded(metrics.daily_revenue(pl.location_daily(spark, d)), money=("total_revenue",))


def q_insight_monthly_revenue(spark, d):
    return rounded(metrics.monthly_revenue(pl.location_daily(spark, d)), money=("total_revenue",))


def q_insight_total_revenue(spark, d):
    return rounded(metrics.total_revenue(pl.fact_customer(spark, d)), money=("total_revenue",))


def q_insight_loyalty_spend(spark, d):
    return rounded(metrics.loyalty_spend(pl.fact_customer(spark, d)), averages=("revenue_daily",))


def q_insight_top_locations_revenue(spark, d):
    top = metrics.top_locations(pl.location_daily(spark, d), "revenue", 5, order_precision=MONEY)
    return rounded(top, money=("total_revenue",))


def q_insight_bottom_locations_revenue(spark, d):
    top = metrics.top_locations(
        pl.location_daily(spark, d), "revenue", 5, ascending=True, order_precision=MONEY
    )
    return rounded(top, money=("total_revenue",))


def q_insight_top_locations_aov(spark, d):
    top = metrics.top_locations(pl.location_daily(spark, d), "aov", 5, order_precision=AVERAGE)
    return rounded(top, averages=("avg_order_value",))


def q_insight_discount_revenue(spark, d):
    return rounded(metrics.discount_revenue(pl.location_daily(spark, d)), money=("total_revenue",))


# ---------------------------------------------------------------- profile
def _raw_sources(spark, d):
    return {
        "order_items": fx.order_items(spark, d),
        "order_item_options": fx.order_item_options(spark, d),
        "date_dim": fx.date_dim(spark, d),
    }


def _profiled(spark, d):
    """The raw sources as profiled: order lines with missing prices as NaN."""
    return _raw_sources(spark, d) | {"order_items": fx.profile_items(spark, d)}


def _profile_sources(spark, d):
    out = _profiled(spark, d)
    for name in ("customer", "part", "events"):
        out[name] = fx.table(spark, d, name)
    return out


# Histogram bin counts used per source in the notebooks.
HISTOGRAM_BINS = {"date_dim": 12, "order_items": 10, "order_item_options": 40}


def _tagged_union(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [df.select(F.lit(name).alias("table_name"), "*") for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_profile_columns(spark, d):
    return _tagged_union(
        {n: profile.column_profile(df) for n, df in _profiled(spark, d).items()}
    )


def q_profile_shape(spark, d):
    return _tagged_union(
        {n: profile.shape(df).select("rows", "columns") for n, df in _raw_sources(spark, d).items()}
    )


def q_profile_missing_rows(spark, d):
    found = profile.missing_rows(fx.profile_items(spark, d), ["LINEITEM_ID", "ITEM_CATEGORY", "ITEM_NAME", "ITEM_PRICE"])
    return profile.missing_as_null(found)


def q_profile_null_summary(spark, d):
    return _tagged_union({n: profile.null_summary(df) for n, df in _profiled(spark, d).items()})


def q_profile_duplicate_rows(spark, d):
    return dedupe.duplicate_rows(fx.date_dim(spark, d))


def q_profile_duplicate_rows_options(spark, d):
    return dedupe.duplicate_rows(fx.order_item_options(spark, d))


def q_profile_duplicate_row_copies(spark, d):
    return dedupe.duplicate_row_copies(fx.order_item_options(spark, d))


def q_profile_key_violation_rows(spark, d):
    cleaned = fx.order_item_options(spark, d).distinct()
    return dedupe.key_violation_rows(cleaned, ["LINEITEM_ID", "OPTION_GROUP_NAME", "OPTION_NAME"], unique=True)


def q_profile_key_violations(spark, d):
    return dedupe.key_violations(fx.order_items(spark, d), ["LINEITEM_ID"])


def q_profile_key_violations_options(spark, d):
    cleaned = fx.order_item_options(spark, d).distinct()
    return dedupe.key_violations(cleaned, ["LINEITEM_ID", "OPTION_GROUP_NAME", "OPTION_NAME"])


def q_profile_iqr_outliers(spark, d):
    out = profile.iqr_outliers_by_table(_profile_sources(spark, d))
    return rounded(out, edges=("q1", "q3", "iqr", "lower_fence", "upper_fence"))


def q_profile_histogram(spark, d):
    src = _profiled(spark, d)
    frames = {n: profile.histogram(src[n], bins) for n, bins in HISTOGRAM_BINS.items()}
    return rounded(_tagged_union(frames), edges=("bin_start", "bin_end"))


def q_clean_dropna_accounting(spark, d):
    return profile.dropna_accounting(fx.profile_items(spark, d), ["LINEITEM_ID"])


def q_clean_dropna_null_counts(spark, d):
    return profile.null_counts(profile.drop_missing(fx.profile_items(spark, d), ["LINEITEM_ID", "ITEM_PRICE"]))


def q_clean_distinct_accounting(spark, d):
    return profile.distinct_accounting(fx.order_item_options(spark, d))


# ---------------------------------------------------------------- validate
def q_validate_negative_prices(spark, d):
    return validate.count_below(fx.order_item_options(spark, d), "OPTION_PRICE")


def q_validate_timestamp_shape(spark, d):
    return validate.text_shape(fx.order_items(spark, d), "CREATION_TIME_UTC")


def q_validate_column_info(spark, d):
    return validate.column_info(pl.silver_fact_orders(spark, d))


def q_source_row_counts(spark, d):
    return validate.row_counts(_raw_sources(spark, d))


def q_source_preview(spark, d):
    items = fx.order_items(spark, d)
    return validate.preview(items, 5, order_by=items.columns)


def q_inspect_gold_slice(spark, d):
    fc = rounded(pl.fact_customer(spark, d), money=CUSTOMER_MONEY)
    return validate.sorted_slice(fc, ["user_id", "creation_date"], 70, 100)


# ---------------------------------------------------------------- loads and incremental builds
def q_insight_clv_distribution_nice(spark, d):
    return rounded(metrics.clv_distribution_nice(_users(spark, d)[0]), edges=("bin_start", "bin_end"))


def q_source_csv_multiline(spark, d):
    """Documents as CSV with line breaks and quotes in fields, read back in parallel."""
    docs = fx.table(spark, d, "documents").select("doc_id", "lang", "n_chars", "text")
    path = scratch_path(spark, "documents-csv")
    csv.write_csv(docs, path)
    back = csv.read_csv(spark, path, schema=docs.schema, multiline=True, missing=())
    return back.select("doc_id", "lang", "n_chars", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def q_source_csv_types(spark, d):
    """Column types found in a CSV extract: two loads are read apart and their states merged."""
    items = fx.order_items(spark, d)
    states = []
    for part in (F.col("ITEM_QUANTITY") <= 25, F.col("ITEM_QUANTITY") > 25):
        path = scratch_path(spark, "items-csv")
        csv.write_csv(items.where(part), path)
        states.append(csv.type_states(csv.read_csv(spark, path)))
    merged = csv.merge_states(*states)
    rows = [(c, csv.state_type(s), bool(s & csv.MISSING)) for c, s in merged.items()]
    return spark.createDataFrame(rows, "column_name string, data_type string, has_missing boolean")


def q_profile_sketches(spark, d):
    """Profile of two loads from their stored sketches, with the estimates held against the exact figures."""
    items = materialize(fx.profile_items(spark, d))
    folder = scratch_path(spark, "sketches")
    early = F.coalesce(F.col("ITEM_QUANTITY") <= 25, F.lit(False))
    for load, part in (("early", early), ("late", ~early)):
        sketches.store_sketches(items.where(part), folder, "order_items", load)
    merged = materialize(sketches.merge_sketches(sketches.stored_sketches(spark, folder, "order_items")))
    found = sketches.sketch_profile(merged)
    exact = profile.column_profile(items).select("column_name", F.col("distinct_values").alias("exact"))
    # each estimated quartile's rank among all rows, from counts on both sides of it
    quartiles = {r.column_name: (r.q_0, r.q_1, r.q_2) for r in found.where("q_1 is not null").collect()}
    clean = profile.missing_as_null(items)
    share = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.avg(F.when(F.col(c).isNotNull(), F.when(F.col(c) < q, 1.0).otherwise(0.0))).alias(f"lt{i}") for i, q in enumerate(qs)],
            *[F.avg(F.when(F.col(c).isNotNull(), F.when(F.col(c) <= q, 1.0).otherwise(0.0))).alias(f"le{i}") for i, q in enumerate(qs)],
        )
        for c, qs in quartiles.items()
    ]
    ranks = clean.agg(*[s.alias(f"s{i}") for i, s in enumerate(share)]).select(F.explode(F.array(*[f"s{i}" for i in range(len(share))])).alias("s")).select("s.*")
    bound = sketches.rank_error()
    near = None
    for i, p in enumerate((0.25, 0.5, 0.75)):
        one = (F.col(f"lt{i}") <= p + bound) & (F.col(f"le{i}") >= p - bound)
        near = one if near is None else near & one
    joined = found.join(exact, "column_name").join(ranks, "column_name", "left")
    gap = F.abs(F.col("distinct_values") - F.col("exact"))
    return joined.select(
        "column_name", "position", "data_type", "rows", "missing",
        (gap <= F.greatest(F.lit(1.0), F.col("exact") * (4 * sketches.distinct_error()))).alias("distinct_within_bound"),
        near.alias("quartiles_within_bound"),
    )


INCREMENT_CUT = date(1999, 6, 30)


def q_gold_incremental_customer(spark, d):
    """``fact_customer`` from a first load and an update with new days, late days and a day that had been incomplete."""
    lines = materialize(pl.enriched_orders(spark, d))
    day = F.col("creation_date")
    late = F.coalesce(F.dayofmonth(day) == 13, F.lit(True))  # these days, and lines without a date, arrive with the update
    partial = (F.dayofmonth(day) == 20) & (F.month(day) == 5) & (F.pmod(F.hash("order_id"), F.lit(2)) == 0)
    known = F.coalesce((day <= F.lit(INCREMENT_CUT)) & ~late & ~partial, F.lit(False))
    fact = materialize(gold.fact_customer(lines.where(known)))
    state = materialize(incremental.carry_state(fact, INCREMENT_CUT))
    days = materialize(lines.where(~known).select("creation_date").distinct())
    on = F.col("creation_date").eqNullSafe(F.col("_touched"))
    touched = lines.join(days.select(day.alias("_touched")), on, "left_semi")
    update = incremental.update_fact_customer(fact, state, INCREMENT_CUT, gold.customer_daily(touched), days)
    return rounded(update.apply(fact), money=CUSTOMER_MONEY)


def q_gold_location_rebuilt(spark, d):
    """Location-day facts by month: a first build, then a rebuild of the partitions that changed since."""
    month = F.coalesce(F.date_format("creation_date", "yyyy-MM"), F.lit("none"))
    lines = materialize(pl.enriched_orders(spark, d).withColumn("month", month))
    target, digests = scratch_path(spark, "location-gold"), scratch_path(spark, "location-digests")

    def build(part):
        return gold.location_daily(part).withColumn("month", month)

    before = lines.where(~F.col("month").isin("1996-02", "1997-05") | (F.pmod(F.hash("lineitem_id"), F.lit(3)) == 0))
    partitions.rebuild_partitions(before.where("month <> '2000-03'"), target, ["month"], build, digests)
    partitions.rebuild_partitions(lines, target, ["month"], build, digests)
    back = spark.read.schema(build(lines).schema).parquet(target).drop("month")
    return rounded(back, money=LOCATION_MONEY, averages=("avg_order_value",))


# ---------------------------------------------------------------- drifting types, wide duplicates, clustered files
def q_source_drifted_files(spark, d):
    """Orders in three loads that disagree on types and columns, read back as one table."""
    orders = fx.table(spark, d, "orders")
    folder = scratch_path(spark, "orders-drifted")
    key, part = F.col("o_orderkey"), F.pmod("o_orderkey", F.lit(3))
    loads = (
        orders.where(part == 0).select(key, F.col("o_custkey").cast("int"), "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate")),
        orders.where(part == 1).select(key.cast("string"), "o_custkey", "o_totalprice", "o_orderdate", F.col("o_custkey").alias("score")),
        orders.where((part == 2) | part.isNull()).select("o_orderpriority", key, "o_custkey", (F.col("o_custkey") / 2).alias("score"), "o_orderdate"),
    )
    for i, load in enumerate(loads):
        load.write.parquet(f"{folder}/load={i}")
    return drift.read_drifted(spark, folder).withColumn("o_orderdate", F.to_date("o_orderdate"))


def _lines_with_copies(spark, d):
    """Order lines with 1 in 50 repeated once and 1 in 1,000 repeated again."""
    lines = fx.table(spark, d, "lineitem")
    key = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    return lines.unionByName(lines.where(key % 50 == 0)).unionByName(lines.where(key % 1000 == 0))


def q_profile_duplicate_rows_by_digest(spark, d):
    return dedupe.duplicate_rows_by_digest(_lines_with_copies(spark, d))


def q_clean_distinct_by_digest(spark, d):
    return dedupe.distinct_by_digest(_lines_with_copies(spark, d))


def q_clean_distinct_accounting_by_digest(spark, d):
    return dedupe.distinct_accounting_by_digest(_lines_with_copies(spark, d))


def q_source_clustered_orders(spark, d):
    """Silver order lines by (user, date) with bloom filters on the ids, read back."""
    orders = pl.silver_fact_orders(spark, d)
    path = scratch_path(spark, "orders-clustered")
    layout.write_clustered(orders, path, ["user_id", "creation_date"], 16, bloom={"order_id": 100_000, "lineitem_id": 100_000})
    return spark.read.schema(orders.schema).parquet(path)


def queries() -> dict[str, Query]:
    return {
        "silver_dim_date": q_silver_dim_date,
        "silver_fact_orders": q_silver_fact_orders,
        "silver_fact_options": q_silver_fact_options,
        "gold_options_revenue": q_gold_options_revenue,
        "gold_enriched_orders": q_gold_enriched_orders,
        "gold_customer_daily": q_gold_customer_daily,
        "gold_recency_churn": q_gold_recency_churn,
        "gold_clv_cumulative": q_gold_clv_cumulative,
        "gold_rolling_metrics": q_gold_rolling_metrics,
        "gold_fact_customer": q_gold_fact_customer,
        "gold_location_daily": q_gold_location_daily,
        "gold_location_ranked": q_gold_location_ranked,
        "gold_location_ranked_by_year": q_gold_location_ranked_by_year,
        "insight_overview": q_insight_overview,
        "insight_total_revenue": q_insight_total_revenue,
        "insight_user_clv": q_insight_user_clv,
        "insight_clv_tagged": q_insight_clv_tagged,
        "insight_clv_kpis": q_insight_clv_kpis,
        "insight_clv_distribution": q_insight_clv_distribution,
        "insight_clv_summary": q_insight_clv_summary,
        "insight_rfm_users": q_insight_rfm_users,
        "insight_rfm_kpis": q_insight_rfm_kpis,
        "insight_rfm_summary": q_insight_rfm_summary,
        "insight_rfm_segment_counts": q_insight_rfm_segment_counts,
        "insight_rfm_users_events": q_insight_rfm_users_events,
        "insight_rfm_users_labels_events": q_insight_rfm_users_labels_events,
        "insight_rfm_users_latest": q_insight_rfm_users_latest,
        "insight_rfm_kpis_events": q_insight_rfm_kpis_events,
        "insight_rfm_summary_events": q_insight_rfm_summary_events,
        "insight_churn_counts": q_insight_churn_counts,
        "insight_daily_revenue": q_insight_daily_revenue,
        "insight_monthly_revenue": q_insight_monthly_revenue,
        "insight_loyalty_spend": q_insight_loyalty_spend,
        "insight_top_locations_revenue": q_insight_top_locations_revenue,
        "insight_bottom_locations_revenue": q_insight_bottom_locations_revenue,
        "insight_top_locations_aov": q_insight_top_locations_aov,
        "insight_discount_revenue": q_insight_discount_revenue,
        "profile_columns": q_profile_columns,
        "profile_shape": q_profile_shape,
        "profile_missing_rows": q_profile_missing_rows,
        "profile_null_summary": q_profile_null_summary,
        "profile_duplicate_rows": q_profile_duplicate_rows,
        "profile_duplicate_row_copies": q_profile_duplicate_row_copies,
        "profile_key_violation_rows": q_profile_key_violation_rows,
        "profile_duplicate_rows_options": q_profile_duplicate_rows_options,
        "profile_key_violations": q_profile_key_violations,
        "profile_key_violations_options": q_profile_key_violations_options,
        "profile_iqr_outliers": q_profile_iqr_outliers,
        "profile_histogram": q_profile_histogram,
        "clean_dropna_accounting": q_clean_dropna_accounting,
        "clean_dropna_null_counts": q_clean_dropna_null_counts,
        "clean_distinct_accounting": q_clean_distinct_accounting,
        "validate_negative_prices": q_validate_negative_prices,
        "validate_timestamp_shape": q_validate_timestamp_shape,
        "validate_column_info": q_validate_column_info,
        "source_row_counts": q_source_row_counts,
        "source_preview": q_source_preview,
        "inspect_gold_slice": q_inspect_gold_slice,
        "insight_clv_distribution_nice": q_insight_clv_distribution_nice,
        "source_csv_multiline": q_source_csv_multiline,
        "source_csv_types": q_source_csv_types,
        "profile_sketches": q_profile_sketches,
        "gold_incremental_customer": q_gold_incremental_customer,
        "gold_location_rebuilt": q_gold_location_rebuilt,
        "source_drifted_files": q_source_drifted_files,
        "source_clustered_orders": q_source_clustered_orders,
        "profile_duplicate_rows_by_digest": q_profile_duplicate_rows_by_digest,
        "clean_distinct_by_digest": q_clean_distinct_by_digest,
        "clean_distinct_accounting_by_digest": q_clean_distinct_accounting_by_digest,
    }
