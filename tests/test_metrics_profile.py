"""Dashboard metrics and profiling reports on hand-made rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.operators import dedupe, metrics, profile, validate

FC_SCHEMA = (
    "user_id string, creation_date date, orders_daily long, revenue_daily double, "
    "loyalty_revenue double, loyalty_orders long, recency_days int, churn_risk_flag string, "
    "clv_cumulative double, frequency_7d long, monetary_7d double, frequency_30d long, "
    "monetary_30d double, frequency_90d long, monetary_90d double"
)


def fc_rows(spark, rows):
    full = []
    for r in rows:
        user, day, rev, rec, flag, clv, freq, mon = r
        full.append((user, day, 1, rev, 0.0, 0, rec, flag, clv, freq, mon, freq, mon, freq, mon))
    return spark.createDataFrame(full, FC_SCHEMA)


D = dt.date


def test_churn_counts_three_rows_and_null_date_is_latest(spark):
    fc = fc_rows(
        spark,
        [
            ("a", D(2021, 1, 1), 1.0, 0, "Low", 1.0, 1, 1.0),
            ("a", D(2021, 3, 1), 1.0, 59, "High", 2.0, 1, 1.0),
            ("b", D(2021, 1, 1), 1.0, 0, "Low", 1.0, 1, 1.0),
            ("b", D(2021, 2, 1), 1.0, 31, "Medium", 2.0, 1, 1.0),
            ("b", None, 1.0, 0, "Low", 3.0, None, None),
        ],
    )
    got = {r.Churn_Risk: r.Count for r in metrics.churn_counts(fc).collect()}
    assert got == {"Low": 1, "Medium": 0, "High": 1}


def test_clv_groups_with_equal_quantiles(spark):
    fc = fc_rows(spark, [(u, D(2021, 1, 1), 1.0, 0, "Low", 5.0, 1, 1.0) for u in "abcde"])
    users, q20, q80 = metrics.user_clv(fc)
    assert q20 == q80 == 5.0
    assert {r.CLV_Group for r in users.collect()} == {"Low CLV"}  # <= q20 checked first
    kpi = metrics.clv_kpis(users, q80).first()
    assert kpi.high_value_customers == 5 and kpi.total_lifetime_revenue == 25.0


def test_clv_quantiles_and_groups(spark):
    vals = [1.0, 2.0, 4.0, 9.0, 20.0]
    fc = fc_rows(spark, [(f"u{i}", D(2021, 1, 1), 1.0, 0, "Low", v, 1, 1.0) for i, v in enumerate(vals)])
    users, q20, q80 = metrics.user_clv(fc)
    assert q20 == pytest.approx(np.quantile(vals, 0.2))
    assert q80 == pytest.approx(np.quantile(vals, 0.8))
    groups = {r.clv_cumulative: r.CLV_Group for r in users.collect()}
    assert groups[1.0] == "Low CLV" and groups[20.0] == "High CLV" and groups[4.0] == "Medium CLV"
    dist = metrics.clv_distribution(users, bins=50).collect()
    assert sum(r.customers for r in dist) == 5
    assert len(dist) == 50 * 3


def test_rfm_segments(spark):
    rows = []
    # u0..u5 active often (frequency grows), u6 has a High churn day.
    for i in range(6):
        rows.append((f"u{i}", D(2021, 1, 1), 1.0, 0, "Low", 1.0, i + 1, float(10 * (i + 1))))
    rows.append(("u6", D(2021, 1, 1), 1.0, 0, "Low", 1.0, 9, 99.0))
    rows.append(("u6", D(2021, 3, 1), 1.0, 59, "High", 2.0, 1, 1.0))
    rfm = {r.user_id: r for r in metrics.rfm_users(fc_rows(spark, rows), 30).collect()}
    assert all(r.Recency == 0 and r.R_Score == 3 for r in rfm.values())  # quirk Q3
    assert rfm["u6"].Segment == "Churn Risk" and rfm["u6"].Churn_Risk == "High"
    assert rfm["u5"].Segment == "VIP" and rfm["u5"].F_Score == 2  # codes 0..2 (quirk Q2)
    assert rfm["u0"].Segment == "New Customer"
    labelled = {r.user_id: r for r in metrics.rfm_users(fc_rows(spark, rows), 30, scores="labels").collect()}
    assert labelled["u5"].F_Score == 3 and labelled["u0"].F_Score == 1
    kpi = metrics.rfm_kpis(metrics.rfm_users(fc_rows(spark, rows), 30)).first()
    assert kpi.Total_Customers == 7 and kpi.Churn_Risk_Customers == 1
    with pytest.raises(ValueError):
        metrics.rfm_users(fc_rows(spark, rows), 14)


def test_constant_frequency_means_nobody_is_vip(spark):
    rows = [(f"u{i}", D(2021, 1, 1), 1.0, 0, "Low", 1.0, 3, float(i)) for i in range(9)]
    rfm = metrics.rfm_users(fc_rows(spark, rows), 30).collect()
    assert {r.F_Score for r in rfm} == {1} and all(r.Segment != "VIP" for r in rfm)
    # labels mode keeps the defaults as they are (R 3, F 1) and labels ranked M 1..3
    lab = metrics.rfm_users(fc_rows(spark, rows), 30, scores="labels").collect()
    assert {r.F_Score for r in lab} == {1} and {r.R_Score for r in lab} == {3}
    assert {r.M_Score for r in lab} == {1, 2, 3}


def test_location_metrics_flags_and_top(spark):
    loc = spark.createDataFrame(
        [
            (D(2021, 1, 1), "r1", 10.0, 2.0, 10.0, 1),
            (D(2021, 1, 2), "r1", 5.0, 1.0, 2.0, 1),
            (D(2021, 1, 1), "r2", 20.0, 4.0, 0.0, 1),
            (None, "r3", None, None, 0.0, 0),
        ],
        "creation_date date, restaurant_id string, total_revenue double, avg_order_value double, "
        "non_loyalty_revenue double, period_month int",
    )
    disc = {r.discount_applied: r.total_revenue for r in metrics.discount_revenue(loc).collect()}
    assert disc == {False: 10.0, True: 25.0}  # NULL comparison counts as False
    top = [r.restaurant_id for r in metrics.top_locations(loc, "revenue", 2).collect()]
    assert top == ["r2", "r1"]
    worst = [r.restaurant_id for r in metrics.top_locations(loc, "revenue", 1, ascending=True).collect()]
    assert worst == ["r3"]  # sum of nothing is 0
    daily = metrics.daily_revenue(loc).collect()
    assert len(daily) == 2  # NULL day dropped


def test_iqr_outliers_and_histogram(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 3.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([(v, 7) for v in vals], "x double, c int")
    out = {r.column_name: r for r in profile.iqr_outliers(df).collect()}
    clean = [v for v in vals if v is not None]
    q1, q3 = np.quantile(clean, [0.25, 0.75])
    assert out["x"].q1 == pytest.approx(q1) and out["x"].q3 == pytest.approx(q3)
    assert out["x"].outliers == 1
    assert out["c"].outliers == 0
    hist = profile.histogram(df, 4)
    x = sorted((r.bin, r["count"]) for r in hist.where("column_name = 'x'").collect())
    counts, _ = np.histogram(clean, bins=4)
    assert [c for _, c in x] == counts.tolist()
    c = sorted((r.bin, r["count"], r.bin_start) for r in hist.where("column_name = 'c'").collect())
    counts_c, edges_c = np.histogram([7] * 9, bins=4)  # min = max: range +-0.5
    assert [k for _, k, _ in c] == counts_c.tolist()
    assert [s for _, _, s in c] == pytest.approx(edges_c[:-1].tolist())


def test_profile_counts_and_accounting(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 1, None), (None, 2, "x")], "k string, n int, t string"
    )
    prof = {r.column_name: r for r in profile.column_profile(df).collect()}
    assert prof["k"].nulls == 1 and prof["k"].distinct_values == 1 and not prof["k"].is_numeric
    assert prof["n"].is_numeric and prof["n"].distinct_values == 2
    acc = profile.dropna_accounting(df, ["k"]).first()
    assert (acc.rows_before, acc.rows_after, acc.rows_removed, acc.any_null_after) == (3, 2, 1, True)
    dist = profile.distinct_accounting(df).first()
    assert (dist.rows_before, dist.rows_after, dist.rows_removed) == (3, 2, 1)
    dups = dedupe.duplicate_rows(df).collect()
    assert len(dups) == 1 and dups[0].extra_copies == 1
    assert dedupe.key_violations(df, ["k"]).count() == 1
    assert not dedupe.is_key_unique(df, ["k"])
    assert profile.has_duplicate_columns(df) is False
    miss = profile.missing_rows(df, ["k"]).count()
    assert miss == 1


def test_validate_helpers(spark):
    df = spark.createDataFrame(
        [("2021-01-01T00:00:00.000Z", -1.0), ("bad", 2.0), (None, None)], "s string, p double"
    )
    shape = validate.text_shape(df, "s").first()
    assert (shape.total_rows, shape.rows_with_t, shape.rows_missing_z) == (3, 1, 2)
    assert validate.count_below(df, "p").first().negative_rows == 1
    counts = {r.table_name: r.rows for r in validate.row_counts({"a": df, "b": df.limit(1)}).collect()}
    assert counts == {"a": 3, "b": 1}
    ids = spark.range(200).withColumnRenamed("id", "k")
    assert [r.k for r in validate.sorted_slice(ids, ["k"], 70, 100).collect()] == list(range(70, 100))


def test_rfm_latest_recency_option(spark):
    rows = [
        ("a", D(2021, 1, 1), 1.0, 0, "Low", 1.0, 1, 1.0),
        ("a", D(2021, 2, 10), 1.0, 40, "Medium", 2.0, 1, 1.0),
        ("b", D(2021, 1, 1), 1.0, 0, "Low", 1.0, 1, 1.0),
        ("b", None, 1.0, 0, "Low", 2.0, None, None),
    ]
    got = {r.user_id: r.Recency for r in metrics.rfm_users(fc_rows(spark, rows), 7, recency="latest").collect()}
    assert got == {"a": 40, "b": 0}  # the NULL-date row counts as latest


def test_profile_approx(spark):
    df = spark.range(1000).selectExpr("id % 37 AS k", "CAST(id AS DOUBLE) AS v")
    exact = {r.column_name: r.distinct_values for r in profile.column_profile(df).collect()}
    approx = {r.column_name: r.distinct_values for r in profile.column_profile(df, approx=True).collect()}
    assert exact == {"k": 37, "v": 1000}
    assert abs(approx["v"] - 1000) <= 50 and abs(approx["k"] - 37) <= 3


def test_nan_is_missing_as_in_pandas(spark):
    import pandas as pd

    nan = float("nan")
    rows = [(1.0, "a"), (2.0, "b"), (3.0, None), (4.0, "d"), (nan, "e"), (None, "f"), (-0.0, "g"), (0.0, "g")]
    df = spark.createDataFrame(rows, "x double, t string")
    pdf = pd.DataFrame(rows, columns=["x", "t"])
    out = profile.iqr_outliers(df, ["x"]).first()
    assert (out.q1, out.q3) == (pdf.x.quantile(0.25), pdf.x.quantile(0.75)) and out.outliers == 0
    hist = sorted((r.bin, r["count"]) for r in profile.histogram(df, 4, ["x"]).collect())
    assert [c for _, c in hist] == np.histogram(pdf.x.dropna(), bins=4)[0].tolist()
    prof = {r.column_name: r for r in profile.column_profile(df).collect()}
    assert (prof["x"].non_null, prof["x"].nulls, prof["x"].distinct_values) == (pdf.x.count(), pdf.x.isna().sum(), pdf.x.nunique())
    assert profile.missing_rows(df, ["x"]).count() == 2
    assert profile.null_summary(df.where("t = 'e'")).first().any_null is True
    acc = profile.dropna_accounting(df, ["x"]).first()
    assert (acc.rows_before, acc.rows_after, acc.rows_removed, acc.any_null_after) == (8, 6, 2, True)
    assert {r.column_name: r.nulls for r in profile.null_counts(profile.drop_missing(df, ["x"])).collect()} == {"x": 0, "t": 1}
    assert {r.column_name: r.non_null for r in validate.column_info(df).collect()} == {"x": 6, "t": 7}
    empty = df.limit(0)
    assert {r.column_name: (r.non_null, r.distinct_values) for r in profile.column_profile(empty).collect()} == {"x": (0, 0), "t": (0, 0)}


def test_rows_behind_duplicates_and_key_violations(spark):
    rows = [("a", 1), ("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, 3), (None, 3), (None, None)]
    df = spark.createDataFrame(rows, "k string, v int")
    copies = sorted(map(tuple, dedupe.duplicate_row_copies(df).collect()), key=str)
    assert copies == sorted([("a", 1), ("a", 1), (None, 3)], key=str)
    later = sorted(map(tuple, dedupe.key_violation_rows(df, ["k"]).collect()), key=str)
    assert later == sorted([("a", 1), ("a", 1), ("a", 2), (None, 3), (None, 3)], key=str)
    assert dedupe.key_violation_rows(df.where("k = 'b'"), ["k"]).count() == 0


def test_round_half_up_of_huge_values(spark):
    from basketry.functions import round_half_up

    df = spark.createDataFrame([(1e29,), (-1e300,), (float("inf"),), (2.345,), (None,)], "x double")
    assert [r.y for r in df.select(round_half_up("x", 2).alias("y")).collect()] == [1e29, -1e300, float("inf"), 2.35, None]


def test_clv_keeps_raw_doubles_unless_told(spark):
    fc = fc_rows(spark, [("a", D(2021, 1, 1), 1.0, 0, "Low", 10.004, 1, 1.0), ("b", D(2021, 1, 1), 1.0, 0, "Low", 10.001, 1, 1.0)])
    assert {r.clv_cumulative for r in metrics.user_clv(fc)[0].collect()} == {10.004, 10.001}
    assert {r.clv_cumulative for r in metrics.user_clv(fc, money_precision=2)[0].collect()} == {10.0}


def test_profile_and_layer_reports(spark):
    from basketry.plans import fixtures as fx

    items = fx.order_items(spark, "/root/testdata/sf0.001")
    rep = profile.profile_report(items, key=["LINEITEM_ID"], bins=10, missing_columns=["ITEM_NAME"])
    assert set(rep) == {
        "shape", "columns", "duplicate_rows", "key_violations", "key_violation_rows", "missing_rows", "iqr_outliers", "histogram"
    }
    assert rep["shape"].first().columns == 12
    assert rep["histogram"].count() == 2 * 10  # ITEM_PRICE, ITEM_QUANTITY
    cleaned, acc, nulls = profile.clean_report(items, null_key=["LINEITEM_ID"])
    assert {r.column_name: r.nulls for r in nulls.collect()}["LINEITEM_ID"] == 0
    a = acc.first()
    assert a.rows_after == cleaned.count() and a.rows_before == items.count()
    opts = fx.order_item_options(spark, "/root/testdata/sf0.001")
    cleaned_o, acc_o, _ = profile.clean_report(opts)
    assert acc_o.first().rows_after == cleaned_o.count()
    lay = validate.layer_report({"order_items": items, "options": opts}, order_by={"order_items": ["LINEITEM_ID", "ORDER_ID"]})
    assert {r.table_name for r in lay["row_counts"].collect()} == {"order_items", "options"}
    assert lay["options.preview"].count() == 5 and lay["order_items.columns"].count() == 12


def test_argument_validation(spark):
    df = spark.createDataFrame([(1.0, "r")], "total_revenue double, restaurant_id string")
    with pytest.raises(ValueError):
        profile.histogram(df, 0)
    with pytest.raises(ValueError):
        metrics.top_locations(df, "revenue", -1)
    with pytest.raises(ValueError):
        metrics.top_locations(df, "margin", 5)


def test_key_violation_rows_of_distinct_rows(spark):
    """A NULL key with a third of the rows; rows vouched for as distinct are neither counted again nor joined."""
    rows = [(None if i % 3 == 0 else f"k{i % 90}", i % 2, f"o{i % 50}", None if i % 5 == 0 else i / 4) for i in range(900)]
    df = spark.createDataFrame(rows + rows[:40], "k string, g int, o string, p double")
    place = F.row_number().over(Window.partitionBy("k", "g").orderBy(F.col("o").asc_nulls_first(), F.col("p").asc_nulls_first()))
    for frame, unique in ((df.distinct(), True), (df.distinct(), False), (df, False)):
        got = dedupe.key_violation_rows(frame, ["k", "g"], unique=unique)
        want = frame.withColumn("n", place).where("n > 1").drop("n")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    text = dedupe.key_violation_rows(df.distinct(), ["k", "g"], unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "SortAggregate" not in text and text.count("HashAggregate") <= 4  # twice the two of distinct()
