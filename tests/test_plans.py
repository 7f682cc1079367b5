"""Plan-shape checks: the physical properties the operators are built for."""

import contextlib
import io
import re

from basketry.operators import gold, metrics, silver, validate
from basketry.plans import fixtures as fx
from basketry.plans import pipeline as pl

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_customer_windows_share_one_sort(spark):
    p = plan(pl.fact_customer(spark, SF))
    window_sorts = re.findall(r"Sort \[user_id#\d+ ASC NULLS FIRST, _day#\d+ ASC NULLS FIRST\]", p)
    assert len(window_sorts) == 1, p
    assert "RangeFrame, -89" in p and "RangeFrame, -6" in p


def test_silver_null_key_filter_reaches_the_scan(spark, tmp_out):
    from basketry.sources import read_parquet, write_parquet

    path = f"{tmp_out}/items"
    write_parquet(fx.order_items(spark, SF), path)
    p = plan(silver.fact_orders(read_parquet(spark, path), order_by="all"))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "IsNotNull(LINEITEM_ID)" in scan  # PushedFilters of the Parquet scan


def test_options_aggregated_before_the_join(spark):
    p = plan(pl.enriched_orders(spark, SF))
    join_at = p.index("LeftOuter")
    # the join's build side is the (order, line) aggregate of the options
    assert re.search(r"HashAggregate\(keys=\[order_id#\d+, lineitem_id#\d+\], functions=\[sum\(\(option_price", p[join_at:])


def test_top_locations_is_a_bounded_top_n(spark):
    p = plan(metrics.top_locations(pl.location_daily(spark, SF), "revenue", 5))
    assert "TakeOrderedAndProject(limit=5" in p


def test_sorted_slice_is_bounded(spark):
    p = plan(validate.sorted_slice(spark.range(1000), ["id"], 70, 100))
    assert "TakeOrderedAndProject(limit=100, offset=70" in p


def test_ranks_and_quantiles_have_no_single_partition_step(spark):
    from basketry.operators.ranking import grouped_quantiles, running_counts, value_counts

    loc = pl.location_daily(spark, SF)
    plans = [
        plan(gold.add_revenue_ranks(loc)),
        plan(running_counts(value_counts(loc, ["period_day"], "total_revenue"), ["period_day"])),
        plan(grouped_quantiles(loc, ["period_day"], "total_revenue", [0.5])),
    ]
    for p in plans:
        assert "rank(" not in p and "row_number(" not in p
        assert "Exchange SinglePartition" not in p, p
    # windows run over counts per value inside a range, and over one row per range
    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", plans[1]):
        assert "_range" in spec, spec


def test_outliers_and_histograms_read_each_source_once(spark, tmp_out):
    """The reports start from stored counts per value: no source file is in their plan."""
    from basketry.operators import profile

    path = f"{tmp_out}/src"
    spark.range(1000).selectExpr("id % 37 AS k", "CAST(id AS DOUBLE) AS v").write.parquet(path)
    df = spark.read.parquet(path)
    for out in (profile.iqr_outliers(df), profile.histogram(df, 5)):
        p = plan(out)
        assert path not in p and "Expand" not in p, p
    p = plan(profile.column_profile(df))
    assert p.count("FileScan") == 1
    # one narrow Expand: two output columns, however many the source has
    assert re.search(r"Expand \[\[0, [^,\]]*\], \[1, [^,\]]*\]\]", p), p


def test_gold_pipeline_runs_once_for_tagged_customers(spark, monkeypatch):
    from basketry.plans import catalog

    built = []
    original = pl.fact_customer
    monkeypatch.setattr(pl, "fact_customer", lambda *a: built.append(a) or original(*a))
    p = plan(catalog.q_insight_clv_tagged(spark, SF))
    assert len(built) == 1 and "lineitem" not in p


def test_scans_add_no_shuffle(spark):
    assert "Exchange" not in plan(fx.table(spark, SF, "lineitem")) and "Exchange" not in plan(fx.table(spark, SF, "events"))


def test_dedupe_combines_map_side(spark):
    p = plan(silver.fact_orders(fx.order_items(spark, SF), order_by="all"))
    assert "partial_min(struct(" in p  # one candidate per key and map task before the shuffle


def test_latest_row_per_user_is_a_hash_aggregate(spark):
    p = plan(metrics.latest_churn(pl.fact_customer(spark, SF)))
    assert re.search(r"HashAggregate\(keys=\[user_id#\d+\], functions=\[partial_max_by", p), p


def test_bucketed_silver_makes_the_enrichment_join_shuffle_free(spark, tmp_out):
    from basketry.plans import jobs
    from basketry.sources import write_parquet

    bronze = f"{tmp_out}/bronze"
    write_parquet(fx.date_dim(spark, SF), f"{bronze}/dbo_date_dim")
    write_parquet(fx.order_items(spark, SF), f"{bronze}/dbo_order_items")
    write_parquet(fx.order_item_options(spark, SF), f"{bronze}/dbo_order_item_options")
    jobs.bronze_to_silver(spark, bronze, f"{tmp_out}/silver", order_by="all", buckets=4, table_prefix="t_bkt_")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        enriched = gold.enrich_orders(spark.table("t_bkt_fact_orders"), spark.table("t_bkt_fact_options"))
        p = plan(enriched)
        assert "SortMergeJoin" in p
        assert "Exchange" not in p, p  # options aggregate and join read co-located buckets
        # same rows as the unbucketed folders
        plain = gold.enrich_orders(
            silver.fact_orders(fx.order_items(spark, SF), order_by="all"),
            silver.fact_options(fx.order_item_options(spark, SF), order_by="all"),
        )
        assert enriched.count() == plain.count()
        assert enriched.exceptAll(plain.select(*enriched.columns)).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS t_bkt_fact_orders")
        spark.sql("DROP TABLE IF EXISTS t_bkt_fact_options")


def test_location_ranks_join_the_rows_once(spark):
    from pyspark.sql import functions as F

    from basketry.operators import gold

    loc = spark.range(50).select(
        (F.col("id") % 7).cast("double").alias("total_revenue"), *[(F.col("id") % n).cast("int").alias(c) for c, n in (("year", 2), ("period_day", 5), ("period_week", 4), ("period_month", 3))]
    )
    for with_year in (False, True):
        text = plan(gold.add_revenue_ranks(loc, with_year=with_year, money_precision=2)).split("== Physical Plan ==")[-1]
        # of the stored rows: one scan and one join; the other joins add totals per range and group
        assert text.count("total_revenue") and len([x for x in text.splitlines() if "FileScan" in x and "total_revenue" in x]) == 1
        assert len([x for x in text.splitlines() if "Join" in x and "_value" in x]) == 1
