"""Aligned histogram bins and mergeable profiles."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import metrics, profile, sketches
from basketry.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def plain_step(lo, hi, most):
    steps = sorted({d * 10.0**e if e >= 0 else d / 10.0**-e for e in range(-12, 13) for d in (1, 2, 5)})
    return 1.0 if lo == hi else next(s for s in steps if math.floor(hi / s) - math.floor(lo / s) + 1 <= most)


def test_nice_steps():
    r = random.Random(1)
    for _ in range(3000):
        lo = r.uniform(-1, 1) * 10 ** r.randint(-4, 6)
        hi = lo + abs(r.gauss(0, 1)) * 10 ** r.randint(-4, 6)
        most = r.randint(2, 80)
        assert metrics.nice_step(lo, hi, most) == plain_step(lo, hi, most)
    assert metrics.nice_step(0, 49, 50) == 1 and metrics.nice_step(0, 50, 50) == 2 and metrics.nice_step(3, 3, 50) == 1
    with pytest.raises(ValueError):
        metrics.nice_step(0, 1, 1)


def test_nice_histogram_rows(spark):
    rows = [(1.0, "a"), (9.99, "a"), (10.0, "b"), (-0.5, None), (99.0, "b"), (None, "c"), (float("nan"), "a")]
    df = spark.createDataFrame(rows, "v double, g string")
    got = {(r.bin, r.g): (r.bin_start, r.bin_end, r.n) for r in metrics.nice_histogram(df, "v", "g", 12).collect()}
    assert len(got) == 11 * 4 and got[0, None] == (-10.0, 0.0, 1) and got[1, "a"] == (0.0, 10.0, 2) and got[10, "b"] == (90.0, 100.0, 1)
    assert sum(n for _, _, n in got.values()) == 5 and got[2, "b"][2] == 1 and got[3, "c"][2] == 0
    assert metrics.nice_histogram(df.where("v > 1000"), "v", "g").count() == 0


def test_sketches_of_a_union_without_reading_older_loads(spark, tmp_path):
    items = fx.profile_items(spark, SF)
    cut = F.pmod(F.hash("ORDER_ID", "LINEITEM_ID"), F.lit(3))
    loads = [items.where(cut == k) for k in range(3)]
    folder = f"{tmp_path}/sketches"
    for k, load in enumerate(loads):
        sketches.store_sketches(load, folder, "items", f"day{k}")
    sketches.store_sketches(loads[2], folder, "items", "day2")  # again: replaced, not added
    sketches.store_sketches(loads[0], folder, "other", "day0")
    merged = sketches.merge_sketches(sketches.stored_sketches(spark, folder, "items"))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan
    got = {r.column_name: r for r in sketches.sketch_profile(merged).collect()}
    exact = {r.column_name: r for r in profile.column_profile(items).collect()}
    fences = {r.column_name: r for r in profile.iqr_outliers(items).collect()}
    assert got.keys() == exact.keys()
    for c, e in exact.items():
        assert (got[c].rows, got[c].missing) == (e.non_null + e.nulls, e.nulls), c
        assert abs(got[c].distinct_values - e.distinct_values) <= max(1, 4 * sketches.distinct_error() * e.distinct_values), c
        assert (got[c].q_0 is not None) == (c in fences), c
    assert len(sketches.stored_sketches(spark, folder).select("source").distinct().collect()) == 2


def test_quantiles_stay_within_the_stated_rank_error(spark):
    values = np.random.default_rng(2).lognormal(3, 2, 60_000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(6)
    parts = [sketches.sketch_columns(df.where(F.pmod(F.hash("v"), F.lit(4)) == k)).withColumn("source", F.lit("s")) for k in range(4)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    merged = sketches.merge_sketches(rows)
    probs = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    found = sketches.sketch_profile(merged, probs).first()
    ordered = np.sort(values)
    for i, p in enumerate(probs):
        rank = np.searchsorted(ordered, found[f"q_{i}"], side="right") / len(values)
        assert abs(rank - p) <= sketches.rank_error(), p
    asked = [float(ordered[k]) for k in (100, 30_000, 59_000)]
    for r in sketches.rank_of(merged, "v", asked).collect():
        assert abs(r["rank"] - np.searchsorted(ordered, r.value, side="right") / len(values)) <= sketches.rank_error()


def test_odd_columns(spark):
    df = spark.createDataFrame([(None, 0.0, "x"), (None, -0.0, None), (None, float("nan"), "x")], "e double, z double, t string")
    got = {r.column_name: r for r in sketches.sketch_profile(sketches.merge_sketches(sketches.sketch_columns(df).withColumn("source", F.lit("s")))).collect()}
    assert (got["e"].missing, got["e"].distinct_values, got["e"].q_1) == (3, 0, None)
    assert (got["z"].missing, got["z"].distinct_values, got["z"].q_1) == (1, 1, 0.0)
    assert (got["t"].missing, got["t"].distinct_values, got["t"].q_1) == (1, 1, None)
    none = {r.column_name: r for r in sketches.sketch_profile(sketches.sketch_columns(df.limit(0))).collect()}
    assert none["z"].rows == 0 and none["z"].distinct_values == 0 and none["z"].q_1 is None
