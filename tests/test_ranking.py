"""Distributed ranking, terciles and quantiles against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.operators.ranking import (
    grouped_quantiles,
    rank_within_few,
    rank_within_groups,
    rank_within_many,
    running_counts,
    tercile_scores,
    tercile_scores_many,
    value_counts,
)


def pandas_tercile_codes(values, default):
    """What the dashboard computed: rank(first) -> qcut(3) -> codes."""
    s = pd.Series(values, dtype="float64")
    if s.nunique() <= 1:
        return [default] * len(s)
    ranked = s.rank(method="first")
    cut = pd.qcut(ranked, q=3, labels=[1, 2, 3], duplicates="drop")
    return cut.cat.codes.replace(-1, default).astype(int).tolist()


def test_running_counts_match_a_window(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, 1, 2]), rnd.choice([None, *map(float, range(40))])) for _ in range(600)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(7)
    for descending in (False, True):
        counts = value_counts(df, ["g"], "v")
        got = running_counts(counts, ["g"], descending)
        order = F.col("value").desc_nulls_last() if descending else F.col("value").asc_nulls_first()
        w = Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        want = counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
        key = lambda r: tuple(map(str, r))
        assert sorted(got.select("g", "value", "n", "before").collect(), key=key) == sorted(want.collect(), key=key)


@pytest.mark.parametrize("descending", [True, False])
def test_rank_within_groups_matches_window_rank(spark, descending):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 3), rnd.choice([None, 1.0, 2.0, 2.0, 3.5, 7.0])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g int, v double")
    got = rank_within_groups(df, ["g"], "v", "r", descending=descending)
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(order)))
    assert sorted(got.select("id", "g", "v", "r").collect()) == sorted(
        want.select("id", "g", "v", F.col("r").cast("int")).collect()
    )


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 10, 31, 100])
def test_tercile_scores_match_pandas_qcut(spark, n):
    rnd = random.Random(n)
    values = [float(rnd.randint(0, 5)) for _ in range(n)]
    users = [f"u{i:03d}" for i in range(n)]
    df = spark.createDataFrame(list(zip(users, values)), "user_id string, x double")
    got = dict(
        tercile_scores(df, F.col("x"), "user_id", "code", default=1)
        .select("user_id", "code")
        .collect()
    )
    want = pandas_tercile_codes(values, 1)
    assert [got[u] for u in users] == want


def test_tercile_four_distinct_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", 4.0)], "user_id string, x double")
    got = [r.code for r in tercile_scores(df, F.col("x"), "user_id", "code", 3).orderBy("user_id").collect()]
    assert got == [0, 1, 2, 2]


def test_tercile_constant_and_nulls_get_default(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", None)], "user_id string, x double")
    got = {r.user_id: r.code for r in tercile_scores(df, F.col("x"), "user_id", "code", 3).collect()}
    assert got == {"a": 3, "b": 3, "c": 3}
    df2 = spark.createDataFrame([("a", 1.0), ("b", 9.0), ("c", None)], "user_id string, x double")
    got2 = {r.user_id: r.code for r in tercile_scores(df2, F.col("x"), "user_id", "code", 1).collect()}
    assert got2["c"] == 1
    assert got2 == dict(zip(["a", "b", "c"], pandas_tercile_codes([1.0, 9.0, None], 1)))


def test_grouped_quantiles_linear_interpolation(spark):
    rnd = random.Random(3)
    rows = [(g, rnd.uniform(-10, 10)) for g in ("a", "b", "c") for _ in range(37 if g != "c" else 1)]
    rows.append(("a", None))
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.q_0, r.q_1, r.n) for r in grouped_quantiles(df, ["g"], "v", [0.25, 0.8]).collect()}
    for g in ("a", "b", "c"):
        vals = [v for gg, v in rows if gg == g and v is not None]
        q = np.quantile(vals, [0.25, 0.8])
        assert got[g][2] == len(vals)
        assert got[g][0] == pytest.approx(q[0], rel=1e-12, abs=1e-12)
        assert got[g][1] == pytest.approx(q[1], rel=1e-12, abs=1e-12)


def test_quantile_small_example(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "v double")
    r = grouped_quantiles(df, [], "v", [0.2]).first()
    assert r.q_0 == pytest.approx(1.6)


def test_several_ranks_from_one_frame(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randint(0, 2), rnd.randint(0, 4), rnd.choice([None, 1.0, 2.0, 5.0, 5.0])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g int, h int, v double")
    got = rank_within_many(df, {"a": ["g"], "b": ["g", "h"], "c": []}, "v")
    order = F.col("v").desc_nulls_last()
    want = df.withColumns(
        {n: F.rank().over(Window.partitionBy(*k).orderBy(order)) for n, k in (("a", ["g"]), ("b", ["g", "h"]), ("c", []))}
    )
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_hot_value_and_many_ranges(spark):
    """One value holds a third of the rows; groups and ties span many ranges."""
    rnd = random.Random(9)
    rows = [(i, rnd.choice([0, 0, 0, 1, 2]), 5.0 if i % 3 == 0 else rnd.choice([None, 1.0, 2.0, rnd.random()])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g int, v double")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for descending in (True, False):
            got = rank_within_groups(df, ["g"], "v", "r", descending=descending)
            order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
            want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(order)))
            assert sorted(map(str, got.select("id", "g", "v", "r").collect())) == sorted(map(str, want.collect()))
        present = [r for r in rows if r[2] is not None]
        ordered = sorted(present, key=lambda r: (r[2], r[0]))
        codes = {r[0]: (0 if 3 * k < len(present) - 1 else 1 if 3 * k < 2 * (len(present) - 1) else 2) for k, r in enumerate(ordered)}
        scored = {r.id: r.s for r in tercile_scores(df, "v", "id", "s", default=9).collect()}
        assert scored == {r[0]: codes.get(r[0], 9) for r in rows}
        q = grouped_quantiles(df, [], "v", [0.2, 0.5, 0.8]).first()
        assert [q.q_0, q.q_1, q.q_2] == pytest.approx(np.quantile([r[2] for r in present], [0.2, 0.5, 0.8]))
    finally:
        for k, val in old.items():
            spark.conf.set(k, val)


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, g int, v double")
    assert rank_within_groups(df, ["g"], "v", "r").count() == 0
    assert tercile_scores(df, "v", "id", "s", default=1).count() == 0
    assert grouped_quantiles(df, ["g"], "v", [0.5]).count() == 0
    assert grouped_quantiles(df, [], "v", [0.5]).count() == 0


def test_terciles_of_several_measures_and_labels(spark):
    rows = [(f"u{i:02d}", float(i % 4), 7.0, None if i == 3 else float(-i)) for i in range(20)]
    df = spark.createDataFrame(rows, "u string, a double, b double, c double")
    got = {r.u: r for r in tercile_scores_many(df, [("a", "A", 1, (3, 2, 1)), ("b", "B", 8, None), ("c", "C", 9, None)], "u").collect()}
    want = [{0: 3, 1: 2, 2: 1}[c] for c in pandas_tercile_codes([r[1] for r in rows], 1)]
    assert [got[r[0]].A for r in rows] == want
    assert {r.B for r in got.values()} == {8} and got["u03"].C == 9
    with pytest.raises(ValueError):
        tercile_scores(df, "a", "u", "s", 1, labels=(1, 2))


def test_ranks_within_few_groups(spark):
    """A hot value, NULLs, NULL groups and many ranges; one row per value and combination of groups is joined back."""
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, 0, 1]), rnd.randint(0, 4), 5.0 if i % 3 == 0 else rnd.choice([None, 1.0, 2.0, float("nan"), rnd.random()])) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, g int, h int, v double")
    groupings = {"a": ["g"], "b": ["g", "h"], "c": []}
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for descending in (True, False):
            got = rank_within_few(df, groupings, "v", descending)
            order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
            want = df.withColumns({n: F.rank().over(Window.partitionBy(*k).orderBy(order)) for n, k in groupings.items()})
            assert got.dtypes == want.dtypes
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert rank_within_few(df.limit(0), groupings, "v").count() == 0
    finally:
        for k, val in old.items():
            spark.conf.set(k, val)
