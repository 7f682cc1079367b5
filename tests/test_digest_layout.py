"""Full-row duplicates by digest, and the clustered layout."""

import os
import re

import pytest
from pyspark.sql import functions as F

from basketry.functions import rules
from basketry.operators import dedupe
from basketry.plans import partitions
from basketry.sources import write_clustered


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def odd(spark):
    nan = float("nan")
    rows = [
        (1, "a", 0.0), (1, "a", -0.0), (1, "a", 0.0), (2, None, nan), (2, None, nan), (None, None, None), (None, None, None),
        (None, "a", None), ("3", "", None), (3, None, None), (4, "x", 1.0),
    ]
    return spark.createDataFrame([(None if a is None else int(a), b, c) for a, b, c in rows], "`k.1` int, t string, v double")


def test_same_duplicates_as_on_whole_rows(odd):
    key = [F.col("`k.1`"), "t", "v", "extra_copies"]
    assert rows_of(dedupe.duplicate_rows_by_digest(odd).select(*key)) == rows_of(
        odd.groupBy(F.col("`k.1`"), "t", "v").agg((F.count(F.lit(1)) - 1).alias("extra_copies")).where("extra_copies > 0")
    )
    assert rows_of(dedupe.distinct_by_digest(odd)) == rows_of(odd.distinct())
    assert rows_of(dedupe.distinct_accounting_by_digest(odd)) == rows_of(dedupe.dedupe_accounting(odd, odd.distinct()))


def test_large_and_empty_frames(spark):
    base = spark.range(20_000).select(F.col("id"), F.repeat(F.lit("w"), 50).alias("t"), (F.col("id") % 7).alias("m"))
    hot = spark.range(10_000).select(F.lit(-1).cast("bigint").alias("id"), F.lit("hot").alias("t"), F.lit(0).cast("bigint").alias("m"))
    df = base.unionByName(hot).unionByName(base.where("id % 100 = 0"))
    got = {(r.id, r.extra_copies) for r in dedupe.duplicate_rows_by_digest(df).collect()}
    assert got == {(-1, 9_999)} | {(i, 1) for i in range(0, 20_000, 100)}
    assert dedupe.distinct_by_digest(df).count() == 20_001
    empty = df.limit(0)
    assert dedupe.duplicate_rows_by_digest(empty).count() == 0 and dedupe.distinct_by_digest(empty).count() == 0
    assert dedupe.distinct_accounting_by_digest(empty).first().rows_before in (0, None)


def test_chance_digests_do_not_decide(spark, monkeypatch):
    """With a filter of one row of bits and a constant digest every row is a candidate; results stay."""
    df = spark.createDataFrame([(i % 40, "x") for i in range(60)], "k int, t string")
    monkeypatch.setattr(dedupe, "row_digests", lambda d: [F.lit(5).cast("bigint"), F.lit(6).cast("bigint")])
    assert sorted(r.k for r in dedupe.duplicate_rows_by_digest(df).collect()) == list(range(20))
    assert dedupe.distinct_by_digest(df).count() == 40


def test_only_rows_that_may_repeat_are_shuffled_whole(spark, tmp_out):
    path = os.path.join(tmp_out, "t")
    spark.range(1000).select("id", F.lit("wide").alias("wide")).write.parquet(path)
    df = spark.read.parquet(path)
    tree = plan(dedupe.duplicate_rows_by_digest(df))
    exchanges = [line for line in tree.splitlines() if "Exchange hashpartitioning" in line]
    assert "BroadcastHashJoin" in tree and "SortMergeJoin" not in tree
    # deepest first: the digests, the words of the filter; whole rows only above the join
    assert any("_a" in x and "_b" in x for x in exchanges) and any("_word" in x for x in exchanges)
    wide = [i for i, x in enumerate(tree.splitlines()) if "Exchange hashpartitioning" in x and "wide" in x]
    join = next(i for i, x in enumerate(tree.splitlines()) if "BroadcastHashJoin" in x)
    assert len(wide) == 1 and wide[0] < join
    single = plan(dedupe.split_by_digest(df)[1])
    assert not re.search(r"Exchange hashpartitioning\([^)]*wide", single)


def scanned_rows(spark, df) -> int:
    """Rows that the scan handed on: those of the row groups it did not skip."""
    found = df._jdf.queryExecution().executedPlan()
    found.executeCollect()
    return found.collectLeaves().head().metrics().apply("numOutputRows").value()


@pytest.fixture()
def clustered(spark, tmp_out):
    path = os.path.join(tmp_out, "t")
    df = spark.range(40_000).select(
        F.concat(F.lit("u"), F.lpad((F.col("id") * 7919 % 500).cast("string"), 4, "0")).alias("user_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
    )
    write_clustered(df, path, ["user_id", "day"], files=8, bloom={"order_id": 10_000})
    return df, path


def test_filters_on_the_leading_columns_skip_row_groups(spark, clustered):
    df, path = clustered
    one = spark.read.parquet(path).where("user_id = 'u0123'")
    assert one.count() == df.where("user_id = 'u0123'").count() > 0
    # ranges come from a sample, so files differ in size: at most the files whose range has the user are read
    per_file = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count("day").alias("n"), F.min("user_id").alias("lo"), F.max("user_id").alias("hi"))
    holding = [r.n for r in per_file.collect() if r.lo <= "u0123" <= r.hi]
    assert len(holding) <= 2 and scanned_rows(spark, one) <= sum(holding) < 40_000 / 2
    assert rows_of(spark.read.parquet(path)) == rows_of(df)


def test_bloom_filters_skip_row_groups(spark, clustered):
    df, path = clustered
    some = df.where("user_id = 'u0123'").first().order_id
    one = spark.read.parquet(path).where(F.col("order_id") == some)
    assert one.count() == 1
    assert scanned_rows(spark, one) <= 40_000 / 2
    # least and largest values cannot tell: hashes lie in the range of every file
    missing = spark.read.parquet(path).where(F.col("order_id") == "8" + "0" * 63)
    assert scanned_rows(spark, missing) <= 40_000 / 2


def test_a_hot_value_is_spread_over_files(spark, tmp_out):
    path = os.path.join(tmp_out, "hot")
    df = spark.range(12_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("u"), "id")
    write_clustered(df, path, ["u"], files=6)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 3 * 12_000 / 6
    with pytest.raises(ValueError):
        write_clustered(df, path, ["u"], files=0)


def test_partition_digests_sum_plain_longs(spark):
    """The sums of 64-bit hashes are exact, and no row is taken to a decimal."""
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("x"))
    got = partitions.partition_digests(df, ["k"])
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in ("k", "x")])
    hashes = df.select("k", F.xxhash64("k", "x", nulls).alias("a"), F.xxhash64(F.lit("k,x"), nulls, "x", "k").alias("b")).collect()
    want = {k: (sum(1 for r in hashes if r.k == k), sum(r.a for r in hashes if r.k == k), sum(r.b for r in hashes if r.k == k)) for k in range(3)}
    assert {r.k: (r.rows, int(r.sum_a), int(r.sum_b)) for r in got.collect()} == want
    assert dict(got.dtypes) == {"k": "bigint", "rows": "bigint", "sum_a": "decimal(38,0)", "sum_b": "decimal(38,0)"}
    partial = got._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1]
    assert "decimal" not in partial.lower()


def test_rounding_takes_decimals_near_ties_only(spark):
    from decimal import ROUND_HALF_UP, Decimal

    values = [0.0, -0.001, 0.005, -0.005, 1.005, 2.675, -2.675, 0.1 + 0.2, 1e9 + 0.125, 123456.785, 99999.994999, 1e13 + 0.1, 5e-324]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan"), float("inf"), 1e30]], "v double")
    for scale in (2, 4, 6):
        got = {str(r.v): r.r for r in df.select("v", rules.round_half_up("v", scale).alias("r")).collect()}
        for v in values:
            ten = Decimal(repr(v)).quantize(Decimal("1e-10"), ROUND_HALF_UP)
            assert str(got[str(v)]) == str(float(ten.quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)) + 0.0)
        assert got["None"] is None and str(got["nan"]) == "nan" and got["inf"] == float("inf") and got["1e+30"] == 1e30
    assert str(rules.round_half_up("v", 2)).count("try_cast") <= 1 and "floor" in str(rules.round_half_up("v", 2)).lower()
