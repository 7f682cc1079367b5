"""Union of files with differing types: no value changes, one scan per group."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.sources import common_schema, common_type, read_drifted
from basketry.sources.drift import schema_groups

D = T.DecimalType


@pytest.mark.parametrize(
    "a,b,want",
    [
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.ByteType(), T.ShortType(), T.ShortType()),
        (T.IntegerType(), T.FloatType(), T.DoubleType()),
        (T.FloatType(), T.DoubleType(), T.DoubleType()),
        (T.LongType(), D(10, 2), D(21, 2)),
        (D(38, 0), D(38, 10), T.StringType()),
        (D(12, 4), D(10, 1), D(13, 4)),
        (T.DateType(), T.TimestampType(), T.TimestampType()),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.BooleanType(), T.LongType(), T.StringType()),
        (T.StringType(), T.DoubleType(), T.StringType()),
        (T.StringType(), T.BinaryType(), T.BinaryType()),
        (T.NullType(), T.DateType(), T.DateType()),
        (T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType()), T.ArrayType(T.StringType())),
    ],
)
def test_common_type(a, b, want):
    assert common_type(a, b) == want == common_type(b, a)


def test_no_common_type_of_nested_and_plain():
    with pytest.raises(ValueError, match="no common type"):
        common_type(T.ArrayType(T.LongType()), T.LongType())


def test_common_schema_ignores_case_and_goes_inside_structs(spark):
    a = T.StructType.fromDDL("Id int, s struct<x:int>")
    b = T.StructType.fromDDL("s struct<x:string,y:date>, ID bigint, extra boolean")
    assert common_schema([a, b]).simpleString() == "struct<Id:bigint,s:struct<x:string,y:date>,extra:boolean>"


def load(spark, folder, name, ddl, rows, **partition):
    path = os.path.join(folder, *[f"{k}={v}" for k, v in partition.items()], name)
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(path)


def test_numbers_text_and_missing_columns(spark, tmp_out):
    load(spark, tmp_out, "a", "k int, v int, d date", [(1, 7, dt.date(2024, 1, 2)), (None, None, None)])
    load(spark, tmp_out, "b", "k bigint, v double", [(2**62, 0.5)])
    load(spark, tmp_out, "c", "k string, D timestamp, flag boolean", [("x-1", dt.datetime(2024, 1, 2, 3, 4), True), ("", None, None)])
    got = read_drifted(spark, [os.path.join(tmp_out, x) for x in "abc"])
    assert dict(got.dtypes) == {"k": "string", "v": "double", "d": "timestamp", "flag": "boolean"}
    rows = {(r.k, r.v, r.d, r.flag) for r in got.collect()}
    assert rows == {
        ("1", 7.0, dt.datetime(2024, 1, 2), None), (None, None, None, None), (str(2**62), 0.5, None, None),
        ("x-1", None, dt.datetime(2024, 1, 2, 3, 4), True), ("", None, None, None),
    }


def test_nested_columns(spark, tmp_out):
    load(spark, tmp_out, "a", "s struct<x:int>, l array<int>, m map<string,int>", [((1,), [1, None], {"a": 1}), (None, None, None)])
    load(spark, tmp_out, "b", "s struct<y:string,x:string>, l array<string>, m map<string,bigint>", [(("q", "z"), ["t"], {"b": 2})])
    got = read_drifted(spark, [os.path.join(tmp_out, x) for x in "ab"])
    rows = [(r.s and (r.s.x, r.s.y), r.l, r.m) for r in got.collect()]
    assert sorted(rows, key=str) == sorted([(("1", None), ["1", None], {"a": 1}), (None, None, None), (("z", "q"), ["t"], {"b": 2})], key=str)


def test_values_that_a_double_cannot_hold_are_named(spark, tmp_out):
    load(spark, tmp_out, "a", "k bigint, p decimal(30,10)", [(2**53 + 1, None), (2**63 - 1, None), (5, None)])
    load(spark, tmp_out, "b", "k double, p double", [(0.5, 1.5)])
    paths = [os.path.join(tmp_out, x) for x in "ab"]
    with pytest.raises(ValueError, match=r"k \(2 values\)"):
        read_drifted(spark, paths)
    assert read_drifted(spark, paths, exact=False).schema["k"].dataType == T.DoubleType()
    as_text = read_drifted(spark, paths, types={"K": "string"})
    assert {r.k for r in as_text.collect()} == {str(2**53 + 1), str(2**63 - 1), "5", "0.5"}
    with pytest.raises(ValueError, match="no such columns"):
        read_drifted(spark, paths, types={"nope": "string"})


def test_partition_folders_keep_their_column(spark, tmp_out):
    folder = os.path.join(tmp_out, "t")
    load(spark, folder, "x", "v int", [(1,)], day="2024-01-01", site="a b")
    load(spark, folder, "x", "v string", [("two",)], day="2024-01-02", site="7")
    # the loads lie in a folder below the partition folders
    got = read_drifted(spark, folder)
    assert dict(got.dtypes) == {"v": "string", "day": "date", "site": "string"}
    assert {(r.v, str(r.day), r.site) for r in got.collect()} == {("1", "2024-01-01", "a b"), ("two", "2024-01-02", "7")}


def test_groups_of_alternating_files(spark, tmp_out):
    for i in range(9):
        load(spark, tmp_out, f"f{i}", "k int" if i % 3 else "k string, e int", [(i,)] if i % 3 else [(str(i), i)])
    files = [f for f in spark.read.schema("k string").parquet(f"{tmp_out}/*").inputFiles()]
    groups = schema_groups(spark, files, threads=2)
    assert sorted(len(members) for _, members in groups) == [3, 6]
    assert sorted(sum((m for _, m in groups), [])) == sorted(files)
    assert sorted(int(r.k) for r in read_drifted(spark, f"{tmp_out}/*").collect()) == list(range(9))


def test_filters_and_pruning_reach_every_scan(spark, tmp_out):
    load(spark, tmp_out, "a", "k int, v string, w string", [(1, "a", "b")])
    load(spark, tmp_out, "b", "k bigint, v string, w string", [(2, "a", "b")])
    df = read_drifted(spark, [os.path.join(tmp_out, x) for x in "ab"]).where(F.col("k") == 2).select("k", "v")
    plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert plan.count("EqualTo(k,2)") >= 2 and "w:string" not in plan
    assert [(r.k, r.v) for r in df.collect()] == [(2, "a")]


def test_no_files(spark, tmp_out):
    os.makedirs(os.path.join(tmp_out, "empty"))
    with pytest.raises(ValueError, match="no Parquet files"):
        read_drifted(spark, os.path.join(tmp_out, "empty"))
