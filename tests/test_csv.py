"""Parallel reads of CSV files with line breaks in fields, and inference by merged states, against pandas."""

import os
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.sources import csv, read_csv, write_csv

CELLS = ["a", "", 'q"uo"te', "two\nlines", "three\n\nlines\n", "a,b", '"', '""', "\n", " pad ", "é😀", "x" * 90, 'end"\n', "1", "NA", "r\r\nn"]


def made(n, seed):
    r = random.Random(seed)
    return pd.DataFrame({"i": range(n), "s": [r.choice(CELLS) for _ in range(n)], "t": [r.choice(CELLS) * r.randint(1, 3) for _ in range(n)]})


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def cells(df):
    return sorted(tuple(None if pd.isna(v) else str(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("max_splits", [csv.MAX_SPLITS, 1])
def test_lines_inside_fields_across_splits(spark, tmp_out, small_splits, monkeypatch, ending, max_splits):
    monkeypatch.setattr(csv.read_records, "__defaults__", (max_splits,))
    os.mkdir(f"{tmp_out}/in")
    for k in range(2):
        made(400, k).to_csv(f"{tmp_out}/in/{k}.csv", index=False, lineterminator=ending)
    want = pd.concat([pd.read_csv(f"{tmp_out}/in/{k}.csv", keep_default_na=False, dtype=str) for k in range(2)])
    got = read_csv(spark, f"{tmp_out}/in", multiline=True, missing=())
    assert max_splits == 1 or got.rdd.getNumPartitions() > 10  # joined splits are dealt again
    back = got.toPandas().fillna("")
    assert cells(back) == cells(want)


def test_one_record_over_many_splits_and_a_quoted_header(spark, tmp_out, small_splits):
    df = pd.DataFrame({"two\nlines": ["x\n" * 3000, "b", 'c"\n"' * 500], "k": [1, 2, 3]})
    df.to_csv(f"{tmp_out}/p.csv", index=False)
    got = read_csv(spark, f"{tmp_out}/p.csv", multiline=True).orderBy("k")
    assert got.columns == ["two\nlines", "k"]
    assert [r[0] for r in got.collect()] == df.iloc[:, 0].tolist()
    empty = f"{tmp_out}/e.csv"
    df.head(0).to_csv(empty, index=False)
    assert read_csv(spark, empty, multiline=True).count() == 0


def test_malformed_records_with_line_breaks(spark, tmp_out):
    with open(f"{tmp_out}/m.csv", "w") as f:
        f.write('a,b\n1,"x\ny"\n\n2\n3,4,5\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_csv(spark, f"{tmp_out}/m.csv", multiline=True).collect()
    rows = read_csv(spark, f"{tmp_out}/m.csv", multiline=True, corrupt_column="bad").collect()
    assert sorted(r.bad for r in rows if r.bad) == ["2", "3,4,5"] and [r.b for r in rows if r.bad is None] == ["x\ny"]


COLUMNS = {
    "yn": ["Y", "N", "Y", None], "clock": ["12:30:00", "09:00:00", None, "23:59:59"], "day": ["2024-01-02", "2024-02-30", "2024-01-01", None],
    "whole": ["1", "-2", "+3", " 4 "], "gaps": ["1", None, "3", "NA"], "real": ["1", "2.5", "-.5e3", "inf"], "mixed": ["1", "x", "2.5", None],
    "flags": ["True", "false", "TRUE", "False"], "flag_gaps": ["True", None, "False", None], "flag_numbers": ["True", "1", "False", "0"],
    "empty": [None, None, "NaN", ""], "large": ["18446744073709551615", "1", "2", "3"], "large_signed": ["18446744073709551615", "-1", "2", "3"],
    "huge": ["18446744073709551616", "1", "2", "3"], "suffix": ["1d", "2f", "3", "4"], "under": ["1_000", "2", "3", "4"], "stamp": ["2024-01-02 10:00:00"] * 4,
}
KINDS = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string", "str": "string", "uint64": "decimal(20,0)"}


def test_types_and_values_as_pandas(spark, tmp_out):
    path = f"{tmp_out}/t.csv"
    pd.DataFrame(COLUMNS).to_csv(path, index=False)
    want, got = pd.read_csv(path), read_csv(spark, path, infer_schema=True)
    types = dict(got.dtypes)
    for c in COLUMNS:
        kind = KINDS[str(want[c].dtype)]
        if c == "gaps":  # whole numbers with gaps: NULL here, so they stay whole
            kind = "bigint"
        elif c == "flag_gaps":
            kind = "boolean"
        assert types[c] == kind, c
        values = [None if pd.isna(v) else v for v in want[c].tolist()]
        assert [r[0] for r in got.select(c).collect()] == values, c


def test_states_of_loads_merge(spark, tmp_out):
    whole = spark.createDataFrame([("1", "x"), ("2", None)], "a string, b string")
    real = spark.createDataFrame([("1.5", None)], "a string, c string")
    one, two = csv.type_states(whole), csv.type_states(real)
    merged = csv.merge_states(one, two)
    assert {n: csv.state_type(s) for n, s in merged.items()} == {"a": "double", "b": "string", "c": "double"}
    assert merged == csv.merge_states(two, one) and csv.merge_states(merged, one) == merged
    assert csv.with_types(whole, merged).schema.simpleString() == "struct<a:double,b:string>"
    assert csv.type_states(whole.limit(0)) == {"a": 0, "b": 0}


def test_inference_does_not_depend_on_splits(spark, tmp_out, small_splits):
    made(500, 4).assign(n=[str(k % 7) if k % 11 else "" for k in range(500)]).to_csv(f"{tmp_out}/a.csv", index=False)
    got = read_csv(spark, f"{tmp_out}/a.csv", multiline=True, infer_schema=True)
    assert dict(got.dtypes) == {"i": "bigint", "s": "string", "t": "string", "n": "bigint"}
    assert got.agg(F.sum("n")).first()[0] == sum(k % 7 for k in range(500) if k % 11)


def test_round_trip_of_a_table(spark, tmp_out):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    write_csv(df.repartition(3), f"{tmp_out}/docs")
    back = read_csv(spark, f"{tmp_out}/docs", schema=df.schema, multiline=True, missing=())
    assert back.count() == df.count() and back.exceptAll(df).count() == 0


def test_kinds_match_expressions_only_for_texts_like_numbers(spark):
    """Every text gets the kind that the expressions alone give it, odd ends included."""
    whole, real = r"[+-]?[0-9]+", r"[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)"
    texts = [
        "", " ", "+", "-.", "5", " 5 ", "\t5", "5\t", "5.", "+.5", "-0", "1e5", "1e", "inf", "-Infinity", "+", "infinit", "NaN", "True", " true", "9" * 18, str(2**63 - 1), str(2**63),
        str(-(2**63)), str(-(2**63) - 1), str(2**64 - 1), str(2**64), "0" * 30 + "7", "+" + "0" * 40, "9" * 39, "1_000", "0x1", "1f", "1996-01-01T00:00:00.000Z", "12-4", "USD",
    ]

    def kind(t):
        if t in csv.BOOLEAN_TOKENS:
            return csv.BOOLEAN
        s = t.strip(" ")
        if re.fullmatch(whole, s):
            n = int(s)
            return csv.NEGATIVE if -(2**63) <= n < 0 else csv.INTEGER if 0 <= n < 2**63 else csv.UNSIGNED if 0 <= n < 2**64 else csv.TEXT
        return csv.FLOAT if re.fullmatch(real, s) else csv.TEXT

    df = spark.createDataFrame([(t,) for t in [*texts, None, "5\n", "-5\r\n"]], "v string")
    got = {r.v: r.k for r in df.select("v", csv.value_kind(F.col("v")).alias("k")).collect()}
    assert got == {t: kind(t) for t in texts} | {None: csv.MISSING, "5\n": csv.INTEGER, "-5\r\n": csv.NEGATIVE}
    # each expression stands once, behind a look at both ends
    said = str(csv.value_kind(F.col("v"))).lower()
    assert said.count("regexp_like") + said.count("rlike") == 2 and "substring" in said
