"""Sources and sinks: round trips in a temporary folder, JDBC without a database."""

import os

import pytest
from pyspark.sql import functions as F

from basketry.plans import jobs
from basketry.plans import fixtures as fx
from basketry.sources import (
    Partitioning,
    ingest_all,
    jdbc_options,
    load_gold,
    read_csv,
    read_parquet,
    target_folder,
    union_frames,
    write_csv,
    write_parquet,
)

SF = "/root/testdata/sf0.001"


def test_parquet_round_trip_and_overwrite(spark, tmp_out):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    path = os.path.join(tmp_out, "t")
    write_parquet(df, path)
    write_parquet(df.limit(3), path)  # full overwrite
    assert read_parquet(spark, path).count() == 3


def test_dynamic_partition_overwrite(spark, tmp_out):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    path = os.path.join(tmp_out, "parts")
    write_parquet(df, path, partition_by=["p"])
    write_parquet(spark.createDataFrame([(3, "a")], "v int, p string"), path, partition_by=["p"], dynamic_overwrite=True)
    got = sorted((r.v, r.p) for r in read_parquet(spark, path).collect())
    assert got == [(2, "b"), (3, "a")]


def test_multi_file_read_merges_schema(spark, tmp_out):
    a, b = os.path.join(tmp_out, "a"), os.path.join(tmp_out, "b")
    write_parquet(spark.createDataFrame([(1,)], "x int"), a)
    write_parquet(spark.createDataFrame([(2, "y")], "x int, y string"), b)
    got = read_parquet(spark, [a, b], merge_schema=True)
    assert sorted(got.columns) == ["x", "y"] and got.count() == 2
    u = union_frames([spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("z",)], "y string")])
    assert u.count() == 2 and sorted(u.columns) == ["x", "y"]


def test_csv_round_trip(spark, tmp_out):
    df = fx.date_dim(spark, SF)
    path = os.path.join(tmp_out, "csv")
    write_csv(df, path)
    back = read_csv(spark, path, schema=df.schema)
    assert back.count() == df.count() and back.exceptAll(df).count() == 0
    inferred = read_csv(spark, path, infer_schema=True)
    assert dict(inferred.dtypes)["year"] == "bigint" and dict(inferred.dtypes)["date_key"] == "string"


AWKWARD = [
    (1, 'He said "hi", ok', "NA"), (2, "line\nbreak", "x"), (3, "", None), (4, None, " padded "), (5, "a,b", '"'), (6, 'tail"', "N/A"),
]


def test_csv_written_by_pandas(spark, tmp_out):
    import pandas as pd

    path = os.path.join(tmp_out, "p.csv")
    pd.DataFrame(AWKWARD, columns=["i", "s", "t"]).to_csv(path, index=False)
    want = pd.read_csv(path)
    got = read_csv(spark, path, multiline=True, infer_schema=True).orderBy("i")
    assert got.columns == list(want.columns)
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)]
    assert [tuple(r) for r in got.collect()] == rows


def test_csv_read_by_pandas(spark, tmp_out):
    import pandas as pd

    path = os.path.join(tmp_out, "out")
    df = spark.createDataFrame(AWKWARD, "i int, s string, t string").coalesce(1)
    write_csv(df, path)
    part = [f for f in os.listdir(path) if f.endswith(".csv")][0]
    got = pd.read_csv(os.path.join(path, part), keep_default_na=False, na_values=[])
    want = [tuple("" if v is None else v for v in r) for r in AWKWARD]
    assert sorted(map(tuple, got.itertuples(index=False))) == sorted(want)
    back = read_csv(spark, path, schema=df.schema, multiline=True, missing=())
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))  # empty and NULL stay apart


def test_csv_never_shifts_cells(spark, tmp_out):
    import pandas as pd

    path = os.path.join(tmp_out, "p.csv")
    pd.DataFrame(AWKWARD, columns=["i", "s", "t"]).to_csv(path, index=False)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_csv(spark, path).collect()
    rows = read_csv(spark, path, corrupt_column="_bad").collect()
    assert sum(r._bad is not None for r in rows) == 2 and sum(r._bad is None for r in rows) == 5
    typed = os.path.join(tmp_out, "t.csv")
    with open(typed, "w") as f:
        f.write("i,x\n1,NA\nnan,2.5\n")
    schema = spark.createDataFrame([], "i int, x double").schema
    assert sorted(map(str, read_csv(spark, typed, schema=schema).collect())) == ["Row(i=1, x=None)", "Row(i=None, x=2.5)"]
    with open(typed, "a") as f:
        f.write("oops,1\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv(spark, typed, schema=schema).collect()


def test_jdbc_options_and_target_folder():
    opts = jdbc_options(
        "jdbc:sqlserver://h;encrypt=true",
        "dbo.orders",
        user="u",
        password="p",
        driver="com.example.Driver",
        partitioning=Partitioning("id", 1, 1000, 8),
        fetch_size=10000,
    )
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "8"
    assert opts["lowerBound"] == "1" and opts["upperBound"] == "1000"
    assert opts["fetchsize"] == "10000" and opts["driver"] == "com.example.Driver"
    assert target_folder("s3://b/raw/", "dbo.order_items") == "s3://b/raw/dbo_order_items"
    with pytest.raises(ValueError):
        jdbc_options("u", "t", partitioning=Partitioning("id", 1, 2, 0))


def test_ingest_isolates_failing_tables(spark, tmp_out):
    written = []

    def fake_writer(df, path):
        written.append(path)

    # The driver class does not exist: every read fails, nothing connects.
    status = ingest_all(
        spark,
        "jdbc:none://nowhere",
        tmp_out,
        tables=["dbo.a", "dbo.b"],
        driver="does.not.Exist",
        writer=fake_writer,
    ).collect()
    assert [r.status for r in status] == ["failed", "failed"]
    assert all("Exist" in r.error or "ClassNotFound" in r.error for r in status)
    assert written == []
    many = ingest_all(
        spark, "jdbc:none://nowhere", tmp_out, tables=["dbo.a", "dbo.b", "dbo.c"],
        driver="does.not.Exist", writer=fake_writer, concurrent_tables=3,
    ).collect()
    assert [r.table_name for r in many] == ["dbo.a", "dbo.b", "dbo.c"]
    assert {r.status for r in many} == {"failed"}


def test_layer_jobs_end_to_end(spark, tmp_out):
    bronze = os.path.join(tmp_out, "bronze")
    write_parquet(fx.date_dim(spark, SF), os.path.join(bronze, "dbo_date_dim"))
    write_parquet(fx.order_items(spark, SF), os.path.join(bronze, "dbo_order_items"))
    write_parquet(fx.order_item_options(spark, SF), os.path.join(bronze, "dbo_order_item_options"))
    silver_paths = jobs.bronze_to_silver(spark, bronze, os.path.join(tmp_out, "silver"), order_by="all")
    gold_paths = jobs.silver_to_gold(spark, os.path.join(tmp_out, "silver"), os.path.join(tmp_out, "gold"), partition_by_year=True)
    fc, fl = load_gold(spark, gold_paths["fact_customer"], gold_paths["fact_orders_location"])
    assert fc.count() > 0 and fl.count() > 0
    assert "revenue_rank_month" in fl.columns and "year" in fl.columns
    assert read_parquet(spark, silver_paths["dim_date"]).count() * 2 == fx.date_dim(spark, SF).count()
    assert not fc.is_cached and not fl.is_cached
    # a rebuild removes a year that the source no longer has; dynamic overwrite keeps it
    years = {r.year for r in fl.select("year").distinct().collect()}
    gone = max(years)
    orders = read_parquet(spark, silver_paths["fact_orders"])
    write_parquet(orders.where(F.coalesce(F.year("creation_date"), F.lit(0)) != gone), os.path.join(tmp_out, "silver2", "fact_orders"))
    write_parquet(read_parquet(spark, silver_paths["fact_options"]), os.path.join(tmp_out, "silver2", "fact_options"))
    for dynamic, left in ((True, years), (False, years - {gone})):
        paths = jobs.silver_to_gold(
            spark, os.path.join(tmp_out, "silver2"), os.path.join(tmp_out, "gold"), partition_by_year=True, dynamic_overwrite=dynamic
        )
        again = read_parquet(spark, paths["fact_orders_location"])
        assert {r.year for r in again.select("year").distinct().collect()} == left


def test_jobs_command_line(spark, tmp_out):
    bronze = os.path.join(tmp_out, "bronze")
    write_parquet(fx.date_dim(spark, SF), os.path.join(bronze, "dbo_date_dim"))
    write_parquet(fx.order_items(spark, SF), os.path.join(bronze, "dbo_order_items"))
    write_parquet(fx.order_item_options(spark, SF), os.path.join(bronze, "dbo_order_item_options"))
    silver_dir, gold_dir = os.path.join(tmp_out, "silver"), os.path.join(tmp_out, "gold")
    assert jobs.main(["silver", "--bronze", bronze, "--silver", silver_dir, "--deterministic"]) == 0
    assert jobs.main(["gold", "--silver", silver_dir, "--gold", gold_dir]) == 0
    assert read_parquet(spark, os.path.join(gold_dir, "fact_customer")).count() > 0


def test_discover_partitioning_uses_one_pushed_query(spark, monkeypatch):
    from basketry.sources import jdbc

    seen = {}

    def fake_read_query(spark_, url, query, alias="q", **kw):
        seen["query"], seen["kw"] = query, kw
        return spark_.createDataFrame([(3, 9000)], "lo long, hi long")

    monkeypatch.setattr(jdbc, "read_query", fake_read_query)
    part = jdbc.discover_partitioning(spark, "jdbc:x", "dbo.orders", "id", 16, user="u")
    assert seen["query"] == "SELECT MIN(id) AS lo, MAX(id) AS hi FROM dbo.orders"
    assert seen["kw"] == {"user": "u"}
    assert part == jdbc.Partitioning("id", 3, 9000, 16)
    opts = jdbc.jdbc_options("jdbc:x", "dbo.orders", partitioning=part)
    assert (opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("3", "9000", "16")


def _fake_database(spark, monkeypatch, fail=()):
    """Substitutes the reader: no connection is made."""
    from basketry.sources import jdbc

    calls = []

    def fake_read_table(spark_, **kw):
        jdbc.jdbc_options(**kw)  # only connection arguments may arrive
        calls.append(kw)
        name = kw["dbtable"]
        if name in fail:
            raise RuntimeError("no access " + "x" * 5000)
        if "catalog" in name:
            return spark_.createDataFrame([("dbo", "a"), ("dbo", "b")], "S string, N string")
        if "MIN(" in name:
            return spark_.createDataFrame([(1, 900)], "lo long, hi long")
        return spark_.createDataFrame([(1,), (2,)], "x int")

    monkeypatch.setattr(jdbc, "read_table", fake_read_table)
    return calls


def test_ingest_with_another_catalog_query(spark, tmp_out, monkeypatch):
    calls = _fake_database(spark, monkeypatch, fail=("dbo.b",))
    status = ingest_all(
        spark, "jdbc:x", tmp_out, catalog_query="(SELECT S, N FROM catalog) AS t", schema_column="S", name_column="N",
        partition_columns={"dbo.a": "id"}, num_partitions=4, count_rows=True, user="u",
    )
    rows = {r.table_name: r for r in status.collect()}
    assert (rows["dbo.a"].status, rows["dbo.a"].rows) == ("ok", 2)
    assert rows["dbo.b"].status == "failed" and len(rows["dbo.b"].error) > 5000  # the whole text
    part = [c["partitioning"] for c in calls if c["dbtable"] == "dbo.a"][0]
    assert part == Partitioning("id", 1, 900, 4)
    assert all(c["user"] == "u" for c in calls)


def test_ingest_command_line(spark, tmp_out, monkeypatch):
    calls = _fake_database(spark, monkeypatch)
    args = ["ingest", "--url", "jdbc:x", "--target", tmp_out, "--catalog-query", "(SELECT S, N FROM catalog) AS t"]
    args += ["--schema-column", "S", "--name-column", "N", "--partition-column", "dbo.b=id", "--partitions", "3"]
    assert jobs.main([*args, "--concurrent-tables", "2"]) == 0
    parts = {c["dbtable"]: c.get("partitioning") for c in calls}
    assert parts["dbo.a"] is None and parts["dbo.b"] == Partitioning("id", 1, 900, 3)
    calls.clear()
    assert jobs.main(["ingest", "--url", "jdbc:x", "--target", tmp_out, "--tables", "dbo.a"]) == 0
    assert [c["dbtable"] for c in calls] == ["dbo.a"]


def test_sqlserver_url():
    from basketry.sources.jdbc import sqlserver_url

    assert sqlserver_url("h", "db") == "jdbc:sqlserver://h:1433;databaseName=db;encrypt=true;trustServerCertificate=true;"
    url = sqlserver_url("h", "db", 1500, encrypt=False, trust_server_certificate=False, loginTimeout="5")
    assert url == "jdbc:sqlserver://h:1500;databaseName=db;encrypt=false;trustServerCertificate=false;loginTimeout=5;"
