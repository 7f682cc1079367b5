"""Balanced ranges of a parallel read; the pushed-down queries run on Spark views in place of a database."""

import pytest

from basketry.sources import ingest_all, jdbc


@pytest.fixture()
def database(spark, monkeypatch):
    """Substitutes the reader: no connection is made."""
    calls = []

    def read_table(spark_, **kw):
        jdbc.jdbc_options(**kw)
        calls.append(kw["dbtable"])
        return spark_.sql(f"SELECT * FROM {kw['dbtable']}")

    def read_ranges(spark_, predicates, **kw):
        jdbc.jdbc_options(**kw)
        calls.append((kw["dbtable"], list(predicates)))
        parts = [spark_.sql(f"SELECT * FROM {kw['dbtable']} WHERE {p}") for p in predicates]
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        return out

    monkeypatch.setattr(jdbc, "read_table", read_table)
    monkeypatch.setattr(jdbc, "read_ranges", read_ranges)
    return calls


def view(spark, name, rows, ddl):
    spark.createDataFrame(rows, ddl).createOrReplaceTempView(name)


def sizes(spark, table, predicates):
    return [spark.sql(f"SELECT 1 FROM {table} WHERE {p}").count() for p in predicates]


def check(spark, table, predicates):
    """Every row in exactly one range; the sizes."""
    n = spark.table(table).count()
    got = sizes(spark, table, predicates)
    hits = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in predicates)
    assert spark.sql(f"SELECT 1 FROM {table} WHERE ({hits}) = 1").count() == n == sum(got)
    return [s for s in got if s]


def test_gaps_in_the_key(spark, database):
    ids = [i for i in range(900)] + [10**9 + i * 10**6 for i in range(100)]
    view(spark, "gaps", [(i,) for i in ids] + [(None,)] * 3, "id long")
    predicates = jdbc.balanced_ranges(spark, "jdbc:x", "gaps", "id", 10)
    got = sorted(check(spark, "gaps", predicates))
    assert got[0] == 3 and got[1:] == [100] * 10  # ranges of equal width would put 900 into one
    assert len(database) == 1 and "NTILE(10)" in database[0]


def test_skewed_repeats_differ_by_under_two(spark, database):
    rows = [(min(i, 5000 // (i + 1)),) for i in range(2000)]
    view(spark, "zipf", rows, "id long")
    got = check(spark, "zipf", jdbc.balanced_ranges(spark, "jdbc:x", "zipf", "id", 8))
    heaviest = max(r["n"] for r in spark.sql("SELECT count(*) AS n FROM zipf GROUP BY id").collect())
    assert max(got) <= max(heaviest, 2 * 2000 / 8)


@pytest.mark.parametrize("where", ["first", "middle", "last"])
def test_a_hot_value_is_cut_by_the_next_key_column(spark, database, where):
    hot = {"first": -1, "middle": 300, "last": 10**6}[where]
    rows = [(i, 0) for i in range(600) if i != hot] + [(hot, j) for j in range(1200)]
    view(spark, "hot", rows, "id long, line int")
    one = check(spark, "hot", jdbc.balanced_ranges(spark, "jdbc:x", "hot", "id", 12))
    assert max(one) == 1200  # one column cannot cut it
    two = check(spark, "hot", jdbc.balanced_ranges(spark, "jdbc:x", "hot", ["id", "line"], 12))
    assert max(two) <= 2 * len(rows) / 12


def test_text_dates_and_empty_tables(spark, database):
    view(spark, "names", [(f"o'{i:03d}",) for i in range(200)], "id string")
    assert max(check(spark, "names", jdbc.balanced_ranges(spark, "jdbc:x", "names", "id", 4).copy())) == 50
    view(spark, "empty", [], "id long")
    assert check(spark, "empty", jdbc.balanced_ranges(spark, "jdbc:x", "empty", "id", 4)) == []
    spark.sql("SELECT date_add(DATE'2024-01-01', CAST(id AS int)) AS d FROM range(100)").createOrReplaceTempView("days")
    assert check(spark, "days", jdbc.balanced_ranges(spark, "jdbc:x", "days", "d", 5)) == [20] * 5


def test_rows_that_arrive_later_are_read(spark, database):
    view(spark, "grows", [(i,) for i in range(100, 200)], "id long")
    predicates = jdbc.balanced_ranges(spark, "jdbc:x", "grows", "id", 4)
    view(spark, "grows", [(i,) for i in range(0, 300)] + [(None,)], "id long")
    check(spark, "grows", predicates)


def test_ingest_finds_keys_in_the_catalog(spark, database, tmp_path):
    view(spark, "t_a", [(i, i % 3) for i in range(90)], "id long, line int")
    view(spark, "t_b", [(1,), (2,)], "x int")
    view(spark, "keys_view", [("dbo", "a", "line", 2), ("dbo", "a", "id", 1)], "s string, t string, c string, p int")
    assert jdbc.key_columns(spark, "jdbc:x", "keys_view") == {"dbo.a": ["id", "line"]}
    database.clear()
    view(spark, "keys_view", [("main", "x", "id", 1)], "s string, t string, c string, p int")
    status = ingest_all(
        spark, "jdbc:x", str(tmp_path), tables=["t_a", "t_b"], partition_columns={"t_a": "id"}, num_partitions=3,
        balanced=True, key_query="keys_view", count_rows=True,
    )
    assert {(r.table_name, r.rows, r.status) for r in status.collect()} == {("t_a", 90, "ok"), ("t_b", 2, "ok")}
    ranges = [c for c in database if isinstance(c, tuple)]
    assert len(ranges) == 1 and ranges[0][0] == "t_a" and len(ranges[0][1]) == 4  # three ranges and the NULL one
    assert "t_b" in database
