"""Incremental Gold equals the full rebuild; only changed partitions are rewritten."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from basketry.operators import gold, incremental
from basketry.plans import partitions
from basketry.session import materialize

LINES = "user_id string, creation_date date, order_id string, total_item_revenue double, is_loyalty boolean"
START = date(2024, 1, 1)


def lines(seed, n=900, users=25, days=200):
    """Order lines; one hot user, gaps longer than the windows, rows without a date or revenue."""
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        u = "hot" if r.random() < 0.3 else f"u{r.randrange(users)}"
        d = START + timedelta(r.choice([r.randrange(days), r.randrange(10), days - 1 - r.randrange(10)]))
        rows.append((u, d if r.random() > 0.03 else None, f"{u}-{r.randrange(n)}", r.choice([None, r.uniform(-5, 99)]), r.choice([True, False, None])))
    return rows


def key(df):
    names = sorted(df.columns)
    return sorted(map(str, df.select(*names).collect()))


def full(df):
    return gold.fact_customer(df)


def day_of(rows, days):
    return [r for r in rows if r[1] in days]


@pytest.mark.parametrize("cuts", [(60, 61, 150), (10, 100, 199), (120,)])
def test_new_days_equal_the_full_rebuild(spark, cuts):
    rows = lines(1)
    ends = [START + timedelta(c) for c in cuts] + [START + timedelta(400)]
    known = [r for r in rows if r[1] is None or r[1] <= ends[0]]
    fact = materialize(full(spark.createDataFrame(known, LINES).coalesce(1)))
    state, through = incremental.carry_state(fact, ends[0]), ends[0]
    for end in ends[1:]:
        new = [r for r in rows if r[1] is not None and through < r[1] <= end]
        if not new:
            continue
        daily = gold.customer_daily(spark.createDataFrame(new, LINES).coalesce(1))
        days = spark.createDataFrame([(d,) for d in sorted({r[1] for r in new})], "creation_date date")
        update = incremental.update_fact_customer(fact, state, through, daily, days)
        assert update.users is None
        fact, state, through = materialize(update.apply(fact)), materialize(update.state), update.through
        known += new
        assert key(fact) == key(full(spark.createDataFrame(known, LINES).coalesce(1)))
        want = incremental.carry_state(fact, through)
        assert key(state) == key(want)


def test_the_history_is_not_read_for_new_days(spark, tmp_path):
    full(spark.createDataFrame(lines(2), LINES)).write.parquet(f"{tmp_path}/fact")
    fact = spark.read.parquet(f"{tmp_path}/fact")
    through = START + timedelta(300)
    state = materialize(incremental.carry_state(fact, through))
    new = [("u1", through + timedelta(1), "o", 5.0, True), ("fresh", through + timedelta(2), "p", 6.0, None)]
    days = spark.createDataFrame([(r[1],) for r in new], "creation_date date")
    update = incremental.update_fact_customer(fact, state, through, gold.customer_daily(spark.createDataFrame(new, LINES)), days)
    for part in (update.rows, update.state):
        assert f"{tmp_path}/fact" not in part._jdf.queryExecution().executedPlan().toString()
    assert {r.user_id for r in update.rows.collect()} == {"u1", "fresh"}


def test_late_changed_and_vanished_days(spark):
    rows = lines(3)
    through = START + timedelta(150)
    known = [r for r in rows if r[1] is None or r[1] <= through]
    fact = materialize(full(spark.createDataFrame(known, LINES).coalesce(1)))
    state = incremental.carry_state(fact, through)
    dated = sorted({r[1] for r in known if r[1]})
    late, vanished, corrected = dated[3], dated[10], dated[40]
    ahead = through + timedelta(7)
    now = [r for r in known if r[1] not in (vanished, corrected)]
    now += [("u3", late, "late", 12.5, True), ("never seen", late, "late2", 1.0, False), ("u4", None, "undated", 3.0, None), ("u5", ahead, "new", 2.0, True), ("u3", ahead, "new2", 2.5, True)]
    now += [(r[0], r[1], r[2], (r[3] or 0) + 1, r[4]) for r in known if r[1] == corrected]
    touched = [late, vanished, corrected, ahead, None]
    daily = gold.customer_daily(spark.createDataFrame(day_of(now, touched), LINES).coalesce(1))
    days = spark.createDataFrame([(d,) for d in touched], "creation_date date")
    update = incremental.update_fact_customer(fact, state, through, daily, days)
    after = materialize(update.apply(fact))
    assert key(after) == key(full(spark.createDataFrame(now, LINES).coalesce(1)))
    assert update.through == ahead and key(update.state) == key(incremental.carry_state(after, ahead))


def files(folder):
    return {f"{os.path.relpath(d, folder)}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def test_only_changed_partitions_are_rewritten(spark, tmp_path):
    target, digests = f"{tmp_path}/gold", f"{tmp_path}/digests"
    base = [("2024", "a", 1.0), ("2024", "b", 2.0), ("2023", "a", 3.0), ("2022", "c", None), (None, "d", 4.0), ("x=/y", "e", 5.0)]

    def build(df):
        return df.where("v is null or v >= 0").groupBy("year", "k").agg(F.sum("v").alias("total"))

    def run(rows):
        df = spark.createDataFrame(rows, "year string, k string, v double").repartition(3)
        done = partitions.rebuild_partitions(df, target, ["year"], build, digests)
        back = spark.read.schema("k string, total double, year string").parquet(target)
        assert key(back) == key(build(df))
        return done

    first = run(base)
    assert len(first.new) == 5 and not first.changed and not first.vanished
    before = files(target)
    assert run(list(reversed(base))) == partitions.Rebuilt([], [], []) and files(target) == before  # order does not matter
    second = run([*base[:2], ("2023", "a", 3.5), base[3], base[4], base[5], ("2025", "z", 1.0)])
    assert second == partitions.Rebuilt([("2025",)], [("2023",)], [])
    after = files(target)
    assert {f: t for f, t in after.items() if "2023" not in f and "2025" not in f} == {f: t for f, t in before.items() if "2023" not in f}
    third = run([*base[:2], ("2023", "a", -1.0), ("2022", None, None), ("2025", "z", 1.0)])
    assert third.changed == [("2022",), ("2023",)] and sorted(third.vanished, key=str) == [("x=/y",), (None,)] or third.vanished == [(None,), ("x=/y",)]
    assert not any("2023" in f or "HIVE_DEFAULT" in f or "x%3D" in f for f in files(target))
    assert run([])  == partitions.Rebuilt([], [], [("2022",), ("2023",), ("2024",), ("2025",)])
