"""Ranks, terciles and exact quantiles from counts per value.

A window over a handful of groups (or none) sends all rows of a group to one
task. Nothing here needs a position per row: the rows of a group are counted
per distinct value first (a hash aggregate that combines map-side, so a value
held by a third of the rows is one row afterwards), the values are
range-partitioned once, and each value learns how many rows come before it
from a running sum inside its range plus the totals of the earlier ranges.
A rank is that number plus one; a quantile and a tercile boundary are the
values that hold given positions. The same plan runs at every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import materialize, materialize_parts, scratch_path


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL; the keys of ``left`` stay. Without keys ``right`` is one row."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys], F.lit(True))
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def value_counts(df: DataFrame, group_cols: Sequence[str], value: Column | str) -> DataFrame:
    """(groups, ``value``, ``n``): rows per distinct value of each group; NULL is a value."""
    return df.select(*group_cols, _as_col(value).alias("value")).groupBy(*group_cols, "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def running_counts(counts: DataFrame, group_cols: Sequence[str], descending: bool = False) -> DataFrame:
    """``counts`` (one row per group and ``value``, with ``n``) plus ``before``.

    ``before`` is the number of rows of the group whose value comes earlier:
    larger with NULL last when ``descending``, smaller with NULL first
    otherwise. The values are dealt into ranges once; the running sum inside a
    range is local, and the only thing combined per group is one row per
    range.
    """
    groups = list(group_cols)
    order = F.col("value").desc_nulls_last() if descending else F.col("value").asc_nulls_first()
    placed = counts.repartitionByRange(*[F.col(g).asc_nulls_first() for g in groups], order)
    placed = materialize(placed.withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range", *groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_local", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    sums = placed.groupBy("_range", *groups).agg(F.sum("n").alias("_n"))
    # one row per group and range: its size is bounded by ranges plus groups
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    if not groups:
        earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_range", *groups, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return null_safe_join(local, offsets, ["_range", *groups]).withColumn(
        "before", F.col("_local") + F.col("_offset")
    ).drop("_range", "_local", "_offset")


def rank_within_groups(
    df: DataFrame,
    group_cols: Sequence[str],
    value: Column | str,
    name: str,
    descending: bool = True,
) -> DataFrame:
    """SQL ``rank()`` of ``value`` within ``group_cols`` (ties share a rank).

    NULL values rank last when descending, first otherwise.
    """
    return rank_within_many(df, {name: list(group_cols)}, value, descending)


def rank_within_many(
    df: DataFrame, groupings: dict[str, list[str]], value: Column | str, descending: bool = True
) -> DataFrame:
    """Several ranks of one value at once: ``groupings`` maps each new column to its group columns.

    All groupings share one frame of counts and one range partitioning; their
    group columns, in the order given, must have comparable types.
    """
    width = max(len(g) for g in groupings.values())
    keyed = df.withColumn("_value", _as_col(value))

    def keys(cols: Sequence[str]) -> list[Column]:
        return [F.col(c) for c in cols] + [F.lit(None)] * (width - len(cols))

    # one row per value and combination of group columns before the groupings are unfolded
    every = list(dict.fromkeys(c for g in groupings.values() for c in g))
    combined = keyed.groupBy(*every, "_value").agg(F.count(F.lit(1)).alias("n"))
    unfolded = combined.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("_kind"), *[k.alias(f"_g{j}") for j, k in enumerate(keys(cols))])
                    for i, cols in enumerate(groupings.values())
                ]
            )
        ).alias("_key"),
        F.col("_value").alias("value"),
        "n",
    ).select("_key.*", "value", "n")
    fields = ["_kind", *[f"_g{j}" for j in range(width)]]
    counts = unfolded.groupBy(*fields, "value").agg(F.sum("n").alias("n"))
    ranks = materialize(running_counts(counts, fields, descending).select(*fields, "value", (F.col("before") + 1).cast("int").alias("_rank")))
    out = keyed
    for i, (name, cols) in enumerate(groupings.items()):
        own = ranks.where(F.col("_kind") == i).select(
            *[F.col(f"_g{j}").alias(c) for j, c in enumerate(cols)], F.col("value").alias("_value"), F.col("_rank").alias(name)
        )
        out = null_safe_join(out, own, [*cols, "_value"])
    return out.drop("_value")


def rank_within_few(
    df: DataFrame, groupings: dict[str, list[str]], value: Column | str, descending: bool = True
) -> DataFrame:
    """:func:`rank_within_many` for group columns with few combinations, such as parts of a date.

    One frame holds a row per value and combination, whatever the number of
    groupings. It is dealt into ranges by value alone, so a value's rows, at
    most one per combination, share a range; each grouping counts inside the
    range and adds its totals of the earlier ranges. The rows then learn all
    ranks from one join.
    """
    every = list(dict.fromkeys(c for g in groupings.values() for c in g))
    keyed = df.withColumn("_value", _as_col(value))
    order = F.col("_value").desc_nulls_last() if descending else F.col("_value").asc_nulls_first()
    combined = keyed.groupBy(*every, "_value").agg(F.count(F.lit(1)).alias("_n"))
    placed = combined.repartitionByRange(order).withColumn("_range", F.spark_partition_id())
    placed = materialize_parts(df.sparkSession, [placed], scratch_path(df.sparkSession, "rank-counts"))
    # every window below is satisfied by this one shuffle
    ranks = placed.repartition("_range")
    for name, cols in groupings.items():
        upto = Window.partitionBy("_range", *cols).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        equal = Window.partitionBy("_range", *cols, "_value")
        ranks = ranks.withColumn(name, F.sum("_n").over(upto) - F.sum("_n").over(equal))
    for name, cols in groupings.items():
        # one row per group and range
        totals = placed.groupBy("_range", *cols).agg(F.sum("_n").alias("_total"))
        earlier = Window.partitionBy(*cols or [F.lit(0)]).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select("_range", *cols, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
        ranks = null_safe_join(ranks, offsets, ["_range", *cols])
        ranks = ranks.withColumn(name, (F.col(name) + F.col("_offset") + 1).cast("int")).drop("_offset")
    return null_safe_join(keyed, ranks.drop("_range", "_n"), [*every, "_value"]).drop("_value")


def tercile_scores(
    df: DataFrame,
    value: Column | str,
    tie_breaker: str,
    name: str,
    default: int,
    labels: Sequence[int] | None = None,
) -> DataFrame:
    """Tercile code 0/1/2 of ``value`` by rank (see :func:`tercile_scores_many`)."""
    return tercile_scores_many(df, [(value, name, default, labels)], tie_breaker)


def tercile_scores_many(
    df: DataFrame,
    specs: Sequence[tuple[Column | str, str, int, Sequence[int] | None]],
    tie_breaker: str,
) -> DataFrame:
    """Tercile scores of several numeric measures: ``specs`` are (value, new column, default, labels).

    Rows are ordered by value, then by ``tie_breaker``, which must be unique
    among equal values; of n rows, position k scores 0 if 3k < n-1, 1 if 3k <
    2(n-1), else 2. (Not ``ntile(3)``, which puts the remainder in the first
    buckets.) ``labels`` (three values) replaces 0/1/2. NULL values, and every
    row of a measure with at most one distinct value, get the default.

    Only the two rows at each measure's boundaries are looked up; scoring is a
    comparison with them, without a join.
    """
    for _, _, _, labels in specs:
        if labels is not None and len(labels) != 3:
            raise ValueError("labels needs three values")
    measures = [_as_col(v).cast("double") for v, _, _, _ in specs]
    long = df.select(
        F.col(tie_breaker).alias("_tie"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("m"), c.alias("value")) for i, c in enumerate(measures)])).alias("_x"),
    ).select("_tie", "_x.*").where("value is not null")
    counts = running_counts(value_counts(long, ["m"], "value"), ["m"])
    totals = counts.groupBy("m").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    # first position of code 1 and of code 2: the smallest k with 3k >= n-1, and with 3k >= 2(n-1)
    edges = totals.where("kinds > 1").select(
        "m", F.explode(F.array(*[F.struct(F.lit(w).alias("w"), F.expr(f"({w} * (total - 1) + 2) div 3").alias("k")) for w in (1, 2)])).alias("e")
    ).select("m", "e.*")
    # at most two rows per measure
    found = (
        counts.join(edges, "m").where("before <= k and k < before + n")
        .select("m", "w", "value", (F.col("k") - F.col("before")).alias("skip")).collect()
    )
    ties = {}
    inside = [(r.m, r.w, r.value, r.skip) for r in found if r.skip > 0]
    if inside:
        # the boundary falls among equal values: the tie-breaker at that place, by the same running count
        wanted = reduce(lambda a, b: a | b, [(F.col("m") == m) & F.col("value").eqNullSafe(F.lit(v)) for m, _, v, _ in inside])
        tied = long.where(wanted).withColumnRenamed("value", "at")
        placed = running_counts(value_counts(tied, ["m", "at"], "_tie"), ["m", "at"])
        pick = reduce(
            lambda a, b: a | b,
            [(F.col("m") == m) & F.col("at").eqNullSafe(F.lit(v)) & (F.col("before") == k) for m, _, v, k in inside],
        )
        at = {(r.m, r.at, r.before): r.value for r in placed.where(pick).collect()}
        ties = {(m, w): at[m, v, k] for m, w, v, k in inside}
    bounds = {(r.m, r.w): r.value for r in found}
    out = {}
    for i, (_, name, default, labels) in enumerate(specs):
        codes = [0, 1, 2] if labels is None else [int(x) for x in labels]
        if (i, 1) not in bounds:
            out[name] = F.lit(default)
            continue

        def below(w: int, i: int = i) -> Column:
            c, edge = measures[i], F.lit(bounds[i, w])
            if (i, w) not in ties:
                return c < edge
            tied = F.coalesce(F.col(tie_breaker) < F.lit(ties[i, w]), F.lit(True))  # a NULL tie-breaker comes first
            return (c < edge) | ((c == edge) & tied)

        out[name] = (
            F.when(measures[i].isNull(), F.lit(default))
            .when(below(1), F.lit(codes[0]))
            .when(below(2), F.lit(codes[1]))
            .otherwise(F.lit(codes[2]))
        )
    return df.withColumns(out)


def quantiles_of_counts(placed: DataFrame, group_cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles from :func:`running_counts`; see :func:`grouped_quantiles`."""
    groups = list(group_cols)
    totals = placed.groupBy(*groups).agg(F.sum("n").alias("_total"))
    joined = null_safe_join(placed, totals, groups).where(F.col("_total") > 0)
    picks = []
    for i, p in enumerate(probs):
        h = (F.col("_total") - 1).cast("double") * F.lit(float(p))
        lo = F.floor(h).cast("bigint")
        hi = F.least(lo + 1, F.col("_total") - 1)
        held = lambda k: (F.col("before") <= k) & (k < F.col("before") + F.col("n"))
        picks += [
            F.max(F.when(held(lo), F.col("value"))).alias(f"_lo{i}"),
            F.max(F.when(held(hi), F.col("value"))).alias(f"_hi{i}"),
            F.max(h - lo).alias(f"_f{i}"),
        ]
    found = joined.groupBy(*groups).agg(F.max("_total").alias("n"), *picks)
    cols = [(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"q_{i}") for i in range(len(probs))]
    return found.where("n is not null").select(*groups, "n", *cols)


def grouped_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value: Column | str,
    probs: Sequence[float],
) -> DataFrame:
    """Linear-interpolated quantiles of ``value`` per group, NULLs ignored.

    One row per group that has a value, with columns ``q_<i>`` for each prob,
    and ``n`` (non-NULL count); an empty input gives no rows.
    """
    base = df.select(*group_cols, _as_col(value).cast("double").alias("_q")).where(F.col("_q").isNotNull())
    return quantiles_of_counts(running_counts(value_counts(base, group_cols, "_q"), group_cols), group_cols, probs)
