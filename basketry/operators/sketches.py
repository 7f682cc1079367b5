"""Column profiles as stored, mergeable sketches.

A load is read once: counts, a HyperLogLog sketch of the distinct values and,
for numeric columns, a KLL sketch of the quantiles, one row per column. Later
reports merge those rows; older loads are never read again. Sketches are small
and combine map-side, so no value is shuffled, however many there are.

The exact reports of :mod:`basketry.operators.profile` stay the default; what
is read from sketches carries the bounds of :func:`distinct_error` and
:func:`rank_error`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.columns import split_numeric_text
from basketry.operators.profile import IQR_FACTOR, missing_as_null

HLL_BITS = 14  # registers as a power of two: 16 kB a column at most
KLL_SIZE = 800
SKETCH_SCHEMA = "column_name string, position int, data_type string, rows long, missing long, distinct_sketch binary, quantile_sketch binary"


def distinct_error(bits: int = HLL_BITS) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (bits / 2)


def rank_error(size: int = KLL_SIZE) -> float:
    """Bound on the error of a rank, as a share of the rows (99 % confidence)."""
    return 2.296 / size**0.9021


def sketch_columns(df: DataFrame, bits: int = HLL_BITS, size: int = KLL_SIZE) -> DataFrame:
    """One row per column (``SKETCH_SCHEMA``): rows, missing cells and sketches; NULL and NaN are missing.

    One aggregate over one read of ``df``. Values are sketched as text, with
    -0.0 as 0.0, so equal numbers are one value; text columns have no quantile
    sketch, nor have columns without a value.
    """
    numeric, _ = split_numeric_text(df)
    clean = missing_as_null(df)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, (c, t) in enumerate(clean.dtypes):
        value = F.col(f"`{c}`")
        text = (value + F.lit(0).cast(t) if t in ("float", "double") else value).cast("string")
        aggs += [F.count(value).alias(f"n{i}"), F.hll_sketch_agg(text, bits).alias(f"h{i}")]
        if c in numeric:
            aggs.append(F.kll_sketch_agg_double(value.cast("double"), size).alias(f"k{i}"))
    row = df.agg(F.count(F.lit(1))) if not df.columns else clean.agg(*aggs)
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i).alias("position"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("rows"),
            (F.col("rows") - F.col(f"n{i}")).alias("missing"),
            F.col(f"h{i}").alias("distinct_sketch"),
            (F.when(F.col(f"n{i}") > 0, F.col(f"k{i}")) if f.name in numeric else F.lit(None).cast("binary")).alias("quantile_sketch"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def store_sketches(df: DataFrame, folder: str, source: str, load: str, bits: int = HLL_BITS, size: int = KLL_SIZE) -> None:
    """Sketch one load of ``source`` and store it; storing a load again replaces its rows."""
    rows = sketch_columns(df, bits, size).withColumns({"source": F.lit(source), "load": F.lit(load)}).coalesce(1)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "load").parquet(folder)


def stored_sketches(spark: SparkSession, folder: str, source: str | None = None) -> DataFrame:
    rows = spark.read.schema(SKETCH_SCHEMA + ", source string, load string").parquet(folder)
    return rows if source is None else rows.where(F.col("source") == source)


def merge_sketches(rows: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    """Sketch rows of several loads as one row per column of ``by``.

    A column's position and type are those of its last load by position; loads
    that lack a column add neither rows nor missing cells to it.
    """
    return rows.groupBy(*by, "column_name").agg(
        F.max("position").alias("position"),
        F.max("data_type").alias("data_type"),
        F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.when(F.count("quantile_sketch") > 0, F.kll_merge_agg_double("quantile_sketch")).alias("quantile_sketch"),
    )


def sketch_profile(merged: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75), factor: float = IQR_FACTOR) -> DataFrame:
    """Reports read from sketch rows: distinct values, quantiles ``q_<i>`` and, with three of them, the IQR fences."""
    has = F.col("rows") > F.col("missing")
    quantile = lambda p: F.when(F.col("quantile_sketch").isNotNull() & has, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(p)))
    keys = [c for c in merged.columns if not c.endswith("_sketch")]
    out = merged.select(
        *keys,
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
        *[quantile(float(p)).alias(f"q_{i}") for i, p in enumerate(probs)],
    )
    if len(probs) != 3:
        return out
    spread = F.col("q_2") - F.col("q_0")
    return out.withColumns({"lower_fence": F.col("q_0") - factor * spread, "upper_fence": F.col("q_2") + factor * spread})


def rank_of(merged: DataFrame, column: str, values: Sequence[float]) -> DataFrame:
    """(value, rank): share of the rows of ``column`` at or below each value, from its sketch."""
    one = merged.where((F.col("column_name") == column) & F.col("quantile_sketch").isNotNull())
    # the functions take literals: one expression per value
    ranks = [F.struct(F.lit(float(v)).alias("value"), F.kll_sketch_get_rank_double("quantile_sketch", F.lit(float(v))).alias("rank")) for v in values]
    return one.select(F.explode(F.array(*ranks)).alias("r")).select("r.*")
