"""Column profiling and cleaning reports (the exploratory notebooks, in Spark).

Missing means NULL or NaN everywhere here, as in the notebooks.

A source is scanned once per report: its columns are unpivoted to narrow
(column, value) rows and counted per value, which combines map-side; distinct
counts, quartiles, outliers and histograms follow from those counts. Results
have one row per column (or per column and bin) and stay small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.columns import duplicate_column_names, split_numeric_text
from basketry.operators.dedupe import dedupe_accounting, key_violation_rows
from basketry.operators.dedupe import duplicate_rows as dedupe_rows_report
from basketry.operators.dedupe import key_violations as key_violation_report
from basketry.operators.metrics import histogram_bins
from basketry.operators.ranking import null_safe_join, quantiles_of_counts, running_counts, value_counts
from basketry.session import materialize

IQR_FACTOR = 1.5


def missing_as_null(df: DataFrame) -> DataFrame:
    """``df`` with NaN as NULL in its float and double columns."""
    nan_types = ("float", "double")
    return df.select(
        *[
            F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if t in nan_types else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )


def _missing(df: DataFrame, column: str) -> Column:
    c = F.col(f"`{column}`")
    return c.isNull() | F.isnan(c) if dict(df.dtypes)[column] in ("float", "double") else c.isNull()


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns, and the column names."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.array(*[F.lit(c) for c in df.columns]).alias("column_names"),
    )


def column_profile(df: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """One row per column: position, type, numeric?, non-NULL, NULL and distinct counts.

    The columns become narrow (position, value as text) rows, counted per
    value, so nothing is shuffled at full width. ``approx=True`` uses
    HyperLogLog (``approx_count_distinct``) on the same rows, which then need
    no shuffle by value at all.
    """
    fields = df.schema.fields
    numeric, _ = split_numeric_text(df)
    clean = missing_as_null(df)
    # adding zero turns -0.0 into 0.0: equal numbers must have equal text
    texts = [
        (F.col(f"`{c}`") + F.lit(0).cast(t) if t in ("float", "double") else F.col(f"`{c}`")).cast("string").alias(str(i))
        for i, (c, t) in enumerate(clean.dtypes)
    ]
    long = clean.select(*texts).unpivot([], [str(i) for i in range(len(fields))], "position", "value")
    long = long.withColumn("position", F.col("position").cast("int"))
    if approx:
        counts = long.groupBy("position").agg(
            F.count("value").alias("non_null"),
            F.count_if(F.col("value").isNull()).alias("nulls"),
            F.approx_count_distinct("value", rsd).alias("distinct_values"),
        )
    else:
        counts = value_counts(long, ["position"], "value").groupBy("position").agg(
            F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
        )
    about = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.name in numeric) for i, f in enumerate(fields)],
        "position int, column_name string, data_type string, is_numeric boolean",
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return about.join(counts, "position", "left").select(
        *about.columns, zero("non_null"), zero("nulls"), zero("distinct_values")
    )


def missing_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a missing cell in any of ``columns``."""
    return df.where(reduce(lambda a, b: a | b, [_missing(df, c) for c in columns]))


def null_summary(df: DataFrame) -> DataFrame:
    """One row: rows and whether any cell of the frame is missing."""
    any_null = reduce(lambda a, b: a | b, [_missing(df, c) for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.max(any_null), F.lit(False)).alias("any_null"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(``column_name``, ``nulls``): missing cells per column, one aggregate."""
    wide = df.agg(*[F.count_if(_missing(df, c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("nulls")) for i, c in enumerate(df.columns)]
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def numeric_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns unpivoted to (``column_name``, ``value`` double); missing values as NULL."""
    cols = list(columns) if columns is not None else split_numeric_text(df)[0]
    if not cols:
        raise ValueError("no numeric columns")
    casted = missing_as_null(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]))
    return casted.unpivot([], cols, "column_name", "value")


def iqr_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    factor: float = IQR_FACTOR,
) -> DataFrame:
    """Per numeric column: Q1, Q3, IQR, fences and the count of values strictly
    outside ``[Q1 - factor*IQR, Q3 + factor*IQR]``; missing values are never outliers."""
    return _iqr_from_long(numeric_long(df, columns), ["column_name"], factor)


def iqr_outliers_by_table(frames: Mapping[str, DataFrame], factor: float = IQR_FACTOR) -> DataFrame:
    """:func:`iqr_outliers` for several sources at once (``table_name`` column).

    The numeric columns of all sources are stacked into one long frame, so
    the quantiles and outlier counts are one grouped computation instead of
    one per source.
    """
    parts = [
        numeric_long(df).select(F.lit(name).alias("table_name"), "column_name", "value")
        for name, df in frames.items()
    ]
    long = reduce(lambda a, b: a.unionAll(b), parts)
    return _iqr_from_long(long, ["table_name", "column_name"], factor)


def _iqr_from_long(long: DataFrame, keys: list[str], factor: float) -> DataFrame:
    counts = materialize(value_counts(long, keys, "value"))  # the only read of the sources
    placed = running_counts(counts.where(F.col("value").isNotNull()), keys)
    q1, q3 = F.col("q_0"), F.col("q_1")
    stats = quantiles_of_counts(placed, keys, [0.25, 0.75]).select(
        *keys,
        q1.alias("q1"),
        q3.alias("q3"),
        (q3 - q1).alias("iqr"),
        (q1 - factor * (q3 - q1)).alias("lower_fence"),
        (q3 + factor * (q3 - q1)).alias("upper_fence"),
    )
    outside = (F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))
    found = null_safe_join(counts, stats, keys, "left")
    measures = ["q1", "q3", "iqr", "lower_fence", "upper_fence"]
    return found.groupBy(*keys).agg(
        *[F.max(m).alias(m) for m in measures],
        F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outliers"),
    )


def histogram(df: DataFrame, bins: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Equal-width histogram per numeric column over its [min, max].

    One row per (column, bin) including empty bins; the last bin is closed;
    a constant column gets the range min-0.5 .. max+0.5.
    """
    if bins < 1:
        raise ValueError("bins must be >= 1")
    values = materialize(value_counts(numeric_long(df, columns).where(F.col("value").isNotNull()), ["column_name"], "value"))
    rng = values.groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    idx, start, width = histogram_bins(F.col("value"), F.col("lo"), F.col("hi"), bins)
    counts = values.join(rng, "column_name").groupBy("column_name", idx.alias("bin")).agg(F.sum("n").alias("count"))
    domain = rng.select(
        "column_name", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    _, d_start, d_width = histogram_bins(F.lit(0.0), F.col("lo"), F.col("hi"), bins)
    return domain.join(counts, ["column_name", "bin"], "left").select(
        "column_name",
        "bin",
        (d_start + d_width * F.col("bin") / bins).alias("bin_start"),
        (d_start + d_width * (F.col("bin") + 1) / bins).alias("bin_end"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def dropna_accounting(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a missing cell in ``subset``; one row with rows before /
    after / removed and whether the cleaned frame still has any missing cell.

    One aggregate pass: the cleaned rows are those where ``subset`` is set.
    """
    drop = reduce(lambda a, b: a | b, [_missing(df, c) for c in subset])
    any_null = reduce(lambda a, b: a | b, [_missing(df, c) for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~drop).alias("rows_after"),
        F.count_if(drop).alias("rows_removed"),
        F.coalesce(F.max(~drop & any_null), F.lit(False)).alias("any_null_after"),
    )


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows without a missing cell in ``subset``."""
    return df.where(~reduce(lambda a, b: a | b, [_missing(df, c) for c in subset]))


def distinct_accounting(df: DataFrame) -> DataFrame:
    """Rows before / after / removed by dropping fully equal rows."""
    return dedupe_accounting(df, df.distinct())


def has_duplicate_columns(df: DataFrame) -> bool:
    """Metadata only: does any column name occur twice?"""
    return bool(duplicate_column_names(df))


def profile_report(
    df: DataFrame,
    key: Sequence[str] | None = None,
    bins: int = 10,
    missing_columns: Sequence[str] | None = None,
    approx: bool = False,
) -> dict[str, DataFrame]:
    """The exploratory profile of one source as lazy DataFrames.

    ``shape``, ``columns`` (types, NULLs, distincts), ``duplicate_rows``,
    ``key_violations`` and ``key_violation_rows`` (if ``key``), ``missing_rows`` (if ``missing_columns``),
    ``iqr_outliers`` and ``histogram`` (if the frame has numeric columns).
    Column-name duplicates are metadata and checked eagerly (raises).
    """
    if has_duplicate_columns(df):
        raise ValueError(f"duplicate column names: {duplicate_column_names(df)}")
    report = {
        "shape": shape(df),
        "columns": column_profile(df, approx=approx),
        "duplicate_rows": dedupe_rows_report(df),
    }
    if key:
        report["key_violations"] = key_violation_report(df, key)
        report["key_violation_rows"] = key_violation_rows(df, key)
    if missing_columns:
        report["missing_rows"] = missing_rows(df, missing_columns)
    if split_numeric_text(df)[0]:
        report["iqr_outliers"] = iqr_outliers(df)
        report["histogram"] = histogram(df, bins)
    return report


def clean_report(
    df: DataFrame, null_key: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean a source the way the notebooks did and account for it.

    With ``null_key`` rows with a missing key are dropped (order lines);
    without it fully equal rows are dropped (options). Returns (cleaned,
    accounting, missing cells per column of the cleaned frame).
    """
    if null_key:
        cleaned = drop_missing(df, null_key)
        return cleaned, dropna_accounting(df, null_key), null_counts(cleaned)
    cleaned = df.distinct()
    return cleaned, distinct_accounting(df), null_counts(cleaned)
