"""Layer validation reports: row counts, previews, value checks, slices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.profile import missing_as_null


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(``table_name``, ``rows``) for each named frame: one union, one aggregate."""
    parts = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionAll(p)
    return union.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` they are deterministic (top-n)."""
    if order_by:
        return df.orderBy(*order_by).limit(n)
    return df.limit(n)


def count_below(df: DataFrame, column: str, threshold: float = 0.0, alias: str = "negative_rows") -> DataFrame:
    """Rows with ``column < threshold`` (e.g. negative prices)."""
    return df.agg(F.count_if(F.col(column) < threshold).alias(alias))


def text_shape(df: DataFrame, column: str, markers: Sequence[str] = ("T", "Z")) -> DataFrame:
    """Total rows and, per marker, rows containing / missing it."""
    c = F.col(column)
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for m in markers:
        aggs.append(F.count_if(F.coalesce(c.contains(m), F.lit(False))).alias(f"rows_with_{m.lower()}"))
    out = df.agg(*aggs)
    for m in markers:
        out = out.withColumn(f"rows_missing_{m.lower()}", F.col("total_rows") - F.col(f"rows_with_{m.lower()}"))
    return out


def column_info(df: DataFrame) -> DataFrame:
    """Per column: position, type and count of cells that are neither NULL nor NaN (one aggregate)."""
    fields = df.schema.fields
    wide = missing_as_null(df).agg(*[F.count(F.col(f"`{f.name}`")).alias(f"_c{i}") for i, f in enumerate(fields)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_c{i}").cast("bigint").alias("non_null"),
        )
        for i, f in enumerate(fields)
    ]
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def sorted_slice(df: DataFrame, order_by: Sequence[str], start: int, stop: int) -> DataFrame:
    """Rows ``[start, stop)`` of ``df`` sorted by ``order_by`` (NULLs last).

    Planned as a bounded top-``stop`` per partition plus one merge, so only
    ``stop`` rows per partition move.
    """
    if start < 0 or stop < start:
        raise ValueError("need 0 <= start <= stop")
    order = [F.col(c).asc_nulls_last() for c in order_by]
    return df.orderBy(*order).limit(stop).offset(start)


def layer_report(
    tables: Mapping[str, DataFrame],
    n: int = 5,
    order_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Validation of one lake layer as lazy DataFrames: row counts of all
    tables, and per table a deterministic preview and the column summary."""
    report = {"row_counts": row_counts(tables)}
    for name, df in tables.items():
        keys = (order_by or {}).get(name) or df.columns
        report[f"{name}.preview"] = preview(df, n, order_by=list(keys))
        report[f"{name}.columns"] = column_info(df)
    return report
