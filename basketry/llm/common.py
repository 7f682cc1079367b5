"""Helpers shared by the operators: shared intermediate tables, text columns, ids."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.session import materialize


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once into the shared checkpoint folder and read back (see :func:`materialize`).

    Cuts the lineage: a lost executor costs a re-read of shared files, never a
    second run of the upstream plan, and later readers see a table of known
    size. ``basketry.session.remove_materialized`` deletes the folders.
    """
    return materialize(df, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    """The text column; a null text counts as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def crc_bucket(id_col: str, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod`` (null for a null id)."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % mod


def fresh_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``taken`` has that name."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted += "_"
    return wanted


def utf8_values(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value of a string column; null gives ``b""``."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [v or b"" for v in column.cast(kind).to_pylist()]


def number_rows(df: DataFrame, group: str, order: list[str], out: str, name: str) -> DataFrame:
    """``df`` plus ``out``: the place of each row in its group, from 0 on, by ``order`` (nulls first); stored on the way.

    Rows are dealt by ranges of (group, order), so a group with a third of all
    rows is spread like any other; a place is the place inside its range plus
    the rows of earlier ranges. Equal rows get different places. A null group
    is a group.
    """
    part, row = fresh_name(df.columns, "_part"), fresh_name(df.columns, "_row")
    keys = [group, *order]
    # the row number parts equal rows, of which a range could otherwise hold any number
    ranged = df.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(*keys, row)
    ranged = stored(ranged.withColumn(part, F.spark_partition_id()).drop(row), name)
    before = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = ranged.groupBy(F.col(group).alias("g"), F.col(part).alias("p")).agg(F.count("*").alias("n"))
    starts = counts.select("g", "p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy(group, part).orderBy(*order)) - 1
    numbered = ranged.withColumn(out, inside)
    joined = numbered.join(starts, numbered[group].eqNullSafe(starts.g) & (numbered[part] == starts.p))
    return joined.select(*[numbered[c] for c in df.columns], (F.col("start") + numbered[out]).alias(out))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that few texts are Python objects at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
