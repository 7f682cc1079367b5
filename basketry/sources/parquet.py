"""Parquet scans and sinks (the lakehouse layers are Parquet folders)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Scan one folder, several paths or a glob as one DataFrame.

    Reading many files is one scan (the row-wise concat of file frames);
    ``merge_schema`` reconciles files whose columns differ. With ``schema``
    nothing is inferred and a mismatch fails at read time.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    dynamic_overwrite: bool = False,
) -> None:
    """Write ``df`` as Parquet; full overwrite by default.

    With ``partition_by`` and ``dynamic_overwrite`` only the partitions
    present in ``df`` are replaced (``partitionOverwriteMode=dynamic``);
    without ``partition_by`` that mode has no effect, as in the original job.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if dynamic_overwrite:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Row-wise union by column name; missing columns become NULL."""
    if not frames:
        raise ValueError("no frames")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def load_gold(
    spark: SparkSession,
    fact_customer_path: str,
    fact_orders_location_path: str,
    persist: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Both Gold tables for a multi-metric session.

    ``persist=True`` also keeps them in executor memory and on executor disks;
    the Parquet folders are the durable copy either way.
    """
    fc = spark.read.parquet(fact_customer_path)
    fl = spark.read.parquet(fact_orders_location_path)
    if persist:
        fc = fc.persist(StorageLevel.MEMORY_AND_DISK)
        fl = fl.persist(StorageLevel.MEMORY_AND_DISK)
    return fc, fl
