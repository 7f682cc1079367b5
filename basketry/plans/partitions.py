"""Rebuild of changed partitions only.

Every partition of a source has a digest that does not depend on the order of
its rows: their number and two sums of row hashes, which combine map-side. The
digests of the last build are stored beside the target. A run compares them
with the present ones and rebuilds the partitions that changed or are new; the
files of all others stay as they are, and partitions that vanished from the
source are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.ranking import null_safe_join
from basketry.session import materialize

DIGEST = "rows long, sum_a decimal(38,0), sum_b decimal(38,0)"


_PIECE = 21  # bits: sums of pieces stay within 64 bits for 2^41 rows of a partition


def partition_digests(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, rows, sum_a, sum_b): order-free digest of every partition; columns count by name.

    A sum of 64-bit hashes needs more than 64 bits; it is put together from
    the sums of three pieces of each hash, which are plain longs.
    """
    columns = sorted(df.columns)
    cells = [F.col(f"`{c}`") for c in columns]
    # hashes skip NULLs, so which cells are NULL is hashed too
    nulls = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cells])
    hashed = df.select(*keys, F.xxhash64(*cells, nulls).alias("_a"), F.xxhash64(F.lit(",".join(columns)), nulls, *reversed(cells)).alias("_b"))
    mask = F.lit((1 << _PIECE) - 1).cast("bigint")

    def piece(c: str, i: int) -> Column:
        moved = F.shiftright(c, i * _PIECE)
        return F.sum(moved if i == 2 else moved.bitwiseAND(mask)).alias(f"{c}{i}")

    def total(c: str) -> Column:
        # wide enough and no wider: a product of two decimals must keep its scale of 0
        return reduce(lambda x, y: x + y, [(F.col(f"{c}{i}").cast("decimal(20,0)") * F.lit(Decimal(1 << i * _PIECE))).cast("decimal(38,0)") for i in range(3)]).cast("decimal(38,0)")

    sums = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[piece(c, i) for c in ("_a", "_b") for i in range(3)])
    return sums.select(*keys, "rows", total("_a").alias("sum_a"), total("_b").alias("sum_b"))


def compare_digests(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, ``change``): ``new``, ``changed`` or ``vanished`` partitions; unchanged ones are not listed."""
    sums = ["rows", "sum_a", "sum_b"]
    before = old.select(*keys, F.struct(*sums).alias("was"), F.lit(None).cast(f"struct<{DIGEST.replace(' ', ':').replace(',:', ',')}>").alias("now"))
    after = new.select(*keys, F.lit(None).cast(before.schema["now"].dataType).alias("was"), F.struct(*sums).alias("now"))
    both = before.unionByName(after).groupBy(*keys).agg(F.max("was").alias("was"), F.max("now").alias("now"))
    change = F.when(F.col("was").isNull(), F.lit("new")).when(F.col("now").isNull(), F.lit("vanished")).otherwise(F.lit("changed"))
    return both.where(~F.col("was").eqNullSafe(F.col("now"))).select(*keys, change.alias("change"))


@dataclass
class Rebuilt:
    """Partition values by what happened to them."""

    new: list[tuple]
    changed: list[tuple]
    vanished: list[tuple]


def rebuild_partitions(
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    build: Callable[[DataFrame], DataFrame],
    digests: str,
) -> Rebuilt:
    """Bring ``target`` (partitioned by ``keys``) up to date with ``source``.

    ``build`` turns source rows into target rows and must work partition by
    partition: rows of one partition depend on source rows of that partition
    alone, and keep its keys. ``digests`` is the folder of the stored digests;
    without it every partition is built. The digests are written last, so a run
    that fails is repeated by the next one.
    """
    spark = source.sparkSession
    keys = list(keys)
    now = materialize(partition_digests(source, keys), "partition-digests")
    try:
        # another folder than the one written below: the old rows are read before
        old = materialize(spark.read.parquet(digests), "partition-digests")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = now.limit(0)
    changes = materialize(compare_digests(old, now, keys), "partition-changes")
    # one row per partition that changed
    found = Rebuilt(*[[tuple(r[k] for k in keys) for r in changes.where(F.col("change") == c).orderBy(*keys).collect()] for c in ("new", "changed", "vanished")])
    again = changes.where("change <> 'vanished'").select(*keys)
    if found.new or found.changed:
        some = null_safe_join(source, again, keys, "left_semi") if old.columns else source
        build(some).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(target)
    gone = found.vanished
    if found.changed:
        # a changed partition for which the build has no row any more is not overwritten: its old files go
        left = spark.read.parquet(target).select(*keys).distinct()
        built = build(null_safe_join(source, again, keys, "left_semi")).select(*keys).distinct()
        stale = null_safe_join(null_safe_join(left, changes.where("change = 'changed'"), keys, "left_semi"), built, keys, "left_anti")
        gone = gone + [tuple(r) for r in stale.select(*keys).collect()]
    _delete_partitions(spark, target, keys, gone)
    now.write.mode("overwrite").parquet(digests)
    return found


def _delete_partitions(spark: SparkSession, target: str, keys: list[str], values: list[tuple]) -> None:
    """Delete the folders of the given partitions, as Spark names them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for row in values:
        parts = [f"{k}=" + ("__HIVE_DEFAULT_PARTITION__" if v is None else escape(str(v))) for k, v in zip(keys, row)]
        path = jvm.org.apache.hadoop.fs.Path("/".join([target.rstrip("/"), *parts]))
        path.getFileSystem(conf).delete(path, True)
