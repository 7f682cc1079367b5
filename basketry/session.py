"""SparkSession settings used by the library, tests and the benchmark.

Money and time semantics depend on two settings: the session time zone must
be UTC (source timestamps are UTC strings) and adaptive execution should be
on so Spark can coalesce small shuffle partitions, split skewed ones and
switch sort-merge joins to broadcast joins when a side turns out small.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; applied on top of whatever the cluster sets.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "basketry",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's required settings.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset so the
    submit-time configuration wins; tests pass ``local[*]`` and a small
    partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (e.g. the driver's)."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def _spark_context(spark: SparkSession):
    """The session's SparkContext, or None for a remote (Connect) session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint directory, setting one only when unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always used. Only a local-mode session without any setting (tests) gets a
    fresh folder under /tmp; a cluster session without one is an error,
    because a machine-local folder would not survive executor loss. A remote
    (Connect) session uses the server's setting; nothing is changed here.
    """
    sc = _spark_context(spark)
    if sc is None:
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/object store) before running jobs that cut lineage"
        )
    path = tempfile.mkdtemp(prefix="basketry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


# paths given out by scratch_path() in this process, for remove_materialized()
_WRITTEN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder; :func:`remove_materialized` deletes what is written there."""
    folder = ensure_checkpoint_dir(spark)
    if not folder:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/object store)")
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def materialize(df, name: str = "basketry"):
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Used where a derived table feeds several passes: each pass then reads the
    files instead of recomputing the upstream plan, a lost executor costs a
    re-read, not a re-run, and Spark knows the table's size. The plan of
    ``df`` runs once and its own cache, if any, is left alone.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_removed(spark: SparkSession):
    """Queries run inside remove their shuffle files as they end, instead of whenever the driver collects garbage.

    For plans that run once, such as a write; a frame run again would shuffle anew.
    """
    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, old)


def materialize_parts(spark: SparkSession, parts: Iterable[DataFrame], path: str) -> DataFrame:
    """Write frames of one schema one after the other into ``path`` and read them back as one.

    Each part's shuffle files are gone before the next part is planned, so the
    disk holds those of one part at a time.
    """
    schema = None
    for part in parts:
        schema = schema or part.schema
        with shuffle_files_removed(spark):
            part.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete one :func:`scratch_path` folder; no frame that reads it may be run any more.

    A remote (Connect) session has no file access: the folder stays.
    """
    sc = _spark_context(spark)
    if sc is None:
        return
    found = sc._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(sc._jsc.hadoopConfiguration()).delete(found, True)
    if path in _WRITTEN:
        _WRITTEN.remove(path)


def remove_materialized(spark: SparkSession) -> int:
    """Delete the folders under :func:`scratch_path` paths of this process; returns their number.

    For long sessions, once no result that was built on them is needed any more.
    """
    done = 0
    for path in [*_WRITTEN]:
        remove_path(spark, path)
        done += 1
    return done
