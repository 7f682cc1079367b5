"""Checkpoint-folder rules: configured shared folder wins; never a local
fallback on a cluster."""

import pytest

from basketry.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self._conf = _Conf(conf)
        self.checkpoint_dir = None

    def getCheckpointDir(self):
        return self.checkpoint_dir

    def setCheckpointDir(self, path):
        self.checkpoint_dir = path

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, conf):
        self.sparkContext = _Context(master, conf)
        self.conf = _Conf(conf)


def test_cluster_without_checkpoint_dir_raises():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn", {}))


def test_configured_shared_folder_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_session_gets_a_temporary_folder():
    s = _Session("local[2]", {})
    path = ensure_checkpoint_dir(s)
    assert path and path.startswith("/") and "basketry-ckpt-" in path


def test_real_session_has_a_checkpoint_dir(spark):
    assert ensure_checkpoint_dir(spark)


def test_materialize_leaves_the_callers_cache_alone(spark):
    from basketry.session import materialize, remove_materialized

    df = spark.range(10).persist()
    level = df.storageLevel
    out = materialize(df)
    assert df.storageLevel == level and out.count() == 10
    df.unpersist()
    assert remove_materialized(spark) >= 1 and remove_materialized(spark) == 0


def test_configure_needs_no_checkpoint_folder():
    """Only the queries that store something ask for the shared folder."""
    from basketry.session import REQUIRED_CONF, configure

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    s = _Session("yarn", {})
    s.conf = Conf()
    configure(s)
    assert s.conf == REQUIRED_CONF
