"""The shared checkpoint folder is read from the session; a local run may
fall back to a folder of its own, a cluster run without the setting fails."""

import pytest

from quarry import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == session.CHECKPOINT_CONF else default


class _SC:
    def __init__(self, master, app):
        self.master, self.applicationId, self.dir = master, app, None

    def getCheckpointDir(self):  # noqa: N802 - Spark's name
        return self.dir

    def setCheckpointDir(self, d):  # noqa: N802
        self.dir = d


class _Spark:
    def __init__(self, master, value, app):
        self.conf, self.sparkContext = _Conf(value), _SC(master, app)


def test_session_setting_wins():
    s = _Spark("spark://cluster:7077", "hdfs://shared/ckpt", "app-1")
    assert session.checkpoint_root(s) == "hdfs://shared/ckpt"
    assert s.sparkContext.dir.startswith("hdfs://shared/ckpt")


def test_local_fallback_is_remembered():
    s = _Spark("local[2]", None, "app-2")
    root = session.checkpoint_root(s)
    assert root and session.checkpoint_root(s) == root  # same folder on the next call
    assert session.scratch_path(s, "a", "b") == f"{root}/a/b"


def test_cluster_without_setting_is_refused():
    with pytest.raises(RuntimeError):
        session.checkpoint_root(_Spark("yarn", None, "app-3"))


def test_real_session_reads_the_setting(spark):
    root = session.checkpoint_root(spark)
    assert root == (spark.conf.get(session.CHECKPOINT_CONF, None) or root)
    assert spark.sparkContext.getCheckpointDir() is not None
