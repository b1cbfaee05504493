"""The scratch folder comes from the session; a local one is made only when none is set."""

from __future__ import annotations

from forgelake.session import scratch_path, scratch_root


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self):
        self.dir = None

    def getCheckpointDir(self):  # noqa: N802 (Spark's name)
        return self.dir

    def setCheckpointDir(self, path):  # noqa: N802
        self.dir = "file:" + path + "/uuid"


class _Session:
    def __init__(self, conf_value):
        self.conf = _Conf(conf_value)
        self.sparkContext = _Context()


def test_cluster_setting_wins():
    s = _Session("hdfs://nn/shared/ckpt/")
    assert scratch_root(s) == "hdfs://nn/shared/ckpt"
    assert s.sparkContext.dir is None  # nothing set behind the cluster's back
    a, b = scratch_path(s, "t"), scratch_path(s, "t")
    assert a != b and a.startswith("hdfs://nn/shared/ckpt/forgelake-")


def test_local_fallback_only_when_unset():
    s = _Session(None)
    root = scratch_root(s)
    assert root.startswith("file:") and s.sparkContext.dir is not None
    assert scratch_root(s) == root  # stable for the session
