"""Checkpoint-directory policy: use the cluster's setting, create one only for local sessions."""

import pytest

from aerolith.session import ensure_checkpoint_dir


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


class _Context:
    def __init__(self, master, conf=None, ckpt=None):
        self.master, self._conf, self._ckpt = master, _Conf(conf or {}), ckpt

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, path):
        self._ckpt = path


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.sparkContext = _Context(master, conf, ckpt)
        self.conf = _Conf()


def test_cluster_setting_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://nn/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs://nn/ckpt"


def test_cluster_without_setting_is_refused():
    with pytest.raises(RuntimeError, match="shared storage"):
        ensure_checkpoint_dir(_Session("spark://master:7077"))


def test_local_session_gets_a_scratch_dir():
    s = _Session("local[2]")
    path = ensure_checkpoint_dir(s)
    assert path and s.sparkContext.getCheckpointDir() == path
    assert s.conf.get("spark.checkpoint.dir") == path


def test_a_submitted_master_stays(monkeypatch):
    from aerolith import session
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", "--master yarn --conf a=b pyspark-shell")
    assert session._submitted_master() == "yarn"
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", "pyspark-shell")
    monkeypatch.delenv("SPARK_MASTER", raising=False)
    monkeypatch.delenv("MASTER", raising=False)
    assert session._submitted_master() is None
