"""Checkpoint folder: read from the session; a local one only in local mode."""

import pytest

from tremor.session import ensure_checkpoint_dir


class _Ctx:
    def __init__(self, master, current=None):
        self.master, self._dir = master, current

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Session:
    def __init__(self, master, configured=None, current=None):
        self.sparkContext = _Ctx(master, current)
        self.conf = _Conf(configured)


def test_existing_dir_is_used():
    s = _Session("yarn", current="hdfs://nn/ckpt/app")
    assert ensure_checkpoint_dir(s) == "hdfs://nn/ckpt/app"


def test_configured_dir_is_used():
    s = _Session("k8s://x", configured="s3a://bucket/ckpt")
    assert ensure_checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_cluster_without_dir_is_an_error():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("spark://master:7077"))


def test_local_without_dir_gets_a_scratch_folder():
    assert ensure_checkpoint_dir(_Session("local[2]")).startswith("/tmp/tremor-ckpt-")


def test_real_session_has_one(spark):
    assert ensure_checkpoint_dir(spark)
