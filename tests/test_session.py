"""The shared scratch folder comes from the session; a local folder only in local mode."""

import pytest

from daybook.session import shared_root


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Context:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, path):
        self._ckpt = path


class _Session:
    def __init__(self, master, ckpt=None, conf=None):
        self.sparkContext, self.conf = _Context(master, ckpt), _Conf(conf or {})


def test_the_cluster_folder_is_used_as_given():
    assert shared_root(_Session("yarn", ckpt="hdfs://nn/ckpt")) == "hdfs://nn/ckpt"
    assert shared_root(_Session("k8s://x", conf={"spark.checkpoint.dir": "s3a://b/ckpt"})) == "s3a://b/ckpt"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_Session("spark://master:7077"))


def test_local_mode_gets_a_fresh_folder():
    s = _Session("local[8]")
    root = shared_root(s)
    assert root and s.sparkContext.getCheckpointDir() == root


def test_clear_scratch(spark):
    from daybook.session import clear_scratch, scratch_path

    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    clear_scratch(spark)
    with pytest.raises(Exception):
        spark.read.parquet(path)
