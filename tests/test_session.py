from __future__ import annotations

import pytest

from tidewatch import session as N


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, context, conf=None):
        self.sparkContext, self.conf = context, _Conf(conf or {})


def test_the_context_folder_comes_first():
    both = _Session(_Context("spark://host:7077", "hdfs:/set/by/user/"), {"spark.checkpoint.dir": "hdfs:/conf"})
    assert N._root(both) == "hdfs:/set/by/user"


def test_then_the_setting():
    assert N._root(_Session(_Context("spark://host:7077"), {"spark.checkpoint.dir": "hdfs:/conf/"})) == "hdfs:/conf"


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError):
            N._root(_Session(_Context(master)))
    assert N._root(_Session(_Context("local[2]")))


def test_discard(spark):
    path = N.shared_folder(spark, "short-lived")
    spark.range(3).write.parquet(path)
    N.discard(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path)
