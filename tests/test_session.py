"""Session settings: cluster defaults, the shared folder, temporary data."""

import os
from types import SimpleNamespace

import pytest

from strata import session


class Builder:
    """Takes down what a session is asked for."""

    def __init__(self):
        self.conf = {}

    def master(self, m):
        self.conf["master"] = m
        return self

    def appName(self, n):  # noqa: N802 - Spark's name
        return self

    def config(self, k, v):
        self.conf[k] = v
        return self

    def getOrCreate(self):  # noqa: N802 - Spark's name
        return SimpleNamespace(sparkContext=SimpleNamespace(setLogLevel=lambda level: None), conf=self.conf)


@pytest.mark.parametrize("master,given,partitions", [
    ("local[8]", None, "8"), ("local", 3, "3"), ("spark://host:7077", None, "20000"),
    ("yarn", 500, "500"), ("local-cluster[2,1,1024]", None, "20000")])
def test_partitions_by_master(monkeypatch, master, given, partitions):
    monkeypatch.setattr(session, "SparkSession", SimpleNamespace(builder=Builder()))
    conf = session.build_session(master, given).conf
    assert conf["spark.sql.shuffle.partitions"] == partitions
    assert ("spark.sql.files.maxPartitionBytes" in conf) == (not session.is_local(master))


def test_unset_checkpoint_dir_is_an_error_on_a_cluster():
    def conf_get(key, default=None):
        return default

    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: SimpleNamespace(get=conf_get))
    spark = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(spark)


def test_temporary_data_goes_also_on_failure(spark):
    with pytest.raises(ValueError):
        with session.temporary(spark):
            path = session.temp_dir(spark, "t")
            spark.range(3).write.parquet(path)
            inner = []
            with session.temporary(spark):
                inner.append(session.temp_dir(spark, "u"))
                spark.range(3).write.parquet(inner[0])
            assert not os.path.exists(inner[0].removeprefix("file:"))
            assert os.path.exists(path.removeprefix("file:"))
            raise ValueError
    assert not os.path.exists(path.removeprefix("file:"))
    kept = session.temp_dir(spark, "v")              # outside of a block: the caller's
    spark.range(1).write.parquet(kept)
    assert os.path.exists(kept.removeprefix("file:"))
