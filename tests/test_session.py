"""The shared checkpoint folder comes from the session; nothing machine-local is invented."""

import os

import pytest

from tallyfold.session import checkpoint_dir, scratch_path, scratch_run


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Session:
    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):  # like Spark Connect: no context on the client
        raise RuntimeError("no SparkContext")


@pytest.mark.parametrize("master", ["yarn", "local[2]", "local-cluster[2,1,512]", None])
def test_without_setting_a_shared_folder_is_used_under_any_master(master):
    s = _Session({"spark.sql.warehouse.dir": "hdfs:///warehouse"} | ({"spark.master": master} if master else {}))
    assert checkpoint_dir(s) == "hdfs:///warehouse/_checkpoints"
    assert s.conf.get("spark.checkpoint.dir") == "hdfs:///warehouse/_checkpoints"


def test_cluster_setting_is_used_as_is():
    s = _Session({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_a_run_removes_its_own_tables(spark, tmp_path):
    with scratch_run(spark) as folder:
        path = scratch_path(spark, "part")
        assert path.startswith(folder)
        spark.range(3).write.parquet(path)
        assert os.path.isdir(path)
    assert not os.path.exists(folder)
    assert not scratch_path(spark, "part").startswith(folder)
