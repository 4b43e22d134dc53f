import pytest

from hirelake.session import checkpoint_root, partition_settings


class _Ctx:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Conf(dict):
    def get(self, k, default=None):
        return super().get(k, default)

    def set(self, k, v):
        self[k] = v


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Ctx(master)
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="shared folder"):
        checkpoint_root(_Session("yarn"))


def test_configured_checkpoint_dir_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_root(s) == "hdfs:///shared/ckpt"


def test_local_master_gets_a_private_folder():
    s = _Session("local[2]")
    root = checkpoint_root(s)
    assert root and s.conf["spark.checkpoint.dir"] == root


def test_partition_settings_scale_with_input():
    small = partition_settings(10 * 2**20)
    big = partition_settings(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.shuffle.partitions"]) > 300_000
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 * 2**20)
