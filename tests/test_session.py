"""Session helpers: cluster sizing and the shared checkpoint folder rule."""

import pytest

from acctpulse.session import cluster_conf, ensure_checkpoint_dir


def test_cluster_conf_sizes_partitions_from_shuffled_bytes():
    conf = cluster_conf(20 * 1024**4, 8000, "s3a://shared/ckpt")
    n = int(conf["spark.sql.shuffle.partitions"])
    assert 0.5 * 1024**3 <= 20 * 1024**4 / n <= 2 * 1024**3 and n >= 2 * 8000
    assert conf["spark.checkpoint.dir"] == "s3a://shared/ckpt"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(10, 64, "x")["spark.sql.shuffle.partitions"]) == 128   # at least two per core
    assert int(cluster_conf(10**18, 1000, "x")["spark.sql.shuffle.partitions"]) <= 50_000   # blocks stay bounded


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _NoContextSession:
    """A session without a local SparkContext (as with Spark Connect)."""

    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no local context")


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_NoContextSession({"spark.master": "spark://cluster:7077"}))


def test_named_checkpoint_dir_is_used():
    s = _NoContextSession({"spark.master": "spark://cluster:7077", "spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


@pytest.mark.parametrize("master", ["local-cluster[3,2,1024]", "spark://cluster:7077", "yarn"])
def test_only_plain_local_mode_makes_its_own_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_NoContextSession({"spark.master": master}))
