"""Session helpers that decide cluster behaviour (no Spark needed: stub sessions)."""

from __future__ import annotations

import pytest

from mercato.session import MAX_SHUFFLE_PARTITIONS, ensure_checkpoint_dir, scale_conf

TB = 1024 ** 4


class _Conf(dict):
    def get(self, key, default=None):  # noqa: D401 - mimic RuntimeConfig.get
        return super().get(key, default)

    def set(self, key, value):
        self[key] = value


class _NoContextSession:
    """Looks like a session without a SparkContext handle (e.g. Spark Connect)."""

    def __init__(self, **conf):
        self.conf = _Conf(conf)

    @property
    def sparkContext(self):
        raise RuntimeError("no SparkContext here")


def test_scale_conf_sizes_shuffles_from_input():
    small = scale_conf(10 * 1024 ** 3)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = scale_conf(100 * TB)
    assert int(big["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == \
        big["spark.sql.shuffle.partitions"]
    mid = scale_conf(2 * TB)
    assert 200 < int(mid["spark.sql.shuffle.partitions"]) < MAX_SHUFFLE_PARTITIONS


def test_checkpoint_dir_is_read_from_the_session():
    s = _NoContextSession(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///ckpt"


def test_no_local_scratch_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_NoContextSession(**{"spark.master": "yarn"}))


def test_local_mode_gets_a_scratch_folder_when_unset():
    s = _NoContextSession(**{"spark.master": "local[2]"})
    path = ensure_checkpoint_dir(s)
    assert path and s.conf["spark.checkpoint.dir"] == path
