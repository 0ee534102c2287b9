"""Checkpoint-folder rules, and raw-share / split edge semantics on table F4."""

import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from playlens.operators.ratings import play_share
from playlens.operators.split import split_per_user
from playlens.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self._dir = master, _Conf(conf), None

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self._dir = d


class _Session:
    def __init__(self, master, conf):
        self.sparkContext = _Context(master, conf)


def test_scratch_tables_go_with_the_session(tmp_path):
    """A written table can be read again while the session lives, and is gone after it; its neighbours stay."""
    code = f"""
from playlens.session import build_session, scratch_path
spark = build_session("local[2]", driver_memory="1g", checkpoint_dir="{tmp_path}")
path = scratch_path(spark, "t")
spark.range(5).write.parquet(path)
print(spark.read.parquet(path).count(), scratch_path(spark, "u").rsplit("/", 1)[0] == path.rsplit("/", 1)[0])
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["5", "True"], done.stderr
    deadline = time.monotonic() + 30
    while list(tmp_path.rglob("*.parquet")) and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not list(tmp_path.rglob("*.parquet")) and tmp_path.exists()


def test_configured_checkpoint_dir_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_cluster_without_checkpoint_dir_fails():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn", {}))


def test_local_without_setting_gets_scratch_folder():
    d = ensure_checkpoint_dir(_Session("local[2]", {}))
    assert d and "playlens-ckpt-" in d


def test_session_checkpoint_dir_is_set(spark):
    assert spark.sparkContext.getCheckpointDir()


def test_raw_share_split_counts_null_items_then_drops_them(edge_plays):
    shares = play_share(edge_plays).select("user_id", "track_new_id", "ranking")
    labelled = split_per_user(shares, 0.8, seed=1)
    # NULL users do not take part; every other pair does, NULL items included
    assert labelled.where(F.col("user_id").isNull()).count() == 0
    per_user = {r.user_id: r.n for r in labelled.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_user == {1: 2, 2: 2, 3: 2, 4: 1, 5: 3}
    kept = labelled.where(F.col("ranking") > 0)
    assert kept.where(F.col("track_new_id").isNull()).count() == 0
    assert kept.where(F.col("user_id") == 4).count() == 0  # only unmatched plays: share NULL
