"""Skew check: one user owns a third of the plays.  How big is the largest task?

Runs the per-user split directly over the raw plays of fixture F2 (sf0.1
by default) after giving every third order to one user, with Spark's event
log written to a scratch folder, then prints, per stage, the number of
tasks, the records read by the largest task and by all tasks.

AQE's skew thresholds are lowered to this data size (they are sized for
hundreds of MB per partition); on real data the defaults apply.

Usage: python scripts/skew_check.py [sf_dir] [rows_per_bucket]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from playlens.operators.ratings import minmax_score  # noqa: E402
from playlens.operators.split import split_per_user  # noqa: E402
from playlens.session import build_session  # noqa: E402


def hot_plays(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_partkey")
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey") + 1).cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("track_new_id"),
        F.col("l_orderkey"),
    )


def hot_pairs(spark, d):
    """Like ``hot_plays`` but the hot user's item is the order key: that user
    then owns many distinct (user, item) pairs, the input of the score join."""
    p = hot_plays(spark, d)
    return p.select(
        "user_id",
        F.when(F.col("user_id") == 0, F.col("l_orderkey").cast("int")).otherwise(F.col("track_new_id")).alias(
            "track_new_id"
        ),
    )


def stage_report(ev_dir):
    tasks, names = {}, {}
    for f in glob.glob(os.path.join(ev_dir, "*", "events_*")):
        with open(f, "rb") as fh:
            for line in io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8"):
                try:
                    e = json.loads(line)
                except ValueError:
                    continue
                if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    m = e["Task Metrics"]
                    rec = m["Input Metrics"]["Records Read"] + m["Shuffle Read Metrics"]["Total Records Read"]
                    tasks.setdefault(e["Stage ID"], []).append(rec)
                elif e["Event"] == "SparkListenerStageCompleted":
                    names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"][:40]
    return tasks, names


def main(argv):
    sf = argv[0] if argv else "/root/testdata/sf0.1"
    per_bucket = int(argv[1]) if len(argv) > 1 else 20_000
    run = tempfile.mkdtemp(prefix="skew-")
    ev = os.path.join(run, "events")
    os.makedirs(ev)
    spark = build_session(
        shuffle_partitions=16,
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": ev,
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
        },
    )
    plays = hot_plays(spark, sf)
    n = plays.count()
    n_hot = plays.where("user_id = 0").count()
    labelled = split_per_user(plays, 0.7, seed=52, rows_per_bucket=per_bucket)
    labelled.write.format("noop").mode("overwrite").save()
    hot_train = labelled.where("user_id = 0 and dataset = 'train'").count()
    spark.sparkContext.setJobGroup("scores", "min-max scores with a hot user")
    scored = minmax_score(hot_pairs(spark, sf), 100.0)
    scored.write.format("noop").mode("overwrite").save()
    n_pairs = scored.count()
    n_hot_pairs = scored.where("user_id = 0").count()
    spark.stop()

    tasks, names = stage_report(ev)
    print(f"plays {n}, hot user {n_hot} ({n_hot / n:.1%}), hot train rows {hot_train} (= int(0.7 * {n_hot}))")
    print(f"rows_per_bucket {per_bucket}; score run: {n_pairs} scored pairs, hot user {n_hot_pairs}")
    print("stage  tasks  max-task-records  all-records  max/all   name")
    for sid in sorted(tasks):
        recs = tasks[sid]
        total = sum(recs)
        if total == 0:
            continue
        print(f"{sid:5d}  {len(recs):5d}  {max(recs):16d}  {total:11d}  {max(recs) / total:6.1%}   {names.get(sid, '')}")


if __name__ == "__main__":
    main(sys.argv[1:])
