"""A hot user: one user owns every third order's plays (about a third of all rows).

The whole preparation chain must stay exact: scores equal the oracle's in
DuckDB, the split keeps ``trunc(f * n)`` rows of the hot user
in train while its rows are ranked in many small buckets.
"""

import __spark_entry__ as E
import pytest
from pyspark.sql import functions as F

from playlens.operators.order import global_positions
from playlens.operators.ratings import minmax_score
from playlens.operators.split import split_per_user
from playlens.plans.prepare import rekeyed_plays
from playlens.sources import fixtures as FX
from tests.oracle import duck

HOT = 0


def _hot_plays(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_partkey")
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(HOT)).otherwise(F.col("o_custkey") + 1).alias("user_id"),
        F.concat(F.lit("msid-"), F.col("l_partkey").cast("string")).alias("recording_msid"),
    )


HOT_PLAYS = """plays AS (
    SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey + 1 END AS user_id,
           'msid-' || CAST(l_partkey AS VARCHAR) AS recording_msid
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

HOT_SQL = (
    E._with(E._cte_catalog(), HOT_PLAYS, E._CTE_IDS, E._CTE_REKEYED, E._CTE_SHARES, E._cte_scored(100.0))
    + "SELECT user_id, track_new_id, ranking, normalized_ranking FROM scored"
)

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def hot_scores(spark):
    rk = rekeyed_plays(FX.catalog(spark, SF), _hot_plays(spark, SF))
    return minmax_score(rk, 100.0).cache()


def test_hot_user_holds_a_third(spark):
    plays = _hot_plays(spark, SF)
    n, hot = plays.count(), plays.where(F.col("user_id") == HOT).count()
    assert 0.3 < hot / n < 0.37


def test_scores_match_the_oracle(hot_scores):
    ours = sorted(tuple(r) for r in hot_scores.collect())
    ref = sorted(tuple(r) for r in duck(SF).sql(HOT_SQL).fetchall())
    assert ours == ref


def test_hot_user_split_is_exact_in_small_buckets(hot_scores):
    n_hot = hot_scores.where(F.col("user_id") == HOT).count()
    # buckets of at most ~50 rows: the hot user's rows are ranked in many tasks' worth of groups
    small = split_per_user(hot_scores, 0.8, seed=9, rows_per_bucket=50, unique_by=["user_id", "track_new_id"])
    whole = split_per_user(hot_scores, 0.8, seed=9, unique_by=["user_id", "track_new_id"])
    key = ["user_id", "track_new_id", "dataset"]
    assert sorted(small.select(key).collect()) == sorted(whole.select(key).collect())
    t = small.where((F.col("user_id") == HOT) & (F.col("dataset") == "train")).count()
    assert t == int(n_hot * 0.8)


def test_hot_user_in_the_callers_order(spark):
    """Split by score, one user with a third of the rows: exact, and no task of the ranking holds that user."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id") % 997 + 1).alias("user_id"),
        F.col("id").alias("track_new_id"),
        (F.col("id") * 7919 % 1009).cast("double").alias("normalized_ranking"),
    ).repartition(6)
    order = [F.col("normalized_ranking").desc(), F.col("track_new_id").asc()]
    own = {}
    for r in rows.collect():
        own.setdefault(r.user_id, []).append((-r.normalized_ranking, r.track_new_id))
    want = {(u, item): i < int(len(of) * 0.8) for u, of in own.items() for i, (_, item) in enumerate(sorted(of))}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = split_per_user(rows, 0.8, order=order)
        assert {(r.user_id, r.track_new_id): r.dataset == "train" for r in got.collect()} == want
        placed = global_positions(rows, order, per=["user_id"])
        tasks = placed.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("user_id") == HOT).alias("hot")
        )
        sizes = tasks.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert max(r.n for r in sizes) < 30_000 / 8
    assert max(r.hot for r in sizes) < 10_000 / 4 and sum(r.hot > 0 for r in sizes) > 4
