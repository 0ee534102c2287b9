"""Split laws: disjoint, complete, trunc(f * n) per user, stable, bucket-exact."""

import pytest
from pyspark.sql import functions as F

from playlens.functions.columns import hash_bucket, hash_key
from playlens.operators.setops import multiset_difference, split_laws
from playlens.operators.split import number_copies, side, split_per_user, split_rows, subsample_per_user


@pytest.fixture(scope="module")
def scored(spark, sf_small):
    import __spark_entry__ as E

    return E.q_minmax_x100(spark, sf_small).cache()


def _labels(df):
    return {(r.user_id, r.track_new_id): r.dataset for r in df.collect()}


def test_split_is_complete_and_disjoint(scored):
    s = split_per_user(scored, 0.8, seed=7)
    train, val = side(s, "train"), side(s, "validation")
    assert train.count() + val.count() == scored.count()
    assert train.intersect(val).count() == 0
    assert train.union(val).subtract(scored).count() == 0


def test_train_size_per_user_truncates(scored):
    s = split_per_user(scored, 0.7, seed=7)
    per_user = s.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("dataset") == "train", 1).otherwise(0)).alias("t")
    )
    for r in per_user.collect():
        assert r.t == int(r.n * 0.7)


def test_buckets_do_not_change_the_split(scored):
    # one bucket per user vs. buckets of at most 3 rows: same labels
    a = _labels(split_per_user(scored, 0.8, seed=3))
    b = _labels(split_per_user(scored, 0.8, seed=3, rows_per_bucket=3))
    assert a == b


def test_split_stable_under_repartitioning(scored):
    a = _labels(split_per_user(scored, 0.8, seed=11))
    b = _labels(split_per_user(scored.repartition(5, "track_new_id"), 0.8, seed=11))
    assert a == b


def test_seed_changes_the_split(scored):
    assert _labels(split_per_user(scored, 0.5, seed=1)) != _labels(split_per_user(scored, 0.5, seed=2))


def test_single_row_user_goes_to_validation(spark):
    df = spark.createDataFrame([(1, 10, 1.0)], "user_id int, track_new_id int, normalized_ranking double")
    assert split_per_user(df, 0.8).first().dataset == "validation"


def test_split_rows_fraction_and_stability(spark, sf_small):
    from playlens.sources import fixtures as FX

    plays = FX.plays_f2(spark, sf_small)
    s = split_rows(plays, (0.8, 0.2), seed=52)
    n = plays.count()
    n_train = s.where("dataset = 'train'").count()
    assert abs(n_train / n - 0.8) < 0.05
    again = split_rows(plays.repartition(3), (0.8, 0.2), seed=52)
    assert sorted(s.collect()) == sorted(again.collect())


def test_three_way_split_weights(spark, sf_small):
    from playlens.sources import fixtures as FX

    plays = FX.plays_f2(spark, sf_small)
    s = split_rows(plays, (1, 1, 2), labels=("a", "b", "c"))
    counts = {r.dataset: r["count"] for r in s.groupBy("dataset").count().collect()}
    assert set(counts) == {"a", "b", "c"} and counts["c"] > counts["a"]


def test_subsample_is_subset(scored):
    sub = subsample_per_user(scored, 0.7)
    assert sub.subtract(scored).count() == 0
    assert sub.count() < scored.count()


def test_empty_input_splits_to_nothing(spark):
    df = spark.createDataFrame([], "user_id int, track_new_id int, normalized_ranking double")
    out = split_per_user(df, 0.8)
    assert out.count() == 0 and out.columns == df.columns + ["dataset"]


def _multiset(df):
    return sorted(map(tuple, df.collect()))


def test_repeated_pairs_split_alike_under_repartitioning(spark):
    df = spark.range(3000).selectExpr("CAST(id % 3 AS INT) user_id", "CAST(id % 10 AS INT) track_new_id", "CAST(id % 4 AS DOUBLE) x")
    a = split_per_user(df, 0.8, seed=5)
    for other in (df.repartition(5), df.repartition(3, "x"), df.orderBy(F.col("x").desc())):
        assert _multiset(split_per_user(other, 0.8, seed=5)) == _multiset(a)
        small = split_per_user(other, 0.8, seed=5, rows_per_bucket=40)
        assert _multiset(small) == _multiset(a)
    per_user = {r.user_id: r["count"] for r in side(a, "train").groupBy("user_id").count().collect()}
    assert per_user == {0: 800, 1: 800, 2: 800}


def test_sides_computed_apart_are_disjoint(spark):
    df = spark.range(500).selectExpr("1 AS user_id", "CAST(id % 2 AS INT) AS track_new_id")
    train = side(split_per_user(df.repartition(3), 0.6, seed=1), "train")
    rest = side(split_per_user(df.repartition(7), 0.6, seed=1), "validation")
    assert _multiset(train.unionAll(rest)) == _multiset(df) and train.count() == 300


def test_hot_pair_is_spread_over_buckets(spark):
    """30,000 copies of one pair: bucket sizes follow the copies' hashes, not the pair's."""
    df = spark.range(30_000).selectExpr("1 AS user_id", "7 AS track_new_id")
    plain = split_per_user(df, 0.8, seed=3)
    assert _multiset(split_per_user(df, 0.8, seed=3, rows_per_bucket=500)) == _multiset(plain)
    keyed = number_copies(df, "_copy").withColumn("_key", hash_key(3, "user_id", "track_new_id", "_copy"))
    sizes = [r["count"] for r in keyed.groupBy(hash_bucket("_key", 60).alias("b")).count().collect()]
    assert len(sizes) == 60 and max(sizes) < 650


def test_row_split_is_independent_for_copies(spark):
    df = spark.range(30_000).selectExpr("1 AS user_id", "'m' AS recording_msid")
    counts = {r.dataset: r["count"] for r in split_rows(df, (0.8, 0.2), seed=52).groupBy("dataset").count().collect()}
    assert abs(counts["train"] / 30_000 - 0.8) < 0.01 and sum(counts.values()) == 30_000


def test_callers_order_is_total_and_stable(spark):
    """Ties go by the other columns, NULLs first; repeated rows are told apart; NULL users go."""
    rows = [(1, None, 5.0), (1, 3, 5.0), (1, 2, 5.0), (1, 2, 5.0), (1, 9, None), (2, 1, 1.0), (None, 4, 1.0)]
    df = spark.createDataFrame(rows, "user_id int, track_new_id int, normalized_ranking double")
    order = [F.col("normalized_ranking").desc_nulls_last()]
    for parts in (1, 4):
        got = split_per_user(df.repartition(parts), 0.6, order=order)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(
            [(1, None, 5.0, "train"), (1, 2, 5.0, "train"), (1, 2, 5.0, "train"), (1, 3, 5.0, "validation"), (1, 9, None, "validation"), (2, 1, 1.0, "validation")],
            key=str,
        )
    assert split_per_user(df.where("user_id > 5"), 0.6, order=order).count() == 0


def test_laws_see_a_lost_a_doubled_and_a_shared_row(spark):
    given = spark.createDataFrame([(1, 1), (1, 2), (2, None), (2, None), (3, 3)], "a int, b int")
    label = lambda rows: spark.createDataFrame(rows, "a int, b int, dataset string")
    good = [(1, 1, "train"), (1, 2, "validation"), (2, None, "train"), (2, None, "validation"), (3, 3, "train")]
    told = lambda rows: tuple(split_laws(given, label(rows)).first())
    assert told(good) == (5, 0, 0)
    assert told(good[1:]) == (5, 1, 0)
    assert told([*good, (1, 1, "validation")]) == (5, 1, 1)
    assert told([*good[:-1], (3, 4, "train")]) == (5, 2, 0)
    assert told([]) == (5, 4, 0)
    assert tuple(split_laws(given.where("a > 9"), label([])).first()) == (0, 0, 0)
    left = multiset_difference(given, label(good[:3]).drop("dataset"))
    assert sorted(map(tuple, left.collect()), key=str) == [(2, None, 1), (3, 3, 1)]


def test_the_laws_of_the_splits_leave_no_shuffle_files(spark, sf_small):
    import time
    from glob import glob

    import __spark_entry__ as E

    E._totals(spark, sf_small).count()
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folder for f in glob(f"{d}/*/shuffle_*")}
    kept = files()
    laws = E.q_split_laws(spark, sf_small).collect()
    assert sorted(r.variant for r in laws) == sorted(
        ["ordered_80", "by_score_80", "hash_70", "zero_after", "raw_share", "rows_80", "duplicates"]
    )
    assert all(r.n_rows > 0 and r.n_different == r.n_overlap == 0 for r in laws)
    end = time.time() + 10
    while files() - kept and time.time() < end:
        time.sleep(0.2)
    assert files() <= kept
