"""Play shares and min-max scores on the edge table F4 and on fixture F2."""

import pytest
from pyspark.sql import functions as F

from playlens.operators.ratings import apply_scaler, fit_scaler, minmax_score, play_share


def _as_dict(df, key=("user_id", "track_new_id"), val="normalized_ranking"):
    return {tuple(r[k] for k in key): r[val] for r in df.collect()}


def test_edge_scores_keep_zeros(edge_plays):
    got = _as_dict(minmax_score(edge_plays, scale=100.0, zeros="keep"))
    # expected values from FIXTURES.md (table F4)
    assert got == {(1, 10): 100.0, (1, 20): 0.0, (2, 10): 100.0, (5, 10): 100.0, (5, 20): 50.0}


def test_edge_scores_drop_zeros(edge_plays):
    got = _as_dict(minmax_score(edge_plays, scale=100.0, zeros="drop_before"))
    assert got == {(1, 10): 100.0, (2, 10): 100.0, (5, 10): 100.0, (5, 20): 50.0}


def test_edge_shares(edge_plays):
    rows = {(r.user_id, r.track_new_id): (r.count_pop, r.count_total, r.ranking) for r in play_share(edge_plays).collect()}
    assert rows[(1, 10)] == (2, 3, pytest.approx(2 / 3))
    assert rows[(2, None)] == (0, 1, 0.0)
    assert rows[(4, None)] == (0, 0, None)  # only unmatched plays: 0/0
    assert rows[(None, 10)] == (1, 1, 1.0)  # NULL user is its own group
    assert rows[(3, 10)][2] == rows[(3, 20)][2] == 0.5
    assert len(rows) == 11


def test_scale_is_linear(edge_plays):
    x1 = _as_dict(minmax_score(edge_plays, scale=1.0))
    x10 = _as_dict(minmax_score(edge_plays, scale=10.0))
    assert x1.keys() == x10.keys()
    for k in x1:
        assert x10[k] == pytest.approx(10 * x1[k])


def test_shares_sum_to_one_and_scores_in_range(spark, sf_small):
    import __spark_entry__ as E

    shares = E.q_play_share(spark, sf_small).where(F.col("track_new_id").isNotNull() & F.col("user_id").isNotNull())
    sums = shares.groupBy("user_id").agg(F.sum("ranking").alias("s")).collect()
    assert sums and all(abs(r.s - 1.0) < 1e-9 for r in sums)
    scored = E.q_minmax_x100(spark, sf_small)
    lo, hi = scored.agg(F.min("normalized_ranking"), F.max("normalized_ranking")).first()
    assert 0.0 <= lo and hi <= 100.0


def test_rejects_unknown_zero_mode(edge_plays):
    with pytest.raises(ValueError):
        minmax_score(edge_plays, zeros="sometimes")


def test_fitted_scaler_on_unseen_rows(spark):
    """Values outside the fitted range, flat users, users and values without a range."""
    train = spark.createDataFrame([(1, 0.2), (1, 0.6), (1, None), (2, 0.5), (2, 0.5), (None, 0.1)], "user_id int, ranking double")
    rows = spark.createDataFrame(
        [(1, 0.2), (1, 0.4), (1, 0.6), (1, 0.1), (1, 0.8), (1, None), (2, 0.5), (2, 0.7), (3, 0.5), (None, 0.1)],
        "user_id int, ranking double",
    )
    fitted = fit_scaler(train)
    assert sorted(map(tuple, fitted.collect())) == [(1, 0.2, 0.6), (2, 0.5, 0.5)]

    def got(outside):
        scored = apply_scaler(rows, fitted, 10.0, outside)
        assert scored.columns == ["user_id", "ranking", "normalized_ranking"]
        return {(r[0], r[1]): None if r[2] is None else round(r[2], 9) for r in scored.collect()}

    none = {(1, None): None, (2, 0.5): None, (2, 0.7): None, (3, 0.5): None, (None, 0.1): None}
    inside = {(1, 0.2): 0.0, (1, 0.4): 5.0, (1, 0.6): 10.0}
    assert got("clip") == none | inside | {(1, 0.1): 0.0, (1, 0.8): 10.0}
    assert got("keep") == none | inside | {(1, 0.1): -2.5, (1, 0.8): 15.0}
    with pytest.raises(ValueError):
        apply_scaler(rows, fitted, outside="wrap")
    assert apply_scaler(rows, fit_scaler(train.where("false"))).where("normalized_ranking IS NOT NULL").count() == 0


def test_score_variants_share_one_aggregation_of_the_plays(spark, monkeypatch):
    import __spark_entry__ as E
    from playlens.operators.ratings import minmax_score, play_share

    rows = [(1, "a", 1), (1, "a", 1), (1, "b", 2), (1, "c", None), (2, "a", 1), (2, "b", 2), (2, "b", 2), (3, "c", None), (None, "a", 1)]
    plays = spark.createDataFrame(rows, "user_id int, recording_msid string, track_new_id int")
    calls = []
    monkeypatch.setattr(E, "_rekeyed", lambda *given: calls.append(given) or plays)
    told = lambda df: sorted(map(str, df.collect()))
    where = "made-up rows of test_ratings"
    for scale, zeros in ((100.0, "keep"), (10.0, "keep"), (100.0, "drop_before")):
        assert told(E._scored(spark, where, scale, zeros)) == told(minmax_score(plays, scale=scale, zeros=zeros))
    assert told(E._shares(spark, where)) == told(play_share(plays).select("user_id", "track_new_id", "ranking"))
    assert len(calls) == 1
