"""

Every query reads the given tables through the fixture mapping of
FIXTURES.md (F1: ``events``; F2: ``lineitem`` x ``orders``; the catalog
from ``part``) and runs the library's operators over the whole tables.
Each oracle states the result independently in DuckDB (``dense_rank`` for
the ids, counts and one join for the scores, ``row_number`` for splits and
lists), so it also checks that the Spark plans (distributed ids, bucketed
split, hits-first metrics) compute the same thing.

The catalog of the fixtures holds nine tenths of ``part``
(``p_partkey % 10 <> 9``, FIXTURES.md); the plays of the rest find no item.
That concerns ``catalog``, ``item_ids``, ``item_ids_f1`` and what is built
on them, and gives the left join its unmatched plays.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlens.operators.ids import build_item_ids, unmatched
from playlens.operators.listcheck import check_lists
from playlens.operators.metrics import ranking_metrics, rmse
from playlens.operators.model import als_certificate, fit_als, predict, predict_factors
from playlens.operators.order import global_positions
from playlens.operators.ratings import (
    apply_scaler,
    fit_scaler,
    minmax_of_totals,
    minmax_score,
    play_share,
    play_totals,
    share_of_totals,
)
from playlens.operators.recommend import recommend_items, recommend_users, recommendation_ids, top_k_per_group
from playlens.operators.setops import split_laws
from playlens.operators.split import side, split_per_user, split_rows
from playlens.operators.topk import topk_items, topk_users
from playlens.operators.tuning import best_by, distinct_models, model_key, param_grid
from playlens.plans import prepare as P
from playlens.plans.evaluate import evaluate_model, labels_of, single_run
from playlens.plans.search import ALPHAS, RANKS, REG_PARAMS, best_points, grid_search
from playlens.session import cut_lineage, scratch_path, shared_path, written_in_waves
from playlens.sources import fixtures as FX
from playlens.sources.sinks import preview, read_split_side, write_csv, write_split, write_table
from playlens.sources.tables import read_csv, read_parquet, register_tables

FLAGSHIP_DIR = "/root/testdata/sf0.001"
SEED = 52


# --------------------------------------------------------------------------
# shared Spark building blocks
# --------------------------------------------------------------------------


def _catalog(spark: SparkSession, d: str, fx: str = "f2") -> DataFrame:
    return FX.catalog(spark, d, fx)


def _rekeyed(spark: SparkSession, d: str, fx: str = "f2") -> DataFrame:
    return P.rekeyed_plays(_catalog(spark, d, fx), FX.plays(spark, d, fx))


def _scores(spark: SparkSession, d: str, scale: float = 100.0, zeros: str = "keep", fx: str = "f2") -> DataFrame:
    return minmax_score(_rekeyed(spark, d, fx), scale=scale, zeros=zeros)


# Prepared tables and fitted models that several queries of a session share.
# At most MAX_KEPT stay; the one not used for longest is released first.
MAX_KEPT = 8
_KEPT: OrderedDict = OrderedDict()


def _kept(spark: SparkSession, *key, build: Callable):
    """``build()``, once per session and key; a DataFrame is persisted (lazily)."""
    app = spark.sparkContext.applicationId
    if (app, *key) not in _KEPT:
        made = build()
        _KEPT[(app, *key)] = made.persist(StorageLevel.MEMORY_AND_DISK) if isinstance(made, DataFrame) else made
    _KEPT.move_to_end((app, *key))
    while len(_KEPT) > MAX_KEPT:
        (old_app, *_), old = _KEPT.popitem(last=False)
        if isinstance(old, DataFrame) and old_app == app:
            old.unpersist()
    return _KEPT[(app, *key)]


def _scored(spark: SparkSession, d: str, scale: float = 100.0, zeros: str = "keep", fx: str = "f2") -> DataFrame:
    """The score table, by what all score and share tables of a fixture follow from; that is prepared once."""
    return minmax_of_totals(_totals(spark, d, fx), scale=scale, zeros=zeros)


def _totals(spark: SparkSession, d: str, fx: str = "f2") -> DataFrame:
    return _kept(spark, "totals", d, fx, build=lambda: play_totals(_rekeyed(spark, d, fx)))


def _shares(spark: SparkSession, d: str) -> DataFrame:
    return share_of_totals(_totals(spark, d)).select(*P.PAIR, "ranking")


def _split80(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, "split", d, "x100", build=lambda: P.labelled_split(_scored(spark, d), 0.8, seed=SEED))


# --------------------------------------------------------------------------
# queries
# --------------------------------------------------------------------------


def q_plays_f1(spark, d):
    return FX.plays_f1(spark, d)


def q_plays_f2(spark, d):
    return FX.plays_f2(spark, d)


def q_catalog(spark, d):
    return _catalog(spark, d, "f2")


def q_item_ids(spark, d):
    return build_item_ids(_catalog(spark, d, "f2")).select(
        "recording_msid", "recording_mbid", "unique_id", "track_new_id"
    )


def q_item_ids_f1(spark, d):
    return build_item_ids(_catalog(spark, d, "f1")).select(
        "recording_msid", "recording_mbid", "unique_id", "track_new_id"
    )


def q_rekeyed_plays(spark, d):
    return _rekeyed(spark, d, "f2")


def q_unmatched_plays(spark, d):
    return unmatched(_rekeyed(spark, d, "f2"))


def q_play_share(spark, d):
    return play_share(_rekeyed(spark, d, "f2"))


def q_minmax_x1(spark, d):
    return _scores(spark, d, 1.0)


def q_minmax_x10(spark, d):
    return _scores(spark, d, 10.0)


def q_minmax_x100(spark, d):
    return _scores(spark, d, 100.0)


def q_minmax_positive(spark, d):
    return _scores(spark, d, 100.0, zeros="drop_before")


def q_minmax_x100_f1(spark, d):
    return _scores(spark, d, 100.0, fx="f1")


def q_rekeyed_plays_f1(spark, d):
    return _rekeyed(spark, d, "f1")


def q_play_share_f1(spark, d):
    return play_share(_rekeyed(spark, d, "f1"))


def q_split_ordered_80_f1(spark, d):
    return P.labelled_split(_scored(spark, d, fx="f1"), 0.8, seed=SEED)


def q_split_ordered_80(spark, d):
    return P.labelled_split(_scored(spark, d), 0.8, seed=SEED)


def q_split_hash_70(spark, d):
    return P.labelled_split(_scored(spark, d, zeros="drop_before"), 0.7, seed=SEED)


def q_split_zero_after(spark, d):
    return P.labelled_split(_scored(spark, d, 10.0), 0.8, zeros="drop_after", seed=SEED)


def q_split_raw_share(spark, d):
    return P.raw_share_split(_shares(spark, d), 0.8, seed=SEED)


def q_split_rows_80(spark, d):
    return split_rows(FX.plays_f2(spark, d), (0.8, 0.2), seed=SEED)


def q_split_duplicates(spark, d):
    """Raw plays: users repeat items, so the split has to tell copies apart."""
    return split_per_user(FX.plays_f1(spark, d), 0.8, seed=SEED, item_col="recording_msid")


def q_train_70pct(spark, d):
    labelled = P.labelled_split(_scored(spark, d, zeros="drop_before"), 0.7, seed=SEED)
    return labelled.where(F.col("dataset") == "train").drop("dataset")


def q_user_counts(spark, d):
    return _scores(spark, d, 100.0).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"))


def q_ground_truth(spark, d):
    return labels_of(side(_split80(spark, d), "validation"))


def q_distinct_users(spark, d):
    return _scores(spark, d, 100.0).select("user_id").distinct()


def q_distinct_items(spark, d):
    return _scores(spark, d, 100.0).select("track_new_id").distinct()


def _score_order():
    return [F.col("user_id").asc(), F.col("normalized_ranking").desc(), F.col("track_new_id").asc()]


def q_sorted_scores(spark, d):
    """The global order, proven by each row's position in it."""
    return global_positions(_scores(spark, d, 100.0), _score_order(), "position")


def q_scores_preview(spark, d):
    return preview(_scores(spark, d, 100.0).orderBy(*_score_order()), 20)


K = 100


def _score_lists(spark, d, k=K):
    """Each user's items ranked by their own score: a deterministic top-k list."""
    return top_k_per_group(
        _scored(spark, d), "user_id", [F.col("normalized_ranking").desc(), F.col("track_new_id").asc()], k
    )


def q_topk_scores(spark, d):
    return _score_lists(spark, d).select("user_id", "pos", "track_new_id", "normalized_ranking")


def _list_metrics(spark, d, k):
    labels = labels_of(side(_split80(spark, d), "validation"))
    m = ranking_metrics(_score_lists(spark, d, K), labels, k)
    return m.select("users", *[F.round(c, 12).alias(c) for c in ("map", "map_at_k", "ndcg_at_k")])


def q_map_all(spark, d):
    return _list_metrics(spark, d, K).select("users", "map")


def q_map_at_k(spark, d):
    return _list_metrics(spark, d, K).select("users", "map_at_k")


def q_ndcg_at_k(spark, d):
    return _list_metrics(spark, d, K).select("users", "ndcg_at_k")


def q_ranking_metrics_at_10(spark, d):
    return _list_metrics(spark, d, 10)


# ALS runs: the workload's timed configuration (rank 100, 5 iterations,
# regParam 1.0) on the x100 scores split 80/20, and its rank-250 run on
# the positive-only 70/30 sets.  Seeds are fixed; each fitted model is
# reused by the queries of one session and data directory.
ALS_PARAMS = dict(rank=100, max_iter=5, reg_param=1.0, alpha=1.0, seed=SEED)
ALS_PARAMS_250 = dict(rank=250, max_iter=5, reg_param=1.0, alpha=1.0, seed=SEED)


def _sets(spark, d, variant="x100"):
    """Train and validation of a variant: two sides of one labelled split, made once."""
    if variant == "x100":
        labelled = _split80(spark, d)
    else:
        v = P.VARIANTS[variant]
        scored = _scored(spark, d, v["scale"], v["zeros"])
        labelled = _kept(
            spark, "split", d, variant, build=lambda: P.labelled_split(scored, v["fraction"], v["zeros"], seed=SEED)
        )
    return side(labelled, "train"), side(labelled, "validation")


def _model(spark, d, variant="x100", params=None):
    params = params or ALS_PARAMS
    key = ("model", d, variant, tuple(sorted(params.items())))
    return _kept(spark, *key, build=lambda: fit_als(_sets(spark, d, variant)[0], **params))


def q_als_predict(spark, d):
    _, validation = _sets(spark, d)
    return predict(_model(spark, d), validation.select("user_id", "track_new_id", "normalized_ranking"))


def q_als_topk_items(spark, d):
    return recommend_items(_model(spark, d), K)


def q_als_topk_users(spark, d):
    return recommend_users(_model(spark, d), K)


def q_als_topk_items_subset(spark, d):
    _, validation = _sets(spark, d)
    return recommend_items(_model(spark, d), K, validation.select("user_id").distinct())


def q_als_topk_users_subset(spark, d):
    _, validation = _sets(spark, d)
    return recommend_users(_model(spark, d), K, validation.select("track_new_id").distinct())


def q_als_recommended_ids(spark, d):
    return recommendation_ids(_model(spark, d), K)


def q_als_rmse(spark, d):
    _, validation = _sets(spark, d)
    return rmse(predict(_model(spark, d), validation.select("user_id", "track_new_id", "normalized_ranking")))


def q_als_metrics(spark, d):
    _, validation = _sets(spark, d)
    return evaluate_model(_model(spark, d), validation, K)


def q_als_metrics_rank250(spark, d):
    train, validation = _sets(spark, d, "positive_70")
    return single_run(train, validation, k=K, **ALS_PARAMS_250)


# Distinct models fitted at a time: scheduling only, the results are the same.
# A half step has too few tasks, and waits of the driver's, to fill the cores alone.
GRID_PARALLELISM = 4


def _grid(spark, d, variant="x100", max_iter=5):
    """The workload's 48-point grid; x100 scores with 5 iterations, or x1
    scores with MLlib's default 10 iterations (its second search job)."""
    train, validation = _sets(spark, d, variant)
    return _kept(
        spark,
        "grid",
        d,
        variant,
        max_iter,
        build=lambda: grid_search(
            train,
            validation,
            k=K,
            max_iter=max_iter,
            seed=SEED,
            parallelism=GRID_PARALLELISM,
            store=shared_path(spark, "playlens-grid-models"),
        ),
    )


def q_grid_results(spark, d):
    return _grid(spark, d).drop("fit_sec")


def q_grid_results_x1(spark, d):
    return _grid(spark, d, "x1", 10).drop("fit_sec")


def q_grid_best_x1(spark, d):
    return best_points(_grid(spark, d, "x1", 10).drop("fit_sec"))


def q_grid_best(spark, d):
    return best_points(_grid(spark, d).drop("fit_sec"))


def _factor_pairs(spark, d):
    """Fixture F3: distinct (customer, part) pairs of the plays with their number as label."""
    item = F.expr("CAST(substr(recording_msid, 6) AS BIGINT)").alias("track_new_id")
    plays = FX.plays_f2(spark, d).select("user_id", item)
    return plays.groupBy("user_id", "track_new_id").agg(F.count(F.lit(1)).cast("double").alias("plays"))


def _vectors(spark, d):
    return spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))


def _factor_predictions(spark, d):
    """The whole table serves as the factors of both sides."""
    return predict_factors(_vectors(spark, d), _vectors(spark, d), _factor_pairs(spark, d))


def q_factor_predict(spark, d):
    return _factor_predictions(spark, d).withColumn("prediction", F.round("prediction", 9))


def q_factor_rmse(spark, d):
    return rmse(_factor_predictions(spark, d), "plays").select("rows", F.round("rmse", 9).alias("rmse"))


# Lists from free-standing factor tables: every vector is a user and, times one plus
# its label, an item, so the items' lengths differ.
TOP = 10


def _item_vectors(spark, d):
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1))
    return spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").alias("id"), scaled.alias("features"))


def q_topk_items(spark, d):
    return topk_items(_vectors(spark, d), _item_vectors(spark, d), TOP)


def q_topk_users(spark, d):
    return topk_users(_vectors(spark, d), _item_vectors(spark, d), TOP)


def q_topk_items_subset(spark, d):
    """Lists of the users that have plays of fixture F1."""
    return topk_items(_vectors(spark, d), _item_vectors(spark, d), TOP, users=FX.plays_f1(spark, d))


def q_topk_users_subset(spark, d):
    """Lists of the items of the catalog."""
    items = _catalog(spark, d).select(F.expr("CAST(substr(recording_msid, 6) AS BIGINT)").alias("track_new_id"))
    return topk_users(_vectors(spark, d), _item_vectors(spark, d), TOP, items=items)


def q_topk_exclude_seen(spark, d):
    """Lists without the items that a user has played."""
    return topk_items(_vectors(spark, d), _item_vectors(spark, d), TOP, seen=_factor_pairs(spark, d))


def q_als_certificate(spark, d):
    """Whether the fitted user factors solve their least-squares equations."""
    model = _model(spark, d)
    told = als_certificate(model.userFactors, model.itemFactors, _sets(spark, d)[0], ALS_PARAMS["reg_param"])
    return told.drop("residual")


def q_als_lists_exact_items(spark, d):
    """The lists of all users, scored again against all items."""
    model = _model(spark, d)
    return check_lists(q_als_topk_items(spark, d), model.userFactors, model.itemFactors, K)


def q_als_lists_exact_users(spark, d):
    """The lists of all items, scored again against all users."""
    model = _model(spark, d)
    return check_lists(q_als_topk_users(spark, d), model.itemFactors, model.userFactors, K, "track_new_id", "user_id")


def q_split_by_score_80(spark, d):
    """The best-scored four fifths of every user's rows: a split in the caller's order."""
    order = [F.col("normalized_ranking").desc(), F.col("track_new_id").asc()]
    return split_per_user(_scored(spark, d), 0.8, order=order)


def q_minmax_fit_on_train(spark, d):
    """Scores whose per-user range comes from the train rows alone; the validation rows are clipped to it."""
    shares = P.share_table(_catalog(spark, d), FX.plays_f2(spark, d)).where("track_new_id IS NOT NULL AND user_id IS NOT NULL")
    labelled = cut_lineage(split_per_user(shares, 0.8, seed=SEED, unique_by=P.PAIR))
    return apply_scaler(labelled, fit_scaler(side(labelled, "train")), 100.0, outside="clip")


def _split_variants(spark, d):
    """Name, input and labelled rows of every split, made when they are asked for."""
    plays = FX.plays_f2(spark, d)
    scored = _scored(spark, d)
    yield "ordered_80", scored, q_split_ordered_80(spark, d)
    yield "by_score_80", scored, q_split_by_score_80(spark, d)
    yield "hash_70", _scored(spark, d, zeros="drop_before"), q_split_hash_70(spark, d)
    yield "zero_after", _scored(spark, d, 10.0).where("normalized_ranking > 0"), q_split_zero_after(spark, d)
    yield "raw_share", _shares(spark, d).where("ranking > 0 AND user_id IS NOT NULL"), q_split_raw_share(spark, d)
    yield "rows_80", plays, q_split_rows_80(spark, d)
    yield "duplicates", FX.plays_f1(spark, d).where("user_id IS NOT NULL"), q_split_duplicates(spark, d)


def q_split_laws(spark, d):
    """Of every split: its two sides together are the input, and share no row.

    The splits are told one after the other, so that the disk holds the shuffles of one.
    """
    laws = (split_laws(given, labelled).select(F.lit(name).alias("variant"), "*") for name, given, labelled in _split_variants(spark, d))
    return written_in_waves(spark, "split-laws", laws)


def q_plays_csv(spark, d):
    """The plays of fixture F2, written as CSV and read again under a declared schema."""
    path = write_csv(FX.plays_f2(spark, d), scratch_path(spark, f"plays-{uuid.uuid4().hex}"))
    return read_csv(spark, path, "user_id BIGINT, recording_msid STRING", malformed="fail")


def q_sink_validation(spark, d):
    """The validation side of a written split."""
    path = write_split(_split80(spark, d), scratch_path(spark, f"split-{uuid.uuid4().hex}"))
    return read_split_side(spark, path, "validation")


def q_als_warm_pairs(spark, d):
    return q_als_predict(spark, d).select("user_id", "track_new_id")


def _list_shape(recs, owner):
    """Rows, first and last position of every list, and whether its ratings never rise."""
    before = F.lag("rating").over(Window.partitionBy(owner).orderBy("pos"))
    return (
        recs.withColumn("falls", F.coalesce(F.col("rating") <= before, F.lit(True)))
        .groupBy(owner)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("pos").alias("min_pos"),
            F.max("pos").alias("max_pos"),
            F.bool_and("falls").alias("non_increasing"),
        )
    )


def q_als_list_shape_items(spark, d):
    return _list_shape(q_als_topk_items(spark, d), "user_id")


def q_als_list_shape_users(spark, d):
    return _list_shape(q_als_topk_users(spark, d), "track_new_id")


def q_als_list_shape_items_subset(spark, d):
    return _list_shape(q_als_topk_items_subset(spark, d), "user_id")


def q_als_list_shape_users_subset(spark, d):
    return _list_shape(q_als_topk_users_subset(spark, d), "track_new_id")


def q_grid_points(spark, d):
    """The grid's points, the model of each and the users that its models are scored on; nothing is fitted."""
    train, validation = _sets(spark, d)
    points = param_grid(REG_PARAMS, RANKS, ALPHAS)
    index = {key: i for i, key in enumerate(distinct_models(points))}
    rows = [(p["grid_index"], p["reg_param"], p["rank"], p["alpha"], index[model_key(p)]) for p in points]
    table = spark.createDataFrame(rows, "grid_index int, reg_param double, rank int, alpha double, model_index int")
    warm = validation.select("user_id").join(train.select("user_id"), "user_id", "left_semi")
    return table.withColumn("users", warm.agg(F.count_distinct("user_id")).scalar())


def q_best_rule(spark, d):
    """``best_by`` on a table with many ties: items as grid points, their number of users as metric."""
    per_item = _scores(spark, d, 100.0).groupBy(F.col("track_new_id").alias("grid_index"))
    return best_by(per_item.agg(F.count(F.lit(1)).alias("metric")), "metric")


def q_sink_scores(spark, d):
    """The score table, written and read again."""
    path = scratch_path(spark, f"scores-{uuid.uuid4().hex}")
    return read_parquet(spark, write_table(_scored(spark, d), path))


def q_sink_train(spark, d):
    """The train side of a written split."""
    path = write_split(_split80(spark, d), scratch_path(spark, f"split-{uuid.uuid4().hex}"))
    return read_split_side(spark, path, "train")


def q_plays_f2_sql(spark, d):
    """The plays of fixture F2 by SQL over the registered tables."""
    register_tables(spark, d, ["lineitem", "orders"])
    return spark.sql(
        """SELECT o_custkey AS user_id, concat('msid-', l_partkey) AS recording_msid
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
    )


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "plays_f1": q_plays_f1,
    "plays_f2": q_plays_f2,
    "catalog": q_catalog,
    "item_ids": q_item_ids,
    "item_ids_f1": q_item_ids_f1,
    "rekeyed_plays": q_rekeyed_plays,
    "unmatched_plays": q_unmatched_plays,
    "play_share": q_play_share,
    "minmax_x1": q_minmax_x1,
    "minmax_x10": q_minmax_x10,
    "minmax_x100": q_minmax_x100,
    "minmax_positive": q_minmax_positive,
    "minmax_x100_f1": q_minmax_x100_f1,
    "split_ordered_80": q_split_ordered_80,
    "rekeyed_plays_f1": q_rekeyed_plays_f1,
    "play_share_f1": q_play_share_f1,
    "split_ordered_80_f1": q_split_ordered_80_f1,
    "split_hash_70": q_split_hash_70,
    "split_zero_after": q_split_zero_after,
    "split_raw_share": q_split_raw_share,
    "split_rows_80": q_split_rows_80,
    "train_70pct": q_train_70pct,
    "user_counts": q_user_counts,
    "ground_truth": q_ground_truth,
    "distinct_users": q_distinct_users,
    "distinct_items": q_distinct_items,
    "sorted_scores": q_sorted_scores,
    "scores_preview": q_scores_preview,
    "topk_scores": q_topk_scores,
    "map_all": q_map_all,
    "map_at_k": q_map_at_k,
    "ndcg_at_k": q_ndcg_at_k,
    "ranking_metrics_at_10": q_ranking_metrics_at_10,
    "als_predict": q_als_predict,
    "als_topk_items": q_als_topk_items,
    "als_topk_users": q_als_topk_users,
    "als_topk_items_subset": q_als_topk_items_subset,
    "als_topk_users_subset": q_als_topk_users_subset,
    "als_recommended_ids": q_als_recommended_ids,
    "als_rmse": q_als_rmse,
    "als_metrics": q_als_metrics,
    "als_metrics_rank250": q_als_metrics_rank250,
    "grid_results": q_grid_results,
    "grid_best": q_grid_best,
    "grid_results_x1": q_grid_results_x1,
    "grid_best_x1": q_grid_best_x1,
    "split_duplicates": q_split_duplicates,
    "factor_predict": q_factor_predict,
    "factor_rmse": q_factor_rmse,
    "als_warm_pairs": q_als_warm_pairs,
    "als_list_shape_items": q_als_list_shape_items,
    "als_list_shape_users": q_als_list_shape_users,
    "als_list_shape_items_subset": q_als_list_shape_items_subset,
    "als_list_shape_users_subset": q_als_list_shape_users_subset,
    "grid_points": q_grid_points,
    "best_rule": q_best_rule,
    "sink_scores": q_sink_scores,
    "sink_train": q_sink_train,
    "plays_f2_sql": q_plays_f2_sql,
    "topk_items": q_topk_items,
    "topk_users": q_topk_users,
    "topk_items_subset": q_topk_items_subset,
    "topk_users_subset": q_topk_users_subset,
    "topk_exclude_seen": q_topk_exclude_seen,
    "als_certificate": q_als_certificate,
    "als_lists_exact_items": q_als_lists_exact_items,
    "als_lists_exact_users": q_als_lists_exact_users,
    "split_by_score_80": q_split_by_score_80,
    "minmax_fit_on_train": q_minmax_fit_on_train,
    "split_laws": q_split_laws,
    "plays_csv": q_plays_csv,
    "sink_validation": q_sink_validation,
}


# --------------------------------------------------------------------------
# oracle SQL (DuckDB)
# --------------------------------------------------------------------------

_ALIAS_MOD = {"f1": 40, "f2": 97}


def _cte_catalog(fx: str = "f2") -> str:
    return f"""catalog AS (
    SELECT 'msid-' || CAST(p_partkey AS VARCHAR) AS recording_msid,
           CASE WHEN p_partkey % 3 = 0 THEN NULL
                ELSE 'mbid-' || CAST(p_partkey % {_ALIAS_MOD[fx]} AS VARCHAR) END AS recording_mbid
    FROM part WHERE p_partkey % 10 <> 9)"""


_CTE_PLAYS = {
    "f1": """plays AS (
    SELECT user_id, 'msid-' || json_extract_string(props, '$.k') AS recording_msid FROM events)""",
    "f2": """plays AS (
    SELECT o_custkey AS user_id, 'msid-' || CAST(l_partkey AS VARCHAR) AS recording_msid
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
}

_CTE_IDS = """ids AS (
    SELECT *, CAST(dense_rank() OVER (ORDER BY unique_id NULLS FIRST) AS INTEGER) AS track_new_id
    FROM (SELECT *, coalesce(recording_mbid, recording_msid) AS unique_id FROM catalog) t)"""

_CTE_REKEYED = """rekeyed AS (
    SELECT CAST(p.user_id AS INTEGER) AS user_id, p.recording_msid, i.track_new_id
    FROM plays p LEFT JOIN ids i ON p.recording_msid = i.recording_msid)"""

# Whole numbers first: plays of each pair, then per user their sum, least and most.
_CTE_PAIRS = """pairs AS (
    SELECT user_id, track_new_id, count(track_new_id) AS plays FROM rekeyed GROUP BY ALL)"""

_CTE_USERS = """users AS (
    SELECT user_id AS uid, CAST(sum(plays) AS BIGINT) AS total, min(plays) AS low, max(plays) AS high
    FROM pairs GROUP BY user_id)"""

_CTE_SHARES = f"""{_CTE_PAIRS},
{_CTE_USERS},
shares AS (
    SELECT user_id, track_new_id, plays, total, low, high, CASE WHEN total > 0 THEN plays / total END AS share
    FROM pairs JOIN users ON user_id IS NOT DISTINCT FROM uid)"""


def _cte_scored(scale: float, positive: bool = False) -> str:
    """A score exists where the user is known, the item is known and the user's counts differ."""
    least = "low < plays" if positive else "low <= plays"
    return f"""scored AS (
    SELECT user_id, track_new_id, share AS ranking,
           (share - low / total) / (high / total - low / total) * {scale!r} AS normalized_ranking
    FROM shares
    WHERE track_new_id IS NOT NULL AND user_id IS NOT NULL AND low < high AND {least})"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _prep(fx: str = "f2") -> list[str]:
    return [_cte_catalog(fx), _CTE_PLAYS[fx], _CTE_IDS, _CTE_REKEYED]


def _split_sql(src: str, fraction: float, cols: str, seed: int = SEED) -> str:
    """Per-user split in the workload's formulation: row_number over the user."""
    return f"""SELECT {cols},
       CASE WHEN row_number() OVER (
                PARTITION BY user_id
                ORDER BY md5(concat_ws('|', '{seed}', coalesce(CAST(user_id AS VARCHAR), ''),
                                       coalesce(CAST(track_new_id AS VARCHAR), ''))),
                         track_new_id NULLS FIRST)
                 <= CAST(floor(count(*) OVER (PARTITION BY user_id) * CAST({fraction!r} AS DOUBLE)) AS BIGINT)
            THEN 'train' ELSE 'validation' END AS dataset
FROM {src} WHERE user_id IS NOT NULL"""


_SCORE_COLS = "user_id, track_new_id, ranking, normalized_ranking"


def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    o["plays_f1"] = _with(_CTE_PLAYS["f1"]) + "SELECT * FROM plays"
    o["plays_f2"] = _with(_CTE_PLAYS["f2"]) + "SELECT * FROM plays"
    o["catalog"] = _with(_cte_catalog("f2")) + "SELECT * FROM catalog"
    o["item_ids"] = (
        _with(_cte_catalog("f2"), _CTE_IDS) + "SELECT recording_msid, recording_mbid, unique_id, track_new_id FROM ids"
    )
    o["item_ids_f1"] = (
        _with(_cte_catalog("f1"), _CTE_IDS) + "SELECT recording_msid, recording_mbid, unique_id, track_new_id FROM ids"
    )
    o["rekeyed_plays"] = _with(*_prep()) + "SELECT * FROM rekeyed"
    o["unmatched_plays"] = _with(*_prep()) + "SELECT * FROM rekeyed WHERE track_new_id IS NULL"
    o["play_share"] = (
        _with(*_prep(), _CTE_SHARES)
        + "SELECT user_id, track_new_id, plays AS count_pop, total AS count_total, share AS ranking FROM shares"
    )
    for name, scale in (("minmax_x1", 1.0), ("minmax_x10", 10.0), ("minmax_x100", 100.0)):
        o[name] = _with(*_prep(), _CTE_SHARES, _cte_scored(scale)) + "SELECT * FROM scored"
    o["minmax_positive"] = _with(*_prep(), _CTE_SHARES, _cte_scored(100.0, positive=True)) + "SELECT * FROM scored"
    o["minmax_x100_f1"] = _with(*_prep("f1"), _CTE_SHARES, _cte_scored(100.0)) + "SELECT * FROM scored"
    o["split_ordered_80"] = _with(*_prep(), _CTE_SHARES, _cte_scored(100.0)) + _split_sql("scored", 0.8, _SCORE_COLS)
    o["rekeyed_plays_f1"] = _with(*_prep("f1")) + "SELECT * FROM rekeyed"
    o["play_share_f1"] = (
        _with(*_prep("f1"), _CTE_SHARES)
        + "SELECT user_id, track_new_id, plays AS count_pop, total AS count_total, share AS ranking FROM shares"
    )
    o["split_ordered_80_f1"] = _with(*_prep("f1"), _CTE_SHARES, _cte_scored(100.0)) + _split_sql(
        "scored", 0.8, _SCORE_COLS
    )
    o["split_hash_70"] = _with(*_prep(), _CTE_SHARES, _cte_scored(100.0, positive=True)) + _split_sql(
        "scored", 0.7, _SCORE_COLS
    )
    o["split_zero_after"] = (
        _with(*_prep(), _CTE_SHARES, _cte_scored(10.0))
        + "SELECT * FROM ("
        + _split_sql("scored", 0.8, _SCORE_COLS)
        + ") s WHERE normalized_ranking > 0"
    )
    o["split_raw_share"] = (
        _with(
            *_prep(),
            _CTE_SHARES,
            "raw AS (SELECT user_id, track_new_id, share AS ranking FROM shares)",
        )
        + "SELECT * FROM ("
        + _split_sql("raw", 0.8, "user_id, track_new_id, ranking")
        + ") s WHERE ranking > 0"
    )
    numbered = """numbered AS (
    SELECT user_id, recording_msid, row_number() OVER (PARTITION BY user_id, recording_msid) AS nth FROM plays),
hashed AS (
    SELECT user_id, recording_msid, nth, md5(concat_ws('|', '%d', coalesce(CAST(user_id AS VARCHAR), ''),
                                                       coalesce(recording_msid, ''), CAST(nth AS VARCHAR))) AS h
    FROM numbered)""" % SEED
    o["split_rows_80"] = _with(_CTE_PLAYS["f2"], numbered) + """SELECT user_id, recording_msid,
       CASE WHEN CAST(('0x' || substr(h, 1, 8)) AS BIGINT) < 0.8 * 4294967296 THEN 'train' ELSE 'validation' END AS dataset
FROM hashed"""
    o["split_duplicates"] = _with(_CTE_PLAYS["f1"], numbered) + """SELECT user_id, recording_msid,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY h, recording_msid, nth)
                 <= floor(0.8 * count(*) OVER (PARTITION BY user_id)) THEN 'train' ELSE 'validation' END AS dataset
FROM hashed WHERE user_id IS NOT NULL"""
    o["train_70pct"] = (
        _with(*_prep(), _CTE_SHARES, _cte_scored(100.0, positive=True))
        + f"SELECT {_SCORE_COLS} FROM ("
        + _split_sql("scored", 0.7, _SCORE_COLS)
        + ") s WHERE dataset = 'train'"
    )
    scored100 = _with(*_prep(), _CTE_SHARES, _cte_scored(100.0))
    o["user_counts"] = scored100 + "SELECT user_id, count(*) AS n_rows FROM scored GROUP BY user_id"
    split80 = "split AS (" + _split_sql("scored", 0.8, _SCORE_COLS) + ")"
    o["ground_truth"] = (
        _with(*_prep(), _CTE_SHARES, _cte_scored(100.0), split80)
        + "SELECT DISTINCT user_id, track_new_id FROM split WHERE dataset = 'validation'"
    )
    o["distinct_users"] = scored100 + "SELECT DISTINCT user_id FROM scored"
    o["distinct_items"] = scored100 + "SELECT DISTINCT track_new_id FROM scored"
    o["sorted_scores"] = scored100 + """SELECT *, row_number() OVER (ORDER BY user_id, normalized_ranking DESC, track_new_id) AS position
FROM scored"""
    o["scores_preview"] = (
        scored100 + "SELECT * FROM scored ORDER BY user_id, normalized_ranking DESC, track_new_id LIMIT 20"
    )
    lists = f"""lists AS (
    SELECT user_id, track_new_id, normalized_ranking,
           row_number() OVER (PARTITION BY user_id ORDER BY normalized_ranking DESC, track_new_id) AS pos
    FROM scored QUALIFY pos <= {K})"""
    o["topk_scores"] = (
        _with(*_prep(), _CTE_SHARES, _cte_scored(100.0), lists)
        + "SELECT user_id, CAST(pos AS INTEGER) AS pos, track_new_id, normalized_ranking FROM lists"
    )

    def metrics_sql(k: int, cols: str) -> str:
        return _with(*_prep(), _CTE_SHARES, _cte_scored(100.0), split80, lists) + f""", labels AS (
    SELECT DISTINCT user_id, track_new_id FROM split WHERE dataset = 'validation'),
n_labels AS (SELECT user_id, count(*) AS n FROM labels GROUP BY user_id),
hits AS (
    SELECT p.user_id, p.pos, CASE WHEN l.user_id IS NULL THEN 0 ELSE 1 END AS hit
    FROM lists p LEFT JOIN labels l ON p.user_id = l.user_id AND p.track_new_id = l.track_new_id),
terms AS (
    SELECT user_id, pos, hit,
           sum(hit) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
    FROM hits),
per_user AS (
    SELECT t.user_id, n.n,
           sum(hit * so_far / pos) AS ps,
           sum(CASE WHEN pos <= {k} THEN hit * so_far / pos ELSE 0 END) AS ps_k,
           sum(CASE WHEN pos <= {k} THEN hit / ln(pos + 1) ELSE 0 END) AS dcg
    FROM terms t JOIN n_labels n ON t.user_id = n.user_id GROUP BY t.user_id, n.n),
scored_users AS (
    SELECT ps / n AS ap, ps_k / least(n, {k}) AS ap_k,
           dcg / (SELECT sum(1 / ln(j + 1)) FROM range(1, least(n, {k}) + 1) r(j)) AS ndcg
    FROM per_user),
m AS (
    SELECT count(*) AS users, round(avg(ap), 12) AS map, round(avg(ap_k), 12) AS map_at_k,
           round(avg(ndcg), 12) AS ndcg_at_k FROM scored_users)
SELECT {cols} FROM m"""

    o["map_all"] = metrics_sql(K, "users, map")
    o["map_at_k"] = metrics_sql(K, "users, map_at_k")
    o["ndcg_at_k"] = metrics_sql(K, "users, ndcg_at_k")
    o["ranking_metrics_at_10"] = metrics_sql(10, "users, map, map_at_k, ndcg_at_k")

    o["plays_f2_sql"] = o["plays_f2"]
    o["sink_scores"] = o["minmax_x100"]
    sides = _with(
        *_prep(),
        _CTE_SHARES,
        _cte_scored(100.0),
        split80,
        "train AS (SELECT * FROM split WHERE dataset = 'train')",
        "validation AS (SELECT * FROM split WHERE dataset = 'validation')",
    )
    o["sink_train"] = sides + f"SELECT {_SCORE_COLS} FROM train"
    o["als_warm_pairs"] = sides + """SELECT user_id, track_new_id FROM validation
WHERE user_id IN (SELECT user_id FROM train) AND track_new_id IN (SELECT track_new_id FROM train)"""

    def shape_sql(owner: str, other: str, subset: bool) -> str:
        only = f" WHERE {owner} IN (SELECT {owner} FROM validation)" if subset else ""
        return sides + f"""SELECT {owner}, n AS n_rows, 1 AS min_pos, n AS max_pos, true AS non_increasing
FROM (SELECT DISTINCT {owner} FROM train{only}), (SELECT least({K}, count(DISTINCT {other})) AS n FROM train)"""

    for name, subset in (("", False), ("_subset", True)):
        o[f"als_list_shape_items{name}"] = shape_sql("user_id", "track_new_id", subset)
        o[f"als_list_shape_users{name}"] = shape_sql("track_new_id", "user_id", subset)
    n_alphas, n_ranks = len(ALPHAS), len(RANKS)
    o["grid_points"] = sides + f"""SELECT CAST((i * {n_ranks} + j) * {n_alphas} + l AS INTEGER) AS grid_index,
       CAST(({list(REG_PARAMS)})[i + 1] AS DOUBLE) AS reg_param, CAST(({list(RANKS)})[j + 1] AS INTEGER) AS rank,
       CAST(({list(ALPHAS)})[l + 1] AS DOUBLE) AS alpha, CAST(i * {n_ranks} + j AS INTEGER) AS model_index,
       (SELECT count(DISTINCT user_id) FROM validation WHERE user_id IN (SELECT user_id FROM train)) AS users
FROM range({len(REG_PARAMS)}) a(i), range({n_ranks}) b(j), range({n_alphas}) c(l)"""
    o["best_rule"] = scored100 + """SELECT track_new_id AS grid_index, count(*) AS metric FROM scored
GROUP BY track_new_id ORDER BY metric DESC, grid_index LIMIT 1"""
    factors = _with(_CTE_PLAYS["f2"], """predicted AS (
    SELECT user_id, item AS track_new_id, plays,
           list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) AS prediction
    FROM (SELECT user_id, CAST(substr(recording_msid, 6) AS BIGINT) AS item, CAST(count(*) AS DOUBLE) AS plays
          FROM plays GROUP BY ALL)
    JOIN embeddings u ON u.vec_id = user_id
    JOIN embeddings i ON i.vec_id = item)""")
    o["factor_predict"] = factors + "SELECT user_id, track_new_id, plays, round(prediction, 9) AS prediction FROM predicted"
    o["factor_rmse"] = factors + """SELECT count(*) AS rows, round(sqrt(avg((plays - prediction) * (plays - prediction))), 9) AS rmse
FROM predicted"""

    def top_sql(owner: str, other: str, only: str = "", unseen: str = "", fx: str = "f2") -> str:
        """All products of users and items, the best of each owner kept."""
        return _with(_cte_catalog("f2"), _CTE_PLAYS[fx], f"""rated AS (
    SELECT u.vec_id AS user_id, i.vec_id AS track_new_id,
           round(list_dot_product(CAST(u.embedding AS DOUBLE[]), [CAST(x AS DOUBLE) * (i.label + 1) FOR x IN i.embedding]), 9) AS rating
    FROM embeddings u, embeddings i)""") + f"""SELECT {owner}, CAST(row_number() OVER best AS INTEGER) AS pos, {other}, rating
FROM rated WHERE true{only}{unseen}
WINDOW best AS (PARTITION BY {owner} ORDER BY rating DESC, {other}) QUALIFY pos <= {TOP}"""

    o["topk_items"] = top_sql("user_id", "track_new_id")
    o["topk_users"] = top_sql("track_new_id", "user_id")
    o["topk_items_subset"] = top_sql("user_id", "track_new_id", " AND user_id IN (SELECT user_id FROM plays)", fx="f1")
    o["topk_users_subset"] = top_sql(
        "track_new_id", "user_id", " AND track_new_id IN (SELECT CAST(substr(recording_msid, 6) AS BIGINT) FROM catalog)"
    )
    o["topk_exclude_seen"] = top_sql(
        "user_id",
        "track_new_id",
        unseen=" AND (user_id, track_new_id) NOT IN (SELECT (user_id, CAST(substr(recording_msid, 6) AS BIGINT)) FROM plays)",
    )
    o["als_certificate"] = sides + "SELECT user_id, count(*) AS n_ratings, true AS solved FROM train GROUP BY user_id"
    for name, owner, other in (("items", "user_id", "track_new_id"), ("users", "track_new_id", "user_id")):
        o[f"als_lists_exact_{name}"] = sides + f"""SELECT {owner}, least({K}, (SELECT count(DISTINCT {other}) FROM train)) AS n_rows,
       true AS own_ratings, true AS best_ratings, true AS no_repeats FROM (SELECT DISTINCT {owner} FROM train)"""
    o["split_by_score_80"] = scored100 + f"""SELECT {_SCORE_COLS},
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY normalized_ranking DESC, track_new_id)
                 <= floor(count(*) OVER (PARTITION BY user_id) * 0.8::DOUBLE) THEN 'train' ELSE 'validation' END AS dataset
FROM scored"""
    o["minmax_fit_on_train"] = _with(
        *_prep(),
        _CTE_SHARES,
        "known AS (SELECT user_id, track_new_id, share AS ranking FROM shares WHERE track_new_id IS NOT NULL)",
        "halves AS (" + _split_sql("known", 0.8, "user_id, track_new_id, ranking") + ")",
        """fitted AS (
    SELECT user_id, min(ranking) AS low, max(ranking) AS high FROM halves WHERE dataset = 'train' GROUP BY user_id)""",
    ) + """SELECT h.user_id, track_new_id, ranking, dataset,
       CASE WHEN low < high THEN least(greatest((ranking - low) / (high - low), 0), 1) * 100 END AS normalized_ranking
FROM halves h LEFT JOIN fitted f ON h.user_id = f.user_id"""
    sizes = {
        "ordered_80": "scored",
        "by_score_80": "scored",
        "hash_70": "scored WHERE normalized_ranking > 0",
        "zero_after": "scored WHERE normalized_ranking > 0",
        "raw_share": "shares WHERE share > 0 AND user_id IS NOT NULL",
        "rows_80": "lineitem JOIN orders ON l_orderkey = o_orderkey",
        "duplicates": "events WHERE user_id IS NOT NULL",
    }
    o["split_laws"] = scored100 + "\nUNION ALL ".join(
        f"SELECT '{name}' AS variant, count(*) AS n_rows, 0::BIGINT AS n_different, 0::BIGINT AS n_overlap FROM {rows}"
        for name, rows in sizes.items()
    )
    o["plays_csv"] = o["plays_f2"]
    o["sink_validation"] = sides + f"SELECT {_SCORE_COLS} FROM validation"
    return o


# --------------------------------------------------------------------------
# driver entry points
# --------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship on sf0.001: plays -> item ids -> x100 scores -> 80/20 split
    -> ALS (rank 100, 5 iterations) -> top-100 for validation users ->
    one row of MAP, MAP@100, NDCG@100 and RMSE."""
    return q_als_metrics(spark, FLAGSHIP_DIR)


def _llm() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and oracle SQL of the training-data operators, where that subpackage is installed."""
    found, sql = {}, {}
    try:
        from playlens.llm.queries import ORACLE_SQL, QUERIES
    except ModuleNotFoundError as e:
        if e.name not in ("playlens.llm", "playlens.llm.queries"):
            raise
        return found, sql
    found |= QUERIES
    sql |= ORACLE_SQL
    try:
        import corpus_pipeline
    except ModuleNotFoundError as e:
        if e.name != "corpus_pipeline":
            raise
        return found, sql
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _llm()[0]


def oracle_sql() -> dict[str, str]:
    return _oracles() | _llm()[1]
