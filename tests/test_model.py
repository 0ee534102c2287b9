"""ALS model laws: seeded determinism, dot-product predictions, alpha inert,
cold rows dropped, subset top-k equal to full top-k restricted, grid choice."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from playlens.functions.columns import checked_int
from playlens.operators.metrics import ranking_metrics
from playlens.operators.listcheck import check_lists
from playlens.operators.model import als_certificate, fit_als, make_als, predict, predict_mllib, timed_fit
from playlens.operators.recommend import recommend_items, recommend_users, top_k_per_group
from playlens.operators.tuning import best_by, distinct_models, param_grid
from playlens.operators.split import side
from playlens.plans.evaluate import evaluate_model, labels_of, single_run
from playlens.plans.search import grid_search

PARAMS = dict(rank=8, max_iter=3, reg_param=0.1, seed=3)


@pytest.fixture(scope="module")
def sets(spark, sf_small):
    import __spark_entry__ as E

    s = E._split80(spark, sf_small).cache()
    return side(s, "train").cache(), side(s, "validation").cache()


@pytest.fixture(scope="module")
def model(sets):
    return fit_als(sets[0], **PARAMS)


def _factors(m):
    return sorted((r.id, tuple(r.features)) for r in m.userFactors.collect())


def test_same_seed_same_factors(sets, model):
    again = fit_als(sets[0], **PARAMS)
    assert _factors(again) == _factors(model)


def test_alpha_is_inert_in_explicit_mode(sets, model):
    other = fit_als(sets[0], alpha=1000.0, **PARAMS)
    assert _factors(other) == _factors(model)


def test_prediction_is_dot_product(sets, model):
    pred = predict(model, sets[1]).limit(50).collect()
    uf = {r.id: r.features for r in model.userFactors.collect()}
    vf = {r.id: r.features for r in model.itemFactors.collect()}
    assert pred
    for r in pred:
        dot = sum(a * b for a, b in zip(uf[r.user_id], vf[r.track_new_id]))
        assert r.prediction == pytest.approx(dot, rel=1e-4, abs=1e-4)


def test_predict_equals_mllib_transform(sets, model):
    key = ["user_id", "track_new_id"]
    ours = {tuple(r[k] for k in key): r.prediction for r in predict(model, sets[1]).collect()}
    ref = {tuple(r[k] for k in key): r.prediction for r in predict_mllib(model, sets[1]).collect()}
    assert ours.keys() == ref.keys() and ours
    for k in ours:
        assert ours[k] == pytest.approx(ref[k], rel=1e-5, abs=1e-5)


def test_cold_rows_dropped(spark, model):
    pairs = spark.createDataFrame([(-1, 1, 1.0), (1, -5, 1.0)], "user_id int, track_new_id int, normalized_ranking double")
    assert predict(model, pairs).count() == 0
    assert predict_mllib(model, pairs).count() == 0


def test_subset_topk_equals_full_restricted(sets, model):
    users = sets[1].select("user_id").distinct()
    full = recommend_items(model, 5).join(users, "user_id")
    sub = recommend_items(model, 5, users)
    key = ["user_id", "pos", "track_new_id"]
    assert sorted(full.select(key).collect()) == sorted(sub.select(key).collect())
    items = sets[1].select("track_new_id").distinct()
    full_u = recommend_users(model, 5).join(items, "track_new_id").select("track_new_id", "user_id")
    sub_u = recommend_users(model, 5, items).select("track_new_id", "user_id")
    assert sorted(full_u.collect()) == sorted(sub_u.collect())


def test_topk_positions(model):
    recs = recommend_items(model, 7)
    per_user = recs.groupBy("user_id").agg(F.max("pos").alias("m"), F.count(F.lit(1)).alias("n"))
    assert per_user.where("m != n").count() == 0
    ordered = recs.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("pos", "rating"))).alias("s"))
    for r in ordered.limit(20).collect():
        ratings = [x.rating for x in r.s]
        assert ratings == sorted(ratings, reverse=True)


def test_rank_must_be_whole():
    with pytest.raises(ValueError):
        make_als(rank=10.5)
    assert make_als(rank=10.0).getRank() == 10


def test_grid_dedupes_alpha_and_best_is_first_max(spark):
    grid = param_grid([0.1, 10], [5, 6], [0.1, 10, 100])
    assert len(grid) == 12 and len(distinct_models(grid)) == 4
    assert len(distinct_models(grid, implicit=True)) == 12
    res = spark.createDataFrame([(0, 0.5), (1, 0.7), (2, 0.7), (3, 0.1)], "grid_index int, ndcg_at_k double")
    assert best_by(res, "ndcg_at_k").first().grid_index == 1


def test_top_k_per_group_bounds(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = top_k_per_group(df, "g", [F.col("v").desc()], 4)
    got = {(r.g, r.pos): r.v for r in out.collect()}
    assert got[(0, 1)] == 99 and got[(1, 1)] == 97 and len(got) == 12


FIT = """
import sys
sys.path.insert(0, {root!r})
from playlens.operators.model import fit_als
from playlens.session import build_session
spark = build_session(master="local[{cores}]", shuffle_partitions=4, driver_memory="2g")
df = spark.range(4000).selectExpr("CAST(id % 97 AS INT) user_id", "CAST(id * 7 % 61 AS INT) track_new_id",
                                  "CAST(id % 5 AS DOUBLE) normalized_ranking")
model = fit_als(df, rank=6, max_iter=3, reg_param=0.1, seed=3)
for r in sorted(model.userFactors.collect()):
    print("F", r.id, *[f"{{x:.9g}}" for x in r.features])
"""


def test_factors_do_not_depend_on_the_cores():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = []
    for cores in (2, 5):
        code = FIT.format(root=root, cores=cores)
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240, check=True).stdout
        found.append([[float(x) for x in line.split()[1:]] for line in out.splitlines() if line.startswith("F ")])
    assert len(found[0]) == 97 and len(found[1]) == 97
    for a, b in zip(*found):
        assert a == pytest.approx(b, rel=1e-3, abs=1e-4)


def test_timed_fit_releases_its_own_cache_only(sets):
    fresh = sets[0].where("track_new_id >= 0")
    timed_fit(fresh, **PARAMS)
    assert not fresh.is_cached
    timed_fit(sets[0], **PARAMS)
    assert sets[0].is_cached


def test_grid_search_keeps_the_callers_cache(sets):
    train, validation = sets
    fresh = train.where("track_new_id >= 0")
    out = grid_search(train, validation, (0.1,), (4,), (1.0, 2.0), k=5, max_iter=1)
    assert train.is_cached and validation.is_cached and out.count() == 2
    grid_search(fresh, validation, (0.1,), (4,), (1.0,), k=5, max_iter=1)
    assert not fresh.is_cached and validation.is_cached


def test_single_run_equals_fit_and_evaluate(sets, model):
    train, validation = sets
    run = single_run(train, validation, k=10, **PARAMS).first()
    for every in (False, True):
        row = evaluate_model(model, validation, 10, all_users=every).first()
        assert row.asDict() == pytest.approx(run.asDict(), rel=1e-9)
    known = predict(model, validation.select("user_id", "track_new_id", "normalized_ranking"))
    assert run["pairs"] == known.count() <= validation.count()


def test_ids_must_fit_an_int(spark):
    for bad in (-3_000_000_000, 3_000_000_000):
        df = spark.createDataFrame([(bad,)], "id long")
        with pytest.raises(Exception, match="does not fit"):
            df.select(checked_int("id", "id")).collect()
    df = spark.createDataFrame([(-(2**31),), (2**31 - 1,), (None,)], "id long")
    assert [r[0] for r in df.select(checked_int("id", "id")).collect()] == [-(2**31), 2**31 - 1, None]


def test_evaluation_equals_long_form_lists(sets, model):
    labels = labels_of(sets[1])
    long_form = ranking_metrics(recommend_items(model, 10), labels, 10).first().asDict()
    row = evaluate_model(model, sets[1], 10).first().asDict()
    assert {c: row[c] for c in long_form} == pytest.approx(long_form, rel=1e-12)


def test_certificate_holds_for_mllib_and_breaks_for_a_perturbed_user(spark, sets, model):
    train = sets[0]
    told = als_certificate(model.userFactors, model.itemFactors, train, PARAMS["reg_param"]).cache()
    n = {r.user_id: r["count"] for r in train.groupBy("user_id").count().collect()}
    assert {r.user_id: r.n_ratings for r in told.collect()} == n and all(r.solved for r in told.collect())
    some = sorted(n)[3]
    moved = F.transform("features", lambda x: (x * F.when(F.col("id") == some, F.lit(1.001)).otherwise(F.lit(1.0))).cast("float"))
    off = als_certificate(model.userFactors.withColumn("features", moved), model.itemFactors, train, PARAMS["reg_param"])
    assert [r.user_id for r in off.collect() if not r.solved] == [some]
    wrong_reg = als_certificate(model.userFactors, model.itemFactors, train, 2 * PARAMS["reg_param"])
    assert not all(r.solved for r in wrong_reg.collect())
    missing = als_certificate(model.userFactors.where(F.col("id") != some), model.itemFactors, train, PARAMS["reg_param"])
    assert [(r.user_id, r.residual) for r in missing.collect() if not r.solved] == [(some, None)]


@pytest.mark.parametrize("side_of", ["items", "users"])
def test_list_check_sees_swapped_missing_and_repeated_rows(spark, model, side_of):
    if side_of == "items":
        lists, own, other, cols = recommend_items(model, 10), model.userFactors, model.itemFactors, ("user_id", "track_new_id")
    else:
        lists, own, other, cols = recommend_users(model, 10), model.itemFactors, model.userFactors, ("track_new_id", "user_id")
    owners = sorted(r.id for r in own.collect())[:4]
    lists, own = lists.where(F.col(cols[0]).isin(owners)).cache(), own.where(F.col("id").isin(owners))
    flags = lambda df: {r[0]: tuple(r)[1:] for r in check_lists(df, own, other, 10, *cols).collect()}
    good = (10, True, True, True)
    assert flags(lists) == dict.fromkeys(owners, good)
    at = F.when(F.col(cols[0]) == owners[0], F.when(F.col("pos") == 1, 9).when(F.col("pos") == 9, 1).otherwise(F.col("pos"))).otherwise(F.col("pos"))
    swapped = lists.withColumn("pos", at.cast("int"))
    assert flags(swapped) == dict.fromkeys(owners, good) | {owners[0]: (10, True, False, True)}
    traded = swapped.select(cols[0], "pos", cols[1]).join(lists.select(cols[0], "pos", "rating"), [cols[0], "pos"])
    assert flags(traded)[owners[0]][:3] == (10, False, True)  # the right ratings beside the wrong names
    assert flags(lists.where(f"NOT ({cols[0]} = {owners[1]} AND pos = 4)"))[owners[1]] == (9, False, False, True)
    assert flags(lists.where(f"{cols[0]} <> {owners[2]}"))[owners[2]] == (0, False, False, True)
    worst = lists.withColumn(cols[1], F.when(F.col("pos") == 2, F.first(cols[1]).over(Window.partitionBy(cols[0]).orderBy("pos"))).otherwise(F.col(cols[1])))
    assert not any(f[3] for f in flags(worst).values())


def test_list_check_in_waves_tells_the_same(spark, model, monkeypatch):
    from playlens import session
    from playlens.operators import listcheck

    lists = recommend_items(model, 10).where("NOT (user_id % 5 = 0 AND pos = 3)")
    told = lambda: sorted(map(tuple, check_lists(lists, model.userFactors, model.itemFactors, 10).collect()))
    whole = told()
    monkeypatch.setattr(session, "WAVE_BYTES", 1 << 14)
    assert listcheck.waves_of_owners(model.userFactors.count(), model.itemFactors.count(), 10, 8) > 1
    assert told() == whole and {r[1] for r in whole} == {9, 10}


def test_a_half_step_in_waves_gives_the_same_factors(spark, tmp_path, monkeypatch):
    from playlens import session
    from playlens.operators import als

    rows = [(t, s, float((t * 7 + s) % 5)) for t in range(400) for s in range(40) if (t * s) % 3 == 0 or t == 5]
    ratings = spark.createDataFrame(rows, "target int, source int, r float")
    factors = spark.createDataFrame([(i, [float((i * k) % 7) for k in (2, 3)]) for i in range(40)], "id int, features array<float>")
    monkeypatch.setattr(als, "SMALLEST_BLOCK", 700)
    for given in (ratings, ratings.selectExpr("source AS target", "target AS source", "r")):  # without heavy targets, and with them
        sources = factors if given is ratings else spark.range(400).selectExpr("CAST(id AS INT) AS id", "array(CAST(id % 7 AS FLOAT), CAST(id % 5 AS FLOAT)) AS features")
        found = []
        for size in (4 << 30, 600):
            monkeypatch.setattr(session, "WAVE_BYTES", size)
            step = als.HalfStep(given, 2)
            found.append((step.waves, step.n_heavy, sorted(map(tuple, step.solve(sources, 0.1, f"{tmp_path}/f", f"{tmp_path}/s").collect()))))
            step.release()
        assert found[0][0] == 1 < found[1][0] and found[0][1:] == found[1][1:] and len(found[0][2]) == given.select("target").distinct().count()


def test_every_list_of_the_model_is_checked(spark, sf_small):
    import __spark_entry__ as E

    fitted = E._model(spark, sf_small)
    sides = {"user_id": (E.q_als_lists_exact_items, fitted.userFactors), "track_new_id": (E.q_als_lists_exact_users, fitted.itemFactors)}
    for owner, (query, factors) in sides.items():
        told = query(spark, sf_small).collect()
        assert sorted(r[owner] for r in told) == sorted(r.id for r in factors.collect())
        assert all(r.own_ratings and r.best_ratings and r.no_repeats for r in told)


def test_grid_goes_on_after_a_lost_driver(spark, sets, tmp_path, monkeypatch):
    """Two models are committed, the third fit fails; the second search fits the rest only."""
    from playlens.plans import search

    fits, real = [], search.fit_als

    def counting(train, **params):
        if len(fits) == limit:
            raise RuntimeError("driver lost")
        fits.append((params["reg_param"], params["rank"]))
        return real(train, **params)

    monkeypatch.setattr(search, "fit_als", counting)
    args = dict(reg_params=(0.1, 1.0), ranks=(2, 3), alphas=(1.0, 2.0), k=5, max_iter=1, seed=3)
    limit = 2
    with pytest.raises(RuntimeError):
        grid_search(*sets, store=str(tmp_path / "store"), **args)
    assert len(fits) == 2
    limit = None
    again = grid_search(*sets, store=str(tmp_path / "store"), **args)
    assert len(fits) == 4 and len(set(fits)) == 4
    rows = lambda df: sorted(map(tuple, df.drop("fit_sec").collect()))
    fits.clear()
    assert rows(grid_search(*sets, store=str(tmp_path / "store"), **args)) == rows(again) and not fits
    assert rows(grid_search(*sets, **args)) == rows(again) and len(fits) == 4
    fits.clear()
    grid_search(sets[0].where("user_id <> 1"), sets[1], store=str(tmp_path / "store"), **{**args, "ranks": (2,)})
    assert len(fits) == 2  # other data, other models


def test_certificate_in_blocks_equals_the_equations(spark, monkeypatch):
    """Small blocks, a user heavier than a block, repeated ratings and missing factors."""
    import numpy as np

    from playlens.operators import model as M

    rng = np.random.default_rng(2)
    items, users = (rng.normal(size=(n, 3)).astype(np.float32) for n in (40, 12))
    rated = [(u, int(i), float(rng.random())) for u in range(12) for i in rng.integers(0, 40, size=200 if u == 4 else 9)] + [(1, 2, 0.5)] * 3
    reg, want = 0.5, {}
    for u in range(12):
        mine = [(i, np.float32(r)) for v, i, r in rated if v == u]
        v, r = items[[i for i, _ in mine]].astype(float), np.array([r for _, r in mine], dtype=float)
        if u == 7:  # solved to the last bits of its floats
            users[u] = np.linalg.solve(v.T @ v + reg * len(r) * np.eye(3), v.T @ r)
        told = v @ users[u].astype(float)
        size = (np.linalg.norm(v, axis=1) * (abs(told) + abs(r))).sum() + reg * len(r) * np.linalg.norm(users[u].astype(float))
        want[u] = (len(r), np.linalg.norm(v.T @ (told - r) + reg * len(r) * users[u].astype(float)) / size)
    frame = lambda m: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<float>")
    train = spark.createDataFrame(rated + [(50, 1, 1.0), (7, 99, 1.0)], "user_id int, track_new_id int, normalized_ranking double")
    for size in (M.BLOCK_BYTES, 12 * 25):  # 25 ratings to a block
        monkeypatch.setattr(M, "BLOCK_BYTES", size)
        told = lambda t: {r.user_id: (r.n_ratings, r.residual, r.solved) for r in M.als_certificate(frame(users), frame(items), t, reg).collect()}
        got = told(train.where("track_new_id <> 99"))
        assert got.pop(50) == (1, None, False)
        assert {u: v[0] for u, v in got.items()} == {u: v[0] for u, v in want.items()}
        assert {u: v[1] for u, v in got.items()} == pytest.approx({u: v[1] for u, v in want.items()}, rel=1e-6, abs=1e-7)
        assert [u for u, v in got.items() if v[2]] == [7]
        assert told(train)[7] == (10, None, False)  # an item without factors


def _close(found, expected):
    assert [i for i, _ in found] == [i for i, _ in expected] and found
    for (_, a), (_, b) in zip(found, expected):
        assert a == pytest.approx(b, rel=1e-4, abs=1e-5)


def test_factors_are_those_of_mllib(spark, monkeypatch):
    """Users with few and many ratings, repeated pairs, and a heavy item and user whose ratings lie in several blocks."""
    from playlens.operators import als, model as module

    rows = [(u, i, float((u * 7 + i * 3) % 11)) for u in range(60) for i in range(25) if (u * i) % 3 == 0 or u == 7]
    rows += [(u, 99, float(u % 5)) for u in range(900)] + [(7, 100 + i, 2.0) for i in range(700)] + rows[:40]
    df = spark.createDataFrame(rows, "user_id int, track_new_id int, normalized_ranking double")
    monkeypatch.setattr(module, "LARGE_FIT", 0)
    monkeypatch.setattr(als, "SMALLEST_BLOCK", 700)
    made = []

    class Step(als.HalfStep):
        def __init__(self, *args):
            super().__init__(*args)
            made.append((self.n_heavy, self.n_light))

    monkeypatch.setattr(module, "HalfStep", Step)
    params = dict(rank=8, max_iter=2, reg_param=0.1, seed=3)
    ours, theirs = fit_als(df, **params), make_als(**params).fit(df)
    assert [heavy for heavy, _ in made] == [1, 1] and all(light > 1 for _, light in made)
    assert (ours.rank, ours.getUserCol(), ours.getItemCol()) == (8, "user_id", "track_new_id")
    for a, b in ((ours.userFactors, theirs.userFactors), (ours.itemFactors, theirs.itemFactors)):
        a, b = (sorted((r.id, tuple(r.features)) for r in df.collect()) for df in (a, b))
        assert [i for i, _ in a] == [i for i, _ in b]
        for (_, x), (_, y) in zip(a, b):
            assert x == pytest.approx(y, rel=1e-4, abs=1e-5)


def test_a_half_step_leaves_no_shuffle_files(spark, tmp_path):
    from glob import glob

    from playlens.operators.als import HalfStep
    from playlens.session import CLEANUP

    rows = [(t, s, float((t * 7 + s) % 5)) for t in range(60) for s in range(30) if (t * s) % 3 == 0]
    step = HalfStep(spark.createDataFrame(rows, "target int, source int, r float"), 4)
    factors = spark.createDataFrame([(i, [float(i % k) for k in (2, 3, 5, 7)]) for i in range(30)], "id int, features array<float>")
    jvm = spark._jvm
    folder = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folder for f in glob(f"{d}/*/shuffle_*")}
    before = spark.conf.get(CLEANUP)
    first = step.solve(factors, 0.1, f"{tmp_path}/first", f"{tmp_path}/sums")
    kept = files()
    again = step.solve(factors, 0.1, f"{tmp_path}/again", f"{tmp_path}/sums")
    assert files() <= kept
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect())) and first.count() == 60
    assert spark.conf.get(CLEANUP) == before
    step.release()


def test_a_search_deals_the_ratings_of_a_rank_once(spark, monkeypatch):
    """Six fits, two ranks: starting factors twice, dealt ratings twice a side; models as of separate fits."""
    from pyspark.ml.recommendation import ALS

    from playlens.operators import model as module
    from playlens.plans import search

    rows = [(u, i, float((u * 7 + i * 3) % 11)) for u in range(40) for i in range(25) if (u * i) % 3 == 0]
    train = spark.createDataFrame(rows, "user_id int, track_new_id int, normalized_ranking double")
    validation = train.where("(user_id + track_new_id) % 4 = 0")
    monkeypatch.setattr(module, "LARGE_FIT", 0)
    dealt, begun, models = [], [], {}

    class Step(module.HalfStep):
        def __init__(self, *args):
            super().__init__(*args)
            dealt.append(self.rank)

    def keeping(train, **params):
        models[params["reg_param"], params["rank"]] = found = fit_als(train, **params)
        return found

    def counting(als, *args, **params):
        begun.append(als.getRank())
        return fit(als, *args, **params)

    fit = ALS.fit
    monkeypatch.setattr(module, "HalfStep", Step)
    monkeypatch.setattr(ALS, "fit", counting)
    monkeypatch.setattr(search, "fit_als", keeping)
    args = dict(reg_params=(0.1, 1.0, 10.0), ranks=(2, 3), alphas=(1.0,), k=5, max_iter=2, seed=3, parallelism=3)
    assert grid_search(train, validation, **args).count() == 6
    assert sorted(dealt) == [2, 2, 3, 3] and sorted(begun) == [2, 3]
    for (reg, rank), found in models.items():
        assert _factors(found) == _factors(fit_als(train, reg_param=reg, rank=rank, max_iter=2, seed=3))
