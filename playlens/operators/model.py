"""ALS factor model (MLlib) with explicit seeds, blocks and checkpoints."""

from __future__ import annotations

import threading
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions.columns import checked_int
from playlens.operators.als import HalfStep
from playlens.session import ensure_checkpoint_dir, scratch_path

DEFAULT_SEED = 52

# MLlib draws the starting factors block by block, so the block counts belong
# to the model like the seed: fixed here, never taken from the cluster.
USER_BLOCKS = 10
ITEM_BLOCKS = 10


# Ratings times the square of the rank from which the fit takes its own half
# steps: six copies of sf0.1 with rank 100 take as long either way on 8 cores.
LARGE_FIT = 1 << 34


def als_input(df: DataFrame, user_col: str, item_col: str, rating_col: str) -> DataFrame:
    """Ratings with int ids (overflow fails) and a double rating."""
    return df.select(
        checked_int(user_col, user_col).alias(user_col),
        checked_int(item_col, item_col).alias(item_col),
        F.col(rating_col).cast("double").alias(rating_col),
    )


def make_als(
    rank: int = 10,
    max_iter: int = 5,
    reg_param: float = 1.0,
    alpha: float = 1.0,
    implicit: bool = False,
    seed: int = DEFAULT_SEED,
    user_col: str = "user_id",
    item_col: str = "track_new_id",
    rating_col: str = "normalized_ranking",
    num_user_blocks: int = USER_BLOCKS,
    num_item_blocks: int = ITEM_BLOCKS,
    checkpoint_interval: int = 10,
    cold_start: str = "drop",
) -> ALS:
    """An ALS estimator; ``rank`` must be a positive whole number.

    The result follows from the data, the seed and both block counts (up to
    float rounding), on any number of cores.  More blocks spread a larger
    factor table over more tasks; every rating task keeps
    ``num_user_blocks * num_item_blocks`` builders, so raise them with the
    number of users and items, not of cores.
    """
    if int(rank) != rank or rank < 1:
        raise ValueError(f"rank must be a positive integer, got {rank!r}")
    return ALS(
        rank=int(rank),
        maxIter=int(max_iter),
        regParam=float(reg_param),
        alpha=float(alpha),
        implicitPrefs=implicit,
        seed=int(seed),
        userCol=user_col,
        itemCol=item_col,
        ratingCol=rating_col,
        numUserBlocks=int(num_user_blocks),
        numItemBlocks=int(num_item_blocks),
        checkpointInterval=checkpoint_interval,
        coldStartStrategy=cold_start,
    )


class FitInputs:
    """What the fits of a search share, made once: ratings, starting factors of a rank and seed, ratings dealt to blocks.

    Fits may run in several threads.  ``release`` ends the search.
    """

    def __init__(self):
        self._lock, self._made = threading.Lock(), {}

    def once(self, key: tuple, build):
        """``build()``, once for the key."""
        with self._lock:
            lock, made = self._made.setdefault(key, (threading.Lock(), []))
        with lock:
            if not made:
                made.append(build())
        return made[0]

    def release(self) -> None:
        for (what, *_), (_, made) in self._made.items():
            for x in made:
                if what == "rated":
                    x[0].unpersist()
                elif what == "step":
                    x.release()
        self._made.clear()


def fit_als(train: DataFrame, shared: FitInputs | None = None, **params) -> ALSModel:
    """Fit ALS on ``train``.

    MLlib checks the ratings and draws the starting factors (its model after
    no iteration); the iterations of the explicit model are the half steps
    of ``als.py``, whose factors equal MLlib's up to float rounding.  They
    are written beside the checkpoints after every half step, so no lineage
    grows.  The implicit model and one without regularisation are MLlib's,
    and so is a small one, for which half steps cost more than they save.

    ``shared`` belongs to one ``train``: fits that get the same object do
    what their parameters have in common once.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    als = make_als(**params)
    given = als_input(train, als.getUserCol(), als.getItemCol(), als.getRatingCol())
    if als.getImplicitPrefs() or als.getRegParam() <= 0 or als.getMaxIter() == 0:
        return als.fit(given)
    inputs = shared or FitInputs()
    columns = (als.getUserCol(), als.getItemCol(), als.getRatingCol())

    def rate():
        rated = given.select(*columns[:2], F.col(columns[2]).cast("float").alias("r")).persist(StorageLevel.MEMORY_AND_DISK)
        return rated, rated.count()

    def begin():
        start = scratch_path(spark, f"als-{uuid.uuid4().hex}")
        als.copy({als.maxIter: 0, als.ratingCol: "r"}).fit(rated).save(start)
        return start

    try:
        rated, n = inputs.once(("rated", *columns), rate)
        if n * als.getRank() ** 2 < LARGE_FIT:
            return als.copy({als.ratingCol: "r"}).fit(rated)
        blocks = (als.getNumUserBlocks(), als.getNumItemBlocks(), als.getSeed())
        start = inputs.once(("start", als.getRank(), *blocks, *columns), begin)
        sides = {"itemFactors": ("source", "target", "r"), "userFactors": ("target", "source", "r")}
        steps = {
            name: inputs.once(("step", name, als.getRank(), *columns), lambda: HalfStep(rated.toDF(*names), als.getRank()))
            for name, names in sides.items()
        }
        path = start
        if shared is not None:  # others begin with the same factors
            path = scratch_path(spark, f"als-{uuid.uuid4().hex}")
            ALSModel.load(start).save(path)
        factors = spark.read.parquet(f"{start}/userFactors")
        for _ in range(als.getMaxIter()):
            for name, step in steps.items():
                factors = step.solve(factors, als.getRegParam(), f"{path}/{name}", f"{path}-sums")
    finally:
        if shared is None:
            inputs.release()
    return ALSModel.load(path)


def timed_fit(train: DataFrame, **params) -> tuple[ALSModel, float]:
    """Fit and wall-clock seconds of the fit alone.

    The input is cached and counted first; a cache of the caller's is used
    and kept, one made here is released.
    """
    own = not train.is_cached
    cached = train.cache() if own else train
    try:
        cached.count()
        t0 = time.perf_counter()
        model = fit_als(cached, **params)
        return model, time.perf_counter() - t0
    finally:
        if own:
            cached.unpersist()


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``pairs`` plus the model's ``prediction``.

    Users or items the model does not know are dropped, which is what
    ``coldStartStrategy="drop"`` does.  Values equal ``model.transform`` up
    to its single-precision rounding.
    """
    return predict_factors(model.userFactors, model.itemFactors, pairs, model.getUserCol(), model.getItemCol())


def predict_factors(
    user_factors: DataFrame,
    item_factors: DataFrame,
    pairs: DataFrame,
    user_col: str = "user_id",
    item_col: str = "track_new_id",
) -> DataFrame:
    """``pairs`` plus ``prediction`` = dot product of the user's and the item's factors.

    The factor tables are (``id``, ``features``).  Two equi-joins and a
    built-in ``aggregate(zip_with(...))`` (JVM-side, no UDF), summed in
    double; pairs without factors on either side are dropped.
    """
    users = user_factors.select(F.col("id").alias(user_col), F.col("features").alias("_uf"))
    items = item_factors.select(F.col("id").alias(item_col), F.col("features").alias("_if"))
    dot = F.aggregate(
        F.zip_with("_uf", "_if", lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    both = pairs.join(users, user_col, "inner").join(items, item_col, "inner")
    return both.select(*pairs.columns, dot.alias("prediction"))


def _norm(vector) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


#: Factors that a task of the certificate holds at most, for each side.
BLOCK_BYTES = 32 << 20
#: Ratings whose terms are computed at a time.
SLICE_RATINGS = 1 << 14

_SUMS = "user int, found long, size double, sum array<double>"


def _sums_of_block(ratings: pa.Table, factors: pa.Table) -> pa.Table:
    """Per user: number of ratings, the sum of their terms and of the terms' lengths."""
    side, ids = factors["side"].to_numpy(), factors["id"].to_numpy()
    column = factors["features"].combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
    matrix = flat.reshape(len(column), len(flat) // max(1, len(column)))
    order = np.lexsort((ids, side))
    n_users = int(np.count_nonzero(side == 0))
    at_user, at_item = order[:n_users], order[n_users:]

    def places(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
        known = ids[rows]
        at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
        return np.where(known[at] == values, at, -1) if len(known) else np.full(len(values), -1)

    u, v = places(ratings["user"].to_numpy(), at_user), places(ratings["item"].to_numpy(), at_item)
    both = np.flatnonzero((u >= 0) & (v >= 0))
    both = both[np.argsort(u[both], kind="stable")]
    u, v, r = u[both], v[both], ratings["r"].to_numpy(zero_copy_only=False)[both]
    total, size = np.zeros((n_users, matrix.shape[1])), np.zeros(n_users)
    for i in range(0, len(u), SLICE_RATINGS):
        s = slice(i, i + SLICE_RATINGS)
        items = matrix[at_item[v[s]]].astype(np.float64)
        told = np.einsum("ij,ij->i", items, matrix[at_user[u[s]]].astype(np.float64))
        first = np.flatnonzero(np.diff(u[s], prepend=-1))
        lengths = np.sqrt(np.einsum("ij,ij->i", items, items)) * (np.abs(told) + np.abs(r[s]))
        total[u[s][first]] += np.add.reduceat(items * (told - r[s])[:, None], first)
        size[u[s][first]] += np.add.reduceat(lengths, first)
    found = np.bincount(u, minlength=n_users)
    use = np.flatnonzero(found)
    starts = np.arange(len(use) + 1, dtype=np.int32) * total.shape[1]
    return pa.table(
        {
            "user": pa.array(ids[at_user[use]], type=pa.int32()),
            "found": pa.array(found[use], type=pa.int64()),
            "size": pa.array(size[use], type=pa.float64()),
            "sum": pa.ListArray.from_arrays(starts, pa.array(total[use].ravel(), type=pa.float64())),
        }
    )


def _normal_sums(user_factors: DataFrame, item_factors: DataFrame, ratings: DataFrame) -> DataFrame:
    """``_SUMS`` rows for the ``(user, item, r)`` of ``ratings`` with factors on both sides; a heavy user has several."""
    known = ratings.where("user IS NOT NULL AND item IS NOT NULL")
    rank = item_factors.select(F.size("features").alias("n")).first()
    block = max(1, BLOCK_BYTES // (4 * (rank["n"] if rank else 1)))
    per_user = known.groupBy("user").agg(F.count(F.lit(1)).alias("n"))
    blocks = max(1, -(-known.count() // block))
    # Fewer than ``blocks`` users hold more than a block's ratings each.
    heavy = per_user.where(F.col("n") > block).select("user", F.ceil(F.col("n") / block).alias("parts"))
    salt = F.pmod(F.xxhash64("item"), F.coalesce("parts", F.lit(1)))
    a = F.pmod(F.xxhash64("user", salt), F.lit(blocks)).cast("int").alias("a")
    dealt = known.join(F.broadcast(heavy), "user", "left").select("user", "item", "r", a)

    def wanted(factors: DataFrame, col: str, side: int) -> DataFrame:
        ids = dealt.select(F.col(col).alias("id"), "a").distinct()
        held = ids.join(factors.where("features IS NOT NULL"), "id").select("a", F.lit(side), "id", "features")
        return held.toDF("to", "side", "id", "features")

    factors = wanted(user_factors, "user", 0).unionAll(wanted(item_factors, "item", 1))
    return dealt.groupBy("a").cogroup(factors.groupBy("to")).applyInArrow(_sums_of_block, _SUMS)


#: How far the user factors may be from solving their equations, relative to the size of the terms: they are floats.
CERTIFICATE_TOLERANCE = 1e-5


def als_certificate(
    user_factors: DataFrame,
    item_factors: DataFrame,
    train: DataFrame,
    reg_param: float,
    user_col: str = "user_id",
    item_col: str = "track_new_id",
    rating_col: str = "normalized_ranking",
    tolerance: float = CERTIFICATE_TOLERANCE,
) -> DataFrame:
    """``(user, n_ratings, residual, solved)``: whether each user's factors solve their least squares.

    Explicit ALS ends with an exact solution for the users: with V the
    factors of a user's n items and r its ratings, the user's factors u
    satisfy ``(V'V + reg_param n I) u = V'r``.  ``residual`` is the length of
    ``V'(Vu - r) + reg_param n u`` over the sum of its terms' lengths, and
    ``solved`` tells whether it is at most ``tolerance``.  A user without
    factors, or with an item without, is not solved (its residual is NULL).

    The ratings are dealt to blocks of users.  Factors travel once to every
    block that rates with them, so what is shuffled grows with the ratings
    and never exceeds one vector for each; a task holds the factors of
    ``BLOCK_BYTES / (4 rank)`` ratings.  Users with more ratings than that
    are dealt to several blocks, whose sums are added.
    """
    ratings = als_input(train, user_col, item_col, rating_col).select(
        user_col, item_col, F.col(rating_col).cast("float").cast("double").alias("_r")
    )
    users = user_factors.select(F.col("id").alias(user_col), F.col("features").alias("_uf"))
    partial = _normal_sums(user_factors, item_factors, ratings.toDF("user", "item", "r"))
    sums = partial.groupBy(F.col("user").alias(user_col)).agg(
        Summarizer.sum(array_to_vector("sum")).alias("_sum"), F.sum("size").alias("_size"), F.sum("found").alias("_found")
    )
    counts = ratings.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_ratings"))
    weight = F.lit(float(reg_param)) * F.col("n_ratings")
    rest = F.zip_with(vector_to_array("_sum"), "_uf", lambda a, x: a + weight * x.cast("double"))
    whole = counts.join(sums, user_col, "left").join(users, user_col, "left")
    measured = whole.withColumn(
        "residual",
        F.when(F.col("_found") == F.col("n_ratings"), F.try_divide(_norm(rest), F.col("_size") + weight * _norm("_uf"))),
    )
    # No terms at all (ratings and factors of 0) leave nothing to solve.
    still = F.col("residual").isNull() & (F.col("_found") == F.col("n_ratings")) & (F.col("_size") == 0)
    return measured.select(
        user_col, "n_ratings", "residual", F.coalesce(F.col("residual") <= tolerance, still, F.lit(False)).alias("solved")
    )


def predict_mllib(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """MLlib's own ``transform`` (float predictions, per-row UDF)."""
    return model.transform(pairs)
