"""Train / validation splits.

``split_per_user`` puts the first ``trunc(fraction * n)`` rows of every
user (in a seeded hash order) into ``train`` and the rest into
``validation``.  The order is total: a md5 of the seed and the row, then the
row's columns, and rows that are equal in all columns are told apart by a
copy number, so the labels never depend on partitioning and the two sides
are disjoint and complete, also when they are computed apart.

Ranking rows inside a user with one window would put all of a heavy
user's rows into one task.  Instead:

* per-user sizes ``n`` and their total ``N`` (a scalar subquery);
* a user is *heavy* when ``n > R`` with ``R = max(rows_per_bucket,
  N / max_heavy)``.  Fewer than ``max_heavy`` users can be heavy, so the
  heavy table has a proven size bound and is broadcast;
* a heavy user's hash range is cut into ``ceil(n / R)`` contiguous buckets
  (``R`` rows each on average over the hash, not at most); every other user
  is one bucket.  Bucket offsets are needed for heavy users only: at most
  ``2 * max_heavy`` rows, broadcast as well;
* one shuffle of the rows by ``(user, bucket)``; ``row_number`` and the
  bucket count run inside each bucket.

The rows are ranked after one shuffle, in groups of about ``R`` rows however
they are spread over users.  A task may hold many such groups.  The sizes
read the input a second time: give the split a written or cached table.

``split_rows`` is the row-level split (``randomSplit``'s job), stable under
repartitioning: each row's side follows from the hash of its columns and its
copy number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.columns import HASH_SPACE, hash_bucket, hash_key, hash_prefix32, truncated_share
from playlens.operators.order import global_positions

DEFAULT_SEED = 52
ROWS_PER_BUCKET = 1_000_000
MAX_HEAVY = 100_000


def number_copies(df: DataFrame, copy_col: str) -> DataFrame:
    """``df`` with rows that are equal in all columns numbered 1, 2, ... in ``copy_col``.

    Copies are counted by partial aggregates and dealt out again, so a row
    that a third of the table repeats is no hot key.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copy_col))
    return counted.withColumn(copy_col, F.explode(F.sequence(F.lit(1).cast("long"), copy_col)))


def split_per_user(
    df: DataFrame,
    fraction: float,
    seed: int = DEFAULT_SEED,
    user_col: str = "user_id",
    item_col: str = "track_new_id",
    label_col: str = "dataset",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    max_heavy: int = MAX_HEAVY,
    unique_by: list[str] | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """``df`` plus ``label_col`` in {train, validation}; rows with a NULL user are dropped.

    ``order`` puts the rows of a user into the caller's order (newest last,
    best first) instead of the seeded hash order; see ``_split_in_order``.

    ``unique_by`` names columns of which no two rows share the values (a
    table of user and item pairs); they alone are hashed then, and copies
    need not be numbered, which saves a shuffle of the rows.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    cols = df.columns
    if order is not None:
        return _split_in_order(df, fraction, order, user_col, label_col)
    known = df.where(F.col(user_col).isNotNull())
    if unique_by is None:
        hashed = [*cols, "_copy"]
        known = number_copies(known, "_copy")
    else:
        hashed = unique_by
    keyed = known.withColumn("_key", hash_key(seed, *hashed))

    sizes = keyed.groupBy(user_col).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n").alias("_total")).scalar()
    bucket_rows = F.greatest(F.lit(int(rows_per_bucket)), F.ceil(total / F.lit(int(max_heavy))))
    # Fewer than max_heavy users can hold more than N / max_heavy rows each.
    heavy = sizes.where(F.col("_n") > bucket_rows).select(
        F.col(user_col),
        F.col("_n").alias("_heavy_n"),
        F.ceil(F.col("_n") / bucket_rows).cast("int").alias("_nb"),
    )
    # The key orders as bytes like its hex digits, in half the space.
    bucket = F.when(F.col("_nb").isNull(), F.lit(0)).otherwise(hash_bucket("_key", F.col("_nb")))
    rows = (
        keyed.join(F.broadcast(heavy), user_col, "left")
        .withColumn("_ub", F.struct(F.col(user_col).alias("u"), bucket.alias("b")))
        .withColumn("_key", F.unhex("_key"))
    )

    # Offsets of the buckets of heavy users: at most 2 * max_heavy rows.
    heavy_buckets = rows.where(F.col("_nb").isNotNull()).groupBy("_ub").agg(F.count(F.lit(1)).alias("_bn"))
    earlier = Window.partitionBy(F.col("_ub.u")).orderBy(F.col("_ub.b")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = heavy_buckets.select("_ub", F.coalesce(F.sum("_bn").over(earlier), F.lit(0)).alias("_offset"))

    in_bucket = Window.partitionBy("_ub").orderBy("_key", item_col, *[c for c in hashed if c != item_col])
    whole_bucket = in_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = rows.join(F.broadcast(offsets), "_ub", "left").select(
        *cols,
        (F.coalesce(F.col("_offset"), F.lit(0)) + F.row_number().over(in_bucket)).alias("_pos"),
        F.coalesce(F.col("_heavy_n"), F.count(F.lit(1)).over(whole_bucket)).alias("_n"),
    )
    return ranked.select(
        *cols,
        F.when(F.col("_pos") <= truncated_share("_n", fraction), F.lit("train"))
        .otherwise(F.lit("validation"))
        .alias(label_col),
    )


def _split_in_order(df: DataFrame, fraction: float, order: Sequence[Column], user_col: str, label_col: str) -> DataFrame:
    """The split with the rows of each user in ``order``.

    Hash ranges know nothing of such an order, so the rows are cut by ranges
    of (user, order) whose bounds come from a sample: a heavy user's rows
    fill several ranges, small users share one, and exact offsets give each
    row its position.  Rows that tie in ``order`` go by all other columns,
    so the labels don't depend on partitioning.
    """
    known = df.where(F.col(user_col).isNotNull())
    total = [*order, *[F.col(c).asc_nulls_first() for c in df.columns if c != user_col]]
    placed = global_positions(known, total, "_pos", per=[user_col], size_col="_n")
    first = F.col("_pos") <= truncated_share("_n", fraction)
    return placed.select(*df.columns, F.when(first, F.lit("train")).otherwise(F.lit("validation")).alias(label_col))


def split_rows(
    df: DataFrame,
    weights: tuple[float, ...] = (0.8, 0.2),
    seed: int = DEFAULT_SEED,
    labels: tuple[str, ...] = ("train", "validation"),
    label_col: str = "dataset",
) -> DataFrame:
    """Row-level split by hash of all columns and the copy number.

    A row goes to side ``i`` when ``u = prefix32(md5) / 2^32`` falls in the
    i-th interval of the normalised cumulative weights.  Rows are split
    independently: copies of one row spread over the sides by the weights.
    """
    if len(weights) != len(labels) or not weights or min(weights) < 0:
        raise ValueError("need one non-negative weight per label")
    total = float(sum(weights))
    numbered = number_copies(df, "_copy")
    u = hash_prefix32(hash_key(seed, *df.columns, "_copy")) / F.lit(float(HASH_SPACE))
    label = F.lit(labels[-1])
    bound = 0.0
    bounds = []
    for w in weights[:-1]:
        bound += w / total
        bounds.append(bound)
    for b, name in reversed(list(zip(bounds, labels[:-1]))):
        label = F.when(u < F.lit(b), F.lit(name)).otherwise(label)
    return numbered.withColumn(label_col, label).drop("_copy")


def side(df: DataFrame, name: str, label_col: str = "dataset") -> DataFrame:
    """One side of a labelled split, without the label."""
    return df.where(F.col(label_col) == name).drop(label_col)


def subsample_per_user(
    df: DataFrame,
    fraction: float,
    seed: int = DEFAULT_SEED,
    user_col: str = "user_id",
    item_col: str = "track_new_id",
    unique_by: list[str] | None = None,
) -> DataFrame:
    """The first ``trunc(fraction * n)`` rows of each user (hash order)."""
    split = split_per_user(df, fraction, seed, user_col, item_col, label_col="_side", unique_by=unique_by)
    return side(split, "train", "_side")
