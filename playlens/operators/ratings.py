"""Play shares and min-max scores per user.

For each (user, item) the share is ``plays of item / plays of user``;
plays without an item id form a ``(user, NULL)`` row with 0 plays (they do
not count towards the total but pull the user's minimum share to 0).  The
min-max score is ``(share - min) / (max - min) * scale`` per user, NULL for
a user whose shares are all equal.

Instead of per-user windows (all of a heavy user's rows in one task),
shares are built from two aggregations with map-side partial combine and
one equi-join on the user:

* pairs:  (user, item) -> plays            (shuffle of partial counts)
* totals: user -> total, min, max plays    (shuffle of partial aggregates)
* pairs JOIN totals ON user                (AQE splits a hot user's rows)

``min(share) = min(plays) / total`` holds exactly in floating point because
division by the same positive total is monotone, so the scores equal the
window formulation bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions.columns import safe_ratio

ZERO_MODES = ("keep", "drop_before", "drop_after")


def play_counts(plays: DataFrame, user_col: str = "user_id", item_col: str = "track_new_id") -> DataFrame:
    """Distinct (user, item) pairs with ``count_pop`` (0 for a NULL item)."""
    return plays.groupBy(user_col, item_col).agg(F.count(item_col).alias("count_pop"))


def user_totals(counts: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Per user: total plays of known items, least and most plays of a pair."""
    return counts.groupBy(user_col).agg(
        F.sum("count_pop").alias("count_total"),
        F.min("count_pop").alias("min_pop"),
        F.max("count_pop").alias("max_pop"),
    )


def play_totals(plays: DataFrame, user_col: str = "user_id", item_col: str = "track_new_id") -> DataFrame:
    """``(user, item, count_pop, count_total, min_pop, max_pop)``: what shares and all min-max scores follow from."""
    counts = play_counts(plays, user_col, item_col)
    totals = user_totals(counts, user_col).withColumnRenamed(user_col, "_user")
    # Null-safe: plays of a NULL user form their own group, as in SQL windows.
    return counts.join(totals, counts[user_col].eqNullSafe(totals["_user"]), "inner").drop("_user")


def play_share(plays: DataFrame, user_col: str = "user_id", item_col: str = "track_new_id") -> DataFrame:
    """``(user, item, count_pop, count_total, ranking)``, one row per pair."""
    return share_of_totals(play_totals(plays, user_col, item_col), user_col, item_col)


def share_of_totals(totals: DataFrame, user_col: str = "user_id", item_col: str = "track_new_id") -> DataFrame:
    """``play_share`` of a table that ``play_totals`` gave."""
    return totals.select(
        user_col,
        item_col,
        "count_pop",
        "count_total",
        safe_ratio("count_pop", "count_total").alias("ranking"),
    )


def minmax_score(
    plays: DataFrame,
    scale: float = 100.0,
    zeros: str = "keep",
    user_col: str = "user_id",
    item_col: str = "track_new_id",
    score_col: str = "normalized_ranking",
) -> DataFrame:
    """Min-max scores per user, rows with any NULL removed.

    ``zeros="drop_before"`` also removes score-0 rows (a user's least
    played items); other modes keep them here and leave the decision to
    the split.  Min and max are taken before NULL rows are removed.
    """
    # NULL users only form their own group, so they can go before the
    # aggregation.  The other NULL conditions are folded into the score
    # (a CASE the optimizer does not push below the join), so both sides
    # of the pairs/totals join keep one identical subtree and the scan,
    # re-key join and pair aggregation run once (exchange reuse).
    totals = play_totals(plays.where(F.col(user_col).isNotNull()), user_col, item_col)
    return minmax_of_totals(totals, scale, zeros, user_col, item_col, score_col)


def minmax_of_totals(
    totals: DataFrame,
    scale: float = 100.0,
    zeros: str = "keep",
    user_col: str = "user_id",
    item_col: str = "track_new_id",
    score_col: str = "normalized_ranking",
) -> DataFrame:
    """``minmax_score`` of a table that ``play_totals`` gave: a projection and a filter, so variants share the table."""
    if zeros not in ZERO_MODES:
        raise ValueError(f"zeros must be one of {ZERO_MODES}")
    t = totals.where(F.col(user_col).isNotNull())
    ranking = safe_ratio("count_pop", "count_total")
    lo = safe_ratio("min_pop", "count_total")
    hi = safe_ratio("max_pop", "count_total")
    score = F.when(F.col(item_col).isNotNull(), F.try_divide(ranking - lo, hi - lo) * F.lit(float(scale)))
    scored = t.select(user_col, item_col, ranking.alias("ranking"), score.alias(score_col)).where(
        F.col(score_col).isNotNull()
    )
    if zeros == "drop_before":
        scored = scored.where(F.col(score_col) > 0)
    return scored


OUTSIDE = ("clip", "keep")


def fit_scaler(train: DataFrame, user_col: str = "user_id", value_col: str = "ranking") -> DataFrame:
    """Per-user scaler ``(user, low, high)`` from the train rows alone: one row for each user with a value."""
    known = train.where(F.col(user_col).isNotNull() & F.col(value_col).isNotNull())
    return known.groupBy(user_col).agg(F.min(value_col).alias("low"), F.max(value_col).alias("high"))


def apply_scaler(
    rows: DataFrame,
    scaler: DataFrame,
    scale: float = 100.0,
    outside: str = "clip",
    user_col: str = "user_id",
    value_col: str = "ranking",
    score_col: str = "normalized_ranking",
) -> DataFrame:
    """``rows`` plus the min-max score of ``value_col`` under a fitted ``scaler``.

    The rows may be ones that the scaler has not seen.  A value outside its
    user's fitted range scores 0 or ``scale`` (``outside="clip"``), or below
    0 or above ``scale`` (``"keep"``).  The score is NULL where the user has
    no fitted range, where that range is a single value, and for a NULL user
    or value; no row is dropped.

    The scaler has one row for each user and is joined on it, so a hot
    user's rows are split by AQE like those of any other equi-join.
    """
    if outside not in OUTSIDE:
        raise ValueError(f"outside must be one of {OUTSIDE}")
    fitted = scaler.select(F.col(user_col).alias("_user"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    share = F.try_divide(F.col(value_col) - F.col("_low"), F.col("_high") - F.col("_low"))
    if outside == "clip":
        # least and greatest skip NULLs, so a missing range is kept apart.
        share = F.when(share.isNotNull(), F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)))
    joined = rows.join(fitted, F.col(user_col) == F.col("_user"), "left")
    return joined.select(*rows.columns, (share * F.lit(float(scale))).alias(score_col))
