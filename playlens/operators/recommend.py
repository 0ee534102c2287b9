"""Top-k lists: from a fitted ALS model, or per user from a scored table.

Model lists are those of MLlib's ``recommendFor*`` calls, scored in larger
blocks with far less to shuffle (``lists.py``).  They are returned in long
form ``(user, pos, item, rating)``; ``pos`` is the list position, 1-based.
For evaluation only the users that have labels need lists, so the subset
calls are preferred.

``top_k_per_group`` ranks rows of a table inside each group with
``row_number`` and keeps the first k; Spark plans that as a
``WindowGroupLimit`` that keeps k rows per group before and after the
shuffle, so a very large group costs k rows of state, not the group.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.operators.lists import best_lists


def _lists(model: ALSModel, k: int, of_users: bool, only: DataFrame | None) -> DataFrame:
    """``(owner, recommendations)`` as MLlib shapes them; ``only`` holds the owners to list."""
    sides = [(model.userFactors, model.getUserCol()), (model.itemFactors, model.getItemCol())]
    (owners, owner_col), (others, other_col) = sides if of_users else sides[::-1]
    if only is not None:
        owners = owners.join(only.select(F.col(owner_col).alias("id")).distinct(), "id", "left_semi")
    return best_lists(owners, others, k, model.rank, owner_col, other_col)


def _long(recs: DataFrame, owner_col: str, other_col: str) -> DataFrame:
    return recs.select(owner_col, F.posexplode("recommendations").alias("_p", "_r")).select(
        F.col(owner_col),
        (F.col("_p") + F.lit(1)).cast("int").alias("pos"),
        F.col(f"_r.{other_col}").alias(other_col),
        F.col("_r.rating").alias("rating"),
    )


def recommend_items(model: ALSModel, k: int, users: DataFrame | None = None) -> DataFrame:
    """Top-k items per user, ``(user, pos, item, rating)``; all users or a subset."""
    user_col, item_col = model.getUserCol(), model.getItemCol()
    return _long(_lists(model, k, True, users), user_col, item_col)


def recommend_users(model: ALSModel, k: int, items: DataFrame | None = None) -> DataFrame:
    """Top-k users per item, ``(item, pos, user, rating)``; all items or a subset."""
    user_col, item_col = model.getUserCol(), model.getItemCol()
    return _long(_lists(model, k, False, items), item_col, user_col)


def recommendation_ids(model: ALSModel, k: int, users: DataFrame | None = None) -> DataFrame:
    """``(user, items array<int>)``: the recommended ids only (k per user, bounded); all users or a subset."""
    user_col, item_col = model.getUserCol(), model.getItemCol()
    recs = _lists(model, k, True, users)
    return recs.select(user_col, F.col(f"recommendations.{item_col}").alias(item_col))


def top_k_per_group(df: DataFrame, group_col: str, order: list[Column], k: int, pos_col: str = "pos") -> DataFrame:
    """The first k rows of each group in ``order``, with their position."""
    w = Window.partitionBy(group_col).orderBy(*order)
    return df.withColumn(pos_col, F.row_number().over(w)).where(F.col(pos_col) <= F.lit(k))
