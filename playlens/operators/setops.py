"""Multiset laws of a labelled split, by signed counts in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that ``left`` and ``right`` (same columns) hold unequally often, with ``surplus``.

    ``surplus`` is the number of copies in ``left`` less those in ``right``;
    an empty result means equal multisets.  Copies are counted by partial
    aggregates; NULLs are values like any other.
    """
    signed = left.withColumn("surplus", F.lit(1)).unionByName(right.withColumn("surplus", F.lit(-1)))
    return signed.groupBy(*left.columns).agg(F.sum("surplus").alias("surplus")).where("surplus <> 0")


def split_laws(given: DataFrame, labelled: DataFrame, label_col: str = "dataset") -> DataFrame:
    """One row: ``n_rows``, ``n_different``, ``n_overlap`` of a split of ``given`` into two sides.

    ``n_different`` counts the distinct rows that the two sides together
    hold more or less often than ``given``: their union is the input where
    it is 0.  ``n_overlap`` counts the copies that lie on both sides but not
    as often in the input (the intersection is empty where it is 0).
    """
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    train = F.when(F.col(label_col) == "train", one).otherwise(zero)
    told = given.select(*given.columns, one.alias("_in"), zero.alias("_train"), zero.alias("_other")).unionByName(
        labelled.select(*given.columns, zero.alias("_in"), train.alias("_train"), (one - train).alias("_other"))
    )
    counts = told.groupBy(*given.columns).agg(*[F.sum(c).alias(c) for c in ("_in", "_train", "_other")])
    both = F.col("_train") + F.col("_other")
    return counts.agg(
        F.coalesce(F.sum("_in"), zero).alias("n_rows"),
        F.count_if(F.col("_in") != both).alias("n_different"),
        F.coalesce(F.sum(F.greatest(F.least("_train", "_other", both - F.col("_in")), zero)), zero).alias("n_overlap"),
    )
