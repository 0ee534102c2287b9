"""Global positions: equal to a single-task row number, on ties, groups and hot keys."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from playlens.operators.order import global_positions


def rows(spark, n=2000):
    return spark.range(n).select(
        F.when(F.col("id") % 11 > 0, F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 7 > 0, (F.col("id") * 7919) % 101).alias("a"),
        F.col("id").alias("b"),
    )


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_equals_row_number(spark, parts):
    order = [F.col("a").desc_nulls_last(), F.col("b").asc()]
    got = global_positions(rows(spark).repartition(7), order, num_partitions=parts)
    want = rows(spark).withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("long"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_positions_per_group(spark):
    order = [F.col("a").asc_nulls_first(), F.col("b").asc()]
    got = global_positions(rows(spark).repartition(5), order, per=["g"], size_col="n", num_partitions=16)
    w = Window.partitionBy("g")
    want = rows(spark).withColumn("position", F.row_number().over(w.orderBy(*order)).cast("long")).withColumn(
        "n", F.count(F.lit(1)).over(w)
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_ties_spread_over_partitions(spark):
    """One key in all rows: positions are complete and no partition holds them all."""
    same = spark.range(10_000).select(F.lit(1).alias("a")).repartition(8)
    got = global_positions(same, [F.col("a").asc()], num_partitions=8)
    assert [r.position for r in got.orderBy("position").collect()] == list(range(1, 10_001))
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 4_000


def test_empty(spark):
    got = global_positions(rows(spark).where("b < 0"), [F.col("b").asc()], per=["g"], size_col="n")
    assert got.columns == ["g", "a", "b", "position", "n"] and got.count() == 0
