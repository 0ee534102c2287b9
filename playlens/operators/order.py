"""Positions in a global order over several columns.

``row_number() OVER (ORDER BY ...)`` without a partition runs in a single
task.  ``global_positions`` numbers rows of any order in parallel:

1. rows are range-partitioned by the order's columns and sorted inside each
   partition.  A number of the row in the input is the last sort key, so
   rows that tie (a third of the table may) still spread over ranges;
2. a reliable checkpoint fixes the ranges, which come from a sample, and the
   order inside each partition, also where a task is run again;
3. a row's place inside its partition is in the lower bits of
   ``monotonically_increasing_id``; partition sizes (one row for each
   partition, broadcast under that bound) give the offsets.

With ``per`` the order starts with group columns and positions start anew
in every group.  Sizes are then kept for each partition and group, and a
row finds its offset by an equi-join on both: a group that holds most rows
lies in many partitions, so that join has no hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.operators.ids import POSITION_BITS
from playlens.session import cut_lineage


def global_positions(
    df: DataFrame,
    order: Sequence[Column],
    pos_col: str = "position",
    per: Sequence[str] = (),
    size_col: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """``df`` plus the 1-based position of every row in ``order``.

    ``per`` names group columns: positions count inside each group (NULL is a
    group like any other).  ``size_col`` adds the number of rows of the group,
    or of the table without ``per``.  Rows that tie in ``order`` get different
    positions; which of them comes first follows their place in the input.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(c).asc_nulls_first() for c in per], *order, F.col("_tie").asc()]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *keys)
    fixed = cut_lineage(ranged.sortWithinPartitions(*keys).drop("_tie"))

    placed = fixed.withColumn("_mid", F.monotonically_increasing_id()).withColumns(
        {
            "_part": F.shiftright("_mid", POSITION_BITS),
            "_place": F.col("_mid").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)),
        }
    )
    sizes = placed.groupBy("_part", *per).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    group = Window.partitionBy(*per) if per else Window.partitionBy()
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(per)],
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_offset"),
        F.sum("_n").over(group).alias("_size"),
    )
    match = F.col("_part") == F.col("_p")
    for i, c in enumerate(per):
        match = match & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    # Without groups there is one row for each partition: a proven bound.
    joined = placed.join(offsets if per else F.broadcast(offsets), match)
    extra = [F.col("_size").alias(size_col)] if size_col else []
    return joined.select(*df.columns, (F.col("_offset") + F.col("_place") + 1).alias(pos_col), *extra)
