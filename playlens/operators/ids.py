"""Item id dictionary (alias merge + dense ids) and re-keying of plays.

``dense_rank() OVER (ORDER BY key)`` without a partition runs in a single
task.  Here the same numbering is computed in parallel:

1. distinct keys, range-partitioned and sorted inside each partition
   (NULL first), then checkpointed so the ranges and the row order inside
   each partition are fixed even if a task is re-run;
2. every row's position inside its partition comes from
   ``monotonically_increasing_id`` (partition index in the upper bits,
   position in the lower 33 bits);
3. the partition sizes (one row per partition, a bounded table) give each
   partition's offset by a running sum; that table is broadcast.

id = offset(partition) + position + 1.  Ids are 1-based, gap-free, in key
order, and a key that does not fit in an int fails the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.columns import checked_int
from playlens.session import cut_lineage

POSITION_BITS = 33  # layout of monotonically_increasing_id


def dense_ids(
    keys: DataFrame,
    key_col: str,
    id_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """``(key, id)`` for the distinct values of ``key_col``, ids dense from 1.

    Same numbering as ``dense_rank() over (order by key nulls first)``.
    """
    spark = keys.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(key_col).asc_nulls_first()
    ranged = (
        keys.select(key_col)
        .distinct()
        .repartitionByRange(n, order)
        .sortWithinPartitions(order)
    )
    ranged = cut_lineage(ranged)

    positioned = ranged.withColumn("_mid", F.monotonically_increasing_id()).select(
        key_col,
        F.shiftright("_mid", POSITION_BITS).alias("_part"),
        F.col("_mid").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).alias("_pos"),
    )
    # One row per non-empty partition: bounded by n, safe to broadcast.
    sizes = positioned.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))

    return positioned.join(F.broadcast(offsets), "_part").select(
        key_col,
        checked_int(F.col("_offset") + F.col("_pos") + F.lit(1), id_col).alias(id_col),
    )


def build_item_ids(
    tracks: DataFrame,
    msid_col: str = "recording_msid",
    mbid_col: str = "recording_mbid",
    id_col: str = "track_new_id",
    num_partitions: int | None = None,
) -> DataFrame:
    """Catalog rows with ``unique_id = coalesce(mbid, msid)`` and a dense id.

    Aliases (msids sharing an mbid) get the same id; tracks without an
    mbid are their own item.  Output: ``tracks.*, unique_id, id_col``.
    """
    keyed = tracks.withColumn("unique_id", F.coalesce(F.col(mbid_col), F.col(msid_col)))
    dictionary = dense_ids(keyed, "unique_id", id_col, num_partitions).withColumnRenamed("unique_id", "_uid")
    return keyed.join(dictionary, keyed["unique_id"].eqNullSafe(dictionary["_uid"]), "inner").drop("_uid")


def rekey(
    plays: DataFrame,
    item_ids: DataFrame,
    user_col: str = "user_id",
    msid_col: str = "recording_msid",
    id_col: str = "track_new_id",
) -> DataFrame:
    """Attach dense item ids to plays; plays without a catalog row keep NULL.

    Left outer equi-join on the msid.  The join strategy is left to AQE
    (broadcast only when the catalog side is measured small at run time);
    a hot msid is split by AQE's skew-join handling.  User ids are cast
    to int, failing on overflow, as ALS requires.
    """
    ids = item_ids.select(msid_col, id_col)
    return plays.join(ids, msid_col, "left").select(
        checked_int(user_col, user_col).alias(user_col), F.col(msid_col), F.col(id_col)
    )


def unmatched(rekeyed: DataFrame, id_col: str = "track_new_id") -> DataFrame:
    """Plays that found no catalog row."""
    return rekeyed.where(F.col(id_col).isNull())
