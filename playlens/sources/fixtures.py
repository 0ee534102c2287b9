"""Interaction and catalog tables derived from the given TPC-H-like tables.

The workload expects two inputs: a play log ``(user_id, recording_msid)``
and a track catalog ``(recording_msid, recording_mbid)`` where the mbid
groups several msids that are the same recording.  The given tables are
mapped onto that shape (see FIXTURES.md):

* catalog: one row per part; ``msid-<partkey>``; the mbid is
  ``mbid-<partkey mod M>`` except for every third part, which has none;
  parts whose key ends in 9 are absent, so some plays have no catalog row.
* F1 plays: ``events`` -- the user and the ``k`` field of ``props``.
* F2 plays: ``lineitem`` joined to ``orders`` -- the customer and the part.

All of these are plain projections, filters and one equi-join, so they
are pushed into the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.sources.tables import read_table

# Fixed values of the fixture mapping (FIXTURES.md): alias modulus per
# fixture, the part-key residue that is left out of the catalog, and the
# residue class without an mbid.
ALIAS_MODULUS = {"f1": 40, "f2": 97}
MISSING_DIGIT = 9
NO_MBID_EVERY = 3


def catalog(spark: SparkSession, base_dir: str, fixture: str = "f2") -> DataFrame:
    """Track catalog ``(recording_msid, recording_mbid)`` for a fixture."""
    modulus = ALIAS_MODULUS[fixture]
    key = F.col("p_partkey")
    return (
        read_table(spark, base_dir, "part", ["p_partkey"])
        .where(key % 10 != MISSING_DIGIT)
        .select(
            F.concat(F.lit("msid-"), key.cast("string")).alias("recording_msid"),
            F.when(key % NO_MBID_EVERY == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("mbid-"), (key % modulus).cast("string")))
            .alias("recording_mbid"),
        )
    )


def plays_f1(spark: SparkSession, base_dir: str) -> DataFrame:
    """F1 play log from ``events``: one row per event."""
    return read_table(spark, base_dir, "events", ["user_id", "props"]).select(
        F.col("user_id"),
        F.concat(F.lit("msid-"), F.get_json_object("props", "$.k")).alias("recording_msid"),
    )


def plays_f2(spark: SparkSession, base_dir: str) -> DataFrame:
    """F2 play log from ``lineitem`` x ``orders``: one row per line item."""
    lines = read_table(spark, base_dir, "lineitem", ["l_orderkey", "l_partkey"])
    orders = read_table(spark, base_dir, "orders", ["o_orderkey", "o_custkey"])
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner").select(
        F.col("o_custkey").alias("user_id"),
        F.concat(F.lit("msid-"), F.col("l_partkey").cast("string")).alias("recording_msid"),
    )


def plays(spark: SparkSession, base_dir: str, fixture: str = "f2") -> DataFrame:
    return plays_f1(spark, base_dir) if fixture == "f1" else plays_f2(spark, base_dir)
