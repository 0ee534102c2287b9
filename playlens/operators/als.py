"""Half steps of explicit ALS as Spark jobs: the same least squares as MLlib's, on blocks bounded in memory.

MLlib builds a ``rank x rank`` matrix for every user and item, however few
ratings they have, and works in as many tasks as the model has blocks.  Here
the ratings are dealt to blocks by the side that is solved, the other side's
factors travel once to every block that needs them, and a task solves its
users (or items) in batches:

* one with n <= rank ratings through its ``n x n`` system: with V its n
  factors, ``(V'V + c I)^-1 V'r = V'(VV' + c I)^-1 r``;
* one with more through the ``rank x rank`` system;
* a *heavy* one's ratings are dealt by the other side instead: every block
  sends the sums ``V'V`` and ``V'r`` of its part, which are added and solved.

All sums are in double precision and in the order of the ids, so the factors
do not depend on partitioning; like MLlib's they are rounded to float.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens import session
from playlens.session import shuffles_deleted

#: Factors that a block of ratings needs at most: one vector for each rating.
BLOCK_BYTES = 256 << 20
#: Blocks that the ratings are cut into at least, where the table is not tiny.
BLOCKS = 24
SMALLEST_BLOCK = 1 << 13
#: Gathered factors (in double precision) of a batch.
BATCH_BYTES = 8 << 20

_SOLVED = "id int, n long, features array<float>, sums array<double>"
_FACTORS = "id int, features array<float>"


def _lists(rows: np.ndarray, of: pa.DataType) -> pa.Array:
    starts = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(starts, pa.array(rows.ravel(), type=of))


def _solve(first: np.ndarray, counts: np.ndarray, at: np.ndarray, r: np.ndarray, matrix: np.ndarray, reg: float) -> np.ndarray:
    """Factors of the targets whose ratings are ``first`` to ``first + counts``, of the vectors ``matrix[at]``."""
    rank = matrix.shape[1]
    out = np.empty((len(first), rank), dtype=np.float32)
    order = np.argsort(counts, kind="stable")
    sizes = counts[order]
    few, i = int(np.searchsorted(sizes, rank, side="right")), 0
    while i < few:
        # Targets of about as many ratings; missing ones are vectors of 0, which change nothing.
        width = int(min(sizes[i] + sizes[i] // 8, rank))
        j = min(int(np.searchsorted(sizes, width, side="right")), i + max(1, BATCH_BYTES // (8 * rank * width)))
        rows = order[i:j]
        place = np.arange(int(sizes[j - 1]))
        there = place < counts[rows][:, None]
        place = np.where(there, first[rows][:, None] + place, 0)
        v = matrix[at[place]].astype(np.float64)
        v[~there] = 0.0
        system = v @ v.transpose(0, 2, 1)
        system[:, np.arange(system.shape[1]), np.arange(system.shape[1])] += (reg * counts[rows])[:, None]
        x = np.linalg.solve(system, np.where(there, r[place], 0.0)[:, :, None])
        out[rows] = (v.transpose(0, 2, 1) @ x)[:, :, 0]
        i = j
    for t in order[few:]:
        out[t] = _solve_sums(*_sums(at[first[t] : first[t] + counts[t]], r[first[t] : first[t] + counts[t]], matrix), reg * counts[t])
    return out


def _sums(at: np.ndarray, r: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``V'V`` and ``V'r``."""
    rank = matrix.shape[1]
    square, told, batch = np.zeros((rank, rank)), np.zeros(rank), max(1, BATCH_BYTES // (8 * rank))
    for i in range(0, len(at), batch):
        v = matrix[at[i : i + batch]].astype(np.float64)
        square += v.T @ v
        told += v.T @ r[i : i + batch]
    return square, told


def _solve_sums(square: np.ndarray, told: np.ndarray, weight: float) -> np.ndarray:
    return np.linalg.solve(square + weight * np.eye(len(told)), told)


def _block(rank: int, reg: float, n_light: int):
    """Solves a block of ratings; blocks from ``n_light`` on hold parts of heavy targets."""
    upper = np.triu_indices(rank)

    def solve(key: tuple, ratings: pa.Table, factors: pa.Table) -> pa.Table:
        ids, column = factors["id"].to_numpy(), factors["features"].combine_chunks()
        matrix = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), rank)
        target, source, r = (ratings[c].to_numpy() for c in ("target", "source", "r"))
        by = np.lexsort((r, source, target))
        target, source, r = target[by], source[by], r[by].astype(np.float64)
        order = np.argsort(ids, kind="stable")
        at = order[np.searchsorted(ids, source, sorter=order)]
        first = np.flatnonzero(np.diff(target, prepend=target[0] - 1)) if len(target) else np.empty(0, dtype=np.int64)
        counts = np.diff(first, append=len(target))
        light = key[0].as_py() < n_light
        if light:
            features, sums = _lists(_solve(first, counts, at, r, matrix, reg), pa.float32()), pa.nulls(len(first), pa.list_(pa.float64()))
        else:
            rows = np.empty((len(first), len(upper[0]) + rank))
            for i, (f, n) in enumerate(zip(first, counts)):
                square, told = _sums(at[f : f + n], r[f : f + n], matrix)
                rows[i] = np.concatenate([square[upper], told])
            features, sums = pa.nulls(len(first), pa.list_(pa.float32())), _lists(rows, pa.float64())
        return pa.table(
            {"id": pa.array(target[first], type=pa.int32()), "n": pa.array(counts, type=pa.int64()), "features": features, "sums": sums}
        )

    return solve


def _whole(rank: int, reg: float):
    """Solves a heavy target from the sums of its parts."""
    upper = np.triu_indices(rank)

    def solve(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("part")
        rows = parts["sums"].combine_chunks().flatten().to_numpy().reshape(len(parts), -1)
        total = rows.sum(axis=0)
        square = np.zeros((rank, rank))
        square[upper] = total[:-rank]
        square = square + np.triu(square, 1).T
        found = _solve_sums(square, total[-rank:], reg * int(np.sum(parts["n"].to_numpy())))
        return pa.table({"id": parts["id"][:1], "features": _lists(found.astype(np.float32)[None, :], pa.float32())})

    return solve


class HalfStep:
    """The ratings of one side's targets, dealt to blocks once; ``solve`` is called in every iteration, of any fit of the rank.

    ``ratings`` is ``(target int, source int, r float)``, repeated pairs
    included.  A block has about ``BLOCK_BYTES / (4 rank)`` ratings.  Targets
    with at least ``2 rank`` ratings for every block are heavy: there are
    fewer than ``BLOCK_BYTES / (8 rank^2)`` of them, and their sums are
    smaller than the vectors that they stand for.
    """

    def __init__(self, ratings: DataFrame, rank: int):
        self.rank = rank
        total, limit = ratings.count(), max(1, BLOCK_BYTES // (4 * rank))
        n = max(1, -(-total // limit), min(BLOCKS, -(-total // SMALLEST_BLOCK)))
        heavy = ratings.groupBy("target").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2 * rank * max(n, 32))
        held = heavy.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        self.n_heavy, of_heavy = held
        self.n_light = max(1, -(-(total - of_heavy) * n // total))
        n_parts = max(1, -(-of_heavy * n // total))
        to = F.pmod(F.xxhash64("target"), F.lit(self.n_light))
        if self.n_heavy:
            part = F.lit(self.n_light) + F.pmod(F.xxhash64("source"), F.lit(n_parts))
            ratings = ratings.join(F.broadcast(heavy), "target", "left")
            to = F.when(F.col("n").isNull(), to).otherwise(part)
        tasks = 2 * (self.n_light + (n_parts if self.n_heavy else 0))
        dealt = ratings.select(to.cast("int").alias("to"), "target", "source", "r").repartition(tasks, "to")
        self.dealt = dealt.persist(StorageLevel.MEMORY_AND_DISK)
        routes = self.dealt.groupBy(F.col("source").alias("id")).agg(F.collect_set("to").alias("to"))
        self.routes = routes.persist(StorageLevel.MEMORY_AND_DISK)
        self.waves = 1
        if total * 4 * rank > session.WAVE_BYTES:  # a vector for each rating, at most
            sent = self.routes.agg(F.coalesce(F.sum(F.size("to")), F.lit(0))).first()[0] * 4 * rank
            self.waves = min(self.n_light + n_parts, max(1, -(-sent // session.WAVE_BYTES)))

    def solve(self, factors: DataFrame, reg: float, path: str, scratch: str) -> DataFrame:
        """Writes ``(id, features)`` of the targets to ``path``, by the sources' ``factors``, and reads it again.

        What was shuffled for it is deleted at once, so that a fit needs the
        disk of one half step; one that sends more than ``WAVE_BYTES`` takes
        its blocks in waves, and needs the disk of one wave.
        """
        with shuffles_deleted(factors.sparkSession):
            return self._solve(factors, reg, path, scratch)

    def _found(self, factors: DataFrame, reg: float, wave: int) -> DataFrame:
        routes, dealt = self.routes, self.dealt
        if self.waves > 1:
            routes = routes.select("id", F.filter("to", lambda to: F.pmod(to, F.lit(self.waves)) == wave).alias("to"))
            dealt = dealt.where(F.pmod("to", F.lit(self.waves)) == wave)
        sent = factors.join(routes.where(F.size("to") > 0), "id").select(F.explode("to").alias("to"), "id", "features")
        both = dealt.groupBy("to").cogroup(sent.groupBy("to"))
        return both.applyInArrow(_block(self.rank, reg, self.n_light), _SOLVED)

    def _solve(self, factors: DataFrame, reg: float, path: str, scratch: str) -> DataFrame:
        spark = factors.sparkSession
        for wave in range(self.waves):
            found = self._found(factors, reg, wave)
            mode = "append" if wave else "overwrite"
            if self.n_heavy:
                found.write.mode(mode).parquet(scratch)
            else:
                found.select("id", "features").write.mode(mode).parquet(path)
        if self.n_heavy:
            found = spark.read.schema(_SOLVED).parquet(scratch)
            parts = found.where("sums IS NOT NULL")
            # Sums are added in an order of their own, so that no bit depends on the order of arrival.
            parts = parts.select("id", "n", "sums", F.xxhash64("n", "sums").alias("part"))
            heavy = parts.groupBy("id").applyInArrow(_whole(self.rank, reg), _FACTORS)
            found.where("sums IS NULL").select("id", "features").unionAll(heavy).write.mode("overwrite").parquet(path)
        return spark.read.schema(_FACTORS).parquet(path)

    def release(self) -> None:
        self.routes.unpersist()
        self.dealt.unpersist()
