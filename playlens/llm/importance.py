"""Importance resampling towards a target, ranked by a parallel sort with regular samples.

Features are runs of consecutive words, hashed to a fixed number of
buckets.  What the corpus and the target hold in each bucket is counted over
all texts; the logarithm of the ratio is the bucket's gain, and a text's
weight is the mean gain of its features, taken from the array of gains.
Adding Gumbel noise, drawn from a hash of the id, to the weight makes the
highest scores a sample without replacement.

The highest scores need exact ranks over all documents.  ``sample_ranks``
sorts them in parallel: every input partition is a run, sorted by itself;
rows at regular places of the runs give the splitters; a run's rows are sent
to the segments between splitters, each of which merges what it gets; and
the sums of the segments' sizes before it give a segment's first rank.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import cut_lineage, free_names
from playlens.llm.decontamination import words_of

BUCKETS = 10_000
GAIN_SCALE = 1000.0
#: Rows at regular places for each segment, and in all; they are sorted on the driver.
SAMPLES_PER_SEGMENT = 64
MAX_SAMPLES = 1 << 20

_PLACE_BITS = 33  # layout of monotonically_increasing_id


def features(text: bytes, max_run: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the buckets of all runs of 1 to ``max_run`` words."""
    words = words_of(text)
    spaced = [b" " + w for w in words]
    runs = list(map(crc32, words))
    out = list(runs)
    for n in range(1, max_run):
        runs = list(map(crc32, spaced[n:], runs))  # a run's checksum goes on from that of its beginning
        out += runs
    return len(words), np.array(out, dtype=np.int64) % buckets


def bucket_counts(texts: DataFrame, text_col: str, max_run: int, buckets: int) -> np.ndarray:
    """Features in each bucket over all texts; at most one row for each bucket comes to the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                total += np.bincount(features(bytes(text), max_run, buckets)[1], minlength=buckets)
        filled = total.nonzero()[0]
        yield pd.DataFrame({"bucket": filled, "n": total[filled]})

    given = texts.where(F.col(text_col).isNotNull()).select(F.col(text_col).cast("binary").alias("text"))
    counted = given.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in counted.collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """Scaled log ratio of target to corpus share, smoothed by one in every bucket, rounded down."""
    buckets = len(corpus)
    s_all, t_all = float(corpus.sum()), float(target.sum())
    ratio = [(t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets)) for s, t in zip(corpus.tolist(), target.tolist())]
    return [math.floor(GAIN_SCALE * math.log(r)) for r in ratio]


def _weights(text: Column, gains: list[int], max_run: int) -> Column:
    @F.pandas_udf("n_words long, n_features long, weight long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = np.array(gains, dtype=np.int64)
        for texts in batches:
            rows = []
            for text in texts:
                n_words, found = features(bytes(text), max_run, len(table))
                rows.append((n_words, len(found), int(table[found].sum()) // len(found) if len(found) else 0))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])

    return of(F.coalesce(text, F.lit("")).cast("binary"))


def gumbel(name: Column, seed: int) -> Column:
    """Scaled Gumbel noise that follows from the seed and a name, rounded down."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(name.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(head, 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-GAIN_SCALE) * F.log(-F.log(u))).cast("long")


def sorted_runs(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """Every partition sorted by itself, and checkpointed: places must not change when a task is run again."""
    return cut_lineage(df.sortWithinPartitions(*_order(keys)))


def sample_ranks(
    runs: DataFrame,
    keys: Sequence[tuple[str, bool]],
    rank_col: str,
    segments: int | None = None,
    max_samples: int = MAX_SAMPLES,
) -> DataFrame:
    """``sorted_runs`` plus the 1-based rank of every row by ``keys``.

    ``keys`` are (column, ascending); falling ones are numbers, and nulls
    come last.  Rows that tie in all keys are told apart by their place in
    the runs, so a key that most rows share still spreads over segments.
    """
    run, place, segment, before = free_names(runs, "_run", "_place", "_segment", "_before")
    segments = segments or int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    placed = runs.select(
        "*", F.shiftright(mid, _PLACE_BITS).alias(run), mid.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias(place)
    )

    # Rows at regular places of the runs, and from them regular splitters.
    by = [*[c for c, _ in keys], run, place]
    ups = [*[up for _, up in keys], True, True]
    stride = max(1, -(-runs.count() // min(segments * SAMPLES_PER_SEGMENT, max_samples)))
    taken = placed.where((F.col(place) + F.col(run)) % stride == 0).select(*by)
    samples = sorted(_comparable(r, ups) for r in taken.collect())
    splitters = [samples[len(samples) * i // segments] for i in range(1, segments)] if len(samples) >= segments else samples[1:]

    @F.arrow_udf("int")
    def segment_of(*columns: pa.Array) -> pa.Array:
        rows = zip(*[c.to_pylist() for c in columns])
        return pa.array([bisect_right(splitters, _comparable(r, ups)) for r in rows], type=pa.int32())

    # The exchange, a merge in each segment, and the sizes of the segments before it: one row each.
    sent = placed.withColumn(segment, segment_of(*by))
    sizes = {r[0]: r[1] for r in sent.groupBy(segment).agg(F.count(F.lit(1))).collect()}
    offsets = np.cumsum([0] + [sizes.get(i, 0) for i in range(len(splitters) + 1)]).tolist()
    starts = runs.sparkSession.createDataFrame(list(enumerate(offsets)), f"{before} int, _start long")
    merged = Window.partitionBy(segment).orderBy(*_order(keys), run, place)
    ranked = sent.repartitionById(len(splitters) + 1, F.col(segment)).withColumn(rank_col, F.row_number().over(merged))
    return ranked.join(F.broadcast(starts), F.col(segment) == F.col(before)).select(
        *runs.columns, (F.col("_start") + F.col(rank_col)).alias(rank_col)
    )


def _order(keys: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in keys]


def _comparable(row: Sequence, ups: Sequence[bool]) -> tuple:
    """A row's keys as a tuple that sorts like the rows: falling numbers negated, nulls last."""
    return tuple((1, 0) if v is None or v != v else (0, v if up else -v) for v, up in zip(row, ups))


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    min_words: int = 20,
    max_run: int = 2,
    buckets: int = BUCKETS,
    seed: int = 7,
    text_col: str = "text",
    id_col: str = "doc_id",
    target_text_col: str = "text",
    segments: int | None = None,
) -> DataFrame:
    """One row for each document: ``id_col``, ``n_features``, ``weight``, ``score`` and ``rank`` (all long).

    Of the N documents of at least ``min_words`` words the ``floor(percent *
    N / 100)`` with the highest scores are drawn and ranked from 1; ``rank``
    is null for all others.  Ids are whole numbers.

    Defined cases: null, empty and wordless texts have no features and weight
    0; equal scores go by the smaller id, null ids last; rows that repeat an
    id with one score are ranked one after the other, the one of fewer
    features first; a null id draws its noise as the empty string; a text of
    any length is read whole; other columns are ignored, whatever their
    names.  An empty target leaves every weight at or near 0; an empty table
    gives an empty result.
    """
    corpus = bucket_counts(docs, text_col, max_run, buckets)
    gains = bucket_gains(corpus, bucket_counts(target, target_text_col, max_run, buckets))
    weighed = docs.select(F.col(id_col).alias("id"), _weights(F.col(text_col), gains, max_run).alias("w"))
    scored = weighed.select(
        "id",
        (F.col("w.n_words") >= min_words).cast("int").alias("eligible"),
        F.col("w.n_features").alias("n_features"),
        F.col("w.weight").alias("weight"),
        (F.col("w.weight") + gumbel(F.col("id"), seed)).alias("score"),
    )
    keys = [("eligible", False), ("score", False), ("id", True), ("n_features", True)]
    runs = sorted_runs(scored, keys)
    drawn = percent * runs.where("eligible = 1").count() // 100
    ranked = sample_ranks(runs, keys, "rank", segments)
    return ranked.select(
        F.col("id").alias(id_col), "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    )
