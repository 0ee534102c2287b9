"""Conflict-constrained best-fit packing of documents into sequences.

Documents are cut into pieces of at most ``capacity`` tokens.  A full piece
is a sequence of its own; the rest are packed by best fit in decreasing
order.  Open bins are kept ordered by their residual capacity and carry two
bitmaps, of the sources and of the duplicate clusters they hold; the search
starts at the smallest residual that is large enough and goes on to the next
one until a bin shares neither with the piece, which is the tightest
compatible bin.

Packing is sequential, so pieces are dealt to shards by a hash of the
document, about ``shard_pieces`` to a shard however many there are, and a
task packs one shard at a time.  Only counts, hashes and ids are shuffled;
no text is.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import cut_lineage, lower_ascii, row_items, split_words

SHARD_PIECES = 2048


def best_fit(
    sizes: list[int], sources: list[int], clusters: list[int], capacity: int, one_per_source: bool = True
) -> tuple[list[int], list[int]]:
    """(bin, offset) of every piece, taken in the given order.

    ``sources`` and ``clusters`` are small numbers, the bits of the bitmaps.
    """
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    held_sources: list[int] = []
    held_clusters: list[int] = []
    bins, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = (1 << source if one_per_source else 0), 1 << cluster
        i = bisect_left(open_bins, (size, -1))
        while i < len(open_bins):
            b = open_bins[i][1]
            if not (held_sources[b] & s or held_clusters[b] & c):
                break
            i += 1
        if i < len(open_bins):
            residual, b = open_bins.pop(i)
        else:
            residual, b = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[b] |= s
        held_clusters[b] |= c
        if residual > size:
            insort(open_bins, (residual - size, b))
        bins.append(b)
        offsets.append(capacity - residual)
    return bins, offsets


def cluster_key(text: Column) -> Column:
    """Texts that are equal up to case (A-Z) and white space are one duplicate cluster."""
    return F.xxhash64(lower_ascii(F.array_join(split_words(text), " ")))


def pack(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    cluster_col: str | None = None,
    capacity: int = 2048,
    one_per_source: bool = True,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece: its document and place there, its sequence and place there.

    Columns: ``id_col``, ``text_key``, ``copy``, ``source``, ``cluster``,
    ``piece`` (from 0), ``start`` (first token in the document),
    ``n_tokens``, ``bin_id`` and ``bin_offset``.  Tokens are the words and
    one that ends the document.  No sequence holds more than ``capacity``
    tokens, two pieces of one duplicate cluster or, with ``one_per_source``,
    two of one source.  ``cluster_col`` names a long column of cluster ids;
    without it, texts equal up to case and white space are a cluster.

    Defined cases: null and empty texts have the one token that ends the
    document (and are one cluster); null sources are a source of their own,
    as are null clusters one cluster; rows that repeat an id and a text are
    told apart by ``copy``; pieces of equal size are packed in the order of
    their hashes.  Extra columns are ignored; an empty table gives an empty
    result.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    text = F.col(text_col)
    extra = {
        "source": F.col(source_col).cast("string"),
        "cluster": F.col(cluster_col).cast("long") if cluster_col else cluster_key(text),
        "tokens": F.size(split_words(text)).cast("long") + 1,
    }
    items = row_items(docs, extra, text_col, id_col).withColumn("last", F.floor((F.col("tokens") - 1) / capacity))
    pieces = cut_lineage(
        items.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        .withColumn("start", F.col("piece") * capacity)
        .withColumn("n_tokens", F.least(F.col("tokens") - F.col("start"), F.lit(capacity)))
        .withColumn("draw", F.xxhash64("id", "text_key", "copy", "piece"))
        .drop("tokens", "last")
    )
    kept = ["id", "text_key", "copy", "source", "cluster", "piece", "start", "n_tokens"]
    full = pieces.where(F.col("n_tokens") == capacity).select(
        *kept,
        F.concat_ws("-", F.lit("w"), F.hex("text_key"), F.coalesce(F.col("id").cast("string"), F.lit("")), "copy", "piece").alias("bin_id"),
        F.lit(0).cast("long").alias("bin_offset"),
    )
    part = pieces.where(F.col("n_tokens") < capacity)
    shards = max(1, -(-part.count() // shard_pieces))

    def pack_shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "draw", "text_key", "copy"], ascending=[False, True, True, True])
        sources = pd.factorize(rows["source"], use_na_sentinel=False)[0].tolist()
        clusters = pd.factorize(rows["cluster"], use_na_sentinel=False)[0].tolist()
        bins, offsets = best_fit(rows["n_tokens"].tolist(), sources, clusters, capacity, one_per_source)
        names = [f"s{shard}-{b}" for shard, b in zip(rows["shard"], bins)]
        return rows[kept].assign(bin_id=names, bin_offset=offsets)

    # Ids and clusters may be null; as text they pass through pandas unchanged.
    types = {c: part.schema[c].dataType for c in ("id", "cluster")}
    plain = part.withColumns({c: F.col(c).cast("string") for c in types})
    schema = plain.select(*kept).schema.add("bin_id", "string").add("bin_offset", "long")
    packed = plain.withColumn("shard", F.pmod("draw", F.lit(shards))).groupBy("shard").applyInPandas(pack_shard, schema)
    packed = packed.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    return packed.unionByName(full).withColumnRenamed("id", id_col)
