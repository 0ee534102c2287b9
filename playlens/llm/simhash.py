"""SimHash near-duplicates: fingerprints, pigeonhole blocks, components.

A fingerprint is the bitwise majority of the XXH64 values of a text's word
shingles.  To find all pairs of fingerprints that differ in at most
``max_bits`` bits, the 64 bits are split into ``blocks`` blocks; a close pair
agrees on some ``blocks - max_bits`` of them, so fingerprints are joined on
every such choice of blocks and the Hamming distance is verified.

Exact copies of a fingerprint are one node, so a group of copies costs as
much as a single text.  A bucket with more than ``bucket_limit`` different
fingerprints is not paired: its members meet at midpoints instead (all
values within ``max_bits / 2`` bits).  Two fingerprints have a midpoint in
common exactly when they differ in at most ``max_bits`` bits, so hanging the
members of a midpoint on the smallest one gives the same components with a
number of rows that is linear in the bucket.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import cut_lineage, free_names, one_row_each
from playlens.llm.components import connected_components

SEED = 42
CHUNK = 1 << 20  # bytes of text that are cut into words at a time
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def _word_runs(text: bytes) -> Iterator[list[bytes]]:
    """Lists of consecutive words; a long text is cut at white space, about ``CHUNK`` bytes each."""
    at = 0
    while at < len(text):
        cut = _GAP.search(text, at + CHUNK) if at + CHUNK < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The text's 64-bit SimHash as an unsigned number; 0 for a text without words."""
    ones, total, tail = np.zeros(64, dtype=np.int64), 0, []
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for words in _word_runs(text.lower()):
        words = tail + words
        n = len(words) - shingle + 1
        if n > 0:
            grams = zip(*(words[i:] for i in range(shingle)))
            values = np.fromiter((digest(join(g), SEED) for g in grams), dtype="<u8", count=n)
            for part in np.array_split(values, -(-n // 65536)):
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
            total += n
        tail = words[-(shingle - 1) :] if shingle > 1 else []
    if not total and tail:
        return digest(join(tail), SEED)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long; null texts count as empty."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(bytes(t), shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return of(F.coalesce(text, F.lit("")).cast("binary"))


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """For every choice of ``blocks - max_bits`` of the blocks, the bits they cover (signed)."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _flips(max_bits: int) -> list[int]:
    found = [sum(1 << b for b in bits) for r in range(max_bits // 2 + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def close_pairs(fps: DataFrame, max_bits: int = 2, blocks: int = 5, bucket_limit: int = 64) -> DataFrame:
    """Edges (``u``, ``v``) that connect the fingerprints (distinct longs, ``fp``) at ``max_bits`` or fewer bits.

    Every edge is a verified link, and any two linked fingerprints are
    connected; inside an oversized bucket not every link has its own row.
    """
    if max_bits % 2 or not 0 <= max_bits < blocks:
        raise ValueError("max_bits must be even and smaller than blocks")
    keys = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(block_masks(blocks, max_bits))]
    rows = fps.select("fp", F.inline(F.array(*keys)))
    sizes = rows.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut_lineage(rows.join(sizes, ["t", "k"]))
    small = shared.where(F.col("n") <= bucket_limit)
    a, b = small.select("t", "k", F.col("fp").alias("u")), small.select("t", "k", F.col("fp").alias("v"))
    paired = (
        a.join(b, ["t", "k"])
        .where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
        .select("u", "v")
    )
    crowded = shared.where(F.col("n") > bucket_limit).select("fp").distinct()
    mids = crowded.select("fp", F.explode(F.array(*[F.lit(m) for m in _flips(max_bits)])).alias("m")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("mid")
    )
    least = mids.groupBy("mid").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hung = mids.join(least, "mid").select(F.col("fp").alias("u"), "v").where("u <> v")
    return paired.unionAll(hung).distinct()


def simhash_groups(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    shingle: int = 3,
    max_bits: int = 2,
    blocks: int = 5,
    bucket_limit: int = 64,
) -> DataFrame:
    """One row per document: ``id_col``, ``text_key``, ``fp`` (long), ``component_id``, ``keeper``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` bits, the document's own included.  ``keeper`` marks the
    rows of the smallest id (and, where rows repeat that id, of the smallest
    ``text_key``, a hash of the text).

    Defined cases: null, empty and wordless texts have fingerprint 0 and are
    linked like any other; a text of fewer words than ``shingle`` is one
    shingle; a text of any length is read whole; repeated rows are copies of
    each other; rows that repeat an id with other texts are documents of
    their own, in the component of their own text; null ids never become a
    component id unless the component has no other (then it is null).  Extra
    columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = cut_lineage(
        docs.select(
            F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), fingerprint_column(F.col(text_col), shingle).alias("fp")
        )
    )
    rank = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("text_key").alias("text_key"))
    nodes = rows.groupBy("fp").agg(F.min(rank).alias("first"))
    roots = connected_components(close_pairs(nodes.select("fp"), max_bits, blocks, bucket_limit))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    firsts = placed.groupBy("root").agg(F.min("first").alias("first"))
    groups = placed.select("fp", "root").join(firsts, "root").select("fp", "first")
    found = rows.join(groups, "fp")
    return found.select(
        F.col("id").alias(id_col),
        "text_key",
        "fp",
        F.col("first.id").alias("component_id"),
        (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_key") == F.col("first.text_key"))).alias("keeper"),
    )


def keep_one(docs: DataFrame, groups: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, same columns, of which one per group of ``simhash_groups`` stays."""
    kid, kkey = free_names(docs, "_kid", "_kkey")
    keepers = groups.where("keeper").select(F.col(id_col).alias(kid), F.col("text_key").alias(kkey)).distinct()
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    kept = docs.join(keepers, F.col(id_col).eqNullSafe(F.col(kid)) & (key == F.col(kkey)), "left_semi")
    return one_row_each(kept, F.col(id_col), key)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
