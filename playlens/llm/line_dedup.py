"""Line deduplication across documents.

Lines are exploded, normalised and hashed; documents are counted per hash;
lines whose key occurs in at least ``min_docs`` documents are dropped
everywhere but in the document with the largest id, and the rest is put
together again by position.

Only hashes and positions are shuffled for the counting; the texts move
once, to meet their list of dropped positions.  A line that a third of all
documents share is counted by partial aggregates, and the join that brings
its verdict back is an equi-join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import WHITE, cut_lineage, digest128, free_names, let, lower_ascii, split_lines


def dropped_lines(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """(``_id``, ``_row``, ``_drop``): positions of the lines to drop, per document row.

    ``_row`` is a hash of the text, so that rows which repeat an id keep
    their own positions.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = (
        docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_row"), F.posexplode(split_lines(text)))
        .select("_id", "_row", F.col("pos").alias("_pos"), F.btrim("col", F.lit(WHITE)).alias("_line"))
        .where(F.length("_line") >= min_chars)
        .select("_id", "_row", "_pos", *[h.alias(n) for h, n in zip(digest128(lower_ascii(F.col("_line"))), ("_h1", "_h2"))])
    )
    shared = (
        lines.select("_h1", "_h2", "_id")
        .distinct()
        .groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_keeper"))
        .where(F.col("_docs") >= min_docs)
        .drop("_docs")
    )
    # Read back from the checkpoint, the keys have no partitioning yet: both sides of the join are
    # exchanged for it, which lets adaptive execution split a line with a third of all rows.
    return (
        lines.join(cut_lineage(shared), ["_h1", "_h2"])
        .where(~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy("_id", "_row")
        .agg(F.collect_set("_pos").alias("_drop"))
    )


def line_dedup(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """``docs`` with the repeated lines removed, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line without surrounding white space, A-Z
    lower-cased; keys shorter than ``min_chars`` code points are left alone.

    Defined cases: a null or empty text is one empty line (and becomes the
    empty text); texts and lines of any length are read whole; a line's keeper
    is the largest id, so there are no ties; documents are told apart by id, so rows that repeat an id
    count once and all of them keep the lines of which that id is the
    keeper; a null id is one document, smaller than every other; a line
    repeated inside a document counts once and is dropped or kept in all its
    places.  Other columns pass through; input columns named ``n_lines`` or
    ``n_dropped`` are replaced.  An empty table gives an empty result.
    """
    tkey, fid, row, drop = free_names(docs, "_tkey", "_fid", "_row", "_drop")
    drops = dropped_lines(docs, text_col, id_col, min_chars, min_docs).toDF(fid, row, drop)
    base = docs.withColumn(text_col, F.coalesce(F.col(text_col), F.lit(""))).withColumn(tkey, F.xxhash64(text_col))
    joined = base.join(drops, F.col(id_col).eqNullSafe(F.col(fid)) & (F.col(tkey) == F.col(row)), "left")

    def without(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop))
        return F.array_join(F.transform(stay, lambda p: F.get(lines, p)), "\n")

    lines, untouched = split_lines(F.col(text_col)), F.col(drop).isNull()
    out = joined.withColumns(
        {
            text_col: F.when(untouched, F.col(text_col)).otherwise(let(lines, without)),
            "n_lines": F.size(lines).cast("long"),
            "n_dropped": F.when(untouched, 0).otherwise(F.size(drop)).cast("long"),
        }
    )
    return out.drop(tkey, fid, row, drop)
