"""From raw documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.

Defined cases, in every stage: extra columns, whatever their names, pass
through the first four stages; texts of any length are read whole; null and
empty texts are documents without words; an empty table gives an empty
result.  What rows with null ids, repeated rows and ties become is said at
each stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm.common import table
from playlens.llm.line_dedup import line_dedup
from playlens.llm.mixing import mix_plan, mixed_documents
from playlens.llm.packing import pack
from playlens.llm.quality_classifier import quality_scores
from playlens.llm.simhash import keep_one, simhash_groups
from playlens.session import scratch_path

MAX_REPEATS = 2.0
CAPACITY = 2048

#: Not expressible in SQL: the classifier is trained and fingerprints are XXH64 values.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts.

    Every row is scored by its text alone: repeated rows stay or go together,
    rows with null ids like any other; a score that equals the threshold stays.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality_scores(docs, labels).where("predicted = 1").select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines; ``n_chars`` follows the text.

    All rows stay; a null text becomes the empty text.  Rows that repeat an id are one document in the counts;
    where a line is in three documents or more, the one with the largest id
    keeps it.
    """
    out = line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Texts without words are copies of each other.  Repeated rows leave one;
    of rows that share the smallest id the one with the smallest hash of its
    text stays; a row with a null id stays only where its group has no other.
    """
    return keep_one(docs, simhash_groups(docs, shingle=3, max_bits=2))


def temperature_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, documents of rare sources up to ``MAX_REPEATS`` times, in block order.

    A null source is a source of its own; rows that repeat an id and a text
    are one document each.  Ties in the order are broken by hash.
    """
    return mixed_documents(docs, mix_plan(docs, max_repeats=MAX_REPEATS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and the sequences that they are packed into.

    Every row is packed whole, in several pieces where it is longer than a
    sequence; a text without words is the one token that ends a document.
    Rows that repeat an id and a text are told apart by ``copy``.
    """
    return pack(docs, capacity=CAPACITY)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("simhash_near_dedup", simhash_near_dedup),
    ("temperature_mixing", temperature_mixing),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus; the stages' results are written beside the checkpoints and go with the session."""
    folder, docs = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}"), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
