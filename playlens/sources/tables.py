"""Readers: Parquet tables, CSV with a declared schema, temp views."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(base_dir: str, name: str) -> str:
    """``<base_dir>/<name>.parquet`` (the layout of the given tables)."""
    return os.path.join(base_dir, f"{name}.parquet")


def read_table(spark: SparkSession, base_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan of one table; ``columns`` prunes the read schema."""
    df = spark.read.parquet(table_path(base_dir, name))
    return df.select(*columns) if columns else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan of a prepared set (scores, train / validation)."""
    return spark.read.parquet(path)


# What happens to a CSV row that doesn't fit the schema, and Spark's name for it.
MALFORMED = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "keep": "PERMISSIVE"}
# How NULL is written in CSV, so that it differs from an empty string.
CSV_NULL = "\\N"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    header: bool = False,
    malformed: str = "fail",
    corrupt_col: str = "_corrupt_record",
    null: str = CSV_NULL,
) -> DataFrame:
    """CSV scan with a DDL schema (no inference pass over the data).

    Rows with too few or too many fields, or a field that isn't of its type,
    are malformed.  ``"fail"`` raises when one is read, ``"drop"`` leaves
    them out, ``"keep"`` returns every row with the column ``corrupt_col``:
    the raw text of a malformed row (its other columns hold what could be
    read), NULL for a good one.  ``null`` is how NULL is written.

    A malformed row is only seen by a plan that reads its columns: Spark
    prunes CSV columns, and a bare count parses none.
    """
    if malformed not in MALFORMED:
        raise ValueError(f"malformed must be one of {sorted(MALFORMED)}")
    if malformed == "keep":
        schema = f"{schema}, `{corrupt_col}` STRING"
    return spark.read.csv(
        path,
        schema=schema,
        header=header,
        mode=MALFORMED[malformed],
        columnNameOfCorruptRecord=corrupt_col,
        nullValue=null,
        escape='"',
        enforceSchema=not header,
    )


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for ``spark.sql``; returns it for chaining."""
    df.createOrReplaceTempView(name)
    return df


def register_tables(spark: SparkSession, base_dir: str, names=TABLES) -> None:
    """Register the given tables as temp views under their own names.

    The paths are Spark's to open (local, HDFS, an object store); a table
    that is not there raises Spark's own error.
    """
    for name in names:
        register_view(read_table(spark, base_dir, name), name)
