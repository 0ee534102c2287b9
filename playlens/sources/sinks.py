"""Writers: score tables and train / validation sets.

The split is written once, partitioned by ``dataset``; readers of one side
get partition pruning instead of a second run of the whole chain (the two
separate writes of an uncached plan could disagree if anything upstream
was not deterministic).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.sources.tables import CSV_NULL


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> str:
    """Parquet sink with an explicit save mode."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = False) -> str:
    """CSV sink that ``read_csv`` reads back: NULL and the empty string stay apart, quotes are doubled, spaces stay."""
    df.write.mode(mode).csv(
        path,
        header=header,
        nullValue=CSV_NULL,
        emptyValue='""',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


def write_split(df: DataFrame, path: str, mode: str = "errorifexists", label_col: str = "dataset") -> str:
    """Write a labelled split in one job, partitioned by the label."""
    return write_table(df, path, mode=mode, partition_by=[label_col])


def read_split_side(spark: SparkSession, path: str, side: str, label_col: str = "dataset") -> DataFrame:
    """One side of a written split (partition-pruned scan)."""
    return spark.read.parquet(path).where(F.col(label_col) == side).drop(label_col)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, as ``show`` would print them."""
    return df.limit(n)
