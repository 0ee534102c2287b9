"""Column expressions and small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.session import cut_lineage

# The white space that separates words and frames lines.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

__all__ = ["WHITE", "cut_lineage", "digest128", "free_names", "let", "lower_ascii", "one_row_each", "row_items", "split_lines", "split_words", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character unchanged.

    ``lower`` only touches A-Z in a pure ASCII string, where it is several
    times faster than ``translate``.
    """
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def split_lines(text: Column) -> Column:
    """The ``\\n``-separated lines; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def split_words(text: Column) -> Column:
    """Words between runs of white space; an empty array where there is none."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, WHITE_RUN, -1))


def digest128(c: Column) -> list[Column]:
    """Two independently seeded 64-bit hashes; together a 128-bit key."""
    return [F.xxhash64(c), F.xxhash64(F.lit(0x9E3779B97F4A7C15 - 2**64), c)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, even where lambdas inside use it for every element.

    A plain column would not do: pushing a filter down can put the column's
    own expression in its place.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that no column of ``df`` has (helpers beside a caller's columns)."""
    taken, names = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        names.append(name)
    return names


def row_items(docs: DataFrame, extra: dict[str, Column], text_col: str, id_col: str) -> DataFrame:
    """(``id``, ``text_key``, *extra*, ``copy``): a narrow row for every row of ``docs``.

    Rows that repeat an id and a text get the numbers 1, 2, ... as ``copy``;
    they are counted by partial aggregates, so any number of copies is fine.
    """
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("text_key"), *[c.alias(n) for n, c in extra.items()])
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    return counted.select(*rows.columns, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))


def one_row_each(df: DataFrame, *keys: Column) -> DataFrame:
    """One row of ``df`` for each value of ``keys``: the one whose columns hash lowest."""
    every = [F.col(c) for c in df.columns]
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    return df.groupBy(*named).agg(F.min_by(F.struct(*every), F.xxhash64(*every)).alias("_doc")).select("_doc.*")
