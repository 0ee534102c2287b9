"""Column expressions built from ``pyspark.sql.functions`` only.

They stay inside whole-stage codegen; none of them is a Python UDF.  The
hash expressions are chosen so that the same value can be written in
plain SQL on other engines (``md5`` of a ``|``-joined string, first eight
hex digits as an unsigned 32-bit number), which is what the oracle
queries in ``__spark_entry__`` rely on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX = 2**31 - 1
HASH_SPACE = 2**32


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(seed: int | str, *cols: str | Column) -> Column:
    """Hex md5 of ``seed|c1|c2|...``; a seeded, total, engine-neutral order.

    NULL parts are written as the empty string, so the key is never NULL.
    """
    parts = [F.lit(str(seed))] + [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hash_prefix32(key: str | Column) -> Column:
    """The first 8 hex digits of a hash key as a number in [0, 2^32).

    Ordering keys by this number never contradicts ordering them as
    strings, so it can be used to cut a key order into ranges.
    """
    return F.conv(F.substring(_col(key), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: str | Column, buckets: int | Column) -> Column:
    """Range bucket of a hash key: ``(prefix32 * buckets) >> 32``, in [0, buckets).

    Integer arithmetic (the product stays below 2^63 for any int bucket
    count), so the result is exact.  Buckets are contiguous ranges of the
    key order: bucket ``b`` holds only keys smaller than every key in
    bucket ``b + 1``.
    """
    b = buckets if isinstance(buckets, Column) else F.lit(int(buckets))
    return F.shiftright(hash_prefix32(key) * b.cast("bigint"), 32).cast("int")


def checked_int(c: str | Column, what: str) -> Column:
    """Cast a long to int, failing loudly outside [-2^31, 2^31-1] instead of wrapping."""
    c = _col(c)
    return (
        F.when(
            (c > F.lit(INT_MAX)) | (c < F.lit(-INT_MAX - 1)),
            F.raise_error(F.lit(f"{what} does not fit in a 32-bit integer")),
        )
        .otherwise(c)
        .cast("int")
    )


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` in double, NULL when ``den`` is 0 (ANSI-safe)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def truncated_share(n: str | Column, fraction: float) -> Column:
    """``int(n * fraction)`` computed in double, truncating like a cast."""
    return (_col(n).cast("double") * F.lit(float(fraction))).cast("bigint")
