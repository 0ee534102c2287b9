"""Column expressions shared by the operators (all JVM-side built-ins)."""

from playlens.functions.columns import (
    checked_int,
    hash_bucket,
    hash_key,
    hash_prefix32,
    safe_ratio,
    truncated_share,
)

__all__ = [
    "checked_int",
    "hash_bucket",
    "hash_key",
    "hash_prefix32",
    "safe_ratio",
    "truncated_share",
]
