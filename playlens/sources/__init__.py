"""Sources and sinks: Parquet / CSV reads, fixture tables, Parquet writes."""

from playlens.sources.fixtures import catalog, plays, plays_f1, plays_f2
from playlens.sources.sinks import preview, read_split_side, write_csv, write_split, write_table
from playlens.sources.tables import read_csv, read_parquet, read_table, register_tables, register_view

__all__ = [
    "catalog",
    "plays",
    "plays_f1",
    "plays_f2",
    "preview",
    "read_csv",
    "read_parquet",
    "read_split_side",
    "read_table",
    "register_tables",
    "register_view",
    "write_csv",
    "write_split",
    "write_table",
]
