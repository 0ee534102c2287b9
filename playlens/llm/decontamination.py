"""Benchmark decontamination by one Aho-Corasick automaton over the test items.

The words of every item (questions and answers, lower-cased) are cut into
windows of consecutive words; an item of fewer words is one window.  All
windows go into one automaton, which runs once over the normalised words of
each text.  Normalising replaces bytes one by one, so the place of a word in
the normalised text is its place in the original, and the matched words are
reported as spans of the original's characters.

The automaton is built in each Python worker from the items that travel with
the job.  Their total size is measured first: beyond ``max_item_bytes`` they
are dealt by hash to several automata, the texts are scanned by one after
the other, and what they find is merged by document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import free_names

# The bytes that separate words; A-Z are lower-cased first, bytes of non-ASCII characters belong to words.
WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in bytes(range(256)).lower())
_WORD = re.compile(rb"[^ ]+")

#: Item text of one automaton.  A byte of item text takes about ten nodes of 40 bytes each.
MAX_ITEM_BYTES = 1 << 19

SPAN = "array<struct<first_word:long,end_word:long,start:long,end:long>>"
FOUND = f"n_words long, spans {SPAN}, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def _body(words: list[bytes]) -> str:
    return (b" " + b" ".join(words) + b" ").decode("utf-8", "replace")


class Windows:
    """The automaton over all windows of some items, (id, text) each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        places: dict[str, tuple[int, set[str]]] = {}
        for name, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                part = words[i : i + window]
                places.setdefault(_body(part), (len(part), set()))[1].add(name)
        self.automaton = ahocorasick.Automaton()
        for part, value in places.items():
            self.automaton.add_word(part, value)
        self.empty = not places
        if places:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, int, int]], list[str]]:
        """Number of words, matched spans without overlaps, ids of the items matched."""
        plain = text.translate(WORD_BYTES)
        words = plain.split()
        if self.empty or not words:
            return len(words), [], []
        body = _body(words)
        runs: list[list[int]] = []
        items: set[str] = set()
        at = seen = 0
        for end, (n, names) in self.automaton.iter(body):
            seen += body.count(" ", at, end)  # words that end before the match's last space
            at = end
            items |= names
            first = seen - n
            # Matches come by their ends; a longer one may reach back over earlier runs.
            while runs and runs[-1][1] >= first:
                first = min(first, runs.pop()[0])
            runs.append([first, seen])
        return len(words), _spans(text, plain, runs) if runs else [], sorted(items)


def _spans(text: bytes, plain: bytes, runs: list[list[int]]) -> list[tuple[int, int, int, int]]:
    """Runs of words with the characters of the original that they cover."""
    edges = [m.span() for m in _WORD.finditer(plain)]
    out, byte, char = [], 0, 0
    for first, end in runs:
        start, stop = edges[first][0], edges[end - 1][1]
        char += len(text[byte:start].decode("utf-8", "replace"))
        begin = char
        char += len(text[start:stop].decode("utf-8", "replace"))
        byte = stop
        out.append((first, end, begin, char))
    return out


def _scan_column(text: Column, items: list[tuple[str, bytes]], window: int) -> Column:
    @F.pandas_udf(FOUND)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        windows = Windows(items, window)
        for texts in batches:
            yield pd.DataFrame([windows.scan(bytes(t)) for t in texts], columns=["n_words", "spans", "items"])

    return scan(F.coalesce(text, F.lit("")).cast("binary"))


def merge_spans(rows) -> list[tuple]:
    """Spans of several automata as spans without overlaps."""
    out: list[tuple] = []
    for r in sorted((r["first_word"], r["end_word"], r["start"], r["end"]) for r in rows):
        if out and r[0] <= out[-1][1]:
            last = out.pop()
            r = (last[0], max(r[1], last[1]), last[2], max(r[3], last[3]))
        out.append(r)
    return out


def item_shards(items: DataFrame, text_col: str, id_col: str, max_item_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The distinct items, in lists of about ``max_item_bytes`` of text."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name")
    rows = items.where(F.col(text_col).isNotNull()).select(name, F.col(text_col).alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // max_item_bytes))
    for i in range(shards):
        part = rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(shards)) == i)
        yield sorted((r["name"], r["text"].encode()) for r in part.collect())


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text_col: str = "text",
    id_col: str = "doc_id",
    item_text_col: str = "text",
    item_id_col: str = "item_id",
    max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_hit``, ``spans``, ``items`` and ``contaminated``.

    ``spans`` are the matched stretches of a text without overlaps: numbers
    of their first word and of the word behind the last, and of their first
    character and the one behind the last in the original text, from 0.
    ``n_hit`` counts their words.  ``items`` are the ids, as strings in
    order, of the items with a window in the text; ``contaminated`` tells
    whether there is one.

    Defined cases: null, empty and wordless texts have no words; items
    without a word match nothing; items that share an id are one item, a null
    id counts as the empty string; a window of several items names them all;
    repeated rows are scanned alike; a text of any length is scanned whole;
    input columns with the names of the results are replaced.  An empty table
    gives an empty result, an empty benchmark one without matches.
    """
    (found,) = free_names(docs, "_found")
    text = F.col(text_col)
    shards = item_shards(items, item_text_col, item_id_col, max_item_bytes)
    scans = [_scan_column(text, part, window) for part in shards]
    if len(scans) == 1:
        out = docs.withColumn(found, scans[0])
    else:
        out = _scan_in_turn(docs, scans, found, text, id_col)
    hits = F.aggregate(F.col(f"{found}.spans"), F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["first_word"])
    return out.withColumns(
        {
            "n_words": F.col(f"{found}.n_words"),
            "n_hit": hits,
            "spans": F.col(f"{found}.spans"),
            "items": F.col(f"{found}.items"),
            "contaminated": F.size(f"{found}.spans") > 0,
        }
    ).drop(found)


def _scan_in_turn(docs: DataFrame, scans: list[Column], found: str, text: Column, id_col: str) -> DataFrame:
    """One scan of all texts for each automaton; only texts with a match meet again, under id and text hash."""
    doc, key, got, first = free_names(docs, "_doc", "_key", "_got", "_first")
    text_key = F.xxhash64(F.coalesce(text, F.lit("")))

    @F.pandas_udf(SPAN)
    def merged_spans(found: pd.Series) -> pd.Series:
        return pd.Series([merge_spans(rows) for rows in found])

    hits = None
    for scan in scans:
        part = docs.select(F.col(id_col).alias(doc), text_key.alias(key), scan.alias(got)).where(F.size(f"{got}.spans") > 0)
        hits = part if hits is None else hits.unionAll(part)
    merged = hits.groupBy(doc, key).agg(
        F.max(f"{got}.n_words").alias("n_words"),
        F.flatten(F.collect_set(f"{got}.spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(f"{got}.items")))).alias("items"),
    )
    merged = merged.select(doc, F.col(key).alias(first), F.struct("n_words", merged_spans("spans").alias("spans"), "items").alias(got))
    none = _scan_column(text, [], 1)
    joined = docs.join(merged, F.col(id_col).eqNullSafe(F.col(doc)) & (text_key == F.col(first)), "left")
    return joined.withColumn(found, F.coalesce(F.col(got), none)).drop(doc, first, got)
