"""Licence scans: notice phrases, identifier tags and licence expressions.

One Aho-Corasick automaton runs over the normalised words of a text and
finds notice phrases; a second one runs over the lower-cased raw text and
finds identifier tags.  The expression behind a tag is read by a
shunting-yard parser (``or`` < ``and`` < ``with``) and evaluated: its labels
are collected, and its score is the best alternative (``or``) of the
strictest condition (``and``).

A document is scanned where it lies: the scan shuffles nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import free_names

# Notice phrases of the contract and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notice phrases and their labels.
NOTICE_PHRASES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license": "epl",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "boost software license": "bsl-1",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4 0": "cc-by",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}

# Identifiers of licence expressions and the labels they stand for.
IDENTIFIERS = {
    "0bsd": "0bsd",
    "agpl-3.0": "agpl-3",
    "apache-1.1": "apache-1",
    "apache-2.0": "apache-2",
    "artistic-2.0": "artistic-2",
    "bsd-1-clause": "bsd",
    "bsd-2-clause": "bsd-2-clause",
    "bsd-3-clause": "bsd-3-clause",
    "bsd-4-clause": "bsd",
    "bsl-1.0": "bsl-1",
    "cc-by-2.0": "cc-by",
    "cc-by-3.0": "cc-by",
    "cc-by-4.0": "cc-by",
    "cc-by-nc-3.0": "cc-by-nc",
    "cc-by-nc-4.0": "cc-by-nc",
    "cc-by-nc-nd-4.0": "cc-by-nc-nd",
    "cc-by-nc-sa-4.0": "cc-by-nc-sa",
    "cc-by-nd-4.0": "cc-by-nd",
    "cc-by-sa-2.0": "cc-by-sa",
    "cc-by-sa-3.0": "cc-by-sa",
    "cc-by-sa-4.0": "cc-by-sa",
    "cc0-1.0": "cc0",
    "cddl-1.0": "cddl",
    "epl-1.0": "epl",
    "epl-2.0": "epl",
    "eupl-1.2": "eupl",
    "gpl-2.0": "gpl-2",
    "gpl-3.0": "gpl-3",
    "isc": "isc",
    "lgpl-2.0": "lgpl",
    "lgpl-2.1": "lgpl",
    "lgpl-3.0": "lgpl",
    "mit": "mit",
    "mit-0": "mit",
    "mpl-1.1": "mpl-1",
    "mpl-2.0": "mpl-2",
    "ncsa": "ncsa",
    "ofl-1.1": "ofl",
    "postgresql": "postgresql",
    "python-2.0": "python",
    "unlicense": "public-domain",
    "wtfpl": "public-domain",
    "zlib": "zlib",
}

# How freely a text under a label may be reused.
FREEDOM = {
    "0bsd": 1.0,
    "agpl-3": 0.2,
    "all-rights-reserved": 0.0,
    "apache-1": 1.0,
    "apache-2": 1.0,
    "artistic-2": 0.6,
    "bsd": 1.0,
    "bsd-2-clause": 1.0,
    "bsd-3-clause": 1.0,
    "bsl-1": 1.0,
    "cc-by": 0.9,
    "cc-by-nc": 0.1,
    "cc-by-nc-nd": 0.05,
    "cc-by-nc-sa": 0.1,
    "cc-by-nd": 0.2,
    "cc-by-sa": 0.6,
    "cc0": 1.0,
    "cddl": 0.5,
    "epl": 0.5,
    "eupl": 0.4,
    "gpl-2": 0.3,
    "gpl-3": 0.3,
    "isc": 1.0,
    "lgpl": 0.4,
    "mit": 1.0,
    "mpl-1": 0.5,
    "mpl-2": 0.5,
    "ncsa": 1.0,
    "ofl": 0.8,
    "postgresql": 1.0,
    "public-domain": 1.0,
    "python": 1.0,
    "zlib": 1.0,
}
UNKNOWN_FREEDOM = 0.5
EXCEPTION_BONUS = 0.2

# Identifier tags; known identifiers count behind each, references to own licences behind the strict one too.
STRICT_TAG = "spdx-license-identifier:"
OWN_REFERENCE = "licenseref-"
LOOSE_TAGS = ("license:", "licence:", "license-expression:")

# The bytes that separate words; A-Z are lower-cased first, bytes of non-ASCII characters belong to words.
_WORDS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in bytes(range(256)).lower())
_LOWER = bytes(range(256)).lower()
_IN_WORD = re.compile("[a-z0-9_]|[^\\x00-\\x7f]")  # before a tag: it is the end of a longer word
_TOKEN = re.compile(r"[ \t]*(\(|\)|[a-z0-9][a-z0-9.+:_-]*)")
OPERATORS = {"or": 1, "and": 2, "with": 3}


def _label(identifier: str) -> str | None:
    name = identifier.rstrip(".:-_")
    for ending in ("+", "-only", "-or-later"):
        name = name.removesuffix(ending)
    return IDENTIFIERS.get(name)


def _known(token: str) -> bool:
    return _label(token) is not None


def _expression(line: str, strict: bool, at: int, stop: int) -> list[str]:
    """The tokens of the longest licence expression that starts at ``at``.

    It ends before the first token that doesn't fit; an operator without a
    right side is left out, parentheses that never close stay open.
    """
    tokens: list[str] = []
    good, want_operand, depth = 0, True, 0
    while m := _TOKEN.match(line, at, stop):
        token, at = m[1], m.end()
        if token == "(":
            if not want_operand:
                break
            depth += 1
        elif token == ")":
            if want_operand or not depth:
                break
            depth -= 1
        elif token in OPERATORS:
            if want_operand:
                break
            want_operand = True
        else:
            exception = bool(tokens) and tokens[-1] == "with"
            if not want_operand or not (exception or _known(token) or strict and token.startswith(OWN_REFERENCE)):
                break
            want_operand = False
        tokens.append(token)
        if not want_operand:
            good = len(tokens)
    return tokens[:good]


def postfix(line: str, strict: bool = True, at: int = 0, stop: int | None = None) -> list[str]:
    """The longest licence expression that ``line`` (lower case) has at ``at``, in postfix order."""
    out: list[str] = []
    ops: list[str] = []
    for token in _expression(line, strict, at, len(line) if stop is None else stop):
        if token == "(":
            ops.append(token)
        elif token == ")":
            while ops[-1] != "(":
                out.append(ops.pop())
            ops.pop()
        elif token in OPERATORS:
            while ops and ops[-1] != "(" and OPERATORS[ops[-1]] >= OPERATORS[token]:
                out.append(ops.pop())
            ops.append(token)
        else:
            out.append(token)
    return out + [op for op in reversed(ops) if op != "("]


def evaluate(rpn: list[str]) -> tuple[set[str], float] | None:
    """Labels and score of an expression in postfix order; None for no expression."""
    stack: list[tuple[set[str], float, str]] = []
    for token in rpn:
        if token not in OPERATORS:
            label = _label(token) or token.rstrip(".:-_+")
            stack.append(({label}, FREEDOM.get(label, UNKNOWN_FREEDOM), token))
            continue
        (right, r, _), (left, v, name) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left, min(1.0, v + EXCEPTION_BONUS), name))
        else:
            stack.append((left | right, max(v, r) if token == "or" else min(v, r), ""))
    return (stack[0][0], stack[0][1]) if stack else None


class Scanner:
    """Both automata, built once for each Python worker."""

    def __init__(self, base: dict[str, str], notices: dict[str, str]):
        self.phrases, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        for phrase, label in {**notices, **base}.items():
            self.phrases.add_word(f" {phrase} ", (len(phrase.split()), label, phrase in base))
        for tag in (STRICT_TAG, *LOOSE_TAGS):
            self.tags.add_word(tag, (len(tag), tag == STRICT_TAG))
        self.phrases.make_automaton()
        self.tags.make_automaton()

    def scan(self, text: bytes) -> tuple:
        words = text.translate(_WORDS).split()
        body = (b" " + b" ".join(words) + b" ").decode("utf-8", "replace") if words else ""
        starts, base, labels, scores = [], set(), set(), []
        at = seen = 0
        for end, (n, label, is_base) in self.phrases.iter(body):
            seen += body.count(" ", at, end)
            at = end
            labels.add(label)
            scores.append(FREEDOM.get(label, UNKNOWN_FREEDOM))
            if is_base:
                starts.append(seen - n)
                base.add(label)
        raw = text.translate(_LOWER).decode("utf-8", "replace")
        stop = -1
        for end, (length, strict) in self.tags.iter(raw):
            if end >= length and _IN_WORD.match(raw, end - length):
                continue
            if stop <= end:
                stop = raw.find("\n", end)
                stop = len(raw) if stop < 0 else stop
            if (value := evaluate(postfix(raw, strict, end + 1, stop))) is not None:
                labels |= value[0]
                scores.append(value[1])
        return (
            len(words),
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(labels)),
            min(scores, default=0.0),
        )


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def license_column(text: Column, base: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> Column:
    """A struct of ``SCHEMA`` for every text."""
    base, notices = BASE_PHRASES if base is None else base, NOTICE_PHRASES if notices is None else notices

    @F.pandas_udf(SCHEMA)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(base, notices)
        for texts in batches:
            found = pd.DataFrame([scanner.scan(bytes(t)) for t in texts], columns=_NAMES)
            yield found.astype({"first_word": "Int64", "last_word": "Int64"})

    return of(F.coalesce(text, F.lit("")).cast("binary"))


def license_scan(
    docs: DataFrame, text_col: str = "text", base: dict[str, str] | None = None, notices: dict[str, str] | None = None
) -> DataFrame:
    """``docs`` with the columns of ``SCHEMA``.

    ``n_base``, ``first_word`` and ``last_word`` are the number of places of
    base phrases and the smallest and largest start among their words, from
    0.  ``base_labels`` has the labels of base phrases, ``labels`` those of
    notices and expressions too (distinct, sorted, comma-joined).  ``score``
    is the freedom of reuse under the strictest of all notices and
    expressions found, and 0 where there is none.

    Defined cases: null and empty texts have no words, no places, empty
    label lists and score 0; places may overlap and all count; a text of any
    length is scanned whole, an expression of any length or depth is read; a
    tag that ends a longer word is none; repeated rows are scanned alike; input columns with the names of the results are
    replaced.  An empty table gives an empty result.
    """
    (scan,) = free_names(docs, "_scan")
    out = docs.withColumn(scan, license_column(F.col(text_col), base, notices))
    return out.withColumns({name: F.col(f"{scan}.{name}") for name in _NAMES}).drop(scan)
