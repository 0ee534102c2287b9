import random
import re

import pytest

from playlens.llm.decontamination import decontaminate
from tests.llm.helpers import clashing, docs, lower, rows_of

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLS = ("doc_id", "n_words", "n_hit", "items", "contaminated")


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute(rows, benchmark, window):
    out = []
    for doc_id, text in rows:
        w, hit, names = WORDS.findall(lower(text)), set(), set()
        for item_id, item in benchmark:
            v = WORDS.findall(lower(item))
            for i in range(max(1, len(v) - window + 1) if v else 0):
                part = v[i : i + window]
                for j in range(len(w) - len(part) + 1):
                    if w[j : j + len(part)] == part:
                        hit |= set(range(j, j + len(part)))
                        names.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(w), len(hit), sorted(names), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("max_item_bytes", [1 << 19, 40])
def test_equals_brute_force(spark, max_item_bytes):
    """Few words, so windows overlap and repeat; also with many automata."""
    rng = random.Random(3)
    talk = lambda n: "".join(rng.choice(["A", "b", "é", "Z9"]) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    rows = [(i, talk(rng.randint(0, 60))) for i in range(60)] + [(3, talk(30)), (5, None), (6, "")]
    bench = [(i, talk(rng.randint(0, 12))) for i in range(20)] + [(2, talk(9)), (None, talk(7)), (50, None), (51, "...")]
    out = decontaminate(docs(spark, rows), items(spark, bench), window=6, max_item_bytes=max_item_bytes)
    assert sorted(map(tuple, out.select(*COLS).collect()), key=str) == brute(rows, bench, 6)


@pytest.mark.parametrize("max_item_bytes", [1 << 19, 8])
def test_spans_point_into_the_original(spark, max_item_bytes):
    text = "Où? (One),  TWO\tthree four! é One-two"
    out = decontaminate(docs(spark, [(1, text)]), items(spark, [(7, "one two three"), (8, "Two, three; four")]), 3, max_item_bytes=max_item_bytes)
    row = out.first()
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == ["One),  TWO\tthree four"]
    assert [(s["first_word"], s["end_word"]) for s in row["spans"]] == [(1, 5)]
    assert row["items"] == ["7", "8"] and row["n_hit"] == 4 and row["n_words"] == 8


def test_short_inside_long(spark):
    out = decontaminate(docs(spark, [(1, "a b c d e f"), (2, "c"), (3, "x")]), items(spark, [(1, "b c d e"), (2, "C")]), 4)
    assert rows_of(out, *COLS) == [(1, 6, 4, ["1", "2"], True), (2, 1, 1, ["2"], True), (3, 1, 0, [], False)]


def test_edges(spark):
    long = "word " * 300_000 + "one two three"
    rows = [(1, None), (2, ""), (3, "..."), (None, "One two, three"), (4, long), (4, long)]
    bench = items(spark, [(9, "one two three"), (9, "one two three"), (10, "two three")])
    want = [
        (1, 0, 0, [], False),
        (2, 0, 0, [], False),
        (3, 0, 0, [], False),
        (4, 300003, 3, ["10", "9"], True),
        (4, 300003, 3, ["10", "9"], True),
        (None, 3, 3, ["10", "9"], True),
    ]
    for limit in (1 << 19, 4):
        assert rows_of(decontaminate(docs(spark, rows), bench, max_item_bytes=limit), *COLS) == want
    odd = clashing(docs(spark, rows), "_found", "_doc", "_key", "_got", "n_words", "spans", "items")
    for limit in (1 << 19, 4):
        out = decontaminate(odd, clashing(bench, "name", "words"), max_item_bytes=limit)
        assert rows_of(out, *COLS) == want
        assert set(odd.columns) <= set(out.columns)
    assert decontaminate(docs(spark, []), bench).count() == 0
    assert rows_of(decontaminate(docs(spark, rows[3:4]), items(spark, [])), *COLS) == [(None, 3, 0, [], False)]
