import pytest
from pyspark.sql import functions as F

from playlens.llm.line_dedup import line_dedup
from playlens.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.helpers import SF, clashing, docs, oracle, rows_of

LONG = "This line is long enough to count."


def test_query_equals_sql(spark):
    got = rows_of(QUERIES["op10_line_dedup"](spark, SF), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    want = oracle(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({ORACLE_SQL['op10_line_dedup']})", "documents")
    assert got == sorted(want, key=lambda r: str(r[0])) and any(r[2] for r in got)


def test_keeps_the_largest_id_and_the_order(spark):
    rows = [(1, f"a\n  {LONG.upper()}\t\nb"), (2, f"{LONG}\nc\n{LONG}"), (7, f"x\n{LONG}\n"), (5, "short\nshort\nshort")]
    out = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup(docs(spark, rows)).collect()}
    assert out == {1: ("a\nb", 3, 1), 2: ("c", 3, 2), 7: (f"x\n{LONG}\n", 3, 0), 5: ("short\nshort\nshort", 3, 0)}


def test_thresholds(spark):
    rows = [(i, f"{'x' * 19}\n{'y' * 20}\n{'z' * 20}" if i < 3 else "z" * 20) for i in range(4)]
    out = {r["doc_id"]: r["text"] for r in line_dedup(docs(spark, rows)).collect()}
    assert out == {0: "x" * 19, 1: "x" * 19, 2: f"{'x' * 19}\n{'y' * 20}", 3: "z" * 20}
    kept = line_dedup(docs(spark, rows[:2])).agg(F.sum("n_dropped")).first()[0]
    assert kept == 0


def test_edges(spark):
    rows = [(None, LONG), (None, LONG), (1, LONG), (2, LONG), (2, LONG), (3, None), (4, ""), (5, "\n" * 50_000 + LONG)]
    out = rows_of(line_dedup(docs(spark, rows)), "doc_id", "n_lines", "n_dropped", "text")
    assert out == [
        (1, 1, 1, ""),
        (2, 1, 1, ""),
        (2, 1, 1, ""),
        (3, 1, 0, ""),
        (4, 1, 0, ""),
        (5, 50001, 0, "\n" * 50_000 + LONG),
        (None, 1, 1, ""),
        (None, 1, 1, ""),
    ]


def test_rows_that_repeat_an_id_count_once(spark):
    rows = [(1, LONG), (1, f"{LONG}\nother"), (2, LONG)]
    assert line_dedup(docs(spark, rows)).agg(F.sum("n_dropped")).first()[0] == 0


def test_empty_and_clashing(spark):
    assert line_dedup(docs(spark, [])).count() == 0
    base = docs(spark, [(i, f"{LONG}\n{i}") for i in range(4)])
    odd = clashing(base, "_id", "_row", "_drop", "_lines", "_tkey", "_fid", "n_lines", "pos", "col", "_h1")
    cols = ["doc_id", "text", "n_dropped"]
    assert rows_of(line_dedup(odd), *cols) == rows_of(line_dedup(base), *cols)
    assert set(odd.columns) <= set(line_dedup(odd).columns)


@pytest.mark.parametrize("lines", [3000])
def test_many_dropped_lines_in_one_text(spark, lines):
    body = "\n".join(f"line number {i:08d} of the text" for i in range(lines))
    out = {r["doc_id"]: r["n_dropped"] for r in line_dedup(docs(spark, [(1, body), (2, body), (3, body)])).collect()}
    assert out == {1: lines, 2: lines, 3: 0}
