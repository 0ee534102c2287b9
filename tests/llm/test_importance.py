import contextlib
import io
import math
import random
import re
import zlib
from hashlib import sha256

from pyspark.sql import functions as F

from playlens.llm.importance import importance_resample, sample_ranks, sorted_runs
from tests.llm.helpers import clashing, docs, lower, rows_of

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLS = ("doc_id", "n_features", "weight", "score", "rank")


def grams(text):
    w = WORDS.findall(lower(text))
    return w, [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(rows, target, percent=25, least=20):
    s, t, out = [0] * 10_000, [0] * 10_000, []
    for counts, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            for b in grams(text)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    for doc_id, text in rows:
        w, f = grams(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        name = "" if doc_id is None else str(doc_id)
        h = int(sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
        out.append((len(w) >= least, doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    drawn = len(able) * percent // 100
    ranked = [(*r[1:], i + 1 if i < drawn else None) for i, r in enumerate(able)]
    return sorted([*ranked, *[(*r[1:], None) for r in out if not r[0]]], key=str)


def texts(n, seed=5):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gämma", "x1", "delta", "é", "omega"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_equals_brute_force(spark):
    rows = [*enumerate(texts(300)), (None, texts(1, 8)[0] * 2), (3, None), (4, ""), (5, "...")]
    target = texts(20, 9)
    given = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    want = brute(rows, target)
    for segments, parts in ((None, 3), (1, 1), (40, 17)):
        got = importance_resample(docs(spark, rows).repartition(parts), given, segments=segments)
        assert sorted(map(tuple, got.select(*COLS).collect()), key=str) == want


def test_repeated_rows_and_ids(spark):
    """A third of the rows are one row; ranks are complete and the copies stand side by side."""
    one, rest = "alpha Beta gamma " * 10, texts(60)
    rows = [(7, one)] * 30 + [(100 + i, t + " word" * 20) for i, t in enumerate(rest)] + [(7, one + "more")]
    given = spark.createDataFrame([(0, one)], "item_id long, text string")
    got = importance_resample(docs(spark, rows).repartition(8), given, percent=100, segments=12)
    assert sorted(map(tuple, got.select(*COLS).collect()), key=str) == brute(rows, [one], percent=100)
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, len(rows) + 1))


def test_ranks_of_a_key_that_all_rows_share(spark):
    same = spark.range(20_000).select(F.lit(1).alias("a"), "id").repartition(8)
    runs = sorted_runs(same, [("a", False)])
    ranked = sample_ranks(runs, [("a", False)], "rank", segments=16)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        ranked.explain()
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 20_001))
    assert buf.getvalue().count("Exchange") - buf.getvalue().count("BroadcastExchange") == 1  # the rows move once
    sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 20_000 / 16 * 2


def test_edges(spark):
    long = "word other " * 100_000
    rows = [(1, None), (2, ""), (None, "a b c"), (4, long), (4, long)]
    given = spark.createDataFrame([(0, "a b"), (1, None)], "item_id long, text string")
    got = importance_resample(docs(spark, rows), given, percent=100)
    assert sorted(map(tuple, got.select(*COLS).collect()), key=str) == brute(rows, ["a b", None], percent=100)
    odd = clashing(docs(spark, rows), "id", "rank", "score", "_run", "_segment", "w")
    assert rows_of(importance_resample(odd, given, percent=100), *COLS) == rows_of(got, *COLS)
    assert importance_resample(docs(spark, []), given).count() == 0
    none = importance_resample(docs(spark, rows), given.where("false"), percent=100)
    assert sorted(map(tuple, none.select(*COLS).collect()), key=str) == brute(rows, [], percent=100)
