import collections
import math
import struct

import xxhash
from pyspark.sql import functions as F

from playlens.llm.queries import QUERIES
from playlens.llm.quality_rules import buckets_for, quality_rules
from tests.llm.helpers import SF, clashing, docs, real_docs, rows_of, words

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute_base(text):
    text = text or ""
    w, lines = words(text), [x for x in text.split("\n") if words(x)]
    where = collections.defaultdict(list)
    for i in range(len(w) - 2):
        where[tuple(w[i : i + 3])].append(i)
    covered = {j for at in where.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def grams(text, buckets):
    uni = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) % buckets for w in words(text)]

    def pair(a, b):
        form = "<i" if buckets <= 1 << 31 else "<q"
        h = xxhash.xxh64_intdigest(struct.pack(form, a), 42)
        return signed(xxhash.xxh64_intdigest(struct.pack(form, b), h)) % buckets

    return uni + [pair(a, b) for a, b in zip(uni, uni[1:])]


def brute_scores(texts, trusted, buckets, smoothing):
    raw, target = collections.Counter(), collections.Counter()
    for i, text in texts:
        g = grams(text, buckets)
        raw.update(g)
        if i in trusted:
            target.update(g)
    r, t = sum(raw.values()) + smoothing * buckets, sum(target.values()) + smoothing * buckets

    def llr(b):
        return math.log((target[b] + smoothing) / t) - math.log((raw[b] + smoothing) / r)

    out = []
    for _, text in texts:
        g = grams(text, buckets)
        out.append(sum(map(llr, g)) / len(g) if g else 0.0)
    return out


def test_query_equals_brute_force(spark):
    texts = [(r["doc_id"], r["text"]) for r in real_docs(spark).collect()]
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    want = dict(zip([i for i, _ in texts], brute_scores(texts, trusted, 1 << 15, 1.0)))
    got = {r["doc_id"]: r for r in QUERIES["op1_quality_rules"](spark, SF).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        row = got[i]
        assert tuple(row[c] for c in BASE) == brute_base(text)
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
        assert abs(row["score"] - want[i]) < 2e-6
        assert row["kept"] == (not row["base_failed"] and row["score"] >= -0.1)


def test_clean_documents_stay_and_junk_goes(spark):
    sf = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op1_quality_rules"](spark, sf).where("NOT base_failed").join(labels, "doc_id").collect()
    clean, junk = [[r["kept"] for r in rows if r["quality"] == q] for q in (1, 0)]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.05 * len(junk) and junk


def test_edges(spark):
    text = "a b c a b c\n\nx\n \nx\nÄö # $"
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, "w " * 60), (4, " ".join(map(str, range(40_000))))]
    trusted = spark.createDataFrame([(3,), (None,), (3,)], "doc_id long")
    out = quality_rules(docs(spark, rows), trusted)
    got = rows_of(out, "doc_id", *BASE, "base_failed")
    want = [(i, *brute_base(t)) for i, t in rows]
    want = [(*w, w[1] < 50 or 100 * w[5] > 50 * w[1]) for w in want]
    assert got == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    scores = {r["doc_id"]: r["score"] for r in out.collect()}
    brute = brute_scores(rows, {3}, 1 << 15, 1.0)
    assert all(abs(scores[i] - s) < 2e-6 for (i, _), s in zip(rows, brute))
    odd = clashing(docs(spark, rows), "words", "lines", "id", "n", "sum", "copy", "bucket", "b", "score", "kept")
    assert rows_of(quality_rules(odd, trusted), "doc_id", *BASE, "base_failed") == got
    assert rows_of(quality_rules(docs(spark, rows), trusted, buckets=7), "doc_id", *BASE, "base_failed") == got


def test_rare_buckets_are_joined(spark):
    """Few held ratios leave most buckets to the join; the scores are those of brute force, repeated rows and null ids too."""
    texts = [(r["doc_id"], r["text"]) for r in real_docs(spark).limit(60).collect()]
    texts += [texts[0], texts[0], (None, texts[1][1]), (None, None), (9_999_999, "")]
    trusted = spark.createDataFrame([(i,) for i, _ in texts[:20]], "doc_id long")
    ids = {i for i, _ in texts[:20]}
    for buckets, most_held in ((1 << 12, 16), (1000, 7), (1 << 33, 64)):
        want = sorted((str(i), t or "", round(s, 5)) for (i, t), s in zip(texts, brute_scores(texts, ids, buckets, 1.0)))
        out = quality_rules(docs(spark, texts), trusted, buckets=buckets, most_held=most_held)
        keys = {signed(xxhash.xxh64_intdigest((t or "").encode(), 42)): t or "" for _, t in texts}
        got = sorted((str(r["doc_id"]), keys[r["text_key"]], r["score"]) for r in out.collect())
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(abs(g[2] - w[2]) < 2e-5 for g, w in zip(got, want))


def test_buckets_follow_the_corpus(spark):
    def count(n):
        mebi, rest = divmod(n, 1 << 20)
        texts = spark.range(mebi).select(F.expr("repeat(chr(65 + id % 9), 1048576)").alias("text"))
        return buckets_for(texts.union(spark.createDataFrame([("x" * rest,), (None,)], "text string")))

    assert [count(n) for n in (0, 1 << 25, (1 << 25) + 1, 1 << 27, (1 << 27) + 1)] == [1 << 15, 1 << 15, 1 << 16, 1 << 16, 1 << 17]
    assert buckets_for(docs(spark, [])) == 1 << 15


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert quality_rules(docs(spark, []), none).count() == 0
    row = quality_rules(docs(spark, [(1, "word " * 80)]), none).first()
    assert row["n_words"] == 80 and row["base_failed"] and not row["kept"]
