import collections
import random

import pytest

from playlens.llm.packing import best_fit, pack
from playlens.llm.queries import QUERIES
from tests.llm.helpers import SF, clashing, docs, real_docs, rows_of, words


def brute_fit(sizes, sources, clusters, capacity, one_per_source=True):
    bins, out = [], []
    for size, s, c in zip(sizes, sources, clusters):
        fits = [
            (b["free"], i)
            for i, b in enumerate(bins)
            if b["free"] >= size and c not in b["clusters"] and not (one_per_source and s in b["sources"])
        ]
        if fits:
            _, i = min(fits)
        else:
            bins.append({"free": capacity, "sources": set(), "clusters": set()})
            i = len(bins) - 1
        out.append((i, capacity - bins[i]["free"]))
        bins[i]["free"] -= size
        bins[i]["sources"].add(s)
        bins[i]["clusters"].add(c)
    return out


@pytest.mark.parametrize("one", [True, False])
@pytest.mark.parametrize("seed", range(5))
def test_best_fit_equals_brute_force(seed, one):
    draw = random.Random(seed)
    n = 300
    sizes = sorted((draw.randint(1, 60) for _ in range(n)), reverse=True)
    sources, clusters = [draw.choice([0, 0, 1, 2, 3]) for _ in range(n)], [draw.randint(0, 80) for _ in range(n)]
    assert list(zip(*best_fit(sizes, sources, clusters, 100, one))) == brute_fit(sizes, sources, clusters, 100, one)


def check_pack(rows, texts, capacity, one_per_source=True):
    bins, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
        pieces[r["doc_id"], r["text_key"], r["source"], r["copy"]].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r["bin_offset"])
        at = 0
        for r in own:
            assert r["bin_offset"] == at
            at += r["n_tokens"]
        assert at <= capacity
        assert len({r["cluster"] for r in own}) == len(own)
        assert not one_per_source or len({r["source"] for r in own}) == len(own)
    got = collections.Counter()
    for (i, _, source, _), own in pieces.items():
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [k * capacity for k in range(len(own))]
        got[i, source, sum(r["n_tokens"] for r in own)] += 1
    assert got == collections.Counter((i, s, len(words(t)) + 1) for i, t, s in texts)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_constraints_on_real_documents(spark, capacity):
    d = real_docs(spark)
    texts = [(r["doc_id"], r["text"], r["source"]) for r in d.collect()]
    check_pack(pack(d, capacity=capacity, shard_pieces=100).collect(), texts, capacity)
    check_pack(pack(d, capacity=capacity, one_per_source=False).collect(), texts, capacity, False)


def test_query_is_stable(spark):
    cols = ["doc_id", "piece", "bin_id", "bin_offset"]
    again = [rows_of(QUERIES["op6_best_fit_packing"](spark, SF), *cols) for _ in range(2)]
    assert again[0] == again[1] and len({r[0] for r in again[0]}) == real_docs(spark).count()


def test_clusters_are_equal_up_to_case_and_white_space(spark):
    d = docs(spark, [(i, "Same  text\nhere" if i % 2 else "same TEXT here", f"s{i}") for i in range(10)])
    rows = pack(d, capacity=100).collect()
    assert len({r["cluster"] for r in rows}) == 1 and len({r["bin_id"] for r in rows}) == 10
    by_column = pack(d.withColumn("group", d["doc_id"] % 5), capacity=100, cluster_col="group").collect()
    assert len({r["bin_id"] for r in by_column}) == 2


def test_edges(spark):
    rows = [(1, None, None), (2, "", "a"), (2, "", "a"), (None, "x y", "a"), ((1 << 60) + 1, "x z", "a"), (4, "long " * 100_000, "b"), (5, "w " * 63, "b")]
    d = docs(spark, rows)
    out = pack(d, capacity=64).collect()
    check_pack(out, rows, 64)
    assert {r["doc_id"] for r in out} == {1, 2, None, (1 << 60) + 1, 4, 5}
    assert pack(docs(spark, [])).count() == 0
    odd = clashing(d, "id", "copy", "tokens", "piece", "shard", "bin_id", "draw", "start", "cluster")
    assert rows_of(pack(odd, capacity=64)) == rows_of(pack(d, capacity=64))
    nulls = pack(d.withColumn("g", d["doc_id"] * 0 + d["n_chars"] * 0), cluster_col="g").collect()
    assert len(nulls) == 7 + sum(r["piece"] > 0 for r in nulls)
    with pytest.raises(ValueError):
        pack(d, capacity=0)
