import collections
import math
import struct

import pytest
import xxhash

from playlens.llm.mixing import bisect_exponent, mix_items, mix_plan, mixed_documents, source_table
from playlens.llm.queries import QUERIES
from tests.llm.helpers import SF, clashing, docs, real_docs, rows_of, words


def plan_rows(df):
    return [r.asDict() for r in df.collect()]


def some(spark, sizes):
    """Documents of ten tokens each (nine words and the end), ``sizes`` of each source."""
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, f"w{i} " * 9, source))
            i += 1
    return docs(spark, rows)


def weights(sizes, a):
    total = sum(sizes.values())
    p = {s: (n / total) ** a for s, n in sizes.items()}
    return {s: x / sum(p.values()) for s, x in p.items()}


SIZES = {"big": 160, "mid": 40, "low": 20}


def test_repetition_limit(spark):
    plan = plan_rows(mix_plan(some(spark, SIZES), max_repeats=2.0))
    a = 1 - math.log(2) / math.log(8)
    assert plan[0]["exponent"] == pytest.approx(a, abs=1e-6)
    want = weights(SIZES, a)
    budget = 1600 / want["big"]
    uses = collections.Counter(r["src"][1:] for r in plan)
    for s, n in SIZES.items():
        assert [r["weight"] for r in plan if r["src"] == f"={s}"][0] == pytest.approx(want[s], abs=1e-6)
        assert uses[s] == pytest.approx(math.ceil(budget * want[s] / 10 - 1e-3), abs=1)
        each = collections.Counter(r["id"] for r in plan if r["src"] == f"={s}")
        assert len(each) == n and max(each.values()) - min(each.values()) <= 1 and max(each.values()) <= 2


@pytest.mark.parametrize("target", [0.6, 0.9, 0.99])
def test_target_entropy(spark, target):
    sources = source_table(mix_items(some(spark, SIZES)))
    a, measure = bisect_exponent(sources, target_entropy=target)
    w = weights(SIZES, a)
    assert -sum(x * math.log(x) for x in w.values()) == pytest.approx(target * math.log(3), abs=1e-6)
    assert measure["entropy"] == pytest.approx(target * math.log(3), abs=1e-6)


def test_budget_and_blocks(spark):
    sizes = {"x": 3000, "y": 1000}
    plan = plan_rows(mix_plan(some(spark, sizes), target_entropy=1.0, budget_tokens=20_000, block_tokens=2000))
    uses = collections.Counter(r["src"][1:] for r in plan)
    assert uses == {"x": 1000, "y": 1000} and {r["exponent"] for r in plan} == {0.0}
    blocks = collections.defaultdict(list)
    for r in plan:
        blocks[r["block"]].append(r)
    assert sorted(blocks) == list(range(10))
    for rows in blocks.values():
        assert sorted(r["position"] for r in rows) == list(range(len(rows)))
        assert collections.Counter(r["src"] for r in rows) == {"=x": 100, "=y": 100}
        order = [r["src"] for r in sorted(rows, key=lambda r: r["position"])]
        assert order != sorted(order)


def test_streams_are_cut_at_the_quota(spark):
    """Against a plain walk over each source's permutation."""
    df = some(spark, {"x": 700, "y": 30})
    plan = plan_rows(mix_plan(df, target_entropy=0.9, budget_tokens=4000, block_tokens=500))
    for s in ("x", "y"):
        own = [r for r in plan if r["src"] == f"={s}"]
        quota = math.ceil(own[0]["weight"] * 4000 - 1e-6)
        assert len(own) == math.ceil(quota / 10)
        full = collections.Counter(r["epoch"] for r in own)
        n = {"x": 700, "y": 30}[s]
        assert all(full[e] == n for e in range(max(full)))


def test_query_repeats_rare_sources(spark):
    """The sources of the table differ 3 times, so the limit must let the rarest be used nearly twice."""
    rows = QUERIES["op4_temperature_mixing"](spark, SF).collect()
    total, tokens = collections.Counter(), collections.Counter()
    for r in real_docs(spark).collect():
        total[r["source"]] += len(words(r["text"])) + 1
    for r in rows:
        tokens[r["source"]] += r["n_tokens"]
    assert max(tokens[s] / total[s] for s in total) > 1.8


def test_query(spark):
    texts = {r["doc_id"]: (r["text"], r["source"]) for r in real_docs(spark).collect()}
    rows = QUERIES["op4_temperature_mixing"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and 0 < rows[0]["exponent"] < 1  # the limit needs an inner exponent
    assert all(r["n_tokens"] == len(words(texts[r["doc_id"]][0])) + 1 and r["source"] == texts[r["doc_id"]][1] for r in rows)
    tokens, weight = collections.Counter(), {}
    for r in rows:
        tokens[r["source"]] += r["n_tokens"]
        weight[r["source"]] = r["weight"]
    total = collections.Counter()
    for t, s in texts.values():
        total[s] += len(words(t)) + 1
    budget = max(total[s] / weight[s] for s in total)
    longest = max(len(words(t)) + 1 for t, _ in texts.values())
    assert sum(weight.values()) == pytest.approx(1)
    assert all(0 <= tokens[s] - weight[s] * budget + 1 <= longest + 2 and tokens[s] <= 2 * total[s] + longest for s in total)
    again = QUERIES["op4_temperature_mixing"](spark, SF)
    assert rows_of(again, "doc_id", "epoch", "block", "position") == sorted(
        [(r["doc_id"], r["epoch"], r["block"], r["position"]) for r in rows], key=lambda r: tuple((x is None, str(x)) for x in r)
    )


def test_mixed_documents(spark):
    d = clashing(some(spark, SIZES), "id", "src", "block", "position", "_block", "tokens")
    mixed = mixed_documents(d, mix_plan(d, max_repeats=2.0))
    assert mixed.columns == d.columns
    assert mixed.count() == mix_plan(d, max_repeats=2.0).count()
    assert mixed.select("doc_id").distinct().count() == 220


def test_edges(spark):
    rows = [(1, None, None), (2, "", "a"), (2, "", "a"), (None, "x y", "a"), (None, "x y", "null"), (3, "long " * 100_000, "b"), (3, None, None)]
    plan = plan_rows(mix_plan(docs(spark, rows), max_repeats=1e9))
    assert {(r["id"], r["src"], r["copy"]) for r in plan} == {
        (1, "null", 1), (2, "=a", 1), (2, "=a", 2), (None, "=a", 1), (None, "=null", 1), (3, "=b", 1), (3, "null", 1)
    }
    whole = mixed_documents(docs(spark, rows), mix_plan(docs(spark, rows), max_repeats=1.0))
    assert rows_of(whole) == rows_of(docs(spark, rows))
    assert mix_plan(docs(spark, []), max_repeats=2.0).count() == 0
    assert mix_plan(docs(spark, []), target_entropy=0.5, budget_tokens=10).count() == 0
    one = mix_plan(docs(spark, [(1, "a b", "s")] * 5), max_repeats=2.0)
    assert rows_of(one, "id", "copy", "epoch") == [(1, c, 0) for c in range(1, 6)]
    assert mixed_documents(docs(spark, [(1, "a b", "s")] * 5), one).count() == 5
    with pytest.raises(ValueError):
        mix_plan(docs(spark, rows))


def chained(*values):
    """Spark's xxhash64 of an int and then longs: each hashed with the hash before it as seed, nulls skipped."""
    h = 42
    for i, v in enumerate(values):
        if v is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<q" if i else "<i", v), seed=h)
    return h - (1 << 64) if h >> 63 else h


def walk(rows, exponent, budget, block_tokens, seed=11):
    """(id, text key, copy, source, epoch, block, position): every source's permutations read in turn up to its quota."""
    items, copies = collections.defaultdict(list), collections.Counter()
    for doc_id, text, source in rows:
        key = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
        key = key - (1 << 64) if key >> 63 else key
        copies[doc_id, key, source] += 1
        items[source].append((doc_id, key, copies[doc_id, key, source], len(words(text)) + 1))
    total = {s: sum(r[3] for r in own) for s, own in items.items()}
    power = {s: (n / sum(total.values())) ** exponent for s, n in total.items()}
    weight = {s: x / sum(power.values()) for s, x in power.items()}
    if budget is None:
        budget = max(total[s] / weight[s] for s in total)
    blocks, dealt = max(1, math.ceil(budget / block_tokens)), collections.defaultdict(list)
    for s, own in items.items():
        quota, slots, at, epoch = math.ceil(weight[s] * budget - 1e-6), -(-len(own) // 256), 0, 0
        while at < quota:
            drawn = [(chained(seed, epoch, *r[:3]), *r) for r in own]
            for _, doc_id, key, copy, tokens in sorted(drawn, key=lambda r: (((r[0] % (1 << 64)) >> 33) * slots >> 31, r[0], r[1] is not None, *r[1:])):
                if at < quota:
                    block = min(math.floor(at / quota * blocks), blocks - 1)
                    dealt[block].append((chained(seed, block, doc_id, key, copy, epoch), doc_id, key, copy, epoch, s))
                at += tokens
            epoch += 1
    out = []
    for block, own in dealt.items():
        for position, (_, doc_id, key, copy, epoch, s) in enumerate(sorted(own, key=lambda r: (r[0], str(r[1:])))):
            out.append((doc_id, key, copy, "null" if s is None else f"={s}", epoch, block, position))
    return sorted(out, key=str)


@pytest.mark.parametrize(
    "target", [dict(max_repeats=1.7), dict(target_entropy=0.8, budget_tokens=9000), dict(target_entropy=0.95, budget_tokens=60_000)]
)
def test_plan_equals_a_plain_walk(spark, target):
    """Every use of every document, its epoch, block and place; sources of more than one slot, copies, odd rows."""
    rows = [(i, f"word{i} " * (i % 37), "big" if i % 3 else "mid" if i % 2 else "low") for i in range(900)]
    rows += [(7, "same text", "big")] * 5 + [(None, "x y z", "low"), (1000, None, None), (1001, "", None)]
    plan = plan_rows(mix_plan(docs(spark, rows).repartition(5), block_tokens=2500, **target))
    want = walk(rows, plan[0]["exponent"], target.get("budget_tokens"), 2500)
    got = sorted(((r["id"], r["text_key"], r["copy"], r["src"], r["epoch"], r["block"], r["position"]) for r in plan), key=str)
    assert got == want and 0 < plan[0]["exponent"] < 8 and len({r["block"] for r in plan}) > 3
