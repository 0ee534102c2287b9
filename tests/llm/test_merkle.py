import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from playlens.llm.merkle import Block, merkle_manifest
from tests.llm.helpers import clashing

SCHEMA = "doc_id long, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "lang", "n_chars", "text"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes, fanout):
    """Levels from the nodes to one, all rebuilt from their children."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def trail(levels, place, fanout):
    """(left, right) siblings on the way up."""
    out = []
    for nodes in levels[:-1]:
        first = place - place % fanout
        out.append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + fanout])))
        place //= fanout
    return out


def brute(rows, fanout, tampered):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    out, trees = [], {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = climb([leaf(r) for r in groups[g]], fanout)
    top = climb([trees[g][-1][0] for g in names], fanout)
    for place, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            sides = trail(trees[g], i, fanout) + trail(top, place, fanout)
            digest = leaf(tampered(r))
            for left, right in sides:
                digest = h(left, digest, right)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], h(*[a + b for a, b in sides]), digest, digest == top[-1][0]))
    return sorted(out, key=str)


def tampered(r):
    return (r[0], r[1], r[2] + 1, r[3]) if r[0] is not None and r[0] % 3 == 0 and r[2] is not None else r


def manifest(df, **kw):
    other = F.col("n_chars") + F.when(F.col("doc_id") % 3 == 0, F.lit(1)).otherwise(F.lit(0))
    return merkle_manifest(df, COLUMNS, "lang", "doc_id", changed={"n_chars": other}, **kw)


def some(n, langs, seed=1):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n + 1), n)
    return [(i, rng.choice(langs), rng.choice([None, 5, 77]), rng.choice([None, "", "é x", "long " * 50])) for i in ids]


@pytest.mark.parametrize("fanout,levels", [(2, 10), (2, 2), (3, 1), (5, 2)])
def test_equals_brute_force(spark, fanout, levels):
    """Blocks of 4 and 3 nodes: many trees upon each other, also for the single rows of a group."""
    rows = some(150, ["en"] * 12 + ["de", "fr", None, ""]) + [(9999, "zz", 1, "alone"), (None, "en", 1, "x"), (-5, "é", 2, "y")]
    got = manifest(spark.createDataFrame(rows, SCHEMA).repartition(5), fanout=fanout, levels=levels)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, fanout, tampered)


@pytest.mark.parametrize("n", [1, 2, 5, 16, 17])
def test_sizes(spark, n):
    rows = some(n, ["en"])
    got = manifest(spark.createDataFrame(rows, SCHEMA), levels=2)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 2, tampered)


def test_more_groups_than_a_block(spark):
    rows = [(i, f"g{i % 23}", i, "t") for i in range(60)]
    got = manifest(spark.createDataFrame(rows, SCHEMA), levels=2)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 2, tampered)


def test_states_fold_like_rebuilding():
    nodes = [h(str(i)) for i in range(13)]
    for fanout in (2, 3, 4):
        block = Block(nodes, fanout, None)
        assert block.root() == climb(nodes, fanout)[-1][0]
        for i in range(13):
            assert block.fold(i, nodes[i]) == block.root()
            other = [*nodes[:i], h("other"), *nodes[i + 1 :]]
            assert block.fold(i, h("other")) == climb(other, fanout)[-1][0]
            assert block.path(i) == trail(climb(nodes, fanout), i, fanout)


def test_edges(spark):
    """Repeated rows are leaves side by side; ids that repeat go by their leaf; extra columns don't matter."""
    rows = [(1, "en", 3, "same")] * 9 + [(1, "en", 4, "other"), (2, None, None, None), (None, None, None, None), (3, "en", 1, "w" * 500_000)]
    got = sorted(map(tuple, manifest(spark.createDataFrame(rows, SCHEMA), levels=2).collect()), key=str)
    assert got == brute(rows, 2, tampered)
    assert sum(r[-1] for r in got) == len(rows) - 1  # only the row with id 3 was tampered with
    odd = clashing(spark.createDataFrame(rows, SCHEMA), "id", "grp", "pos", "n", "digest", "changed", "leaf", "block", "_tie")
    assert sorted(map(tuple, manifest(odd, levels=2).collect()), key=str) == got
    empty = manifest(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"
    plain = merkle_manifest(spark.createDataFrame(rows, SCHEMA), COLUMNS, "lang", "doc_id")
    assert all(r["verified"] for r in plain.collect())
