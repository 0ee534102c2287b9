import numpy as np
import pandas as pd
import pytest

from playlens.llm import embedding_dedup as ed
from playlens.llm.embedding_dedup import embedding_near_dups
from playlens.llm.queries import QUERIES
from tests.llm.helpers import clashing, components, rows_of

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def groups(seed, sizes, noise, dim=64):
    draw = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        centre = draw.normal(size=dim)
        rows += [centre + noise * draw.normal(size=dim) * np.linalg.norm(centre) / np.sqrt(dim) for _ in range(size)]
    return np.asarray(rows, dtype=np.float32)


def brute(x, cosine=0.9):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    close = u @ u.T >= cosine
    np.fill_diagonal(close, False)
    return close, components(len(x), lambda i, j: close[i, j])


@pytest.mark.parametrize("chunk", [8, 256])
def test_equals_brute_force(spark, chunk):
    x = groups(1, [60, 5, 2, 1, 1, 30] + [1] * 200, 0.15)
    x = np.concatenate([x, x[:3], x[:1]])
    close, root = brute(x)
    out = embedding_near_dups(vectors(spark, list(enumerate(x))), chunk=chunk).collect()
    got = {r["vec_id"]: r for r in out}
    assert [got[i]["n_links"] for i in range(len(x))] == close.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == root
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def test_recall_near_the_threshold(spark):
    x = groups(2, [2] * 300, 0.33)
    close, _ = brute(x)
    got = {r["vec_id"]: r["n_links"] for r in embedding_near_dups(vectors(spark, list(enumerate(x)))).collect()}
    found = sum(got.values())
    assert close.sum() > 200 and all(got[i] <= n for i, n in enumerate(close.sum(axis=1)))
    assert found >= 0.9 * close.sum()


def test_recall_far_beyond_the_sample(spark):
    """Pairs of cosine 0.90 to 0.95 in a table ten times the quantiser's sample, against their planted partners."""
    x = groups(2, [2] * 20500, 0.33)
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    cosine = (u[::2] * u[1::2]).sum(axis=1)
    near = np.nonzero((cosine >= 0.9) & (cosine < 0.95))[0]
    table = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x), "label": 0}), SCHEMA)
    got = embedding_near_dups(table).toPandas().set_index("vec_id")
    found = got["component_id"].reindex(2 * near + 1).to_numpy() == 2 * near
    assert len(x) >= 10 * 4096 and len(near) > 10_000
    assert found.mean() >= 0.9
    assert (got["n_links"] <= 1).all()  # a pair that meets by several codes counts once


@pytest.mark.parametrize("dim", [64, 384])
def test_query_recall(spark, tmp_path, dim):
    """The query on a table of its own shape with planted links of every strength above the threshold."""
    x = np.concatenate([groups(11, [2] * 1500, 0.3, dim), groups(12, [3] * 100, 0.1, dim), groups(13, [1] * 700, 0, dim)])
    spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x), "label": 0}), SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    close = (u @ u.T >= 0.9).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in QUERIES["op8_embedding_near_dedup"](spark, str(tmp_path)).collect()}
    links = np.array([got[i] for i in range(len(x))])
    assert close.sum() > 2000 and (links <= close).all() and links.sum() >= 0.9 * close.sum()
    assert (links[3000:3300] == close[3000:3300]).all()  # groups far above the threshold are whole


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(9, v), (4, [2.0, 4.0, 6.0]), (7, [-1.0, -2.0, -3.0]), (1, None), (2, []), (3, [0.0, 0.0, 0.0])]
    rows += [(5, [None, 1.0, 2.0]), (6, [float("nan"), 1.0, 2.0]), (8, [float("inf"), 1.0, 2.0]), (10, [1.0, 2.0]), (None, v)]
    rows += [(11, [0.0, 0.0, 5.0]), (11, [0.0, 7.0, 0.0]), (12, [0.0, 0.1, 9.0]), (13, [0.0, 9.0, 0.1]), (4, [2.0, 4.0, 6.0])]
    out = rows_of(embedding_near_dups(vectors(spark, rows)), "vec_id", "n_links", "component_id", "kept")
    want = [(9, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (7, 0, 7, True)]
    want += [(i, 0, i, True) for i in (1, 2, 3, 5, 6, 8, 10)] + [(None, 0, None, False)]
    want += [(11, 2, 11, True), (11, 2, 11, True), (12, 1, 11, False), (13, 1, 11, False)]
    assert out == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert embedding_near_dups(vectors(spark, [])).count() == 0
    assert rows_of(embedding_near_dups(vectors(spark, [(1, None), (None, None)])), "vec_id", "kept") == [(1, True), (None, False)]
    odd = clashing(vectors(spark, rows), "id", "emb", "h1", "node", "n", "code", "links", "root", "t", "k", "kept")
    assert rows_of(embedding_near_dups(odd), "vec_id", "n_links", "component_id", "kept") == out


@pytest.mark.parametrize("dim", [1, 5, 64, 100])
def test_dimensions(spark, dim):
    x = groups(3, [4, 3, 1, 1, 1, 1], 0.02, dim)
    close, root = brute(x)
    got = {r["vec_id"]: r for r in embedding_near_dups(vectors(spark, list(enumerate(x)))).collect()}
    assert [got[i]["component_id"] for i in range(len(x))] == root
    assert [got[i]["n_links"] for i in range(len(x))] == close.sum(axis=1).tolist()


@pytest.mark.parametrize("learned", [64, 1])
def test_every_length_is_linked(spark, monkeypatch, learned):
    """Also where only the commonest length has a learned quantiser."""
    monkeypatch.setattr(ed, "MAX_LENGTHS", learned)
    parts = [groups(6 + i, sizes, 0.05, dim) for i, (sizes, dim) in enumerate([([3, 2] + [1] * 40, 64), ([4, 2, 1], 32), ([2, 1], 100), ([1], 7)])]
    rows, want = [], {}
    for x in parts:
        close, root = brute(x)
        want |= {len(rows) + i: (close[i].sum(), len(rows) + root[i]) for i in range(len(x))}
        rows += list(enumerate(x, len(rows)))
    rows += [(1000 + i, v) for i, v in enumerate([[1.0, 2.0], [1.0, 2.0], [2.0, -1.0], [1.0, 2.0, 0.0]])]
    want |= {1000: (1, 1000), 1001: (1, 1000), 1002: (0, 1002), 1003: (0, 1003)}
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_near_dups(vectors(spark, rows)).collect()}
    assert got == want


def test_rotation_is_orthogonal_and_balances():
    x = groups(4, [1] * 500, 0).astype(float)
    mean, projection = ed.learn_codes(x)
    assert np.allclose(projection.T @ projection, np.eye(64), atol=1e-8)
    on = (ed._unit(x) - mean) @ projection > 0
    assert 0.3 < on.mean() < 0.7


def test_groups_are_never_cut():
    rows = pd.DataFrame({"t": [0] * 3 + [1] * 9 + [2], "k": 5, "c1": 0, "c2": 0, "node": range(13)})
    for size in range(1, 14):
        batches = [rows.iloc[i : i + size] for i in range(0, 13, size)]
        parts = list(ed._whole_groups(iter(batches)))
        assert pd.concat(parts)["node"].tolist() == list(range(13))
        assert sum(p["t"].nunique() for p in parts) == 3


def coded(spark, x):
    """Nodes as the operator makes them, with codes of drawn rotations and their balls."""
    quantisers = [ed.drawn_codes(x.shape[1], 3 + c) for c in range(2)]
    codes = np.stack([ed.encode(x.astype(np.float64), *q) for q in quantisers], axis=1)
    rows = pd.DataFrame({"node": np.arange(len(x)), "h1": np.arange(len(x)), "n": 1, "d": x.shape[1], "codes": list(codes), "emb": list(x.astype(np.float64))})
    return spark.createDataFrame(rows, "node long, h1 long, n long, d int, codes array<long>, emb array<double>")


def test_work_on_near_copies_is_linear(spark):
    """One group of near copies among 300 others: compared rows and edges stay in proportion to the group."""
    for size in (500, 2000):
        nodes = coded(spark, groups(21, [size] + [1] * 300, 0.1))
        centres = ed.ball_centres(nodes, 0.9, 2, 64, 2)
        balled = nodes.withColumn("ball", ed._ball_of(centres, 0.9)("emb"))
        assert balled.where("ball >= 0").count() == size
        assert ed.bucket_members(balled, True, 2, 64, 2).count() <= 2 * size
        links, found = ed.embedding_links(nodes, chunk=64)
        assert {r["links"] for r in links.collect()} == {size - 1}
        assert found.count() == size


def test_balls_beside_each_other(spark):
    """Two overlapping balls, a ring round them, copies and repeated ids: nothing is lost or counted twice."""
    draw = np.random.default_rng(5)
    centre, side = np.linalg.qr(draw.normal(size=(64, 2)))[0].T
    def around(c, size, angle):
        off = draw.normal(size=(size, 64))
        off -= np.outer(off @ c, c)
        off /= np.linalg.norm(off, axis=1, keepdims=True)
        return np.cos(angle) * c + np.sin(angle) * off
    turned = np.cos(0.3) * centre + np.sin(0.3) * side
    x = np.concatenate([around(centre, 150, 0.12), around(turned, 150, 0.12), around(centre, 40, 0.3), around(centre, 40, 0.4)]).astype(np.float32)
    x = np.concatenate([x, x[:5], x[:1]])
    close, root = brute(x)
    out = embedding_near_dups(vectors(spark, list(enumerate(x))), chunk=16).collect()
    got = {r["vec_id"]: r for r in out}
    links, want = np.array([got[i]["n_links"] for i in range(len(x))]), close.sum(axis=1)
    assert (links <= want).all() and links.sum() >= 0.97 * want.sum()
    assert {got[i]["component_id"] for i in range(300)} == {0} == {root[i] for i in range(300)}


def test_a_third_in_one_loose_group(spark):
    """Copies near the threshold, too far apart to be one ball, hold a third of the rows."""
    x = np.concatenate([groups(31, [400], 0.27), groups(32, [1] * 800, 0)])
    close, _ = brute(x)
    got = {r["vec_id"]: r["n_links"] for r in embedding_near_dups(vectors(spark, list(enumerate(x)))).collect()}
    links, want = np.array([got[i] for i in range(len(x))]), close.sum(axis=1)
    assert want.sum() > 100_000 and (links <= want).all() and links.sum() >= 0.9 * want.sum()
