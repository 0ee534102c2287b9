"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact rerank.

A rotation that balances binary codes is learned by iterative quantisation
(principal axes, then alternating sign codes and orthogonal Procrustes) on a
bounded sample; every vector gets a 64-bit code.  The code's eight bytes are
the blocks of a multi-index: there is a table for every choice of ``equal``
bytes, keyed by those bytes, so two codes meet when that many bytes agree.
One rotation alone misses a fifth of the links near the threshold that way,
so ``codes`` of them are learned from different starts, each with a code and
tables of its own.  Codes that meet within ``max_bits`` bits are candidates,
and their cosine is taken from the original vectors in double precision.
Vectors of different lengths never meet: each length has its own quantisers
and tables.

Equal vectors are one node with a count.  A pair that meets in several
tables counts only in the first of them, so links are counted where they are
found and no list of pairs is made: a bucket yields, for each of its members,
the number of links and one edge to the smallest member it is connected
with.  A bucket larger than ``chunk`` is dealt over pairs of chunks, so that
its comparisons are spread over tasks.  Vectors travel only for members that
have a candidate.

Large groups of near copies would make that quadratic, so they become balls
first: the means of the most crowded cells are centres, and vectors within
half the threshold's angle of one centre are all linked with each other, by
the triangle inequality on angles.  Such links are counted by the size of the
ball; in the tables a ball's members meet only what lies outside of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import cut_lineage, digest128
from playlens.llm.components import connected_components

BITS, BLOCKS = 64, 8
#: Quantisers are learned for the commonest lengths only, and of vectors up to a width; other lengths take drawn rotations.
MAX_LENGTHS, MAX_WIDTH = 64, 4096
#: Cells that may become centres of balls in a round, and rounds; what lies in no ball is compared in chunks.
MAX_CELLS, ROUNDS = 256, 3
_GROUP = ["t", "k", "c1", "c2"]


def _weights(unit: np.ndarray, alike: float = 0.8) -> np.ndarray:
    """One over the number of vectors that are alike, so that a group of near copies weighs about one vector."""
    near = [(unit[lo : lo + 512] @ unit.T >= alike).sum(axis=1) for lo in range(0, len(unit), 512)]
    return 1.0 / np.maximum(np.concatenate(near), 1)


def learn_codes(sample: np.ndarray, rounds: int = 40, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) of iterative quantisation: code bits are ``(unit - mean) @ projection > 0``.

    Near copies share the weight of one vector, and the mean is drawn to zero
    by ``BITS`` vectors of zero: codes centred on a large group's own middle
    would tear the group apart.
    """
    unit = _unit(sample)
    weight = _weights(unit)[:, None]
    mean = (weight * unit).sum(axis=0) / (weight.sum() + BITS)
    centred = unit - mean
    _, axes = np.linalg.eigh((weight * centred).T @ centred)
    axes = axes[:, ::-1][:, :BITS]
    flat = centred @ axes
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))
    for _ in range(rounds):
        signs = np.where(flat @ rotation > 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd((weight * signs).T @ flat)
        rotation = (u @ vt).T
    return mean, axes @ rotation


def drawn_codes(width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) of a rotation that is drawn, not learned."""
    drawn = np.random.default_rng([seed, width]).normal(size=(width, min(width, BITS)))
    return np.zeros(width), np.linalg.qr(drawn)[0]


def learned_quantisers(distinct: DataFrame, sample: int, codes: int) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    """Quantisers by length (``d``), each learned in a task of its own; at most ``MAX_LENGTHS`` times ``codes`` are fetched."""
    counts = distinct.where(f"d <= {MAX_WIDTH}").groupBy("d").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    common = [r["d"] for r in counts.orderBy(F.desc("rows"), "d").limit(MAX_LENGTHS).collect()]
    first = Window.partitionBy("d").orderBy(F.xxhash64("node"), "node", "h1")
    taken = distinct.where(F.col("d").isin(common)).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= sample)

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(rows.sort_values("nth")["emb"].to_numpy())
        learned = [learn_codes(vectors, seed=3 + c) for c in range(codes)]
        return pd.DataFrame(
            {"d": rows["d"].iloc[0], "c": range(codes), "mean": [m for m, _ in learned], "projection": [p.ravel() for _, p in learned]}
        )

    out: dict[int, list] = {}
    found = taken.select("d", "nth", "emb").groupBy("d").applyInPandas(learn, "d int, c int, mean array<double>, projection array<double>")
    for r in sorted(found.collect(), key=lambda r: (r["d"], r["c"])):
        out.setdefault(r["d"], []).append((np.array(r["mean"]), np.array(r["projection"]).reshape(r["d"], -1)))
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Codes as signed longs; with fewer than 64 bits they are dealt over the bytes in turn."""
    on = (_unit(x) - mean) @ projection > 0
    bits = np.zeros((len(x), BITS), dtype=np.uint8)
    place = np.arange(on.shape[1])
    bits[:, place % BLOCKS * 8 + place // BLOCKS] = on
    return np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()


def _tables(equal: int) -> list[tuple[int, int, int]]:
    """(mask, last byte, bytes before the last) of every table; the masks are signed."""
    found = []
    for chosen in combinations(range(BLOCKS), equal):
        mask = sum(0xFF << 8 * b for b in chosen)
        found.append((mask - (1 << 64) if mask >> 63 else mask, chosen[-1], equal - 1))
    return found


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows, sorted by group before, cut so that no group is split."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[_GROUP].to_numpy()
        if held and (held[-1][_GROUP].to_numpy()[-1] == keys[0]).all():
            edge = np.nonzero((keys != keys[0]).any(axis=1))[0]
            if not len(edge):
                held.append(batch)
                continue
            held.append(batch.iloc[: edge[0]])
            batch, keys = batch.iloc[edge[0] :], keys[edge[0] :]
        if held:
            yield pd.concat(held, ignore_index=True)
        last = np.nonzero((keys != keys[-1]).any(axis=1))[0]
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield batch.iloc[:cut].reset_index(drop=True)
        held = [batch.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def _by_length(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The rows of every length of ``emb``; tables belong to one length, so no group is split."""
    for _, part in rows.groupby(rows["emb"].map(len), sort=False):
        yield part.reset_index(drop=True)


def _candidates(rows: pd.DataFrame, equal: int, max_bits: int, codes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of candidate pairs in the same group, whose first common table is the group's."""
    keys = rows[_GROUP].to_numpy()
    new = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]
    first = np.nonzero(new)[0]
    size = np.diff(np.r_[first, len(rows)])
    after = np.repeat(first + size, size) - np.arange(len(rows)) - 1  # rows of the group that follow
    node, chunk = rows["node"].to_numpy(), rows["chunk"].to_numpy()
    ball = rows["ball"].to_numpy()
    every = np.stack([rows[f"code{c}"].to_numpy() for c in range(codes)])
    cross = rows["c1"].to_numpy() != rows["c2"].to_numpy()
    tables = _tables(equal)
    which, table = np.divmod(rows["t"].to_numpy() % (codes * len(tables)), len(tables))
    code = every[which, np.arange(len(rows))]
    last = np.array([t[1] for t in tables])[table]
    i, step = np.arange(len(rows)), 1
    while len(i := i[after[i] >= step]):
        x = code[i] ^ code[i + step]
        near = (np.bitwise_count(x.view(np.uint64)) <= max_bits) & (node[i] != node[i + step])
        near &= ~cross[i] | (chunk[i] != chunk[i + step])
        near &= (ball[i] < 0) | (ball[i] != ball[i + step])  # pairs inside a ball are counted by its size
        a = i[near]
        same = np.cumsum(x[near].view(np.uint8).reshape(-1, BLOCKS) == 0, axis=1)
        a = a[same[np.arange(len(a)), last[a] - 1] == equal - 1] if equal > 1 else a[(same[np.arange(len(a)), last[a]] == 1)]
        for c in range(codes - 1):  # a pair that met by an earlier code counts there
            x = every[c, a] ^ every[c, a + step]
            met = (x.view(np.uint8).reshape(-1, BLOCKS) == 0).sum(axis=1) >= equal
            met &= np.bitwise_count(x.view(np.uint64)) <= max_bits
            a = a[~met | (which[a] <= c)]
        if len(a):
            yield a, a + step
        step += 1


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the smallest row that it is connected with."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root


def ball_centres(nodes: DataFrame, cosine: float, equal: int, chunk: int, codes: int) -> dict[int, np.ndarray]:
    """Centres by length: unit means of the most crowded cells of one table a round, none inside another's ball.

    Any vector may be a centre, so the choice bears on the work only.  A
    round fetches at most ``MAX_CELLS`` means.
    """
    centres: dict[int, np.ndarray] = {}
    tables = _tables(equal)
    for r in range(ROUNDS):
        cell = F.get("codes", F.lit(r % codes)).bitwiseAND(F.lit(tables[r * (len(tables) // ROUNDS)][0]))
        left = nodes.where(f"d <= {MAX_WIDTH}").select("d", cell.alias("k"), "emb")
        if centres:
            left = left.where(_ball_of(centres, cosine)("emb") < 0)
        sizes = left.groupBy("d", "k").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > chunk)
        crowded = {(c["d"], c["k"]): c["size"] for c in sizes.orderBy(F.desc("size"), "d", "k").limit(MAX_CELLS).collect()}
        if not crowded:
            continue

        def sums(batches: Iterator[pd.DataFrame], wanted: frozenset = frozenset(crowded)) -> Iterator[pd.DataFrame]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for key, part in batch.groupby(["d", "k"], sort=False):
                    if key in wanted:
                        total[key] = total.get(key, 0.0) + _unit(np.stack(part["emb"].to_numpy()).astype(np.float64)).sum(axis=0)
            if total:
                yield pd.DataFrame({"d": [d for d, _ in total], "k": [k for _, k in total], "sum": list(total.values())})

        def added(part: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"d": part["d"].iloc[:1], "k": part["k"].iloc[:1], "sum": [np.sum(part["sum"].to_numpy(), axis=0)]})

        shape = "d int, k long, sum array<double>"
        means = left.mapInPandas(sums, shape).groupBy("d", "k").applyInPandas(added, shape).collect()
        for m in sorted(means, key=lambda m: (-crowded[m["d"], m["k"]], m["d"], m["k"])):
            mean = np.array(m["sum"])
            if not np.abs(mean).max() > 0:
                continue
            mean, own = _unit(mean[None])[0], centres.get(m["d"], np.zeros((0, m["d"])))
            if not (own @ mean >= _half_angle(cosine)).any():
                centres[m["d"]] = np.vstack([own, mean])
    return centres


def _half_angle(cosine: float) -> float:
    """Cosine of half the angle, with a margin for rounding."""
    return float(np.sqrt((1 + cosine) / 2)) + 1e-9


def _ball_of(centres: dict[int, np.ndarray], cosine: float):
    """A pandas UDF: the number of the first centre within half the angle, or -1."""
    start, offsets = 0, {}
    for d in sorted(centres):
        offsets[d], start = start, start + len(centres[d])

    @F.pandas_udf("long")
    def ball(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            found, sizes = np.full(len(x), -1, dtype=np.int64), x.map(len).to_numpy()
            for d in set(sizes) & set(centres):
                at = np.nonzero(sizes == d)[0]
                inside = _unit(np.stack(x.to_numpy()[at]).astype(np.float64)) @ centres[d].T >= _half_angle(cosine)
                found[at] = np.where(inside.any(axis=1), offsets[d] + inside.argmax(axis=1), -1)
            yield pd.Series(found)

    return ball


def ball_links(nodes: DataFrame) -> DataFrame:
    """(``node``, ``root``, ``links``) of the members of every ball, which are all linked with each other."""
    members = nodes.where("ball >= 0").groupBy("ball", "node").agg(F.sum("n").alias("own"), F.count(F.lit(1)).alias("rows"))
    whole = members.groupBy("ball").agg(F.sum("own").alias("all"), F.min("node").alias("root"))
    # One row for each ball, of which there are at most MAX_CELLS times ROUNDS.
    out = members.join(F.broadcast(whole), "ball").where(F.col("all") > F.col("own"))
    return out.select("node", "root", (F.col("rows") * (F.col("all") - F.col("own"))).alias("links"))


def bucket_members(nodes: DataFrame, balls: bool, equal: int, chunk: int, codes: int) -> DataFrame:
    """Rows of ``nodes`` in every bucket and pair of chunks (``t``, ``k``, ``c1``, ``c2``) where they have to be compared.

    The members of a ball that fill more than a chunk of a bucket have
    chunks of their own, which meet the bucket's other chunks only.
    """
    names, tables = [f"code{c}" for c in range(codes)], _tables(equal)
    keys = [
        F.struct((F.col("d") * (codes * len(tables)) + c * len(tables) + t).alias("t"), F.col(name).bitwiseAND(F.lit(mask)).alias("k"))
        for c, name in enumerate(names)
        for t, (mask, _, _) in enumerate(tables)
    ]
    named = [F.get("codes", F.lit(c)).alias(name) for c, name in enumerate(names)]
    coded = nodes.select("node", "h1", "ball", F.col("d").cast("long").alias("d"), *named)
    rows = coded.select("node", "h1", "ball", *names, F.inline(F.array(*keys)))
    size, none = F.count(F.lit(1)).alias("size"), F.lit(0).cast("long")

    def chunks_of(rows_in: Column) -> Column:
        return F.ceil(rows_in / chunk)

    if balls:
        bucket = Window.partitionBy("t", "k")
        before = bucket.orderBy("ball").rowsBetween(Window.unboundedPreceding, -1)
        sizes = rows.groupBy("t", "k", "ball").agg(size)
        sizes = sizes.withColumn("apart", (F.col("ball") >= 0) & (F.col("size") > chunk))
        sizes = sizes.withColumn("own", F.when(F.col("apart"), chunks_of(F.col("size"))).otherwise(none))
        sizes = sizes.withColumn("rest", chunks_of(F.sum(F.when(F.col("apart"), none).otherwise(F.col("size"))).over(bucket)))
        sizes = sizes.withColumns(
            {
                "total": F.sum("size").over(bucket),
                "chunks": F.col("rest") + F.sum("own").over(bucket),
                "first": F.when(F.col("apart"), F.col("rest") + F.coalesce(F.sum("own").over(before), none)).otherwise(none),
            }
        )
        sizes = sizes.where(F.col("total") > F.when(F.col("ball") >= 0, F.col("size")).otherwise(1))
        sizes = sizes.withColumn("own", F.when(F.col("apart"), F.col("own")).otherwise(F.col("rest"))).drop("size", "rest", "total")
        met = rows.join(sizes, ["t", "k", "ball"])
    else:
        sizes = rows.groupBy("t", "k").agg(size).where("size > 1").withColumn("own", chunks_of(F.col("size"))).drop("size")
        met = rows.join(sizes, ["t", "k"]).withColumns({"apart": F.lit(False), "chunks": F.col("own"), "first": none})
    met = met.withColumn("chunk", (F.col("first") + F.pmod(F.xxhash64("node"), F.col("own"))).cast("int"))
    every = F.sequence(none, F.col("chunks") - 1)
    outside = F.filter(every, lambda c: (c < F.col("first")) | (c >= F.col("first") + F.col("own")))
    met = met.withColumn("other", F.explode(F.when(F.col("apart"), outside).otherwise(every))).withColumn("other", F.col("other").cast("int"))
    return met.select(
        "t", "k", F.least("chunk", "other").alias("c1"), F.greatest("chunk", "other").alias("c2"), "chunk", "ball", "node", "h1", *names
    )


def embedding_links(
    nodes: DataFrame, cosine: float = 0.9, equal: int = 2, max_bits: int = 16, chunk: int = 256, codes: int = 2
) -> tuple[DataFrame, DataFrame]:
    """Links between ``nodes`` (``node``, ``h1``, ``n``, ``d``, ``codes``, ``emb``; a node may have several rows): (``node``, ``links``) and edges (``u``, ``v``).

    ``d`` is the vector's length; only vectors of one length meet.
    ``links`` counts the copies of the linked nodes.
    """
    names = [f"code{c}" for c in range(codes)]
    centres = ball_centres(nodes, cosine, equal, chunk, codes)
    if centres:
        nodes = cut_lineage(nodes.withColumn("ball", _ball_of(centres, cosine)("emb")))
    else:
        nodes = nodes.withColumn("ball", F.lit(-1).cast("long"))
    met = bucket_members(nodes, bool(centres), equal, chunk, codes)

    def with_candidate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _whole_groups(batches):
            hit = np.zeros(len(group), dtype=bool)
            for a, b in _candidates(group, equal, max_bits, codes):
                hit[a] = hit[b] = True
            yield group.loc[hit, [*_GROUP, "chunk", "ball", "node", "h1", *names]]

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in (of_length for whole in _whole_groups(batches) for of_length in _by_length(whole)):
            unit = _unit(np.stack(group["emb"].to_numpy()).astype(np.float64))
            n, links, found = group["n"].to_numpy(), np.zeros(len(group), dtype=np.int64), []
            for a, b in _candidates(group, equal, max_bits, codes):
                for lo in range(0, len(a), 4096):
                    x, y = a[lo : lo + 4096], b[lo : lo + 4096]
                    ok = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
                    x, y = x[ok], y[ok]
                    np.add.at(links, x, n[y])
                    np.add.at(links, y, n[x])
                    found.append((x, y))
            if not links.any():
                continue
            node = group["node"].to_numpy()
            root = node[_local_roots(len(group), np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))]
            out = pd.DataFrame({"node": node, "root": root, "links": links})
            yield out[links > 0]

    parted = met.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "node")
    members = parted.mapInPandas(with_candidate, parted.schema.simpleString()[7:-1].replace(":", " "))
    fetched = members.join(nodes.select("node", "h1", "n", "emb"), ["node", "h1"]).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "node")
    found = fetched.mapInPandas(verified, "node long, root long, links long")
    found = cut_lineage(found.unionAll(ball_links(nodes)) if centres else found)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    return links, found.select(F.col("node").alias("u"), F.col("root").alias("v"))


def embedding_near_dups(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.9,
    equal: int = 2,
    max_bits: int = 16,
    sample: int = 4096,
    chunk: int = 256,
    codes: int = 2,
) -> DataFrame:
    """One row per row of ``vectors``: ``id_col``, ``n_links``, ``component_id``, ``kept``.

    ``n_links`` is the number of other rows linked directly (cosine at least
    ``cosine``), ``component_id`` the smallest id reachable over links, the
    row's own included, and ``kept`` whether that is the row's own id.  The
    quantisers of a length are learned from the ``sample`` different vectors
    of it with the smallest hash of their id; lengths beyond the
    ``MAX_LENGTHS`` commonest and ``MAX_WIDTH`` take drawn rotations.  Every
    vector is indexed, by ``codes`` codes.
    Two vectors whose codes agree in fewer than ``equal`` of their eight
    bytes, by every code, never meet (none such differ in fewer than
    ``9 - equal`` bits of a code); a larger ``equal`` makes smaller buckets
    for larger tables and needs more ``codes`` for the same recall.

    Defined cases: vectors that are null, empty or zero, or hold null or
    non-finite components link with nothing; others link with vectors of
    their own length.  Rows with a null id link with nothing; their
    component is null and they are not kept.  Rows that repeat an id are one
    node, linked wherever one of their vectors is.  Extra columns are
    ignored; an empty table gives an empty result.
    """
    emb = F.col("emb")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("emb"))
    finite = F.forall(emb, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    sound = F.col("id").isNotNull() & emb.isNotNull() & finite & F.exists(emb, lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    rows = rows.withColumns({n: F.when(F.col("sound"), h) for h, n in zip(digest128(emb), ("h1", "h2"))})
    distinct = (
        rows.where("h1 IS NOT NULL")
        .groupBy("h1", "h2")
        .agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n"), F.min("emb").alias("emb"))
    )
    distinct = cut_lineage(distinct.withColumn("d", F.size("emb")))
    quantisers = learned_quantisers(distinct, sample, codes)

    @F.pandas_udf("array<long>")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            found = pd.Series([np.zeros(codes, dtype=np.int64)] * len(x), dtype="object")
            sizes = x.map(len).to_numpy()
            for d in set(sizes):
                at = np.nonzero(sizes == d)[0]
                same = np.stack(x.to_numpy()[at])
                own = quantisers.get(d) or [drawn_codes(d, 3 + c) for c in range(codes)]
                found.iloc[at] = list(np.stack([encode(same, *q) for q in own], axis=1))
            yield found

    nodes = cut_lineage(distinct.select("h1", "h2", "node", "n", "d", "emb", code("emb").alias("codes")))
    links, edges = embedding_links(nodes, cosine, equal, max_bits, chunk, codes)
    roots = connected_components(edges).withColumnRenamed("node", "member")
    info = (
        nodes.select("h1", "h2", "node", "n")
        .join(links.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left")
        .join(roots, F.col("node") == F.col("member"), "left")
        .select(
            F.col("h1").alias("i1"),
            F.col("h2").alias("i2"),
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    out = rows.select("id", "h1", "h2").join(info, (F.col("h1") == F.col("i1")) & (F.col("h2") == F.col("i2")), "left")
    out = out.select(
        "id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))).withColumnRenamed("id", id_col)
