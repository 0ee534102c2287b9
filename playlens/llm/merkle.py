"""Merkle manifest of a dataset, with proofs that are folded from retained hash states.

Every row is a leaf; the leaves of a group, in the order of their ids, are
hashed run by run up to the group's root, and the groups' roots likewise to
the root of the dataset.

A parent keeps copies of its hash state as it was before each child.  To
fold a replaced child into the tree, the state before its slot is copied,
and takes the replacement and the siblings to the right only: what lies to
the left is in the state already.

The tree is built in blocks of ``fanout ** levels`` nodes, each in one task
however many leaves a group has: blocks of leaves give the leaves of the
next tree above, until one node is left.  Paths then come down the same
way, and every leaf block is folded by the states of its own nodes and of
its path upwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.llm.common import cut_lineage
from playlens.operators.order import global_positions

FANOUT = 2
LEVELS = 10

# A path upwards: the siblings to the left and to the right of each node on it, joined.
PATH = "array<struct<left:string,right:string>>"


def hashed(*parts: str) -> str:
    state = sha256()
    for part in parts:
        state.update(part.encode())
    return state.hexdigest()


class Block:
    """A subtree over some nodes; ``states[level][parent][slot]`` is the hash before that child."""

    def __init__(self, nodes: list[str], fanout: int, levels: int | None):
        """``levels``: how many to build, also above a single node; None: until one node is left."""
        self.fanout, self.nodes, self.states = fanout, [nodes], []
        while len(self.states) < levels if levels is not None else len(self.nodes[-1]) > 1:
            parents, states = [], []
            below = self.nodes[-1]
            for at in range(0, len(below), fanout):
                state, before = sha256(), []
                for child in below[at : at + fanout]:
                    before.append(state.copy())
                    state.update(child.encode())
                parents.append(state.hexdigest())
                states.append(before)
            self.nodes.append(parents)
            self.states.append(states)

    def root(self) -> str:
        return self.nodes[-1][0]

    def path(self, place: int) -> list[tuple[str, str]]:
        out = []
        for nodes in self.nodes[:-1]:
            first = place - place % self.fanout
            out.append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + self.fanout])))
            place //= self.fanout
        return out

    def fold(self, place: int, replacement: str) -> str:
        for nodes, states in zip(self.nodes, self.states):
            parent, slot = divmod(place, self.fanout)
            state = states[parent][slot].copy()
            state.update(replacement.encode())
            for right in nodes[place + 1 : (parent + 1) * self.fanout]:
                state.update(right.encode())
            replacement, place = state.hexdigest(), parent
        return replacement


class Ascent:
    """A path upwards as retained states: the hash before the node on the path, and what follows it."""

    def __init__(self, path: list[tuple[str, str]]):
        self.steps = [(sha256(left.encode()), right.encode()) for left, right in path]

    def fold(self, replacement: str) -> str:
        for before, right in self.steps:
            state = before.copy()
            state.update(replacement.encode())
            state.update(right)
            replacement = state.hexdigest()
        return replacement


def _block_of(table: pa.Table, column: str, fanout: int, levels: int) -> tuple[pa.Table, Block]:
    """The nodes of one block in order, and the subtree over them."""
    table = table.sort_by("pos")
    whole = table["n"][0].as_py() > fanout**levels  # other blocks beside it: all rise by as many levels
    return table, Block(table[column].to_pylist(), fanout, levels if whole else None)


NODES = "grp string, pos long, n long, digest string"


def _blocks(nodes: DataFrame, size: int) -> DataFrame:
    return nodes.withColumn("block", F.floor((F.col("pos")) / size).cast("long"))


def tree(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Tables of ``NODES`` from the given one up to one node for each group.

    ``pos`` counts from 0 in each group, ``n`` is the group's number of
    nodes.  Every table after the first is checkpointed; the number of
    tables is the logarithm of the largest group.
    """
    size = fanout**levels

    def rise(table: pa.Table) -> pa.Table:
        n = -(-table["n"][0].as_py() // size)
        grp, place = table["grp"][0].as_py(), table["block"][0].as_py()
        root = _block_of(table, "digest", fanout, levels)[1].root()
        return pa.table({"grp": [grp], "pos": [place], "n": [n], "digest": [root]})

    tables = [nodes]
    while True:
        tables.append(cut_lineage(_blocks(tables[-1].select("grp", "pos", "n", "digest"), size).groupBy("grp", "block").applyInArrow(rise, NODES)))
        if (tables[-1].agg(F.max("n")).first()[0] or 1) == 1:
            return tables


def paths_down(tables: list[DataFrame], top: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Paths of the nodes of ``tables[1]``, from ``top``: (grp, pos, path, subroot) of the last table's nodes."""
    size = fanout**levels
    schema = f"grp string, pos long, path {PATH}, subroot string"
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def descend(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, block = _block_of(nodes, "digest", fanout, levels)
        up = [(s["left"], s["right"]) for s in above["path"][0].as_py()]
        first = nodes["pos"][0].as_py()
        whole = [[{"left": a, "right": b} for a, b in block.path(p - first) + up] for p in nodes["pos"].to_pylist()]
        return pa.table(
            {
                "grp": nodes["grp"],
                "pos": nodes["pos"],
                "path": pa.array(whole, type=kind),
                "subroot": pa.array([above["subroot"][0].as_py()] * len(whole), type=pa.string()),
            }
        )

    paths = top
    for nodes in reversed(tables[1:-1]):
        left = _blocks(nodes, size).groupBy("grp", "block")
        right = paths.withColumnRenamed("pos", "block").groupBy("grp", "block")
        paths = left.cogroup(right).applyInArrow(descend, schema)
    return paths


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 of the columns in order, each ``-`` where null, else its length in bytes, ``:`` and its value."""
    parts = []
    for c in columns.values():
        text = c.cast("string")
        parts.append(F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def merkle_manifest(
    docs: DataFrame,
    columns: list[str],
    group_col: str,
    id_col: str,
    changed: dict[str, Column] | None = None,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """One row for each row of ``docs``: id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    ``columns`` are hashed into the leaf, ``changed`` names other values of
    some of them: the leaf of the changed row is folded with the original
    siblings to ``folded_root``, and ``verified`` tells whether that is the
    ``root``.  ``proof_sha256`` is the hash of all siblings on the way up.

    Defined cases: a null in a column is hashed as such and differs from an
    empty text; null groups come first and are one group, null ids come
    first in their group; rows that share an id are ordered by their leaf,
    rows that are equal in all columns are leaves side by side, each with a
    path of its own (which row has which is arbitrary); a group of one row
    has its leaf as subroot, a dataset of one group the subroot as root; a
    text of any length is hashed whole; other columns are ignored, whatever
    their names.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    plain = {c: F.col(c) for c in columns}
    other = plain | (changed or {})
    same = F.lit(True)
    for c in changed or {}:
        same = same & plain[c].eqNullSafe(other[c])
    leaf = leaf_digest(plain)
    # Texts are read and hashed once; all that follows works on this narrow table.
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("grp"),
        F.col(id_col).alias("id"),
        leaf.alias("digest"),
        F.when(same, leaf).otherwise(leaf_digest(other)).alias("changed"),
    )
    order = [F.col("id").asc_nulls_first(), F.col("digest").asc()]
    leaves = global_positions(cut_lineage(rows), order, "pos", per=["grp"], size_col="n").withColumn("pos", F.col("pos") - 1)

    groups = tree(leaves, fanout, levels)
    subroots = groups[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    ranked = global_positions(subroots, [F.col("name").asc()], "pos", size_col="n").withColumn("pos", F.col("pos") - 1)
    ranked = cut_lineage(ranked)
    tops = tree(ranked, fanout, levels)
    root = tops[-1].first()
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    none = spark.createDataFrame([("", 0, [], "")], f"grp string, pos long, path {PATH}, subroot string")
    up = paths_down([ranked, *tops], none, fanout, levels)
    names = ranked.select(F.col("name"), F.col("pos").alias("_pos"), F.col("digest").alias("_root"))
    top = names.join(up, F.col("_pos") == F.col("pos")).select(
        F.col("name").alias("grp"), F.lit(0).cast("long").alias("pos"), "path", F.col("_root").alias("subroot")
    )
    paths = paths_down(groups, cut_lineage(top), fanout, levels)

    size, the_root = fanout**levels, root["digest"] if root else ""
    id_type = rows.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            *[T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
            T.StructField("verified", T.BooleanType()),
        ]
    )

    def finish(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, block = _block_of(nodes, "digest", fanout, levels)
        up = [(s["left"], s["right"]) for s in above["path"][0].as_py()]
        ascent, beyond = Ascent(up), "".join(a + b for a, b in up)
        first, n = nodes["pos"][0].as_py(), len(nodes)
        proofs, folded = [], []
        for place, leaf in zip(nodes["pos"].to_pylist(), nodes["changed"].to_pylist()):
            near = "".join(a + b for a, b in block.path(place - first))
            proofs.append(hashed(near, beyond))
            folded.append(ascent.fold(block.fold(place - first, leaf)))
        return pa.table(
            {
                "id": nodes["id"],
                "leaf": nodes["digest"],
                "subroot": pa.array([above["subroot"][0].as_py()] * n, type=pa.string()),
                "root": pa.array([the_root] * n, type=pa.string()),
                "proof_sha256": pa.array(proofs, type=pa.string()),
                "folded_root": pa.array(folded, type=pa.string()),
                "verified": pa.array([f == the_root for f in folded], type=pa.bool_()),
            }
        )

    left = _blocks(leaves, size).groupBy("grp", "block")
    right = paths.withColumnRenamed("pos", "block").groupBy("grp", "block")
    return left.cogroup(right).applyInArrow(finish, schema).withColumnRenamed("id", id_col)
