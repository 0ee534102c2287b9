"""Mixing sources to target weights by temperature.

A source's weight is its token share raised to an exponent, normalised.  The
exponent is bisected until the weights have a target entropy, or until no
source is repeated more often than a limit.  The weights are then realised:
every source is a stream of seeded permutations of its documents (one for
each epoch), cut where its token quota ends; the streams are dealt over
blocks in equal parts, so that every block has the target weights, and every
block is permuted.

Everything is a built-in function.  Running token sums inside a source are
split into slots of its permutation order (about ``SLOT_ROWS`` documents
each), so that a source with a third of all documents is summed by many
tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playlens.llm.common import cut_lineage, free_names, one_row_each, row_items, split_words

SLOT_ROWS = 256
SLOT_GROUP = 1024
MAX_BROADCAST_SOURCES = 10_000  # a source table of more rows is joined by a shuffle
STEPS = 6  # bisection steps that one pass over the source table answers


def token_count(text: Column) -> Column:
    """Words of the text and one token that ends the document."""
    return F.size(split_words(text)).cast("long") + 1


def _source_key(source: Column) -> Column:
    """A null source is a source of its own."""
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source.cast("string")))


def mix_items(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    extra = {"src": _source_key(F.col(source_col)), "tokens": token_count(F.col(text_col))}
    return cut_lineage(row_items(docs, extra, text_col, id_col))


def source_table(items: DataFrame) -> DataFrame:
    """(``src``, ``tokens``, ``docs``, ``share``), one row for each source."""
    per = items.groupBy("src").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    total = per.agg(F.sum("tokens").alias("all"))
    return per.withColumn("share", F.col("tokens") / total.scalar())


def _measures(sources: DataFrame, exponents: list[float]) -> dict[float, dict[str, float]]:
    """Entropy of the weights and the spread of weight per token, for each exponent."""
    power, grid = F.pow("share", F.col("a")), F.array(*[F.lit(a) for a in exponents])
    rows = (
        sources.withColumn("a", F.explode(grid))
        .groupBy("a")
        .agg(
            F.sum(power).alias("z"),
            F.sum(power * F.log("share")).alias("zl"),
            F.max(power / F.col("share")).alias("high"),
            F.min(power / F.col("share")).alias("low"),
        )
        .collect()
    )
    return {
        r["a"]: {
            "entropy": math.log(r["z"]) - r["a"] * r["zl"] / r["z"],
            "high": r["high"] / r["z"],
            "low": r["low"] / r["z"],
            "z": r["z"],
        }
        for r in rows
    }


def bisect_exponent(
    sources: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget_share: float | None = None,
    passes: int = 6,
) -> tuple[float, dict[str, float]]:
    """The exponent that meets the target, and the measures of its weights.

    ``target_entropy`` is a fraction of the largest possible entropy, the
    logarithm of the number of sources; the exponent is sought in [0, 8].
    ``max_repeats`` limits how often a source's tokens are used (with
    ``budget_share`` of all tokens as budget, or with the least budget that
    uses every document); the smallest exponent in [0, 1] that keeps it is
    taken, and 1 where none does.  Both measures fall as the exponent grows.
    Every pass evaluates all exponents that the next ``STEPS`` bisection
    steps can ask for.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give either target_entropy or max_repeats")
    size = max(sources.count(), 1)
    low, high = 0.0, 8.0 if max_repeats is None else 1.0

    def above(m: dict[str, float]) -> bool:
        if max_repeats is None:
            return m["entropy"] > target_entropy * math.log(size)
        return (m["high"] / m["low"] if budget_share is None else m["high"] * budget_share) > max_repeats

    for _ in range(passes):
        width = (high - low) / 2**STEPS
        found = _measures(sources, [low + i * width for i in range(2**STEPS + 1)])
        if not found:
            return 1.0, {}
        grid = sorted(found)
        if not above(found[grid[0]]):
            return grid[0], found[grid[0]]
        a, b = 0, len(grid) - 1
        while b - a > 1:
            mid = (a + b) // 2
            a, b = (mid, b) if above(found[grid[mid]]) else (a, mid)
        low, high = grid[a], grid[b]
    return high, found[high]


def _before(slots: DataFrame) -> DataFrame:
    """Tokens of all earlier slots of the same source and epoch, by two levels of running sums."""
    grouped = slots.withColumn("group", F.floor(F.col("slot") / SLOT_GROUP))
    whole = grouped.groupBy("src", "epoch", "group").agg(F.sum("sum").alias("gsum"))
    outer = Window.partitionBy("src", "epoch").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = whole.withColumn("gbase", F.coalesce(F.sum("gsum").over(outer), F.lit(0))).drop("gsum")
    inner = Window.partitionBy("src", "epoch", "group").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = grouped.withColumn("sbase", F.coalesce(F.sum("sum").over(inner), F.lit(0)))
    return placed.join(groups, ["src", "epoch", "group"]).select(
        "src", "epoch", "slot", (F.col("gbase") + F.col("sbase")).alias("base")
    )


def mix_plan(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget_tokens: int | None = None,
    block_tokens: int = 1 << 18,
    seed: int = 11,
) -> DataFrame:
    """The mixture, one row per use of a document.

    Columns: ``id``, ``text_key``, ``copy``, ``src``, ``tokens``, ``epoch``
    (from 0), ``block`` and ``position`` (both from 0), ``weight`` (of the
    source) and ``exponent``.  Without ``budget_tokens`` the budget is the
    least that uses every document at least once, so that nothing is lost
    and rare sources are repeated.  A source's stream ends with the document
    in which its quota ends.

    Defined cases: null and empty texts are one token, the end of the
    document; a text of any length is counted whole and never cut; a null source is a source of its own; rows that repeat an id
    and a text are told apart by ``copy``; equal hashes are ordered by the
    remaining columns.  Extra columns are ignored; an empty table gives an
    empty result.
    """
    items = mix_items(docs, text_col, id_col, source_col)
    sources = cut_lineage(source_table(items))
    total = sources.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    share = budget_tokens / total if budget_tokens is not None and total else None
    exponent, measure = bisect_exponent(sources, target_entropy, max_repeats, share)
    if not measure:
        budget = 0.0
    else:
        budget = float(budget_tokens) if budget_tokens is not None else total / measure["low"]
    blocks = max(1, math.ceil(budget / block_tokens))
    weight = F.pow("share", F.lit(exponent)) / F.lit(measure.get("z", 1.0))
    quotas = cut_lineage(
        sources.withColumn("weight", weight)
        .withColumn("quota", F.ceil(F.col("weight") * budget - 1e-6))
        .select(
            "src",
            "weight",
            "quota",
            F.col("tokens").alias("src_tokens"),
            F.ceil(F.col("docs") / SLOT_ROWS).alias("slots"),
            F.ceil(F.col("quota") / F.col("tokens")).alias("epochs"),
        )
        .where("epochs > 0")
    )

    def draw(*cols: str) -> Column:
        return F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])

    side = F.broadcast(quotas) if quotas.count() <= MAX_BROADCAST_SOURCES else quotas
    uses = items.join(side, "src").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
    uses = uses.withColumn("order", draw("epoch", "id", "text_key", "copy"))
    uses = uses.withColumn("slot", F.shiftright(F.shiftrightunsigned("order", 33) * F.col("slots"), 31))
    # Dealt by slot here: where the join above has left the rows by source, the window would take them so.
    uses = uses.repartition("src", "epoch", "slot")
    slots = uses.groupBy("src", "epoch", "slot").agg(F.sum("tokens").alias("sum"))
    # The unsigned order of the slots' upper bits and the signed order inside a slot: both fixed by the hash.
    inside = Window.partitionBy("src", "epoch", "slot").orderBy("order", "id", "text_key", "copy")
    run = F.coalesce(F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = uses.withColumn("run", run).join(_before(slots), ["src", "epoch", "slot"])
    at = F.col("epoch") * F.col("src_tokens") + F.col("base") + F.col("run")
    dealt = placed.withColumn("at", at).where("at < quota")
    block = F.least(F.floor(F.col("at") / F.col("quota") * blocks), F.lit(blocks - 1)).cast("long")
    dealt = dealt.withColumn("block", block).withColumn("mix", draw("block", "id", "text_key", "copy", "epoch"))
    within = Window.partitionBy("block").orderBy("mix", "id", "text_key", "copy", "epoch")
    return dealt.select(
        "id",
        "text_key",
        "copy",
        "src",
        "tokens",
        "epoch",
        "block",
        (F.row_number().over(within) - 1).cast("long").alias("position"),
        "weight",
        F.lit(exponent).alias("exponent"),
    )


def mixed_documents(
    docs: DataFrame, plan: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """The rows of ``docs``, same columns, as often as ``plan`` uses them; a partition holds whole blocks, in order."""
    key, src = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), _source_key(F.col(source_col))
    texts = one_row_each(docs, F.col(id_col), key, src)
    names = free_names(docs, "_plan_id", "_plan_key", "_plan_src", "_block", "_position")
    uses = plan.select("id", "text_key", "src", "block", "position").toDF(*names)
    pid, pkey, psrc, block, position = (F.col(n) for n in names)
    mixed = texts.join(uses, F.col(id_col).eqNullSafe(pid) & (key == pkey) & (src == psrc))
    return mixed.repartition(block).sortWithinPartitions(block, position).drop(*names)
