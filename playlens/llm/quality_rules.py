"""Quality rules: counted base rules and a hashed n-gram log-likelihood ratio.

The words of every text are hashed into buckets; unigrams and bigrams of
buckets are counted over the whole corpus (raw) and over the trusted
documents in it (target).  Both counts give smoothed multinomials, and a
document's score is the mean over its n-grams of
``log p_target - log p_raw``.  Every document is held against the same
threshold, so the verdict is deterministic.

The buckets grow with the corpus, see ``buckets_for``.

Everything is a built-in function.  The counting pass shuffles four bytes a
word (bucket numbers, not texts) to meet the trusted ids.  In the scoring
pass the ratios of frequent buckets are broadcast, those that hold at least
one of ``HELD`` n-grams of the corpus each, so that there are never more than
``HELD`` of them.  What lies in other buckets, which there are only where the
corpus has more than ``HELD``, is counted per document and joined with its
ratios: no key of that join holds more than one of ``HELD`` n-grams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import cut_lineage, split_lines, split_words

# Limits of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"

MIN_BUCKETS = 1 << 15
MIN_OCTETS = 1 << 25
HELD = 1 << 20  # rows of the ratio table that are broadcast at most, 24 bytes each
MICRO = 1_000_000  # ratios are summed as integers, in any order the same


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def buckets_for(docs: DataFrame, text_col: str = "text") -> int:
    """A power of two: ``MIN_BUCKETS`` up to ``MIN_OCTETS`` octets of text, twice as many for every four times of that."""
    octets = docs.agg(F.coalesce(F.sum(F.octet_length(text_col).cast("long")), F.lit(0))).first()[0]
    buckets = MIN_BUCKETS
    while buckets * buckets * MIN_OCTETS < octets * MIN_BUCKETS * MIN_BUCKETS:
        buckets *= 2
    return buckets


def _number(buckets: int) -> str:
    return "int" if buckets <= 1 << 31 else "long"


def _buckets(hashes: Column, buckets: int) -> Column:
    return F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast(_number(buckets)))


def _ngrams(uni: Column, buckets: int) -> Column:
    """Buckets of the unigrams and then of the bigrams, which are hashed from pairs of unigram buckets."""
    pairs = F.zip_with(
        F.slice(uni, F.lit(1), F.greatest(F.size(uni) - 1, F.lit(0))),
        F.slice(uni, F.lit(2), F.greatest(F.size(uni) - 1, F.lit(0))),
        lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast(_number(buckets)),
    )
    return F.concat(uni, pairs)


def bucket_counts(
    docs: DataFrame, trusted: DataFrame, buckets: int, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """(``bucket``, ``n_raw``, ``n_target``): n-grams of all documents and of those whose id is in ``trusted``."""
    hashed = docs.select(F.col(id_col).alias("id"), _buckets(word_hashes(split_words(F.col(text_col))), buckets).alias("uni"))
    # Merged at every size: the ids grow with the corpus, so they are never broadcast.
    ids = trusted.select(F.col(id_col).alias("tid")).where("tid IS NOT NULL").distinct().hint("merge")
    marked = hashed.join(ids, hashed["id"] == ids["tid"], "left").select(
        F.col("tid").isNotNull().cast("long").alias("target"), F.explode(_ngrams(F.col("uni"), buckets)).alias("bucket")
    )
    return marked.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_raw"), F.sum("target").alias("n_target"))


def ratio_table(counts: DataFrame, buckets: int, smoothing: float) -> DataFrame:
    """(``bucket``, ``n_raw``, ``micro`` int): log-likelihood ratios in millionths of the buckets that occur."""
    totals = counts.agg(F.coalesce(F.sum("n_raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("n_target"), F.lit(0)).alias("target"))
    mass = smoothing * buckets
    ratio = F.log((F.col("n_target") + smoothing) / (totals.select("target").scalar() + mass)) - F.log(
        (F.col("n_raw") + smoothing) / (totals.select("raw").scalar() + mass)
    )
    return counts.select("bucket", "n_raw", F.round(ratio * MICRO).cast("int").alias("micro"))


def _joined_sums(grams: DataFrame, ratios: DataFrame, held: DataFrame) -> DataFrame:
    """(``rid``, ``rkey``, ``more``): the ratios outside ``held`` that a row's n-grams sum to; equal rows share theirs."""
    key = ["id", "text_key"]
    copies = grams.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    rare = grams.select(*key, F.explode("grams").alias("bucket")).join(F.broadcast(held.select("bucket")), "bucket", "left_anti")
    rare = rare.groupBy(*key, "bucket").agg(F.count(F.lit(1)).alias("m"))
    sums = rare.join(ratios.select("bucket", "micro").hint("merge"), "bucket").groupBy(*key).agg(F.sum(F.col("m") * F.col("micro")).alias("all"))
    sums = sums.toDF("rid", "rkey", "all")
    both = sums.join(copies, sums["rid"].eqNullSafe(copies["id"]) & (sums["rkey"] == copies["text_key"]))
    return both.select("rid", "rkey", F.expr("all div copies").alias("more"))


def _windows(hashes: str) -> Column:
    """Hashes of the three-word windows."""
    return F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )


def _repeated_words(order: str) -> Column:
    """Words covered by windows that stand beside an equal one in ``order`` (sorted hashes and places, or null)."""
    twice = F.filter(
        order,
        lambda x, i: F.coalesce(x["h"] == F.get(order, i - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(order, i + 1)["h"], F.lit(False)),
    )
    covered = F.flatten(F.transform(twice, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
    return F.when(F.col(order).isNull(), 0).otherwise(F.size(F.array_distinct(covered))).cast("long")


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    buckets: int | None = None,
    smoothing: float = 1.0,
    threshold: float = -0.1,
    most_held: int = HELD,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``text_key``, base counts, ``base_failed``, ``score``, ``kept``.

    ``trusted`` names the target documents by ``id_col``.  ``word_chars``
    counts code points in words, ``n_symbols`` the characters
    ``#*$%&|<>``, ``n_dup_lines`` lines with a word that equal an earlier
    line, ``n_repeat_words`` words in three-word windows that the text has
    twice or more.  ``kept`` is false where the base rules fail and else
    ``score >= threshold``.  ``text_key`` is a hash of the text.  ``buckets``
    is ``buckets_for(docs)`` unless given; ``most_held`` changes the way of
    the ratios to the documents, not the result.

    Defined cases: null and empty texts have no words, score 0 and fail the
    base rules; a text of any length is read whole; a score that equals the
    threshold is kept; trusted documents are scored like any other; ids that are null are never trusted; repeated rows count as
    often as they occur and all come back; without trusted documents every
    ratio is that of the smoothing alone.  Extra columns are ignored; an
    empty table gives an empty result.
    """
    buckets = buckets_for(docs, text_col) if buckets is None else buckets
    if buckets < 1 or most_held < 1:
        raise ValueError("buckets and most_held must be positive")
    counts = cut_lineage(bucket_counts(docs, trusted, buckets, text_col, id_col))
    ratios = ratio_table(counts, buckets, smoothing)
    every = counts.agg(F.sum("n_raw").alias("n")).scalar()
    held = ratios if buckets <= most_held else ratios.where(F.col("n_raw") * most_held >= every)
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    d = d.withColumns(
        {
            "words": split_words(F.col("text")),
            "lines": F.filter(split_lines(F.col("text")), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
        }
    )
    d = d.select(
        "id",
        F.xxhash64("text").alias("text_key"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        word_hashes(F.col("words")).alias("hashes"),
    )
    d = d.withColumns({"windows": _windows("hashes"), "uni": _buckets(F.col("hashes"), buckets)})
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    d = d.withColumn("order", F.when(repeats, F.sort_array(placed)))
    d = d.withColumn("n_repeat_words", _repeated_words("order"))
    facts = ["id", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    grams = d.select(*facts, F.explode_outer(_ngrams(F.col("uni"), buckets)).alias("bucket"))
    scored = (
        grams.join(F.broadcast(held.select("bucket", "micro")), "bucket", "left")
        .groupBy(*facts)
        .agg(F.coalesce(F.sum("micro"), F.lit(0)).alias("sum"), F.count(F.lit(1)).alias("n"))
    )
    # The narrow result is written once: a caller's filter must not be pushed into the chain of arrays above.
    scored = cut_lineage(scored)
    per_row = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    scored = scored.withColumn("copies", (F.col("n") / per_row).cast("long"))
    if buckets > most_held:
        every_gram = d.select("id", "text_key", _ngrams(F.col("uni"), buckets).alias("grams"))
        more = _joined_sums(every_gram, ratios, held)
        scored = scored.join(more, scored["id"].eqNullSafe(more["rid"]) & (scored["text_key"] == more["rkey"]), "left")
        scored = scored.withColumn("sum", F.col("sum") + F.col("copies") * F.coalesce("more", F.lit(0))).drop("rid", "rkey", "more")
    score = F.coalesce(F.col("sum") / (F.col("n") * MICRO), F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = scored.withColumns({"base_failed": failed, "score": score}).withColumns(
        {
            "kept": ~F.col("base_failed") & (F.col("score") >= threshold),
            "copy": F.explode(F.sequence(F.lit(1).cast("long"), "copies")),
        }
    )
    return rows.drop("copy", "copies", "sum", "n").withColumnRenamed("id", id_col)
