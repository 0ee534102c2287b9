"""Chat formatting by quotation linking.

Messages quote each other with ``>`` at the start of a line, once for each
level.  Runs of lines of one level are quoted passages; they, their
paragraphs and their lines are normalised, hashed and joined to the messages
of the conversation that hold the same passage as their own text.  The
earliest such message wrote it.  A message replies to the latest writer among
its outermost linked quotes; one without a linked quote replies to the
message before it.  Following each message's first reply gives threads, in
which every message directly follows the one that it replies to.

All steps are built-in functions.  Positions in a conversation come from
ranges of the whole order, so that a conversation with a third of all messages
is ordered by many tasks, however its turns are numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playlens.llm.common import WHITE, cut_lineage, digest128, lower_ascii, split_lines, split_words
from playlens.operators.order import global_positions

_QUOTED = "^[ \\t]*>"
_MARK = "^(?:[ \\t]*>)+[ \\t]?"
# Lines that introduce the quotation right below them, blank lines aside.
_INTRO = "(?m)^(?:On|Le|Am|El) [^\\n]+(?:wrote|écrit|schrieb|escribió) ?:[ \\t]*\\n(?=(?:[ \\t]*\\n)*[ \\t]*>)"
RUN = 1024  # positions of a bucket
_FIRST = -(1 << 63)


def own_text(text: Column) -> Column:
    """The text; where it has quoted lines, without them, the lines that introduce them, and white space at its ends."""
    quoted = F.exists(split_lines(text), lambda x: x.rlike(_QUOTED))
    own = F.filter(split_lines(F.regexp_replace(text, _INTRO, "")), lambda x: ~x.rlike(_QUOTED))
    return F.when(quoted, F.btrim(F.array_join(own, "\n"), F.lit(WHITE))).otherwise(text)


def passages(text: Column, min_chars: int) -> Column:
    """Normalised: the whole text unless it is blank, and its paragraphs and lines of at least ``min_chars`` characters."""
    parts = F.concat(F.array(text), F.split(text, "\\n[ \\t]*(?:\\n[ \\t]*)+", -1), split_lines(text))
    plain = F.transform(parts, lambda x: lower_ascii(F.array_join(split_words(x), " ")))
    return F.array_distinct(F.filter(plain, lambda x, i: F.length(x) >= F.when(i == 0, 1).otherwise(min_chars)))


def _quotes(messages: DataFrame) -> DataFrame:
    """(message key, ``level``, ``quote``): every run of quoted lines of one level."""
    key = ["conv", "turn", "tkey", "role"]
    lines = messages.where(F.exists(split_lines(F.col("text")), lambda x: x.rlike(_QUOTED))).select(
        *key, F.posexplode(split_lines(F.col("text"))).alias("pos", "line")
    )
    marks = F.regexp_extract("line", _MARK, 0)
    lines = lines.withColumns(
        {"level": F.length(F.regexp_replace(marks, "[^>]", "")), "body": F.regexp_replace("line", _MARK, "")}
    )
    own = Window.partitionBy(*key).orderBy("pos")
    turned = F.when(F.col("level") == F.lag("level").over(own), 0).otherwise(1)
    runs = lines.withColumn("turned", turned).withColumn("run", F.sum("turned").over(own)).where("level > 0")
    whole = runs.groupBy(*key, "run", "level").agg(F.sort_array(F.collect_list(F.struct("pos", "body"))).alias("lines"))
    return whole.select(*key, "level", F.array_join(F.col("lines.body"), "\n").alias("quote"))


def _writers(messages: DataFrame, min_chars: int) -> tuple[DataFrame, DataFrame]:
    """Quoted passages with their writer: links (message key, ``level``, ``writer``), and quotes by message."""
    key = ["conv", "turn", "tkey", "role"]
    quotes = _quotes(messages)
    entries = quotes.select(*key, "level", F.explode(passages(F.col("quote"), min_chars)).alias("p"))
    entries = cut_lineage(entries.select(*key, "level", *[h.alias(n) for h, n in zip(digest128(F.col("p")), ("h1", "h2"))]))
    wanted = entries.select("conv", "h1", "h2").distinct()
    held = messages.select(*key, F.explode(passages(own_text(F.col("text")), min_chars)).alias("p"))
    held = held.select(*key, *[h.alias(n) for h, n in zip(digest128(F.col("p")), ("h1", "h2"))])
    first = (
        held.join(wanted, ["conv", "h1", "h2"], "left_semi")
        .groupBy("conv", "h1", "h2")
        .agg(F.min(F.struct("turn", "tkey", "role")).alias("writer"))
    )
    links = entries.join(cut_lineage(first), ["conv", "h1", "h2"]).where(F.col("writer") < F.struct("turn", "tkey", "role"))
    counts = quotes.groupBy(*key).agg(F.count(F.lit(1)).alias("n_quotes"))
    return links.select(*key, "level", "writer"), counts


def _positions(messages: DataFrame) -> DataFrame:
    """``messages`` (distinct keys) with ``position``, from 0, in the conversation's order."""
    order = [F.asc_nulls_first(c) for c in ("turn", "tkey", "role")]
    placed = global_positions(messages, order, "position", per=["conv"])
    return placed.withColumn("position", F.col("position") - 1)


def _last_head(rows: DataFrame) -> DataFrame:
    """``rows`` (``conv``, ``position``, ``head`` flag) with ``start``: the last head at or before the position."""
    r = rows.withColumns({"part": F.floor(F.col("position") / RUN), "mark": F.when(F.col("head"), F.col("position"))})
    parts = r.groupBy("conv", "part").agg(F.max("mark").alias("top"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv", "part", F.max("top").over(earlier).alias("carried"))
    within = Window.partitionBy("conv", "part").orderBy("position")
    r = r.withColumn("here", F.max("mark").over(within)).join(parts, ["conv", "part"])
    return r.select(*rows.columns, F.coalesce("here", "carried").alias("start"))


def _threads(heads: DataFrame) -> DataFrame:
    """(``conv``, ``start``, ``thread``, ``base``) by pointer doubling over ``heads`` (``conv``, ``start``, ``up``, ``steps``).

    ``up`` is the head of the run that the head continues, itself if none,
    and ``steps`` how many messages lie between the two.
    """
    now = cut_lineage(heads)
    while now.where("up <> start").limit(1).count():
        over = now.select("conv", F.col("start").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"))
        after = cut_lineage(
            now.join(over, ["conv", "up"]).select(
                "conv",
                "start",
                F.col("up2").alias("up"),
                F.when(F.col("up") == F.col("start"), F.col("steps")).otherwise(F.col("steps") + F.col("steps2")).alias("steps"),
                (F.col("up2") != F.col("up")).alias("moved"),
            )
        )
        now, moved = after.drop("moved"), after.where("moved").limit(1).count()
        if not moved:
            break
    return now.select("conv", "start", F.col("up").alias("thread"), F.col("steps").alias("base"))


def link_messages(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    min_chars: int = 8,
) -> DataFrame:
    """One row per row of ``conversations``, in reply order by (``conv_col``, ``thread``, ``seq``).

    Columns: the four input columns (``text_col`` without quotes, as
    ``content``), ``position`` in the conversation, ``reply_to`` (the
    position that it replies to, null for the first), ``thread`` (the
    position that its thread starts with), ``seq`` in the thread,
    ``n_quotes`` and ``n_linked`` (quoted passages, and levels of them whose
    writer was found).

    Defined cases: null and empty texts are empty messages; texts and quotes
    of any length are read whole; a null turn
    comes first; null conversation ids are one conversation; messages of one
    turn are ordered by a hash of the text, then by role; rows that repeat a
    whole message share its position.  A line or paragraph of fewer than
    ``min_chars`` characters links only where it is a whole quote and equals
    a whole earlier message; a passage that no earlier message wrote, and a
    blank one, links nothing.  Extra columns are ignored; an empty table
    gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn_id"),
        F.col(role_col).alias("role_id"),
        text.alias("text"),
        F.xxhash64(F.col(conv_col).isNull(), F.col(conv_col)).alias("c2"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit(_FIRST)).alias("turn"),
        F.xxhash64(text).alias("tkey"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(conv_col).cast("string"), F.lit("")).alias("c1"),
    ).withColumn("conv", F.struct("c1", "c2"))
    rows = rows.drop("c1", "c2")
    key = ["conv", "turn", "tkey", "role"]
    links, counts = _writers(rows, min_chars)
    best = links.groupBy(*key).agg(
        F.max(F.struct((-F.col("level")).alias("l"), F.col("writer"))).alias("best"), F.countDistinct("level").alias("n_linked")
    )
    placed = cut_lineage(_positions(rows.select(*key).distinct()))
    where = placed.select("conv", *[F.col(c).alias(f"w_{c}") for c in key[1:]], F.col("position").alias("quoted"))
    linked = best.select(*key, *[F.col("best.writer")[c].alias(f"w_{c}") for c in key[1:]], "n_linked").join(
        where, ["conv", *[f"w_{c}" for c in key[1:]]]
    )
    told = placed.join(linked.select(*key, "quoted", "n_linked"), key, "left").join(counts, key, "left")
    told = told.withColumn("reply_to", F.coalesce("quoted", F.when(F.col("position") > 0, F.col("position") - 1)))
    told = told.withColumn("head", F.col("reply_to").isNull() | (F.col("reply_to") != F.col("position") - 1))
    told = cut_lineage(_last_head(told.drop("quoted")))

    # A run of messages that each reply to the one before continues another where its head is a first reply.
    first = told.where("reply_to IS NOT NULL").groupBy("conv", "reply_to").agg(F.min("position").alias("first_reply"))
    heads = told.where("head").select("conv", "position", "reply_to")
    above = told.select("conv", F.col("position").alias("reply_to"), F.col("start").alias("up_start"))
    heads = heads.join(first, ["conv", "reply_to"], "left").join(above, ["conv", "reply_to"], "left")
    goes_on = F.coalesce(F.col("first_reply") == F.col("position"), F.lit(False))
    heads = heads.select(
        "conv",
        F.col("position").alias("start"),
        F.when(goes_on, F.col("up_start")).otherwise(F.col("position")).alias("up"),
        F.when(goes_on, F.col("reply_to") - F.col("up_start") + 1).otherwise(0).alias("steps"),
    )
    threads = told.join(_threads(heads), ["conv", "start"]).select(
        *key,
        "position",
        "reply_to",
        "thread",
        (F.col("base") + F.col("position") - F.col("start")).alias("seq"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )
    return rows.join(threads, key).select(
        F.col("conv_id").alias(conv_col),
        F.col("turn_id").alias(turn_col),
        F.col("role_id").alias(role_col),
        "position",
        "reply_to",
        "thread",
        "seq",
        "n_quotes",
        "n_linked",
        own_text(F.col("text")).alias("content"),
    )


def chat_blocks(messages: DataFrame, conv_col: str = "conv_id", role_col: str = "role", length: int = 64) -> DataFrame:
    """Threads of ``link_messages`` as chat strings, ``length`` messages to a block.

    Columns: ``conv_col``, ``thread``, ``block``, ``n_messages`` and ``chat``
    (each message as ``<|role|>``, a line break and its content).  Rows that
    repeat a whole message appear once.
    """
    turn = F.concat(F.lit("<|"), F.coalesce(F.col(role_col), F.lit("")), F.lit("|>\n"), F.col("content"))
    said = messages.select(conv_col, "thread", "seq", F.floor(F.col("seq") / length).alias("block"), turn.alias("said")).distinct()
    return (
        said.groupBy(conv_col, "thread", "block")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "said"))).alias("list"))
        .select(conv_col, "thread", "block", F.size("list").alias("n_messages"), F.array_join("list.said", "\n").alias("chat"))
    )
