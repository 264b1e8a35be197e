"""Chat formatting by quotation linking.

Quote levels are parsed line by line (``>`` marks, nested), quoted lines are
normalised and hashed, and joined to the first message of the conversation
that wrote the line itself. A message's parent is the original of most of its
quoted lines (the shallowest level with a link; ties: the latest turn).
Threads are resolved by pointer doubling, and messages are ordered by thread
root, depth and turn, without their quotes. Only DataFrame functions.

Defined results: null texts are empty messages; messages of a null
conversation or turn quote nothing and are their own root; a line quoted from
nobody links nothing and is removed all the same; rows repeated with the same
(conversation, turn) are one node of the thread and are returned row by row,
ordered by role and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandops.llm.common import cut, global_rank, release

ATTRIBUTION = r"(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$"


def quote_lines(text: Column) -> Column:
    """Array of (level, body) of the lines of a text."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, r"^(\s*>)*", 0), "[^>]", "")).alias("level"),
        F.regexp_replace(x, r"^(\s*>)+ ?", "").alias("body")))


def normalised(body: Column) -> Column:
    """Lower case, single spaces, no outer white space."""
    return F.trim(F.regexp_replace(F.lower(body), r"\s+", " "))


def own_text(lines: Column) -> Column:
    """The message without quoted lines and the attribution lines above them."""
    kept = F.filter(lines, lambda x, i: (x["level"] == 0) & ~(
        x["body"].rlike(ATTRIBUTION)
        & F.coalesce(F.get(lines, i + 1)["level"] > 0, F.lit(False))))
    return F.trim(F.array_join(F.transform(kept, lambda x: x["body"]), "\n"))


def link_quotes(parsed: DataFrame) -> DataFrame:
    """(conv, turn, parent): the linked original of every quoting node."""
    rows = (parsed.filter(F.col("conv").isNotNull() & F.col("turn").isNotNull())
            .select("conv", "turn", F.inline("_lines"))
            .withColumn("norm", normalised(F.col("body"))).filter(F.col("norm") != "")
            .select("conv", "turn", "level", F.xxhash64("norm").alias("_h1"),
                    F.xxhash64(F.lit("second"), "norm").alias("_h2")).distinct())
    quoted = rows.filter("level > 0")
    # one row per written line: the first turn that wrote it
    first = (rows.filter("level = 0").groupBy("conv", "_h1", "_h2").agg(F.min("turn").alias("source")))
    votes = (quoted.join(first, ["conv", "_h1", "_h2"]).filter(F.col("source") < F.col("turn"))
             .groupBy("conv", "turn", "level", "source").agg(F.count("*").alias("n")))
    best = F.max(F.struct((-F.col("level")).alias("l"), "n", "source"))
    return votes.groupBy("conv", "turn").agg(best["source"].alias("parent"))


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, root, depth) of every quoting node, by pointer doubling:
    a round doubles the distance that each node sees."""
    state = cut(links.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).alias("depth")), "threads")
    while True:
        nxt = state.select("conv", F.col("turn").alias("root"), F.col("root").alias("_r"),
                           F.col("depth").alias("_d"))
        step = cut(state.join(nxt, ["conv", "root"], "left")
                   .select("conv", "turn", F.coalesce("_r", "root").alias("root"),
                           (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"),
                           F.col("_r").isNotNull().alias("_moved")), "threads")
        moved = step.filter("_moved").limit(1).count()
        release(state)
        state = step
        if not moved:
            return state.drop("_moved")


def format_conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, reply_to (parent turn),
    root_turn, depth, position (0-based place in the reply-ordered
    conversation), n_quoted (quoted lines), text without quotes."""
    parsed = cut(messages.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.col(f"`{role}`").alias("role"), quote_lines(F.col(f"`{text}`")).alias("_lines"))
        .select("conv", "turn", "role", "_lines", own_text(F.col("_lines")).alias("text"),
                F.size(F.filter("_lines", lambda x: x["level"] > 0)).cast("long").alias("n_quoted")), "messages")
    links = cut(link_quotes(parsed), "links")
    tree = threads(links)
    placed = (parsed.drop("_lines").join(links, ["conv", "turn"], "left")
              .join(tree, ["conv", "turn"], "left")
              .select("conv", "turn", "role", F.col("parent").alias("reply_to"),
                      F.coalesce("root", "turn").alias("root_turn"),
                      F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "n_quoted", "text"))
    ranked = global_rank(placed, ["conv", "root_turn", "depth", "turn", "role", "text"], "_rank", "reply-order")
    starts = ranked.groupBy("conv").agg(F.min("_rank").alias("_start"))
    return (ranked.join(starts, ranked["conv"].eqNullSafe(starts["conv"])).drop(starts["conv"])
            .select(F.col("conv").alias("conv_id"), "turn", "role", "reply_to", "root_turn", "depth",
                    (F.col("_rank") - F.col("_start")).alias("position"), "n_quoted", "text"))
