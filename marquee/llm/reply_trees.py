"""Chat formatting of reply trees: the best root-to-leaf paths, each as one conversation with a loss mask.

DataFrame operations only. Paths come from self-joins whose steps double in
length: after k joins every message knows its ancestor 2**k steps up, and the
score and number of messages on the way. So a tree of depth d takes log2(d)
joins instead of d, and no row ever holds a whole path until the last step,
where the formatted conversation is one value. Only ids and scores are joined;
texts are read once, for the messages of chosen paths.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.merkle import group_key
from marquee.llm.shared import stored

ASSISTANT = "assistant"
# A turn is START role MIDDLE text END. Only ``<turn`` and ``</turn`` control anything.
START, MIDDLE, END = "<turn ", ">", "</turn>\n"
TURN = r"(?s)<turn ([^>]*)>(.*?)</turn>\n"


def escape(text: Column) -> Column:
    """``text`` with a backslash put into every control string, also into those that hold some already."""
    return F.regexp_replace(text, r"<(\\*/?turn)", r"<\\$1")


def unescape(text: Column) -> Column:
    """What ``escape`` was given: one backslash less in every control string."""
    return F.regexp_replace(text, r"<\\(\\*/?turn)", r"<$1")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit(">"), F.lit("%3E"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%3E"), F.lit(">")), F.lit("%25"), F.lit("%"))


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Self-joins of ``nodes`` (tree, id, up, total, steps, ...) until every ancestor chain has ended.

    Returns the tables of all steps, of which number k holds in ``up`` the
    ancestor 2**k above a message, and the last one's rows that reached a root.
    Messages on a cycle, or below one, never do: they still climb after as many
    steps as the longest chain could need.
    """
    steps = [nodes]
    most = math.ceil(math.log2(max(nodes.count(), 1))) + 1
    for _ in range(most):
        now = steps[-1]
        climbing = now.filter(F.col("up").isNotNull())
        if climbing.isEmpty():
            break
        rest = [c for c in now.columns if c not in ("tree", "id", "up", "total", "steps")]
        above = now.select("tree", F.col("id").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"), F.col("steps").alias("further"))
        climbed = climbing.join(above, ["tree", "up"]).select(
            "tree", "id", F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total"),
            (F.col("steps") + F.col("further")).alias("steps"), *rest)
        steps.append(stored(climbed.unionByName(now.filter(F.col("up").isNull()))))
    return steps, steps[-1].filter(F.col("up").isNull())


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, path_rank, score, place, id): the messages of the best ``branches`` paths of every tree, ``place`` 1 being the root's.

    ``messages`` has tree, id and parent, none of them a null tree or id, and
    score. A path's score is the mean of its messages' scores, a null counting
    0; equal paths fall to the smaller leaf. A parent that is null or not in its
    tree makes a message a root. Messages on or below a cycle lie on no path.
    Ids repeated in a tree are one message, of the smallest parent and score.
    """
    once = messages.groupBy("tree", "id").agg(F.min("parent").alias("parent"), F.min(F.coalesce("score", F.lit(0.0))).alias("score"))
    once = stored(once)
    known = once.select("tree", F.col("id").alias("parent"), F.lit(True).alias("known"))
    answered = once.select("tree", F.col("parent").alias("id"), F.lit(True).alias("answered")).filter("id is not null").distinct()
    replies = once.filter("parent is not null").join(known, ["tree", "parent"], "left")
    nodes = replies.unionByName(once.filter("parent is null").withColumn("known", F.lit(None).cast("boolean")))
    nodes = stored(nodes.join(answered, ["tree", "id"], "left").select(
        "tree", "id", F.when(F.col("known"), F.col("parent")).alias("up"), F.col("score").alias("total"), F.lit(1).cast("bigint").alias("steps"),
        F.col("answered").isNull().alias("is_leaf")))

    steps, ended = climb(nodes)
    score = (F.col("total") / F.col("steps")).alias("score")
    leaves = ended.filter("is_leaf").select("tree", F.col("id").alias("leaf"), score, "steps")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), F.asc("leaf")))
    chosen = leaves.withColumn("path_rank", rank).filter(F.col("path_rank") <= branches)
    found = stored(chosen.select("tree", "leaf", "path_rank", "score", F.col("steps").alias("place"), F.col("leaf").alias("id")))
    # every distance to the leaf is one sum of powers of two, so each message is reached once
    for k in reversed(range(len(steps) - 1)):
        jump = steps[k].filter(F.col("up").isNotNull()).select("tree", "id", "up")
        higher = found.join(jump, ["tree", "id"]).withColumn("place", F.col("place") - 2 ** k).withColumn("id", F.col("up"))
        found = stored(found.unionByName(higher.select(found.columns)))
    return found


def format_turns(turns: Column) -> Column:
    """An array of (role, text) as template parts (text, loss); only an assistant's text is under the loss mask."""
    def parts(turn: Column) -> Column:
        head = F.concat(F.lit(START), escape_role(turn["role"]), F.lit(MIDDLE))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), (turn["role"] == ASSISTANT).alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
        )
    return F.flatten(F.transform(turns, parts))


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) that a formatted conversation holds."""
    roles, texts = (F.regexp_extract_all(formatted, F.lit(TURN), F.lit(k)) for k in (1, 2))
    return F.zip_with(roles, texts, lambda role, text: F.struct(unescape_role(role).alias("role"), unescape(text).alias("text")))


def masked_text(parts: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(parts, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, path_rank, score, parts, formatted): the best paths of every tree as conversations.

    ``messages`` has the columns of ``best_paths`` and role and text, of which
    null counts as empty. ``parts`` is the formatted text in pieces (text, loss),
    ``formatted`` the pieces joined. A conversation is one value and has to fit
    in a row; nothing else here grows with a tree.
    """
    paths = best_paths(messages.select("tree", "id", "parent", "score"), branches)
    said = F.struct("place", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = (
        messages.select("tree", "id", "role", "text").join(paths, ["tree", "id"])
        .groupBy("tree", "leaf", "path_rank", "score").agg(F.sort_array(F.collect_list(said)).alias("turns"))
    )
    return turns.select("tree", "leaf", "path_rank", "score", format_turns(F.col("turns")).alias("parts")).withColumn(
        "formatted", F.array_join(F.transform("parts", lambda p: p["text"]), ""))


def reply_chains(conversations: DataFrame) -> DataFrame:
    """``conversations`` as reply trees: every turn answers the one before it.

    Ordered by turn, null first; rows of one turn by role and MD5 of the text.
    Rows without a conv_id form one conversation.
    """
    rows = conversations.select(
        group_key(F.col("conv_id")).alias("tree"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    place = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "digest"))
    return rows.withColumn("id", place).select(
        "tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), F.lit(None).cast("double").alias("score"), "role", "text")


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them: one row per conversation."""
    found = format_trees(reply_chains(conversations))
    # parsed once: the columns below read it several times
    found = found.withColumn("turns", read_turns(F.col("formatted"))).withColumn("lost", masked_text(F.col("parts")))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return found.select(
        F.when(F.col("tree") != "", F.substr("tree", F.lit(2))).cast(conversations.schema["conv_id"].dataType).alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("lost").cast("bigint").alias("loss_chars"), F.sha2("lost", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
