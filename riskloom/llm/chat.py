"""Reply trees formatted as conversations, with DataFrame functions only.

Messages point to their parents. Self-joins with doubling reach give every message its depth and
the score of its path to the root; every leaf is one branch. The chosen branches are then expanded
from leaf to root with the same jumps in falling order, and each becomes one conversation. The
number of self-joins grows with the logarithm of the deepest tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.store import Scratch

# The template. A turn is OPEN, role, line feed, text, CLOSE; control strings cannot occur inside
# roles and texts, where their first characters are written as references.
OPEN, CLOSE = "[INST]", "</s>"
_REFERENCES = (("&", "&amp;"), ("[", "&#91;"), ("<", "&lt;"))  # first in, last out
LINE = "&#10;"  # a line feed inside a role
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    for plain, written in _REFERENCES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(_REFERENCES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def turns(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """Plain conversations as reply trees: each row answers the one before it.

    tree, node (place in the conversation, from 0), parent (null for the first), role, text, score.
    Rows are ordered by turn (nulls first); equal turns by role and text. Rows with a null
    conversation id form one conversation of that id; a null role or text counts as empty.
    """
    rows = messages.select(
        F.col(conv).alias("tree"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long") - 1)
    parent = F.when(F.col("node") > 0, F.col("node") - 1)
    return rows.select("tree", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def branches(messages: DataFrame, best: int, scratch: Scratch) -> DataFrame:
    """(tree, leaf, depth, node) for all messages of the ``best`` branches of every tree.

    Branches are ranked by the sum of their scores (null counts as 0), then by the smaller leaf.
    Messages whose parent is not there stand as roots; a cycle of parents has no leaf and no branch.
    """
    links = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = links.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    links = links.join(known, same("tree", "t") & (F.col("parent") == F.col("p")), "left").select(
        "tree", "node", F.col("p").alias("parent"), "score")
    links = scratch.save(links)
    leaves = links.join(links.select(F.col("tree").alias("t"), F.col("parent").alias("c")),
                        same("tree", "t") & (F.col("node") == F.col("c")), "left_anti").select("tree", "node")

    # up: the ancestor 2^k steps above; depth and total: steps and scores up to there.
    state = links.select("tree", "node", F.col("parent").alias("up"), F.lit(1).alias("depth"),
                         F.col("score").alias("total"))
    # Messages that have reached their root are only looked up from then on.
    jumps, most, level, done = [], links.count(), 0, None
    while True:
        state = scratch.save(state)
        jumps.append(state)
        known = state if done is None else state.unionAll(done)
        ended = state.where("up IS NULL")
        done = ended if done is None else done.unionAll(ended)
        going = state.where("up IS NOT NULL")
        if 2**level > most or going.isEmpty():
            break
        above = known.select(F.col("tree").alias("t"), F.col("node").alias("a"), F.col("up").alias("up2"),
                             F.col("depth").alias("depth2"), F.col("total").alias("total2"))
        state = going.join(above, same("tree", "t") & (F.col("up") == F.col("a"))).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"),
            (F.col("total") + F.col("total2")).alias("total"))
        level += 1

    place = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node"))
    path = leaves.withColumnRenamed("tree", "t").withColumnRenamed("node", "l").join(
        done, same("tree", "t") & (F.col("node") == F.col("l")))
    path = path.withColumn("place", place).where(F.col("place") <= best)
    path = path.select("tree", F.col("node").alias("leaf"), "depth", "node")
    for jump in reversed(jumps[:-1]):
        reach = jump.where("up IS NOT NULL").select(
            F.col("tree").alias("t"), F.col("node").alias("n"), "up", F.col("depth").alias("steps"))
        further = path.join(reach, same("tree", "t") & (F.col("node") == F.col("n"))).select(
            "tree", "leaf", (F.col("depth") - F.col("steps")).alias("depth"), F.col("up").alias("node"))
        path = scratch.save(path.unionAll(further))
    return path


def conversations(messages: DataFrame, best: int = 1) -> DataFrame:
    """Chosen branches of every reply tree as formatted text.

    ``messages``: tree, node, parent, role, text, score; others are ignored. Of messages that share tree and
    node, repeated rows among them, the one that sorts first by (parent, role, text, score), nulls first, counts.
    Result: tree, leaf, formatted, and loss, the [start, length) of every assistant text in
    characters of ``formatted``, as it stands there. Null roles and texts count as empty; messages
    with a null node are left out as nothing can refer to them. An empty table gives an empty result.
    """
    scratch = Scratch(messages.sparkSession, "chat")
    first = F.min(F.struct("parent", F.coalesce("role", F.lit("")).alias("role"),
                           F.coalesce("text", F.lit("")).alias("text"), "score")).alias("m")
    messages = scratch.save(messages.where("node IS NOT NULL").groupBy("tree", "node").agg(first).select(
        "tree", "node", "m.parent", "m.role", "m.text", "m.score"))
    path = branches(messages, best, scratch)
    words = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    rows = path.join(words, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    head = F.concat(F.lit(OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(LINE)), F.lit("\n"))
    body = escape(F.col("text"))
    rows = rows.select("tree", "leaf", F.struct(
        "depth", head.alias("head"), body.alias("body"), (F.col("role") == LOSS_ROLE).alias("loss")).alias("m"))
    # One conversation is one text; its messages meet here and nowhere else.
    whole = rows.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list("m")).alias("m"))
    size = lambda m: F.length(m["head"]) + F.length(m["body"]) + len(CLOSE)
    spans = F.aggregate(
        "m", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans")),
        lambda s, m: F.struct(
            (s["at"] + size(m)).alias("at"),
            F.when(m["loss"], F.concat(s["spans"], F.array(F.struct(
                (s["at"] + F.length(m["head"])).cast("long").alias("start"), F.length(m["body"]).cast("long").alias("length")))))
            .otherwise(s["spans"]).alias("spans")),
        lambda s: s["spans"])
    text = F.array_join(F.transform("m", lambda m: F.concat(m["head"], m["body"], F.lit(CLOSE))), "")
    return whole.select("tree", "leaf", text.alias("formatted"), spans.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    parts = F.split(formatted, CLOSE)  # the last part is empty
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.struct(
        unescape(F.replace(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1),
                           F.lit(LINE), F.lit("\n"))).alias("role"),
        unescape(F.substr(p, F.instr(p, F.lit("\n")) + 1)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
