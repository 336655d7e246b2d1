"""Chat formatting of reply trees, with DataFrame functions only.

A message names its parent; iterative self-joins (pointer doubling, so about log2 of the
depth of them) bring every message to its root and add up the scores on the way. The leaves
of a tree are ranked by the score of their path, and the chosen paths are walked down again
by the stored jumps: a message at distance d from the leaf is reached once, by the binary
digits of d. No join sees more rows than there are messages, or messages on chosen paths.

Template: a turn is ``<s>role\\ntext</s>``; the part between the marks is wrapped in
``[INST] `` and `` [/INST]`` unless the role is ``assistant``. Control strings inside roles
and texts get a backslash behind their opening bracket (one more if they have some), and
only they are changed, so ``unescape`` restores every text. The loss mask covers the texts
of assistant turns.

A conversation is returned in chunks of 256 turns (``formatted``; ``loss_spans``: code
points within the chunk): concatenated in order they are the whole conversation, and no row
or group grows with the conversation. ``whole`` joins them.

Defined cases: a parent that doesn't exist makes its message a root; messages that lead
into a cycle have no root and are on no path; null text or role counts as empty; a null
score as 0; equal path scores go to the smaller leaf id; message ids are unique within a
tree; rows of conversations with equal turns are ordered by role, then text; null turns
come first; a null conversation id is one conversation; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graustein.llm.base import stored

TURNS = 256
CONTROL = r"(<(?=\\%s/?s>)|\[(?=\\%s/?INST\])|<<(?=\\%s/?SYS>>))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL % ("*", "*", "*"), r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL % ("+", "+", "+") + r"\\", "$1")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("&"), F.lit("&amp;")), F.lit("\n"), F.lit("&#10;")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("&#10;"), F.lit("\n")), F.lit("&amp;"), F.lit("&"))


def chains(conversations: DataFrame) -> DataFrame:
    """Reply trees (tree, msg, parent, role, text, score) of a table of turns: every turn
    answers the one before. Turns are numbered in ranges of turn values, so a long
    conversation isn't sorted in one task."""
    rows = conversations.select(
        F.col("conv_id").alias("tree"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / TURNS).cast("long"), F.lit(-(2**63))).alias("range"))
    numbered = rows.withColumn("at", F.row_number().over(W.partitionBy("tree", "range").orderBy("turn", "role", "text")).cast("long"))
    sizes = rows.groupBy(F.col("tree").alias("t"), F.col("range").alias("r")).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("t", "r", (F.sum("n").over(W.partitionBy("t").orderBy("r").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    placed = numbered.join(before, numbered["tree"].eqNullSafe(before["t"]) & (numbered["range"] == before["r"]))
    msg = F.col("before") + F.col("at") - 1
    return placed.select("tree", msg.alias("msg"), F.when(msg > 0, msg - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def _up(rows: DataFrame, jumps: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``jumps`` (to_tree, to_msg, ...) where ``key`` is the message."""
    return rows.join(jumps, rows["tree"].eqNullSafe(jumps["to_tree"]) & (rows[key] == jumps["to_msg"]), how)


def best_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, path, place, msg): the ``top`` best root-to-leaf paths of every tree; ``path``
    is the leaf, ``place`` counts from 0 at the root."""
    nodes = stored(messages.select("tree", "msg", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "nodes")
    known = nodes.select(F.col("tree").alias("to_tree"), F.col("msg").alias("to_msg"))
    state = stored(_up(nodes, known, "parent", "left").select(
        "tree", "msg", F.when(F.col("to_msg").isNotNull(), F.col("parent")).alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("depth")), "jumps")
    leaves = nodes.join(nodes.select(F.col("tree").alias("of"), F.col("parent").alias("p")),
                        nodes["tree"].eqNullSafe(F.col("of")) & (nodes["msg"] == F.col("p")), "left_anti").select("tree", "msg")
    n = state.count()
    jumps, step = [], 1
    while step <= n and not state.filter("up IS NOT NULL").isEmpty():
        jumps.append((step, state.filter("up IS NOT NULL").select(F.col("tree").alias("to_tree"), F.col("msg").alias("to_msg"), "up")))
        further = state.select(F.col("tree").alias("to_tree"), F.col("msg").alias("to_msg"), F.col("up").alias("next"),
                               F.col("total").alias("more"), F.col("depth").alias("deeper"))
        moved = _up(state.filter("up IS NOT NULL"), further, "up").select(
            "tree", "msg", F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total"), (F.col("depth") + F.col("deeper")).alias("depth"))
        state = stored(state.filter("up IS NULL").unionByName(moved), "jumps")
        step *= 2
    rooted = state.filter("up IS NULL").select(F.col("tree").alias("to_tree"), F.col("msg").alias("to_msg"), "total", "depth")
    ranked = _up(leaves, rooted, "msg").withColumn("rank", F.row_number().over(W.partitionBy("tree").orderBy(F.desc("total"), "msg")))
    path = stored(ranked.filter(F.col("rank") <= top).select("tree", F.col("msg").alias("path"), "msg", (F.col("depth") - 1).alias("place")), "paths")
    for length, jump in reversed(jumps):
        above = _up(path, jump, "msg").select("tree", "path", F.col("up").alias("msg"), (F.col("place") - length).alias("place"))
        path = stored(path.unionByName(above), "paths")
    return path


def formatted(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per path and chunk: tree, path, chunk, n_turns, formatted, loss_spans."""
    said = messages.select(F.col("tree").alias("to_tree"), F.col("msg").alias("to_msg"),
                           F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turn = _up(paths, said, "msg")
    loss, text = F.col("role") == "assistant", escape(F.col("text"))
    head = F.concat(F.lit("<s>"), F.when(loss, F.lit("")).otherwise(F.lit("[INST] ")), escape_role(F.col("role")), F.lit("\n"))
    tail = F.concat(F.when(loss, F.lit("")).otherwise(F.lit(" [/INST]")), F.lit("</s>"))
    parts = turn.select("tree", "path", F.floor(F.col("place") / TURNS).cast("long").alias("chunk"), F.struct(
        "place", F.concat(head, text, tail).alias("piece"), F.length(head).alias("head"), F.length(text).alias("body"), loss.alias("loss")).alias("turn"))
    grouped = parts.groupBy("tree", "path", "chunk").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    at = F.aggregate(F.col("turns"), F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")), lambda s, t: F.struct(
        (s["at"] + F.length(t["piece"])).alias("at"),
        F.when(t["loss"], F.concat(s["spans"], F.array(F.struct((s["at"] + t["head"]).alias("start"), (s["at"] + t["head"] + t["body"]).alias("end")))))
        .otherwise(s["spans"]).alias("spans")), lambda s: s["spans"])
    return grouped.select("tree", "path", "chunk", F.size("turns").cast("long").alias("n_turns"),
                          F.array_join("turns.piece", "").alias("formatted"), at.alias("loss_spans"))


def whole(chunks: DataFrame) -> DataFrame:
    """(tree, path, formatted): every conversation as one string."""
    return chunks.groupBy("tree", "path").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "formatted"))), lambda c: c["formatted"]), "").alias("formatted"))


def read_back(chunks: DataFrame) -> DataFrame:
    """(tree, path, chunk, turns, loss): the turns (role, text) and the texts under the loss
    mask, taken from ``formatted`` and ``loss_spans`` alone."""
    pieces = F.split("formatted", "</s>", -1)
    body = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.substr(p, F.lit(4)))
    inner = F.transform(body, lambda b: F.when(F.startswith(b, F.lit("[INST] ")), F.substr(b, F.lit(8), F.length(b) - 15)).otherwise(b))
    turns = F.transform(inner, lambda t: F.struct(
        unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
        unescape(F.substr(t, F.length(F.substring_index(t, "\n", 1)) + 2)).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return chunks.select("tree", "path", "chunk", F.length("formatted").cast("long").alias("chars"), turns.alias("turns"), loss.alias("loss"))


def digests(chunks: DataFrame) -> DataFrame:
    """Per path: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back."""
    read = read_back(chunks).select("tree", "path", "chunk", "chars", F.size("turns").cast("long").alias("n"), F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"), F.array_join("loss", "").alias("loss"))
    joined = read.groupBy("tree", "path").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("chunk", "turns", "loss"))).alias("parts"))
    turns = F.array_join(F.transform("parts", lambda p: p["turns"]), "")
    loss = F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    return joined.select("tree", "path", "n_turns", F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                         F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
