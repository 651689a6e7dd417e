"""Chat formatting from reply trees, with DataFrame functions only.

Messages point at the message they reply to.  Iterative self-joins double the
distance every message looks up its tree: after round k it knows its ancestor
2^k replies above (or the root) and the sum of the scores passed, so a tree of
depth D takes log2 D rounds.  The leaves of a root are ranked by their path's
total score; only the paths of the chosen ones are enumerated, again by
doubling, in as many rows as the paths have messages.  Each path becomes one
formatted conversation with the byte spans that carry loss.

Template: ``<turn ROLE>\\nTEXT</turn>\\n`` per message.  In texts every
``<turn`` and ``</turn`` gets one more backslash behind ``<`` than it had, so
no text holds a control string and taking one backslash away gives it back.
Roles write backslash, ``<``, ``>`` and line feed as ``\\\\``, ``\\l``, ``\\g`` and
``\\n``; a null role is ``<turn>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagsmith.llm.common import stash

CLOSE = "</turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?turn)", r"<$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?turn)", r"<$1$2")


def escape_role(role: Column) -> Column:
    for plain, coded in (("\\", "\\\\"), ("<", "\\l"), (">", "\\g"), ("\n", "\\n")):
        role = F.replace(role, F.lit(plain), F.lit(coded))
    return role


def unescape_role(role: Column) -> Column:
    # one pass from the left: a coded backslash must not start another code
    for coded, plain in (("l", "<"), ("g", ">"), ("n", "\n")):
        role = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\" + coded, "$1" + plain)
    return F.replace(role, F.lit("\\\\"), F.lit("\\"))


def threads(messages: DataFrame, id_col: str = "message_id", parent_col: str = "parent_id",
            score_col: str = "score") -> tuple[DataFrame, list[DataFrame]]:
    """(leaves, jumps).  ``leaves``: (leaf, root, depth, total) for every leaf
    that a root stands above; ``depth`` is the number of replies between them,
    ``total`` the sum of the scores of the path's messages.  ``jumps[k]``:
    (node, up) for every message with an ancestor 2^k replies above.

    A null or unknown parent makes a root.  Messages without an id are no
    part of a tree; of messages with one id the tree takes one parent and one
    score, the smallest of each.  Messages on or under a cycle have no root
    and no path.  Null scores count 0."""
    nodes = stash(messages.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("node"))
                  .agg(F.min(parent_col).alias("parent"), F.coalesce(F.min(score_col).cast("double"), F.lit(0.0)).alias("score")), "reply-nodes")
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    # top: the ancestor min(2^k, depth) above, passed: scores from the message to just below it
    linked = nodes.join(known, "parent", "left")
    here = stash(linked.select("node", F.when(F.col("known"), F.col("parent")).alias("up"), "score"), "reply-edges")
    state = here.select("node", F.coalesce("up", "node").alias("top"), F.col("up").isNull().alias("done"),
                        F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("dist"),
                        F.when(F.col("up").isNull(), 0.0).otherwise(F.col("score")).alias("passed"))
    jumps = [here.where("up is not null").select("node", "up")]
    most = nodes.count()
    k = 0
    state = stash(state, "reply-jump")
    while 1 << k <= most and not state.where("not done").isEmpty():  # more rounds only walk round cycles
        far = state.select(F.col("node").alias("top"), F.col("top").alias("over"), F.col("done").alias("ended"),
                           F.col("dist").alias("more"), F.col("passed").alias("gone"))
        moved = state.where("not done").join(far, "top").select(
            "node", F.col("over").alias("top"), F.col("ended").alias("done"), (F.col("dist") + F.col("more")).alias("dist"),
            (F.col("passed") + F.col("gone")).alias("passed"))
        k += 1
        state = stash(state.where("done").union(moved), "reply-jump")
        jumps.append(state.where(F.col("dist") == 1 << k).select("node", F.col("top").alias("up")))
    replied = here.where("up is not null").select(F.col("up").alias("node")).distinct()
    scores = nodes.select(F.col("node").alias("top"), F.col("score").alias("last"))
    leaves = state.where("done").join(replied, "node", "left_anti").join(scores, "top").select(
        F.col("node").alias("leaf"), F.col("top").alias("root"), F.col("dist").alias("depth"), (F.col("passed") + F.col("last")).alias("total"))
    return leaves, jumps


def paths(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(leaf, node, above): the messages of the paths of ``chosen`` leaves;
    ``above`` counts the replies between node and leaf.  Every distance is
    reached once, by the jumps of its binary digits."""
    walk = chosen.select("leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("above"))
    for k in range(len(jumps) - 1, -1, -1):
        walk = stash(walk.union(walk.join(jumps[k], "node").select("leaf", F.col("up").alias("node"), F.col("above") + (1 << k))), "reply-path")
    return walk


def rank_branches(leaves: DataFrame, branches: int | None) -> DataFrame:
    """``leaves`` with branch, the rank of a leaf under its root (highest
    total first, then shorter paths, then the smaller leaf id); the first
    ``branches`` of each root (None: all)."""
    place = Window.partitionBy("root").orderBy(F.desc("total"), "depth", "leaf")
    ranked = leaves.withColumn("branch", F.row_number().over(place))
    return ranked if branches is None else ranked.where(F.col("branch") <= branches)


def format_threads(messages: DataFrame, branches: int | None = 1, loss_role: str = "assistant", id_col: str = "message_id",
                   parent_col: str = "parent_id", role_col: str = "role", text_col: str = "text", score_col: str = "score") -> DataFrame:
    """One row per chosen root-to-leaf path: root, leaf, branch, total,
    n_turns (long), formatted (string) and spans, the [start, end) byte ranges
    of the UTF-8 of ``formatted`` that hold the escaped texts of ``loss_role``.

    ``branches`` paths of a root are taken, the best scores first (None: all).
    Null text is empty.  Of messages with one id the smallest (role, text)
    is the message.  Roots without replies are paths of one message; see
    ``threads`` for null ids, unknown parents and cycles.  An empty table
    gives no rows; other columns are ignored."""
    clean = messages.select(F.col(id_col).alias("message_id"), F.col(parent_col).alias("parent_id"), F.col(role_col).cast("string").alias("role"),
                            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(score_col).alias("score"))
    leaves, jumps = threads(clean)
    chosen = stash(rank_branches(leaves, branches), "reply-chosen")
    steps = stash(paths(chosen, jumps), "reply-steps")
    said = clean.where("message_id is not null").groupBy(F.col("message_id").alias("node")).agg(F.min(F.struct("role", "text")).alias("m"))
    said = said.select("node", "m.role", "m.text")  # dealt by node, as the join below needs it
    head = F.concat(F.lit("<turn"), F.coalesce(F.concat(F.lit(" "), escape_role(F.col("role"))), F.lit("")), F.lit(">\n"))
    parts = steps.join(said, "node").select(
        "leaf", F.negate("above").alias("pos"), F.coalesce(F.col("role") == loss_role, F.lit(False)).alias("loss"),
        head.alias("head"), escape(F.col("text")).alias("body"))
    before = Window.partitionBy("leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length("head") + F.octet_length("body") + len(CLOSE)
    start = F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0)) + F.octet_length("head")
    placed = parts.select("leaf", "pos", F.concat("head", "body", F.lit(CLOSE)).alias("said"),
                          F.when(F.col("loss"), F.struct(start.alias("start"), (start + F.octet_length("body")).alias("end"))).alias("span"))
    whole = placed.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("pos", "said", "span"))).alias("turns"))
    made = whole.select("leaf", F.size("turns").cast("long").alias("n_turns"), F.array_join("turns.said", "").alias("formatted"),
                        F.filter("turns.span", lambda s: s.isNotNull()).alias("spans"))
    return made.join(chosen.select("leaf", "root", "branch", "total"), "leaf").select(
        "root", "leaf", "branch", "total", "n_turns", "formatted", "spans")


def chain_messages(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages (conversation, message_id, parent_id, role, text, score) of
    conversations given as numbered turns: every turn replies to the one
    before it.  Equal turns go by role and text, null turns come first; rows
    with a null conversation id form one conversation."""
    order = Window.partitionBy(id_col).orderBy(turn_col, role_col, text_col)
    at = rows.select(F.col(id_col).alias("conversation"), F.col(role_col).alias("role"), F.col(text_col).alias("text"),
                     F.row_number().over(order).cast("long").alias("at"))
    name = F.coalesce(F.col("conversation").cast("string"), F.lit("null"))
    key = F.concat(name, F.lit("/"), F.lpad(F.col("at").cast("string"), 12, "0"))
    return at.select("conversation", key.alias("message_id"),
                     F.when(F.col("at") > 1, F.concat(name, F.lit("/"), F.lpad((F.col("at") - 1).cast("string"), 12, "0"))).alias("parent_id"),
                     "role", "text", F.lit(0.0).alias("score"))


def conversation_of(message_id: Column) -> Column:
    """The conversation id (as text, null for the null id) of a message id
    made by ``chain_messages``."""
    name = F.regexp_extract(message_id, r"^(.*)/\d+$", 1)
    return F.when(name != "null", name)


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation as array<struct<role, text>>."""
    pieces = F.split(formatted, CLOSE, -1)  # texts hold no closing mark; behind the last one nothing is left
    turn = lambda p: F.struct(
        F.when(F.startswith(p, F.lit("<turn ")), unescape_role(F.regexp_extract(p, r"^<turn ([^>]*)>\n", 1))).alias("role"),
        unescape(F.regexp_replace(p, r"^<turn[^>]*>\n", "")).alias("text"))
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    cut = lambda s: unescape(F.decode(F.substring(
        formatted.cast(T.BinaryType()), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), "UTF-8"))
    return F.array_join(F.transform(spans, cut), "")
