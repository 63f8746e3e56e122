"""Chat formatting of reply trees (operator 10, DataFrame functions only).

Messages point to the message they answer.  Self-joins that double the distance
each time give every message its root, its depth and the score of its whole
branch in log2(longest branch) rounds.  Leaves of one root are ranked by branch
score and the best ``branches`` are kept; a second series of doubling joins
walks from each kept leaf over all its ancestors, so a path costs its length and
a message on several kept paths is repeated on each.  Every path is then written
as one conversation with marked turns and the spans that carry loss.

Template: ``### role: text</turn>`` and a line feed per turn.  Inside roles and
texts the characters of the marks are escaped (backslash, ``#``, ``<`` and, in
roles, ``:`` become a backslash and a letter), so no text can contain a mark and
the original comes back exactly.  Loss spans are (start, length) in code points
of the formatted string and cover the escaped text of every assistant turn.

Defined results: null texts and roles are empty; a null conversation id is one
conversation of its own; a message whose parent is missing is a root; equal turn
numbers are ordered by role, then text (repeated rows stay separate turns);
branches of equal score are ranked by leaf id; messages on a cycle have no root
and raise an error; empty tables give empty tables.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import discard, stored

MARK, MIDDLE, END = "### ", ": ", "</turn>\n"
MAX_ROUNDS = 40   # branches of up to 2^40 messages


def escape(text: Column, role: bool = False) -> Column:
    out = F.coalesce(text, F.lit(""))
    for plain, coded in (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"), *([(":", "\\c")] if role else [])):
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return out


def unescape(text: Column) -> Column:
    for coded, plain in (("\\c", ":"), ("\\l", "<"), ("\\h", "#"), ("\\s", "\\")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, step, node): the messages of the best paths, step 0 at the root.

    ``messages`` has columns tree, node, parent (null for roots) and score (a long); (tree, node) is unique.
    """
    base = stored(messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0)).cast("bigint").alias("score")), "replies")
    there = base.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    # a parent that does not exist makes a root
    linked = base.join(there, (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("n")), "left").select(
        "tree", "node", "score", F.col("n").alias("up"))
    # hops[i]: each message's ancestor 2^i steps up; state: nearest unread ancestor, depth and score so far
    state = stored(linked.select("tree", "node", "up", F.when(F.col("up").isNull(), F.col("node")).alias("root"),
                                 F.lit(0).cast("bigint").alias("depth"), "score",
                                 F.when(F.col("up").isNotNull(), 1).otherwise(0).alias("open")), "replies")
    hops, finished = [state], []
    while True:
        # trees whose messages have all reached their roots are set aside
        open_trees = state.where("open = 1").select("tree").distinct()
        finished.append(state.join(open_trees, "tree", "left_anti"))
        if not open_trees.limit(1).count():
            break
        if len(hops) > MAX_ROUNDS:
            raise ValueError("messages answer each other in a circle")
        state = stored(state.join(open_trees, "tree", "left_semi"), "replies")
        far = state.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("up2"),
                           F.col("root").alias("root2"), F.col("depth").alias("depth2"), F.col("score").alias("score2"),
                           F.col("open").alias("open2"))
        step = 1 << (len(hops) - 1)
        joined = state.join(far, (F.col("tree") == F.col("t")) & (F.col("up") == F.col("n")), "left")
        jumped = F.col("up").isNotNull()
        state = stored(joined.select(
            "tree", "node", F.col("up2").alias("up"), F.when(jumped, F.col("root2")).otherwise(F.col("root")).alias("root"),
            F.when(jumped, F.col("depth2") + step).otherwise(F.col("depth")).alias("depth"),
            F.when(jumped, F.col("score") + F.col("score2")).otherwise(F.col("score")).alias("score"),
            F.when(jumped, F.col("open2")).otherwise(0).alias("open")), "replies")
        hops.append(state)
    state = finished[0]
    for more in finished[1:]:
        state = state.unionByName(more)

    answered = linked.where("up is not null").select(F.col("tree").alias("t"), F.col("up").alias("n")).distinct()
    leaves = state.join(answered, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n")), "left_anti")
    ranked = leaves.withColumn("rank", F.row_number().over(
        Window.partitionBy("tree", "root").orderBy(F.desc("score"), "node"))).where(F.col("rank") <= branches)
    path = stored(ranked.select("tree", F.col("node").alias("leaf"), "rank", F.col("depth").alias("step"), "node"), "replies")
    for i, hop in reversed(list(enumerate(hops))):
        far = hop.where("up is not null").select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        higher = path.join(far, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n"))).select(
            "tree", "leaf", "rank", (F.col("step") - (1 << i)).alias("step"), F.col("up").alias("node"))
        old, path = path, stored(path.unionByName(higher), "replies")
        discard(old)
    for used in (*hops, base):
        discard(used)
    return path


def as_chain(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """Rows of linear conversations as messages that answer the turn before."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return (rows.select(F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("tree"),
                        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .withColumn("node", F.row_number().over(order).cast("bigint"))
            .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
            .withColumn("score", F.lit(1).cast("bigint")))


def format_paths(messages: DataFrame, branches: int = 1, loss_role: str = "assistant") -> DataFrame:
    """(tree, leaf, rank, n_turns, formatted, loss): one row per kept path.

    ``messages`` also has role and text; ``loss`` is an array of (start, length) in code points, from 1.
    """
    paths = best_paths(messages, branches)
    said = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    turns = paths.join(said, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n")))
    head = F.concat(F.lit(MARK), escape(F.col("role"), role=True), F.lit(MIDDLE))
    body = escape(F.col("text"))
    turns = turns.select("tree", "leaf", "rank", F.struct(
        "step", F.concat(head, body, F.lit(END)).alias("piece"), F.length(head).alias("head"), F.length(body).alias("body"),
        (F.coalesce(F.col("role"), F.lit("")) == loss_role).alias("learns")).alias("turn"))
    whole = turns.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    # running start of every piece, then the span of its text
    spans = F.aggregate(
        "turns", F.struct(F.lit(1).cast("int").alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, t: F.struct((acc["at"] + F.length(t["piece"])).alias("at"), F.when(
            t["learns"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + t["head"]).alias("start"), t["body"].alias("length")))))
            .otherwise(acc["spans"]).alias("spans")), lambda acc: acc["spans"])
    return whole.select("tree", "leaf", "rank", F.size("turns").cast("bigint").alias("n_turns"),
                        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), spans.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) back from a formatted conversation."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")
    role = lambda p: F.substring_index(F.substring(p, F.lit(len(MARK) + 1), F.length(p)), MIDDLE, 1)
    text = lambda p: F.substring(p, F.instr(p, MIDDLE) + len(MIDDLE), F.length(p))
    return F.transform(pieces, lambda p: F.struct(unescape(role(p)).alias("role"), unescape(text(p)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"], s["length"]))), "")


SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
coded as (
  select conv_id, turn, role, text,
    replace(replace(replace(replace(role, '\', '\s'), '#', '\h'), '<', '\l'), ':', '\c') as r,
    replace(replace(replace(text, '\', '\s'), '#', '\h'), '<', '\l') as t from rows),
whole as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as said,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '') as learned,
    sum(length('### ' || r || ': ' || t || '</turn>') + 1) as n
  from coded group by conv_id)
select conv_id, n_turns, sha256(said) as turns_sha256, length(learned) as loss_chars,
       sha256(learned) as loss_sha256, n::bigint as formatted_chars from whole
"""
