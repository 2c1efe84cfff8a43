"""Conversations from reply trees: iterative self-joins find the root-to-leaf paths, the best paths are formatted.

The self-joins double the step: after j rounds each message knows its ancestor 2^j replies up, the score of the messages
in between and its depth, so that a tree of depth d takes log2(d) rounds whatever its size. The same tables then spell
out the chosen paths only, from the leaf up. Everything is built-in functions and joins.

Format of a turn: ``<|turn|>role``, a line feed, the text, ``<|end|>`` and a line feed. In role and text a backslash, ``<`` and ``[`` are
written as ``\\\\``, ``\\l`` and ``\\b``, and a line feed in a role as ``\\n``, so that no control string of this or a similar template
can come from a text and everything reads back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.operators.scale import settle

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
MOST_ROUNDS = 40


def escaped(text: Column, role: bool = False) -> Column:
    for raw, code in (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b"), *((("\n", "\\n"),) if role else ())):
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescaped(text: Column, role: bool = False) -> Column:
    """Between two-backslash codes, every other code stands for itself."""

    def plain(part: Column) -> Column:
        for raw, code in (("<", "\\l"), ("[", "\\b"), *((("\n", "\\n"),) if role else ())):
            part = F.replace(part, F.lit(code), F.lit(raw))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def _same(left: str, right: str, *columns: str) -> Column:
    match = F.lit(True)
    for c in columns:
        match = match & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return match


def paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """The ``keep`` best root-to-leaf paths of each tree as rows (tree, path, depth, id), depth from 0 at the root.

    ``messages``: tree, id, parent, score; ids are unique in a tree and not null. A message whose parent is null or not in
    its tree is a root. A path's score is the mean of its messages' (a null one is 0); ties go to the smaller leaf. ``path``
    ranks from 1. Messages on a circle of replies, and below one, have no root and so no path.
    """
    known = messages.select("tree", "id")
    nodes = messages.alias("m").join(known.alias("p"), F.col("m.tree").eqNullSafe(F.col("p.tree")) & (F.col("m.parent") == F.col("p.id")), "left")
    nodes = nodes.select("m.tree", "m.id", F.col("p.id").alias("up"), F.lit(1).alias("n"), F.coalesce("m.score", F.lit(0.0)).alias("total"))
    steps = [settle(nodes, "replies")]
    open_ = steps[0].where("up is not null").count()
    while open_ and len(steps) < MOST_ROUNDS:
        now = steps[-1]
        joined = now.alias("x").join(now.alias("y"), F.col("x.tree").eqNullSafe(F.col("y.tree")) & (F.col("x.up") == F.col("y.id")), "left")
        further = joined.select(
            "x.tree", "x.id", "y.up", (F.col("x.n") + F.coalesce("y.n", F.lit(0))).alias("n"), (F.col("x.total") + F.coalesce("y.total", F.lit(0.0))).alias("total")
        )
        steps.append(settle(further, "replies"))
        left = steps[-1].where("up is not null").count()
        if left == open_:  # only circles are left
            break
        open_ = left
    done = steps[-1].where("up is null")
    inner = steps[0].where("up is not null").select("tree", F.col("up").alias("id")).distinct()
    leaves = done.alias("d").join(inner.alias("i"), _same("d", "i", "tree", "id"), "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("n")), "id")
    chosen = leaves.withColumn("path", F.row_number().over(best)).where(F.col("path") <= keep).select("tree", "path", "id", (F.col("n") - 1).alias("depth"))
    rows = settle(chosen, "paths")
    # each row adds the message 2^j replies above it: after the last round a path's depths are complete
    for step in reversed(range(len(steps))):
        above = rows.alias("r").join(steps[step].where("up is not null").alias("s"), _same("r", "s", "tree", "id"))
        rows = settle(rows.unionByName(above.select("r.tree", "r.path", F.col("s.up").alias("id"), (F.col("r.depth") - (1 << step)).alias("depth"))), "paths")
    return rows


def formatted(messages: DataFrame, keep: int = 1, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per chosen path: tree, path, n_turns, formatted, loss (array of start, end in code points).

    ``messages``: tree, id, parent, role, text, score; other columns are not read. Null roles and texts are empty. The loss
    covers the escaped texts of ``loss_roles``. Rows that repeat a tree and id count once, with the smallest of the rest;
    rows with a null id are left out; null trees are one tree. A path longer than one row can hold fails. An empty
    table gives an empty result.
    """
    fields = ["parent", "score", "role", "text"]
    unique = messages.where("id is not null").groupBy("tree", "id").agg(F.min(F.struct(*fields)).alias("m")).select("tree", "id", "m.*")
    unique = settle(unique, "messages")
    found = paths(unique.select("tree", "id", "parent", "score"), keep)
    turns = found.alias("f").join(unique.alias("u"), _same("f", "u", "tree", "id"))
    head = F.concat(F.lit(OPEN), escaped(F.coalesce("u.role", F.lit("")), role=True), F.lit("\n"))
    body = escaped(F.coalesce("u.text", F.lit("")))
    turn = F.struct("f.depth", head.alias("head"), body.alias("body"), F.coalesce(F.col("u.role").isin(*loss_roles), F.lit(False)).alias("loss"))
    rows = turns.groupBy("f.tree", "f.path").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans_type = "array<struct<start:bigint,end:bigint>>"

    def place(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(CLOSE)).alias("at"), F.concat(state["loss"], F.when(t["loss"], one).otherwise(F.array().cast(spans_type))).alias("loss"))

    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(spans_type).alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    return rows.select("tree", "path", F.size("turns").cast("bigint").alias("n_turns"), whole.alias("formatted"), F.aggregate("turns", first, place, lambda s: s["loss"]).alias("loss"))


def read_back(formatted_text: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    parts = F.filter(F.split(formatted_text, r"<\|end\|>\n", -1), lambda p: p != "")

    def turn(part: Column) -> Column:
        line = F.instr(part, "\n")
        role = F.substring(part, len(OPEN) + 1, line - len(OPEN) - 1)
        return F.struct(unescaped(role, role=True).alias("role"), unescaped(F.substring(part, line + 1, F.length(part))).alias("text"))

    return F.transform(parts, turn)


def reply_chain(conversations: DataFrame) -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before it by turn (ties by role, then text)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    number = F.row_number().over(order).cast("bigint")
    return conversations.select(F.col("conv_id").alias("tree"), number.alias("id"), "role", "text").select(
        "tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def digest(conversations: DataFrame) -> DataFrame:
    """What reads back from the formatted conversations: counts and hashes of turns and loss per conv_id."""
    rows = formatted(reply_chain(conversations))
    turns = F.array_join(F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    pieces = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    read = rows.select(F.col("tree").alias("conv_id"), "n_turns", turns.alias("turns"), F.array_join(pieces, "").alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars"))
    return read.select(
        "conv_id", "n_turns", F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, 8 + 1 + 8 + length(role) + length(text)
    + length(regexp_replace(role || text, '[^\\<\[]', '', 'g')) AS chars FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
