"""Operator 2: conversations from reply trees, in native DataFrame operations.

Messages point at the message they answer.  Self-joins that double the distance (a table of
ancestors 1, 2, 4, ... replies up) enumerate every root-to-leaf path in as many rounds as
the logarithm of the deepest reply.  Branches of a tree are ranked by the mean score of
their messages, and each chosen path becomes one conversation, written by a template that
marks the turns, with the places of the assistant's texts as loss spans.

Template, fixed values: a turn is ``<s>role[INST]text[/INST]</s>``.  In roles and texts a
backslash is doubled, and the four marks get a backslash behind their first character, so
that no mark occurs inside; taking the first backslash of each pair away restores the text.

Defined results: null roles and texts are empty; messages whose parent is missing, or null,
are roots; messages on a cycle have no root and are in no path; repeated rows of one id
stand behind each other, ordered by role and text, as ``from_turns`` numbers them; a tree
without messages has no conversation; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import materialize, pick

BEGIN, TEXT, END_TEXT, END = "<s>", "[INST]", "[/INST]", "</s>"


def escape(c: Column) -> Column:
    doubled = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"(<(?=/?s>)|\[(?=/?INST\]))", r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def from_turns(conversations: DataFrame) -> DataFrame:
    """Messages (tree, id, parent, role, text, score) of conversations by rows: each turn
    answers the one before it."""
    c = pick(conversations, "conv_id", "turn", "role", "text")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    c = c.select("conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "turn").withColumn("id", F.row_number().over(order).cast("long"))
    return c.select(F.col("conv_id").alias("tree"), "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """Rows (tree, leaf, rank, id, depth) of every chosen root-to-leaf path; depth counts
    from the leaf.  ``best``: branches to keep of each tree (None: all)."""
    m = pick(messages, "tree", "id", "parent", "score")
    up = m.filter("parent is not null").join(m.select(F.col("tree").alias("t"), F.col("id").alias("p")), F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("p")), "left_semi").select("tree", F.col("id").alias("node"), F.col("parent").alias("above"))
    leaves = m.join(up.select(F.col("tree").alias("t"), "above"), F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("above")), "left_anti")
    found = leaves.select("tree", F.col("id").alias("leaf"), F.col("id"), F.lit(0).cast("long").alias("depth"))
    step, nodes = 1, None
    up = materialize(up, "replies")
    while not up.isEmpty():
        if nodes is None:
            nodes = m.count()
        if step > nodes:  # only cycles climb this far
            break
        j = up.select(F.col("tree").alias("t"), "node", "above")
        found = materialize(found.unionByName(found.join(j, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("node"))).select("tree", "leaf", F.col("above").alias("id"), (F.col("depth") + step).alias("depth"))), "paths")
        k = up.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("above").alias("a"))
        up = materialize(up.join(k, F.col("tree").eqNullSafe(F.col("t")) & (F.col("above") == F.col("n"))).select("tree", "node", F.col("a").alias("above")), "replies")
        step *= 2
    scored = found.join(m.select(F.col("tree").alias("t"), F.col("id").alias("n"), F.coalesce("score", F.lit(0.0)).alias("score")), F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("n"))).select("tree", "leaf", "id", "depth", "score")
    branch = scored.groupBy("tree", "leaf").agg(F.avg("score").alias("score"))
    ranked = branch.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))).drop("score")
    if best is not None:
        ranked = ranked.filter(F.col("rank") <= best)
    r = ranked.select(F.col("tree").alias("t"), F.col("leaf").alias("l"), "rank")
    return found.join(r, F.col("tree").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("l"))).select("tree", "leaf", "rank", "id", "depth")


def format_paths(messages: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row per path: tree, leaf, rank, formatted, loss_spans (from and length, in code
    points of ``formatted``, of each escaped assistant text)."""
    m = pick(messages, "tree", "id", "role", "text").select(F.col("tree").alias("t"), F.col("id").alias("n"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = chosen.join(m, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("n")))
    head = F.concat(F.lit(BEGIN), escape(F.col("role")), F.lit(TEXT))
    body = escape(F.col("text"))
    rows = rows.select("tree", "leaf", "rank", "depth", head.alias("head"), body.alias("body"), (F.col("role") == "assistant").alias("loss"))
    rows = rows.withColumn("size", F.length("head") + F.length("body") + len(END_TEXT + END))
    turns = rows.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(F.struct((-F.col("depth")).alias("at"), "head", "body", "loss", "size"))).alias("turns"))
    formatted = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END_TEXT + END))))
    walk = F.aggregate(
        F.transform("turns", lambda t: F.struct(F.length(t["head"]).alias("h"), F.length(t["body"]).alias("b"), t["loss"].alias("loss"), t["size"].alias("size"))),
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans")),
        lambda a, t: F.struct((a["at"] + t["size"]).alias("at"), F.when(t["loss"], F.concat(a["spans"], F.array(F.struct((a["at"] + t["h"]).alias("start"), t["b"].alias("length"))))).otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"],
    )
    return turns.select("tree", "leaf", "rank", formatted.alias("formatted"), walk.alias("loss_spans"))


def parse(formatted: DataFrame) -> DataFrame:
    """Read conversations back: adds ``turns`` (role, text) and ``loss_text``."""
    inner = formatted.withColumn("b", F.expr(f"substring(formatted, {len(BEGIN) + 1}, greatest(length(formatted) - {len(BEGIN + END_TEXT + END)}, 0))"))
    pieces = F.split("b", r"\[/INST\]</s><s>")

    def turn(p: Column) -> Column:
        return F.struct(unescape(F.substring_index(p, TEXT, 1)).alias("role"), unescape(F.regexp_replace(p, r"(?s)\A.*?\[INST\]", "")).alias("text"))

    turns = F.when(F.length("formatted") == 0, F.expr("cast(array() as array<struct<role:string,text:string>>)")).otherwise(F.transform(pieces, turn))
    loss = F.concat_ws("", F.transform("loss_spans", lambda s: unescape(F.col("formatted").substr(s["start"] + 1, s["length"]))))
    return inner.withColumn("turns", turns).withColumn("loss_text", loss).drop("b")


def digests(parsed: DataFrame) -> DataFrame:
    text = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return parsed.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (
  SELECT *, length(replace(replace(replace(replace(replace(role, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'))
    + length(replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')) + 20 AS size FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""
