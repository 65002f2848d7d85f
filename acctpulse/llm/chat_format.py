r"""Chat formatting over reply trees.

Rows (conv_id, turn, role, text) are nodes; a reply's parent is given by a
``parent`` column, or else is the row before it in its conversation, so that a
plain conversation is a tree with one branch.  Root-to-leaf paths are listed by
iterative self-joins that double the reach of each step, so a branch of n turns
takes about log2(n) joins.  Branches of a tree are ranked by their score (the
sum over their nodes, if there is a score column; ties go to the longer branch,
then the smaller leaf) and each of the ``top`` best becomes one conversation.

The template writes ``<|im_start|>role\ntext<|im_end|>\n`` per turn.  Control
strings inside roles and texts (``<|``, ``<s>``, ``</s>``, ``[INST]``,
``[/INST]``) get a backslash after their first character, and one more if they
already have some, so that removing one gives back the text; a line break in a role becomes
the control string ``<|br|>``.  The loss mask is the list of code point spans of the escaped assistant texts.

Defined results: a null text or role is empty; rows of equal turn are ordered
by role and text; a null turn comes first; rows with a null conv_id form no
conversation and are left out; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from acctpulse.llm.common import constant_rows, written

START, END, BREAK, ROLE_BREAK = "<|im_start|>", "<|im_end|>", "\n", "<|br|>"
MAX_DOUBLINGS = 48

#: The conversation that the contract adds.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<(\\*)(\||/?s>)", r"<\\$1$2")
    return F.regexp_replace(text, r"\[(\\*)(/?INST\])", r"[\\$1$2")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<\\(\\*)(\||/?s>)", r"<$1$2")
    return F.regexp_replace(text, r"\[\\(\\*)(/?INST\])", r"[$1$2")


def chains(rows: DataFrame) -> DataFrame:
    """Plain conversations as trees: (tree, node, parent, role, text, score)."""
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    node = rows.filter("conv_id is not null").select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return node.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, above): every node on the path of every leaf, with how
    many replies lie between it and the leaf.  After k rounds ``reach`` holds each
    node's ancestor 2^k above and ``found`` the 2^k nearest nodes of each path."""
    edge = nodes.filter("parent is not null").select("tree", "node", "parent")
    leaves = nodes.join(edge.select("tree", F.col("parent").alias("node")).distinct(), ["tree", "node"], "left_anti")
    found = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"))
    reach = written(edge.select("tree", "node", F.col("parent").alias("up")), "reach")
    for k in range(MAX_DOUBLINGS):
        if reach.isEmpty():
            return found
        further = found.join(reach, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above"))
        found = written(found.union(further), "paths")
        next_up = reach.select("tree", F.col("node").alias("up"), F.col("up").alias("top"))
        reach = written(reach.join(next_up, ["tree", "up"]).select("tree", "node", F.col("top").alias("up")), "reach")
    raise ValueError("the replies form a cycle")


def format_trees(nodes: DataFrame, top: int = 1) -> DataFrame:
    """(tree, rank, formatted, loss_mask) of the ``top`` branches of each tree;
    loss_mask is an array of (start, length) code point spans of ``formatted``."""
    nodes = written(nodes, "nodes")
    on_path = paths(nodes).join(nodes, ["tree", "node"])
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit(BREAK), F.lit(ROLE_BREAK))
    text = escape(F.coalesce("text", F.lit("")))
    turns = on_path.select("tree", "leaf", "score", F.struct(
        (-F.col("above")).alias("at"), F.concat(F.lit(START), role, F.lit(BREAK)).alias("head"), text.alias("body"), (F.col("role") == "assistant").alias("learn")).alias("turn"))
    branch = turns.groupBy("tree", "leaf").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("depth"), F.array_sort(F.collect_list("turn")).alias("turns"))
    rank = F.row_number().over(W.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "leaf"))
    chosen = branch.withColumn("rank", rank).filter(F.col("rank") <= top)
    tail = F.lit(END + BREAK)
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], tail)), "")
    # one pass: the end of the text so far, and the spans of the assistant texts
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        begin = state["end"] + F.length(t["head"])
        size = F.length(t["body"]).cast("long")
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct((begin + size + len(END + BREAK)).alias("end"), F.when(t["learn"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return chosen.select("tree", "rank", whole.alias("formatted"), F.aggregate("turns", zero, step)["spans"].alias("loss_mask"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation, unescaped."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")

    def turn(p: Column) -> Column:
        own = F.substring_index(p, END, 1)
        cut = F.instr(own, BREAK)
        return F.struct(unescape(F.replace(F.substr(own, F.lit(1), cut - 1), F.lit(ROLE_BREAK), F.lit(BREAK))).alias("role"), unescape(F.substr(own, cut + 1, F.length(own))).alias("text"))

    return F.transform(parts, turn)


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped span by span."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def with_probe(conversations: DataFrame, spark: SparkSession) -> DataFrame:
    probe = constant_rows(spark, PROBE, conv_id="long", turn="long", role="string", text="string")
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)


def report(conversations: DataFrame) -> DataFrame:
    """Formats every conversation and reads the written output back."""
    out = written(format_trees(chains(conversations)), "formatted")
    masked = masked_text(F.col("formatted"), F.col("loss_mask"))
    read = out.select(F.col("tree").alias("conv_id"), read_turns(F.col("formatted")).alias("turns"), masked.alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars")


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS role0, text AS text0 FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, replace(regexp_replace(regexp_replace(role, '<(\\*)(\||/?s>)', '<\\\1\2', 'g'), '\[(\\*)(/?INST\])', '[\\\1\2', 'g'), chr(10), '<|br|>') AS safe_role,
    regexp_replace(regexp_replace(text, '<(\\*)(\||/?s>)', '<\\\1\2', 'g'), '\[(\\*)(/?INST\])', '[\\\1\2', 'g') AS safe_text
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role0 NULLS FIRST, text0 NULLS FIRST)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role0 NULLS FIRST, text0 NULLS FIRST), '')) AS loss_sha256,
  CAST(sum(length(safe_role) + length(safe_text) + length('<|im_start|>') + length('<|im_end|>') + 2) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
