"""Chat formatting: reply trees, their ranked root-to-leaf paths, and a reversible template."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import durable

#: A turn is HEAD, the role, a new line, the text, END. Roles and texts are escaped, so both strings occur in a formatted conversation only as markers.
HEAD, END = "### ", "</turn>\n"
#: Control strings and what stands for them. The escape sign comes first; each stand-in is the sign and one letter.
ESCAPES = (("\\", "\\\\"), ("### ", "\\h"), ("</turn>", "\\t"), ("\n", "\\n"))
#: Line breaks are escaped in roles only.
TEXT_ESCAPES = ESCAPES[:3]
TRAINED_ROLE = "assistant"


def escape(value: Column, pairs=TEXT_ESCAPES) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, F.coalesce(value, F.lit("")))


def unescape(value: Column, pairs=TEXT_ESCAPES) -> Column:
    """The inverse of escape. Doubled signs are the places to cut: between them every sign begins a stand-in."""
    part = lambda x: reduce(lambda c, p: F.replace(c, F.lit(p[1]), F.lit(p[0])), pairs[1:], x)
    return F.array_join(F.transform(F.split(value, r"\\\\", -1), part), "\\")


def ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Self-joins by doubling: the k-th table has, for each node with at least 2^k ancestors, the one 2^k above it, and the summed score of the nodes from it up to, not including, that one. Then the nodes whose parents run in a circle.

    nodes: tree, node, parent (null: root), score. A parent that isn't a node of the same tree counts as null. The number of joins is the logarithm of the depth; a node with more ancestors than there are nodes is in a circle or below one.
    """
    ids = nodes.select(F.col("tree").alias("t"), F.col("node").alias("up"))
    most = nodes.count().bit_length()
    step = durable(nodes.where("parent is not null").join(ids, (F.col("tree").eqNullSafe(F.col("t"))) & (F.col("parent") == F.col("up"))).select("tree", "node", "up", F.col("score").alias("gain")))
    levels = []
    while len(levels) < most and not step.isEmpty():
        levels.append(step)
        above = step.select(F.col("tree").alias("t"), F.col("node").alias("via"), F.col("up").alias("top"), F.col("gain").alias("more"))
        step = durable(step.join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("via"))).select("tree", "node", F.col("top").alias("up"), (F.col("gain") + F.col("more")).alias("gain")))
    return levels, step.select("tree", "node")


def paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, leaf, branch, total, node, depth): the nodes of the chosen root-to-leaf paths of each reply tree; branch 1 has the highest summed score.

    Branches of a tree with several roots are ranked together; equal sums by the smaller leaf. branches: how many are kept of each tree, None for all. Null scores count as 0.
    Nodes whose parents run in a circle have no root: they, and what hangs below them, are on no path.
    """
    nodes = durable(nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0)).cast("double").alias("score")))
    levels, circling = ancestors(nodes)
    if not circling.isEmpty():
        gone = circling.select(F.col("tree").alias("t"), F.col("node").alias("n"))
        nodes, *levels = (durable(x.join(gone, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti")) for x in (nodes, *levels))
    parents = nodes.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    ends = nodes.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")), "left_anti")
    totals = ends.select("tree", "node", F.col("node").alias("at"), F.lit(0.0).alias("total"), F.lit(0).cast("long").alias("height"))
    for k, step in reversed(list(enumerate(levels))):
        s = step.select(F.col("tree").alias("t"), F.col("node").alias("from"), "up", "gain")
        totals = totals.join(s, F.col("tree").eqNullSafe(F.col("t")) & (F.col("at") == F.col("from")), "left").select(
            "tree", "node", F.coalesce("up", "at").alias("at"), (F.col("total") + F.coalesce("gain", F.lit(0.0))).alias("total"), (F.col("height") + F.when(F.col("up").isNotNull(), 2**k).otherwise(0)).alias("height"))
    root = nodes.select(F.col("tree").alias("t"), F.col("node").alias("root"), F.col("score").alias("base"))
    leaves = durable(totals.join(root, F.col("tree").eqNullSafe(F.col("t")) & (F.col("at") == F.col("root"))).select("tree", "node", (F.col("total") + F.col("base")).alias("total"), "height"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node"))
    ranked = leaves.withColumn("branch", rank)
    ranked = ranked if branches is None else ranked.where(F.col("branch") <= branches)
    on_path = durable(ranked.select("tree", F.col("node").alias("leaf"), "branch", "total", "node", "height"))
    for k, step in reversed(list(enumerate(levels))):
        s = step.select(F.col("tree").alias("t"), F.col("node").alias("from"), "up")
        raised = on_path.join(s, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("from"))).select("tree", "leaf", "branch", "total", F.col("up").alias("node"), (F.col("height") - 2**k).alias("height"))
        on_path = durable(on_path.unionByName(raised))  # else each level's plan would hold the one before twice
    return on_path.withColumnRenamed("height", "depth")


def formatted(turns: DataFrame, key: list[str], trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per key with conversation (string) and loss_spans, an array of struct(start, length) in code points, of the escaped texts of the trained role. turns: key, depth, role, text; null role or text: empty."""
    head = F.concat(F.lit(HEAD), escape(F.col("role"), ESCAPES), F.lit("\n"))
    turn = F.struct("depth", head.alias("head"), escape(F.col("text")).alias("body"), (F.coalesce("role", F.lit("")) == trained_role).alias("loss"))
    rows = turns.groupBy(*key).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    conversation = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    sizes = F.transform("turns", lambda t: F.struct((F.char_length(t["head"]) + F.char_length(t["body"]) + len(END)).cast("long").alias("all"), F.char_length(t["head"]).cast("long").alias("head"), F.char_length(t["body"]).cast("long").alias("body"), t["loss"].alias("loss")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    span = lambda s, t: F.array(F.struct((s["at"] + t["head"]).alias("start"), t["body"].alias("length")))
    walk = F.aggregate(sizes, zero, lambda s, t: F.struct((s["at"] + t["all"]).alias("at"), F.when(t["loss"], F.concat(s["spans"], span(s, t))).otherwise(s["spans"]).alias("spans")))
    return rows.select(*key, conversation.alias("conversation"), walk["spans"].alias("loss_spans"))


def read_back(conversation: Column) -> Column:
    """array of struct(role, text) that a formatted conversation holds."""
    turns = F.filter(F.split(conversation, END, -1), lambda t: t != "")
    return F.transform(turns, lambda t: F.struct(
        unescape(F.substring_index(F.substring(t, len(HEAD) + 1, 1 << 30), "\n", 1), ESCAPES).alias("role"),
        unescape(F.substring(t, F.instr(t, "\n") + 1, F.lit(1 << 30))).alias("text"),
    ))


def loss_text(conversation: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, one span after the other with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(conversation, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def format_trees(messages: DataFrame, tree_col: str, node_col: str, parent_col: str, role_col: str, text_col: str, score_col: str | None = None, branches: int | None = 1) -> DataFrame:
    """Formats the chosen branches of reply trees: tree, leaf, branch, total, conversation, loss_spans.

    A node id names one message of its tree. Of several rows of one tree and node, equal or not, the first by parent, role, text and score (nulls first) is the message. A row with a null node has no place in a tree and is left out, and so are
    messages whose parents run in a circle; a parent that isn't there makes a root. Null trees form one tree. No rows give none. Other columns are not read.
    """
    score = F.col(score_col) if score_col else F.lit(0)
    rows = messages.select(F.col(tree_col).alias("tree"), F.col(node_col).alias("node"), F.col(parent_col).alias("parent"), F.col(role_col).alias("role"), F.col(text_col).alias("text"), score.alias("score"))
    rows = rows.where("node is not null").groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m")).select("tree", "node", "m.*")
    chosen = paths(rows.select("tree", "node", "parent", "score"), branches)
    texts = rows.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    turns = chosen.join(texts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    return formatted(turns, ["tree", "leaf", "branch", "total"])


def conversations_as_trees(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Linear conversations as reply trees of one branch: each row answers the one before it by turn; equal turns go by role, then text, nulls first."""
    place = F.row_number().over(Window.partitionBy(conv_col).orderBy(F.col(turn_col).asc_nulls_first(), F.col(role_col).asc_nulls_first(), F.col(text_col).asc_nulls_first()))
    nodes = rows.select(F.col(conv_col).alias("conv_id"), place.cast("long").alias("node"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    return nodes.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def digest(formatted_rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of formatted conversations, read back from what was written."""
    turns = read_back(F.col("conversation"))
    rows = formatted_rows.select(F.col("tree").alias("conv_id"), "conversation", turns.alias("turns"), loss_text(F.col("conversation"), F.col("loss_spans")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("conversation").cast("long").alias("formatted_chars"),
    )
