"""Reply trees as conversations: paths by self-joins, branches by score, one formatted text per chosen path with its loss mask.

A tree is a table of messages with the ids of their parents. Jumps of one step are joined with themselves into jumps of two, four, ...
steps; each leaf then collects the messages above it by joining what it has reached with each jump table in turn, so a path of n
messages takes log n rounds and only ids move. Texts meet the chosen paths once. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestep.llm.common import stored

#: A turn is HEAD, role, SEPARATOR, text, END. Control strings inside roles and texts are broken up by a backslash.
HEAD, SEPARATOR, END = "### ", ": ", "</turn>\n"
#: Control strings and what stands for them; a backslash takes the next character as it is. Backslashes go first.
ESCAPES = (("\\", "\\\\"), ("##", "#\\#"), ("</turn>", "<\\/turn>"))
LOSS_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    """``text`` without control strings; NULL is empty. :func:`unescape` gives the text back."""
    out = F.coalesce(text, F.lit(""))
    for plain, marked in ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(marked))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): every leaf with each message on its way to the root, ``up`` steps above it.

    ``nodes`` has tree, node and parent, a row per message id. A message without a parent, or whose parent is not in its tree, is a root; one
    that is nobody's parent is a leaf. Messages on a circle, or below one, have no root and are on no path. NULL trees are one tree.
    """
    key = F.struct("tree").alias("tree")  # in a struct, NULL equals NULL
    nodes = nodes.select(key, "node", "parent")
    known = nodes.select("tree", F.col("node").alias("parent"))
    jumps = [stored(nodes.join(known, ["tree", "parent"], "left_semi").select("tree", "node", F.col("parent").alias("above")), "jumps")]
    most = None
    while not jumps[-1].isEmpty():
        if most is None:
            most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0]
        if 2 ** (len(jumps) - 1) > most:
            break
        last = jumps[-1]
        further = last.select("tree", F.col("node").alias("above"), F.col("above").alias("top"))
        jumps.append(stored(last.join(further, ["tree", "above"]).select("tree", "node", F.col("top").alias("above")), "jumps"))
    endless = jumps.pop()  # empty, but for circles
    leaves = nodes.join(nodes.select("tree", F.col("parent").alias("node")), ["tree", "node"], "left_anti")
    leaves = leaves.join(endless, ["tree", "node"], "left_anti") if not endless.isEmpty() else leaves
    reached = stored(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up")), "reached")
    for i, jump in enumerate(jumps):
        further = reached.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + 2 ** i).alias("up"))
        reached = reached.unionByName(stored(further, "reached"))
    return reached.select(F.col("tree.tree").alias("tree"), "leaf", "node", "up")


def best_branches(reached: DataFrame, scores: DataFrame, branches: int) -> DataFrame:
    """(tree, leaf, score, rank): in each tree the ``branches`` leaves whose paths have the highest mean score; ties by leaf.

    Each task first cuts a tree to its best leaves, so a tree of very many leaves is not gathered.
    """
    key = F.struct("tree").alias("tree")
    scored = (reached.select(key, "leaf", "node").join(scores.select(key, "node", "score"), ["tree", "node"])
              .groupBy("tree", "leaf").agg((F.sum("score") / F.count(F.lit(1))).alias("score")))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))
    return ranked.filter(F.col("rank") <= branches).select(F.col("tree.tree").alias("tree"), "leaf", "score", "rank")


def format_turns(turns: DataFrame, key, order, role: str = "role", text: str = "text", loss_roles=LOSS_ROLES) -> DataFrame:
    """A row per ``key``: its columns, formatted (string) and loss (array of start and end, in bytes of UTF-8, end exclusive).

    Turns follow ``order``, then role and text. NULL roles and texts are empty. ``loss`` has one span for each turn of ``loss_roles``, around
    its escaped text. A conversation is one record, so one row holds all its turns.
    """
    start = F.concat(F.lit(HEAD), F.replace(escape(F.col(role)), F.lit(":"), F.lit("\\:")), F.lit(SEPARATOR))
    body = escape(F.col(text))
    spread = turns.select(*key, F.struct(*order, F.col(role).alias("_role"), F.col(text).alias("_text")).alias("_at"),
                          F.concat(start, body, F.lit(END)).alias("_turn"), F.octet_length(start).alias("_start"),
                          F.octet_length(body).alias("_body"), F.coalesce(F.col(role).isin(*loss_roles), F.lit(False)).alias("_loss"))
    so_far = Window.partitionBy(*key).orderBy("_at")
    placed = (spread.withColumn("_end", F.sum(F.octet_length("_turn")).over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_number", F.row_number().over(so_far)))
    first = F.col("_end") - F.octet_length("_turn") + F.col("_start")
    turn = F.struct("_number", "_turn", "_loss", first.alias("start"), (first + F.col("_body")).alias("end"))
    return (placed.groupBy(*key).agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
            .select(*key, F.array_join(F.transform("_turns", lambda t: t["_turn"]), "").alias("formatted"),
                    F.transform(F.filter("_turns", lambda t: t["_loss"]), lambda t: F.struct(t["start"], t["end"])).alias("loss")))


def format_trees(nodes: DataFrame, tree: str = "tree", node: str = "node", parent: str = "parent", role: str = "role", text: str = "text",
                 score: str | None = None, branches: int | None = 1, loss_roles=LOSS_ROLES) -> DataFrame:
    """A row per chosen path: tree, leaf, formatted, loss.

    Of every tree the ``branches`` best paths (mean ``score``, NULL counts as 0; without a score column all tie) or, with None, all. Rows that
    share a tree and node are one message: they stand one after another, by role and text; the message has their least parent and
    their mean score. Other columns are not looked at; no rows give no rows.
    """
    value = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    rows = stored(nodes.select(F.col(tree).alias("tree"), F.col(node).alias("node"), F.col(parent).alias("parent"), F.col(role).alias("role"),
                               F.col(text).alias("text"), value.alias("score")), "messages")
    ids = stored(rows.groupBy("tree", "node").agg(F.min("parent").alias("parent"), F.avg("score").alias("score")), "ids")
    reached = paths(ids)
    key = F.struct("tree").alias("key")
    chosen = reached.select(key, "leaf", "node", "up")
    if branches is not None:
        best = best_branches(reached, ids, branches).select(key, "leaf")
        chosen = chosen.join(best, ["key", "leaf"], "left_semi")
    turns = chosen.join(rows.select(key, "tree", "node", "role", "text"), ["key", "node"]).withColumn("down", -F.col("up"))
    return format_turns(turns, ["tree", "leaf"], ["down"], loss_roles=loss_roles)


def from_turns(turns: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations of numbered turns as trees without branches: tree, node, parent, role, text.

    Turns that share a number follow each other by role and text, each the reply to the one before; a NULL number comes first.
    """
    at = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = turns.select(F.col(tree).alias("tree"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    number = F.row_number().over(at).cast("long")
    return (rows.withColumn("node", number).drop("turn")
            .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).select("tree", "node", "parent", "role", "text"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of role and text, unescaped."""
    shape = r"(?s)^### ([^\\:]*+(?:\\.[^\\:]*+)*+): (.*)$"
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(unescape(F.regexp_extract(p, shape, 1)).alias("role"),
                                                  unescape(F.regexp_extract(p, shape, 2)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, span after span."""
    raw = formatted.cast("binary")
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(raw, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
                                                             .cast("string"))), "")
