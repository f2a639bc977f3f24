"""Merkle manifest of a dataset: a leaf per row, a tree per group, a tree over the groups, and a proof for each leaf.

Nodes are numbered within their group and cut into aligned blocks of ``arity ** LEVELS``. A block keeps every level as one string of
hex digests: fixed-width substrings of a level are hashed into the next, and the substrings that flank a node in its run are its
siblings. The roots of the blocks are the nodes of the next layer, until each group has one; the roots of the groups
are the nodes of the top tree. On the way back each block meets one row, the path above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestep.llm.common import let, stored

#: Levels inside a block; with two nodes a run a block has 256 nodes, 16 KB of digests.
LEVELS = 8
#: Hex digits of a digest.
WIDTH = 64


def field(value: Column) -> Column:
    """A value in a leaf: ``-`` if NULL, else its length in UTF-8 bytes, a colon, and it; integers in decimal."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """SHA-256 of the fields of a row in the order given, in lower-case hex."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _counting(n: Column | int, body) -> Column:
    """``body`` of 0, 1, ... n - 1; an empty array where n is 0."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.transform(F.slice(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), F.lit(1), n), body)


def _parents(level: Column, arity: int) -> Column:
    """The level above ``level`` (hex digests as bytes): a digest for each substring of ``arity`` digests, the last one shorter or not."""
    run = arity * WIDTH
    hashed = _counting(F.ceil(F.length(level) / run).cast("int"), lambda i: F.sha2(F.substring(level, i * run + 1, F.lit(run)), 256))
    return F.array_join(hashed, "").cast("binary")


def _flanks(level: Column, at: Column, arity: int) -> Column:
    """The digests left and right of node ``at`` in its run, concatenated; empty where there are none."""
    first = at - at % arity
    return F.struct(F.substring(level, first * WIDTH + 1, (at - first) * WIDTH).cast("string").alias("left"),
                    F.substring(level, (at + 1) * WIDTH + 1, (first + arity - 1 - at) * WIDTH).cast("string").alias("right"))


def _placed(rows: DataFrame) -> DataFrame:
    """(grp, pos, total, node, key, extra): rows numbered from 0 within their group, by key, then digest.

    Ranges of all rows are sorted on their own and counted; a group of any size, or a key that very many rows share, lies over
    several ranges (equal rows are parted by their row number), and only the counts, one per range and group, are summed in order.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["grp", "key", "node", "row"]
    ordered = stored(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("row")
                     .withColumn("range", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "ordered")
    counts = ordered.groupBy("grp", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("grp").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select("grp", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), "first",
                                  F.sum("n").over(Window.partitionBy("grp")).alias("total")), "starts")
    return ordered.join(starts, ["grp", "range"]).select("grp", (F.col("before") + F.col("at") - F.col("first")).alias("pos"), "total", "node",
                                                         "key", "extra")


def _blocks(nodes: DataFrame, arity: int) -> DataFrame:
    """(grp, block, total, entries, levels): each block's nodes in order, and its levels from its nodes up to its root."""
    size = arity ** LEVELS
    entry = F.struct("pos", *[c for c in nodes.columns if c not in ("grp", "pos", "total")])
    grouped = (nodes.groupBy("grp", F.floor(F.col("pos") / size).alias("block"))
               .agg(F.array_sort(F.collect_list(entry)).alias("entries"), F.first("total").alias("total")))
    base = F.array_join(F.transform("entries", lambda e: e["node"]), "").cast("binary")
    height = F.size(F.filter(F.array(*[F.lit(arity ** i) for i in range(LEVELS)]), lambda p: p < F.col("total")))
    levels = F.aggregate(_counting(height, lambda i: i), F.array(base),
                         lambda done, _: F.concat(done, F.array(_parents(F.element_at(done, -1), arity))))
    return grouped.withColumn("levels", levels)


def _grown(rows: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """The layers of blocks over ``rows`` (grp, key, node, extra, row), and (grp, root)."""
    size = arity ** LEVELS
    nodes, layers = _placed(rows), []
    while True:
        blocks = stored(_blocks(nodes, arity), "blocks")
        layers.append(blocks)
        root = F.element_at("levels", -1).cast("string")
        if (blocks.agg(F.max("total")).first()[0] or 0) <= size:
            return layers, blocks.select("grp", root.alias("root"))
        nodes = blocks.select("grp", F.col("block").alias("pos"), F.ceil(F.col("total") / size).alias("total"), root.alias("node"))


def _proved(layers: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """The nodes of the lowest layer with their paths; ``above`` has grp, block (0), path and what else every node is to carry."""
    size = arity ** LEVELS
    carried = [c for c in above.columns if c not in ("grp", "block", "path")]
    powers = F.array(*[F.lit(arity ** i) for i in range(LEVELS)])

    def path(entry):
        at = (entry["pos"] % size).cast("int")
        inside = _counting(F.size("levels") - 1, lambda i: _flanks(F.col("levels")[i], F.floor(at / powers[i]).cast("int"), arity))
        return F.concat(inside, F.col("path"))

    for blocks in reversed(layers):
        nodes = blocks.join(above, ["grp", "block"]).select(
            "grp", *carried, F.explode(F.transform("entries", lambda e: F.struct(e.alias("e"), path(e).alias("path")))).alias("n"))
        above = nodes.select("grp", F.col("n.e.pos").alias("block"), F.col("n.path").alias("path"), *carried)
    return nodes.select("grp", F.col("n.e").alias("entry"), F.col("n.path").alias("path"), *carried)


def prove(leaves: DataFrame, leaf: str = "leaf", group: str = "lang", order: str = "doc_id", carry=(), arity: int = 2) -> DataFrame:
    """A row per row of ``leaves``: its group, order, leaf and ``carry`` columns, then subroot, root and path.

    Per group the leaves ascend by ``order`` (NULL first, ties by leaf; rows that tie in both are equal nodes side by side). While several
    nodes remain, every run of ``arity`` (the last may be shorter, even one) becomes the hash of its concatenation; a lone leaf is its
    subroot. Subroots by group (NULL first, then by UTF-8 bytes) give the root in the same way. ``path`` has, level by level from the leaf
    to the root, the siblings left and right of the node. No rows give no rows. Other columns are not looked at;
    ``carry`` columns must be orderable.
    """
    rows = stored(leaves.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
                                F.col(order).alias("key"), F.col(leaf).alias("node"),
                                F.struct(F.col(group).alias("of"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]).alias("extra"),
                                F.monotonically_increasing_id().alias("row")), "leaves")
    layers, subroots = _grown(rows, arity)
    tops, roots = _grown(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("root").alias("node"),
                                         F.lit(0).alias("extra"), F.lit(0).alias("row")), arity)
    empty = F.array().cast("array<struct<left: string, right: string>>")
    groups = _proved(tops, roots.select("grp", F.lit(0).cast("long").alias("block"), empty.alias("path"), "root"), arity)
    above = groups.select(F.col("entry.key").alias("grp"), F.lit(0).cast("long").alias("block"), "path",
                          F.col("entry.node").alias("subroot"), "root")
    found = _proved(layers, above, arity)
    return found.select(F.col("entry.extra.of").alias(group), F.col("entry.key").alias(order), F.col("entry.node").alias(leaf),
                        *[F.col("entry.extra")[f"c{i}"].alias(c) for i, c in enumerate(carry)], "subroot", "root", "path")


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def check(docs: DataFrame, fields=("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang", order: str = "doc_id",
          counter: str = "n_chars", every: int = 7, arity: int = 2) -> DataFrame:
    """Prove every row, and fold it again as it would be after tampering.

    Where ``every`` divides the CRC-32 of the decimal ``order`` (NULL: nowhere), ``counter`` is taken one higher (NULL stays). Columns:
    ``order``, leaf, subroot, root, proof_sha256, folded_root, verified. Rows that repeat, NULL and empty values and empty tables follow
    :func:`prove`.
    """
    value = {f: F.col(f) for f in fields}
    hit = F.crc32(F.col(order).cast("string")) % every == 0
    tampered = F.when(hit, leaf(*{**value, counter: F.col(counter) + 1}.values()))
    proved = prove(docs.select(group, order, leaf(*value.values()).alias("leaf"), tampered.alias("tampered")), "leaf", group, order,
                   ["tampered"], arity)
    folded = proved.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select(order, "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
