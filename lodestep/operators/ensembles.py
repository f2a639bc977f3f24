"""Tree ensembles as tables of nodes: walked by joins, re-measured on other rows, ranked by their gains.

A node table has a row per node: tree, node (0 is a root), left and right (-1 at a leaf), feature (position in the list of
features), threshold (values up to it go left; larger ones, NULL and NaN go right), cover (weight of the rows it was grown on), value
(share of class 1, or a regression value), gain (drop of impurity by its split) and weight (of its tree). It may come from a fitted model, from a stored
table, or be written by hand as a scorecard.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..session import materialize, new_path, spread

COLUMNS = ["tree", "node", "left", "right", "feature", "threshold", "cover", "value", "gain", "weight"]
FOREST, BOOSTING = "forest", "boosting"
# Trees go to the executors in parts of at most this many nodes (or one tree).
PART_NODES = 500_000
# Rows of a task that walks trees, and places (rows x trees) looked up at a time.
ROWS, AT_ONCE = 20_000, 1 << 18


def node_table(model: PipelineModel, spark) -> DataFrame:
    """The nodes of a fitted forest or boosted ensemble (binary), read from its saved form in the shared folder."""
    fitted = model.stages[-1]
    path = new_path(spark, "ensemble")
    fitted.write().save(path)
    node = F.col("nodeData")
    stats = node["impurityStats"]
    if type(fitted).__name__.startswith("GBT"):
        cover, value = stats[0], node["prediction"]
    else:
        cover, value = stats[0] + stats[1], stats[1] / (stats[0] + stats[1])
    weights = F.array(*[F.lit(float(w)) for w in fitted.treeWeights])
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"), F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"),
        cover.alias("cover"), value.alias("value"), F.greatest(node["gain"], F.lit(0.0)).alias("gain"), weights[F.col("treeID")].alias("weight"))


def height(nodes: DataFrame) -> int:
    """Splits on the longest path. Every level is one join of the nodes reached so far with the table."""
    table = materialize(nodes.where("left >= 0").select("tree", "node", F.explode(F.array("left", "right")).alias("child")))
    reached, levels = table.where("node = 0"), 0
    while not reached.isEmpty():
        levels += 1
        reached = materialize(reached.select("tree", F.col("child").alias("node")).join(table, ["tree", "node"]))
    return levels


def walk(nodes: DataFrame, rows: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Each row under each tree: kept columns, tree, and the path of nodes from the root to the leaf.

    The walk goes level by level: where a row stands in a tree meets that node's split in a join, and the result is where it
    stands next. Where Spark finds the node table small enough it sends it along and the whole walk is one stage; a larger table is shuffled to.
    """
    nodes = materialize(nodes)
    splits = nodes.where("left >= 0").select("tree", F.col("node").alias("_at"), "left", "right", "feature", "threshold")
    trees = sorted(r["tree"] for r in nodes.select("tree").distinct().collect())  # a row per tree
    values = F.array(*[F.col(f).cast("double") for f in features])
    here = rows.select(*keep, values.alias("_x"), F.explode(F.array(*[F.lit(t) for t in trees])).alias("tree"),
                       F.lit(0).alias("_at"), F.array(F.lit(0)).alias("path"))
    low = F.get("_x", F.col("feature"))
    child = F.when(F.coalesce(low <= F.col("threshold"), F.lit(False)), F.col("left")).otherwise(F.col("right"))
    for _ in range(height(nodes)):
        here = here.join(splits, ["tree", "_at"], "left").select(
            *keep, "_x", "tree", F.coalesce(child, "_at").alias("_at"),
            F.when(F.col("left").isNotNull(), F.concat("path", F.array(child))).otherwise(F.col("path")).alias("path"))
    return here.select(*keep, "tree", F.col("_at").alias("leaf"), "path")


def parts_of(nodes: DataFrame, most: int) -> tuple[list[list[int]], int]:
    """The trees in parts of at most ``most`` nodes (or one tree), and their number."""
    sizes = nodes.groupBy("tree").count().orderBy("tree").collect()  # one row per tree
    parts: list[list[int]] = []
    room = 0
    for row in sizes:
        if not parts or row["count"] > room:
            parts.append([])
            room = most
        parts[-1].append(row["tree"])
        room -= row["count"]
    return parts, len(sizes)


def _steps(table: pd.DataFrame, features: int) -> dict:
    """A node table as arrays by place: where a row goes to either side, on which value, and what it finds at a leaf.

    A child that the table does not have is a place without a leaf, and a feature that the row does not have is missing.
    """
    places = {key: i for i, key in enumerate(zip(table["tree"].tolist(), table["node"].tolist()))}
    nowhere = len(places)
    here = np.array([*places.values(), nowhere])
    sides = {}
    inner = np.append(table["left"].to_numpy(float) >= 0, False)
    for side in ("left", "right"):
        there = [places.get((t, c), nowhere) for t, c in zip(table["tree"].tolist(), table[side].tolist())]
        sides[side] = np.where(inner, np.append(there, nowhere), here).astype(np.int32)
    feature = np.append(table["feature"].to_numpy(float), -1)
    feature = np.where((feature >= 0) & (feature < features), feature, features).astype(np.int32)
    roots = np.array([i for (_, node), i in places.items() if node == 0], np.int32)
    levels, front = 0, roots[inner[roots]]
    while len(front):
        levels += 1
        front = np.unique(np.concatenate([sides["left"][front], sides["right"][front]]))
        front = front[inner[front]]
    leaf = np.append(table["left"].to_numpy(float) < 0, False)
    number = lambda c: np.append(table[c].to_numpy(float), np.nan)
    return {**sides, "feature": feature, "threshold": number("threshold"), "leaf": leaf, "value": number("value"), "weight": number("weight"),
            "roots": roots, "levels": levels}


def _summed(features: int, kind: str, sent):
    """Adds to ``found`` of each row the sum of the leaf values of these trees, how many there are, and how many leaves it reached."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        worth = np.where(trees["leaf"], trees["value"] if kind == FOREST else trees["value"] * trees["weight"], np.nan)
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, features)
            x = np.concatenate([x, np.full((len(x), 1), np.nan)], axis=1)
            found = batch.column("found").flatten().to_numpy(zero_copy_only=False).reshape(len(x), 3).copy()
            step = max(1, AT_ONCE // max(1, len(trees["roots"])))
            for low in range(0, len(x), step):
                some = x[low:low + step]
                row = np.arange(len(some))[:, None]
                at = np.tile(trees["roots"], (len(some), 1))
                for _ in range(trees["levels"]):
                    at = np.where(some[row, trees["feature"][at]] <= trees["threshold"][at], trees["left"][at], trees["right"][at])
                value = worth[at]
                known = ~np.isnan(value)
                found[low:low + step] += np.stack([np.where(known, value, 0.0).sum(1), known.sum(1), trees["leaf"][at].sum(1)], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * len(x) + 1, 3, dtype=np.int32)), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(n) if n != "found" else lists for n in batch.schema.names], batch.schema.names)

    return add


def score(nodes: DataFrame, rows: DataFrame, features: Sequence[str], keep: Sequence[str] = (), kind: str = FOREST) -> DataFrame:
    """Kept columns and the score of each row, repeated rows included.

    A forest's score is the mean value of the leaves; a boosted ensemble's the logistic of twice their weighted sum. The trees go to the rows in
    parts of bounded size, and a row walks all trees of a part at once where it is: no copy of a row is made for a tree, and none moves.
    """
    if kind not in (FOREST, BOOSTING):
        raise ValueError("kind is 'forest' or 'boosting'")
    spark = rows.sparkSession
    nodes = materialize(nodes)
    rows = materialize(rows.select(*dict.fromkeys([*keep, *features])))
    # A missing value goes right as NaN does.
    values = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features])
    none = F.array(*[F.lit(0.0)] * 3)
    out = spread(rows.select(F.struct(*[F.col(c) for c in keep], F.lit(0).alias("_")).alias("_kept"), values.alias("_x"), none.alias("found")),
                 rows.count(), ROWS, per_core=3)
    for part in parts_of(nodes, PART_NODES)[0]:
        trees = _steps(nodes.where(F.col("tree").isin(part)).toPandas(), len(features))
        add = _summed(len(features), kind, spark.sparkContext.broadcast(trees))
        out = out.mapInArrow(add, out.schema)
    total, known, reached = (F.col("found")[i] for i in range(3))
    found = total / known if kind == FOREST else 1 / (1 + F.exp(-2 * total))
    return out.where(reached > 0).select(*[F.col("_kept")[c].alias(c) for c in keep], F.when(known > 0, found).alias("score"))


def measured(nodes: DataFrame, rows: DataFrame, features: Sequence[str], label: str, weight: str | None = None) -> DataFrame:
    """The same trees with cover, value and gain as these rows give them.

    ``value`` is the weighted share of ``label`` among the rows that reach a node (NULL where none does), ``gain`` the drop of the Gini impurity by its
    split. With rows the trees were not grown on, these are honest estimates.
    """
    nodes = materialize(nodes)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    ready = rows.select(*features, w.alias("_w"), (w * F.col(label).cast("double")).alias("_wy"))
    reached = walk(nodes, ready, features, ["_w", "_wy"]).select("tree", "_w", "_wy", F.explode("path").alias("node"))
    counts = reached.groupBy("tree", "node").agg(F.sum("_w").alias("cover"), F.sum("_wy").alias("_y"))
    share = F.col("_y") / F.col("cover")
    stats = materialize(nodes.drop("cover", "value", "gain").join(counts, ["tree", "node"], "left").withColumns({
        "cover": F.coalesce("cover", F.lit(0.0)), "value": share, "_impure": F.coalesce(2 * share * (1 - share), F.lit(0.0)) * F.coalesce("cover", F.lit(0.0))}))
    side = lambda name: stats.select("tree", F.col("node").alias(name), F.col("_impure").alias(f"_{name}"))
    both = stats.join(side("left"), ["tree", "left"], "left").join(side("right"), ["tree", "right"], "left")
    gain = F.when((F.col("left") >= 0) & (F.col("cover") > 0), (F.col("_impure") - F.col("_left") - F.col("_right")) / F.col("cover")).otherwise(0.0)
    return both.withColumn("gain", F.greatest(gain, F.lit(0.0))).select(*COLUMNS)


def importance(nodes: DataFrame, features: Sequence[str], kind: str = FOREST) -> DataFrame:
    """Share of each feature in the summed gains (gain times cover), highest first.

    In a forest every tree with a split counts the same; in a boosted ensemble its gains do. Features without a split have 0.
    """
    gains = nodes.where("left >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("cover")).alias("g"))
    if kind == FOREST:
        whole = gains.groupBy("tree").agg(F.sum("g").alias("all")).where("all > 0")
        gains = gains.join(whole, "tree").select("feature", (F.col("g") / F.col("all")).alias("g"))
    summed = gains.groupBy("feature").agg(F.sum("g").alias("g"))
    names = nodes.sparkSession.createDataFrame(list(enumerate(features)), "position int, feature string")
    out = names.join(summed.withColumnRenamed("feature", "position"), "position", "left").select("feature", F.coalesce("g", F.lit(0.0)).alias("g"))
    total = summed.agg(F.sum("g")).scalar()
    return out.select("feature", F.coalesce(F.try_divide(F.col("g"), total), F.lit(0.0)).alias("importance")).orderBy(F.col("importance").desc(), "feature")
