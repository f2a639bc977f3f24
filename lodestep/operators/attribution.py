"""Additive attributions of a tree ensemble, path-dependent, as a distributed scoring job.

Each leaf is a product of interval conditions, one per feature on its path. For a row, a condition holds or not (``one``), and without knowledge of
the feature it holds with the share of training weight that went that way (``zero``). The weight that a Shapley value gives to a set of known
features is a Beta integral, so the value of feature i at a leaf is

    value * (one_i - zero_i) * integral over t in (0, 1) of the product, over the other features j, of one_j * t + zero_j * (1 - t),

a polynomial in t that Gauss-Legendre quadrature with half as many points as the path has features integrates exactly. The products are shared
along paths: going down, a node has its parent's product times one factor; going up, it has the sum over its leaves, and each
edge adds its feature's share of that sum. The work is nodes times points for each row, for all rows of a batch and all nodes of a level at once.
Trees are sent to the executors in parts of bounded size, whose contributions add up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..session import spread
from .ensembles import node_table, parts_of

# Trees go to the executors in parts of at most this many nodes (or one tree).
PART_NODES = 500_000
# Trees are explained together up to so many nodes, for so many numbers (nodes x rows x points) at a time.
GROUP_NODES, AT_ONCE = 1_000, 1 << 18
# Rows of a task: under a forest of hundreds of trees a row costs milliseconds.
ROWS = 500
# A branch no training row took still has this share.
LEAST_SHARE = 1e-12


@dataclass
class Level:
    """The nodes of one depth of several trees, left children first, and what their edges do to a row.

    ``factors`` and ``shares`` have a row per node for each of three cases: the row fails the condition so far, meets only the one the path had
    on this feature before, or meets both.
    """

    parent: np.ndarray
    feature: np.ndarray
    bounds: np.ndarray
    factors: np.ndarray
    shares: np.ndarray
    inner: np.ndarray
    value: np.ndarray


def _levels(trees: list[dict], points: np.ndarray, weights: np.ndarray) -> tuple[list[Level], float, np.ndarray]:
    """Levels below the roots of some trees (a dict of columns each), their base value, and the roots' splits mark."""
    anywhere = (-np.inf, np.inf, 1.0)
    base = 0.0
    front = [(tree, int(np.flatnonzero(tree["node"] == 0)[0]), {}, 1.0) for tree in trees]
    place = [{int(n): i for i, n in enumerate(tree["node"])} for tree in trees]
    spots = {id(tree): spot for tree, spot in zip(trees, place)}
    base += sum(float(tree["value"][i]) for tree, i, _, _ in front if tree["left"][i] < 0)
    roots = np.array([tree["left"][i] >= 0 for tree, i, _, _ in front])
    levels = []
    while True:
        inner = [k for k, (tree, i, _, _) in enumerate(front) if tree["left"][i] >= 0]
        if not inner:
            return levels, base, roots
        below, parent, feature, bounds, zeros = [], [], [], [], []
        for side in ("left", "right"):
            for number, k in enumerate(inner):
                tree, i, path, reach = front[k]
                f, cut = int(tree["feature"][i]), float(tree["threshold"][i])
                low, high, zero = path.get(f, anywhere)
                child = spots[id(tree)][int(tree[side][i])]
                share = max(float(tree["cover"][child] / tree["cover"][i]) if tree["cover"][i] else 0.0, LEAST_SHARE)
                new = (low, min(high, cut), zero * share) if side == "left" else (max(low, cut), high, zero * share)
                below.append((tree, child, {**path, f: new}, reach * share))
                parent.append(k)
                feature.append(f)
                bounds.append((low, high, new[0], new[1]))
                zeros.append((zero, new[2]))
                if tree["left"][child] < 0:
                    base += float(tree["value"][child]) * reach * share
        zero = np.array(zeros)[:, :, None, None]
        one = np.array([[[0.0], [1.0], [1.0]], [[0.0], [0.0], [1.0]]])[None]  # before and now, in the three cases
        q = one * points + zero * (1 - points)
        part = (one - zero) / q
        values = np.array([float(tree["value"][i]) if tree["left"][i] < 0 else 0.0 for tree, i, _, _ in below])
        levels.append(Level(np.array(parent), np.array(feature), np.array(bounds), np.ascontiguousarray((q[:, 1] / q[:, 0])),
                            np.ascontiguousarray((part[:, 1] - part[:, 0]) * weights),
                            np.array([tree["left"][i] >= 0 for tree, i, _, _ in below]), values))
        front = below


def compiled(nodes: pd.DataFrame, trees: int | None = None) -> tuple[list[list[Level]], float]:
    """Groups of trees ready for :func:`row_attributions`, and the mean of the ensemble over its own training rows.

    Values are divided by the number of ``trees`` of the whole ensemble.
    """
    columns = ["node", "left", "right", "feature", "threshold", "cover", "value"]
    each = [{c: tree[c].to_numpy() for c in columns} for _, tree in nodes.groupby("tree")]
    trees = trees or len(each)
    each = [{**tree, "value": tree["value"] / trees} for tree in each]
    groups, room = [], 0
    for tree in each:
        if len(tree["node"]) > room:
            groups.append([])
            room = max(GROUP_NODES, len(tree["node"]))
        groups[-1].append(tree)
        room -= len(tree["node"])
    out, base = [], 0.0
    for group in groups:
        depth = max(_depth(tree) for tree in group)
        if depth == 0:
            base += sum(float(tree["value"][0]) for tree in group)
            continue
        points, weights = np.polynomial.legendre.leggauss((depth + 1) // 2)
        levels, part, _ = _levels(group, (points + 1) / 2, weights / 2)
        out.append(levels)
        base += part
    return out, base


def _depth(tree: dict) -> int:
    at = {int(n): i for i, n in enumerate(tree["node"])}
    front, depth = [0], 0
    while front := [int(tree[side][at[n]]) for n in front if tree["left"][at[n]] >= 0 for side in ("left", "right")]:
        depth += 1
    return depth


def row_attributions(x: np.ndarray, groups: Sequence[list[Level]]) -> np.ndarray:
    """Contributions (rows x features) of rows of feature values; NaN lies above every threshold."""
    phi = np.zeros(x.shape)
    x = np.where(np.isnan(x), np.inf, x)
    for levels in groups:
        step = max(1, AT_ONCE // (sum(len(level.parent) for level in levels) * levels[0].factors.shape[-1]))
        for first in range(0, len(x), step):
            rows = slice(first, first + step)
            phi[rows] += _explained(x[rows], levels)
    return phi


def _explained(x: np.ndarray, levels: list[Level]) -> np.ndarray:
    columns = np.ascontiguousarray(x.T)
    cases, products = [], []
    above = np.ones((int(levels[0].parent.max()) + 1, len(x), levels[0].factors.shape[-1]))
    for level in levels:
        cell, (low, high, new_low, new_high) = columns[level.feature], level.bounds.T[:, :, None]
        case = ((cell > low) & (cell <= high)).astype(np.intp) + ((cell > new_low) & (cell <= new_high))
        case += 3 * np.arange(len(case))[:, None]  # the row of the tables below, whose points are moved as one
        above = above[level.parent]
        above *= np.take(level.factors.reshape(-1, above.shape[-1]), case, axis=0)
        cases.append(case)
        products.append(above)
    phi = np.zeros((x.shape[1], len(x)))
    sums = None
    for level, case, product in zip(reversed(levels), reversed(cases), reversed(products)):
        product *= level.value[:, None, None]
        if sums is not None:
            product[level.inner] = sums
        total = product
        change = np.einsum("nrk,nrk->nr", total, np.take(level.shares.reshape(-1, total.shape[-1]), case, axis=0))
        phi += (np.arange(len(phi))[:, None] == level.feature) @ change
        half = len(total) // 2
        sums = total[:half] + total[half:]
    return phi.T


def attributions(model: PipelineModel, df: DataFrame, features: Sequence[str], keep: Sequence[str] = ("user_id",)) -> tuple[DataFrame, float]:
    """(kept columns, ``phi`` array in feature order) per row and the base value, for a fitted forest.

    The base plus a row's contributions is the forest's probability of class 1.
    """
    return explained(node_table(model, df.sparkSession), df, features, keep)


def explained(nodes: DataFrame, df: DataFrame, features: Sequence[str], keep: Sequence[str] = ("user_id",)) -> tuple[DataFrame, float]:
    """As :func:`attributions` for any node table of a forest (see ``ensembles``): base and contributions add up to its mean leaf value."""
    spark = df.sparkSession
    parts, trees = parts_of(nodes, PART_NODES)
    names, kept = list(features), list(keep)
    columns = list(dict.fromkeys([*kept, *names]))
    out = spread(df.select(*columns), df.count(), ROWS, per_core=3).select("*", F.array_repeat(F.lit(0.0), len(names)).alias("phi"))
    base = 0.0
    for part in parts:
        groups, mean = compiled(nodes.where(F.col("tree").isin(part)).toPandas(), trees)
        base += mean
        out = out.mapInPandas(_explain(names, spark.sparkContext.broadcast(groups)), out.schema)
    return out.select(*kept, "phi"), base


def _explain(names: list[str], sent):
    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            phi = row_attributions(batch[names].to_numpy(dtype=float), sent.value)
            yield batch.assign(phi=[a + b for a, b in zip(batch["phi"], phi)])

    return explain


def mean_absolute(explained: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature, highest first."""
    wide = explained.agg(*[F.avg(F.abs(F.element_at("phi", i + 1))).alias(f"_{i}") for i in range(len(features))])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_{i}").alias("mean_abs_contribution")) for i, f in enumerate(features)])
    return wide.select(F.explode(rows).alias("r")).select("r.*").orderBy(F.col("mean_abs_contribution").desc(), "feature")


def sample_points(explained: DataFrame, features: Sequence[str], top: Sequence[str], key: str = "user_id", size: int = 500,
                  seed: int = 42) -> DataFrame:
    """Contribution and min-max scaled value of the top features for a reproducible sample of rows.

    ``explained`` also keeps the feature columns.
    """
    sample = explained.orderBy(F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(str(seed))))).limit(size)
    position = {f: i + 1 for i, f in enumerate(features)}
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.element_at("phi", position[f]).alias("contribution"),
                              F.col(f).cast("double").alias("value")) for f in top])
    long = sample.select(key, F.explode(rows).alias("r")).select(key, "r.*")
    ends = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    return long.join(ends, "feature").select(
        key, "feature", "contribution", ((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1e-9)).alias("scaled_value"))
