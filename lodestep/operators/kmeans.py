"""K-means for several numbers of clusters and many starts in one pass, and the silhouette with plain distances.

A scan of the points updates every model that still moves; only sums per centre leave the executors.
The silhouette needs the mean distance of every point to every cluster. Each cluster is reduced to at most ``cells`` weighted cells, and the
mean distance to the members of a cell with mean m and mean squared spread v lies between d and sqrt(d^2 + v), where d is the distance to m
(Jensen's inequality both ways). So every point gets a score with certain bounds at a cost in proportion to the number of points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize, spread

#: Distinct points drawn by hash, with their weights, for start centres and cells.
DRAWN = 4096
#: Cells a cluster is reduced to. With no more distinct points than that, scores are exact.
CELLS = 256
_ROWS = 1024
#: Distances computed at a time, few enough for a core's cache.
_CACHED = 1 << 15
#: Points of a task: a step meets every start of every k, the silhouette every cell of every cluster.
POINTS = 2_000


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, coordinate by coordinate, so that equal points are at distance zero."""
    out = np.zeros((len(x), len(centres)))
    columns = np.ascontiguousarray(centres.T)
    step = max(1, _CACHED // max(1, len(centres)))
    held = np.empty((min(step, len(x)), len(centres)))
    for low in range(0, len(x), step):
        rows, sums = x[low:low + step], out[low:low + step]
        part = held[:len(rows)]
        for j in range(x.shape[1]):
            np.subtract(rows[:, j, None], columns[j], out=part)
            np.multiply(part, part, out=part)
            sums += part
    return out


def stored_points(points: DataFrame, *keep: str) -> DataFrame:
    """``features`` as an array x, written once and in files for as many tasks as the number of points asks for; points without features are left out."""
    some = points.where("features IS NOT NULL")
    return materialize(spread(some.select(vector_to_array("features").alias("x"), *keep), some.count(), POINTS))


def drawn(table: DataFrame, n: int = DRAWN, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Up to n distinct points, by hash and so the same ones in every run, and how often each stands in the table."""
    counts = table.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(n).collect()
    if not rows:
        return np.zeros((0, 0)), np.zeros(0)
    return np.array([r["x"] for r in rows], float), np.array([r["n"] for r in rows], float)


def seeded(x: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k start centres among weighted points, each drawn in proportion to its squared distance from those before (k-means++)."""
    rng = np.random.default_rng([seed, k])
    picked = [int(rng.choice(len(x), p=weight / weight.sum()))]
    far = _squared(x, x[picked])[:, 0]
    while len(picked) < min(k, len(x)):
        mass = weight * far
        picked.append(int(rng.choice(len(x), p=mass / mass.sum())))
        far = np.minimum(far, _squared(x, x[picked[-1:]])[:, 0])
    return x[picked]


def step(table: DataFrame, models: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """One scan for all models: for each its centres moved to the means of their points, the number of these, and the cost before the move.

    A point as near to several centres goes to the first; a centre without points stays.
    """
    centres = np.vstack(models)
    cuts = np.cumsum([0, *map(len, models)])
    wide = centres.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, total = np.zeros(len(centres)), np.zeros(len(centres)), np.zeros(centres.shape)
        for batch in batches:
            every = _matrix(batch.column(0))
            for low in range(0, len(every), _ROWS):
                x = every[low:low + _ROWS]
                far = _squared(x, centres)
                for a, b in zip(cuts[:-1], cuts[1:]):
                    near = a + far[:, a:b].argmin(axis=1)
                    n += np.bincount(near, minlength=len(centres))
                    cost += np.bincount(near, far[np.arange(len(x)), near], len(centres))
                    for j in range(wide):
                        total[:, j] += np.bincount(near, x[:, j], len(centres))
        columns = [pa.array(np.arange(len(centres)), pa.int32()), pa.array(n), pa.array(cost), *[pa.array(total[:, j]) for j in range(wide)]]
        yield pa.RecordBatch.from_arrays(columns, ["centre", "n", "cost", *[f"s{j}" for j in range(wide)]])

    names = ["n", "cost", *[f"s{j}" for j in range(wide)]]
    found = table.select("x").mapInArrow(sums, "centre int, " + ", ".join(f"{c} double" for c in names))
    rows = found.groupBy("centre").agg(*[F.sum(c).alias(c) for c in names]).collect()  # one row per centre
    n, cost, moved = np.zeros(len(centres)), np.zeros(len(centres)), centres.copy()
    for r in rows:
        n[r["centre"]], cost[r["centre"]] = r["n"], r["cost"]
        if r["n"]:
            moved[r["centre"]] = np.array([r[f"s{j}"] for j in range(wide)]) / r["n"]
    return [(moved[a:b], n[a:b], float(cost[a:b].sum())) for a, b in zip(cuts[:-1], cuts[1:])]


def fit(table: DataFrame, ks: Sequence[int], starts: int, seed: int = 42, iterations: int = 100, tolerance: float = 1e-4) -> dict[int, tuple[np.ndarray, float]]:
    """For each k the centres of the cheapest of several starts, and their cost.

    All models share the scans; one is done when its centres move by less than ``tolerance`` in squared distance. With fewer distinct points
    than k there are as many centres as points; an empty table has none.
    """
    x, weight = drawn(table, seed=seed)
    if not len(x):
        return {k: (x, 0.0) for k in ks}
    owner = [k for k in ks for _ in range(starts)]
    models = [seeded(x, weight, k, seed + i) for k in ks for i in range(starts)]
    moving = list(range(len(models)))
    for _ in range(iterations):
        if not moving:
            break
        still = []
        for i, (moved, _n, _cost) in zip(moving, step(table, [models[i] for i in moving])):
            if np.square(moved - models[i]).sum() > tolerance:
                still.append(i)
            models[i] = moved
        moving = still
    costs = [cost for _, _, cost in step(table, models)]
    best = {k: min((i for i, o in enumerate(owner) if o == k), key=lambda i: (costs[i], i)) for k in ks}
    return {k: (models[i], costs[i]) for k, i in best.items()}


def nearest(x, centres: np.ndarray):
    """Column with the number of the nearest centre of an array column."""

    @F.pandas_udf("int")
    def number(column):
        import pandas as pd

        rows = np.array(column.tolist(), float).reshape(len(column), -1)
        parts = [_squared(rows[i:i + _ROWS], centres).argmin(axis=1) for i in range(0, len(rows), _ROWS)]
        return pd.Series(np.concatenate(parts) if parts else [], dtype="int32")

    return number(x)


def cell_centres(table: DataFrame, cells: int = CELLS, seed: int = 42) -> np.ndarray:
    """Centres of the cells: all distinct points where there are no more than ``cells``, else k-means of the drawn ones."""
    x, weight = drawn(table, max(DRAWN, cells + 1), seed)
    if len(x) <= cells:
        return x
    centres = seeded(x, weight, cells, seed)
    for _ in range(10):
        near = _squared(x, centres).argmin(axis=1)
        n = np.bincount(near, weight, cells)
        for j in range(x.shape[1]):
            centres[n > 0, j] = (np.bincount(near, weight * x[:, j], cells) / np.maximum(n, 1e-300))[n > 0]
    return centres


def _coreset(table: DataFrame, by: str, centres: np.ndarray) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Clusters, and for each (cluster, cell): its cluster's place, points, mean and mean squared spread. At most ``cells`` rows a cluster."""
    wide = centres.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, label = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            if not len(label):
                continue
            near = np.concatenate([_squared(every[i:i + _ROWS], centres).argmin(axis=1) for i in range(0, len(every), _ROWS)])
            off = every - centres[near]  # measured from the centre, so that a cell of equal points has no spread
            pair, which = np.unique(np.stack([label, near]), axis=1, return_inverse=True)
            which = which.reshape(-1)
            columns = [pa.array(pair[0], pa.int32()), pa.array(pair[1], pa.int32()), pa.array(np.bincount(which).astype(float)),
                       pa.array(np.bincount(which, np.square(off).sum(axis=1))), *[pa.array(np.bincount(which, off[:, j])) for j in range(wide)]]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "cell", "n", "q", *[f"s{j}" for j in range(wide)]])

    names = ["n", "q", *[f"s{j}" for j in range(wide)]]
    found = table.select("x", F.col(by).cast("int").alias("cluster")).mapInArrow(sums, "cluster int, cell int, " + ", ".join(f"{c} double" for c in names))
    rows = found.groupBy("cluster", "cell").agg(*[F.sum(c).alias(c) for c in names]).orderBy("cluster", "cell").collect()
    clusters = sorted({r["cluster"] for r in rows})
    place = np.array([clusters.index(r["cluster"]) for r in rows], int)
    n = np.array([r["n"] for r in rows])
    shift = np.array([[r[f"s{j}"] for j in range(wide)] for r in rows]) / n[:, None]
    spread = np.maximum(0.0, np.array([r["q"] for r in rows]) / n - np.square(shift).sum(axis=1))
    return clusters, place, n, centres[[r["cell"] for r in rows]] + shift, spread


def silhouette(table: DataFrame, by: str = "cluster", cells: int = CELLS, seed: int = 42, centres: np.ndarray | None = None) -> DataFrame:
    """``table`` (x as from ``stored_points``, and a whole-numbered cluster) with silhouette, silhouette_low and silhouette_high for every point.

    Plain Euclidean distances. A point alone in its cluster, or without another cluster, scores 0. The exact score lies within
    the bounds; ``silhouette`` takes the middle of each mean distance. Clusters times cells bounds what is sent to the executors.
    """
    centres = cell_centres(table, cells, seed) if centres is None else centres
    shape = T.StructType(list(table.schema.fields))
    for name in ("silhouette", "silhouette_low", "silhouette_high"):
        shape = shape.add(name, "double")
    if not len(centres):
        return table.select("*", *[F.lit(0.0).alias(n) for n in ("silhouette", "silhouette_low", "silhouette_high")])
    clusters, place, weight, middle, spread = _coreset(table, by, centres)
    size = np.bincount(place, weight, len(clusters))
    share = np.zeros((len(place), len(clusters)))
    share[np.arange(len(place)), place] = weight
    number = {c: i for i, c in enumerate(clusters)}
    at, label_at = table.columns.index("x"), table.columns.index(by)

    def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        top = np.maximum(a, b)
        return np.where(top > 0, (b - a) / np.where(top > 0, top, 1.0), 0.0)

    def scores(x: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
        square = _squared(x, middle)
        line = np.arange(len(x))
        inner, outer = [], []
        for distance in (np.sqrt(square), np.sqrt(square + spread)):
            sums = distance @ share
            inner.append(sums[line, own] / np.maximum(size[own] - 1, 1))
            means = sums / size
            means[line, own] = np.inf
            outer.append(means.min(axis=1))
        some = (size[own] > 1) & np.isfinite(outer[0])
        (a0, a1), (b0, b1) = inner, [np.where(some, b, 0.0) for b in outer]
        return [np.where(some, s, 0.0) for s in (ratio((a0 + a1) / 2, (b0 + b1) / 2), ratio(a1, b0), ratio(a0, b1))]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = _matrix(batch.column(at))
            own = np.array([number[int(c)] for c in batch.column(label_at).to_pylist()], int)
            parts = [scores(every[i:i + _ROWS], own[i:i + _ROWS]) for i in range(0, len(every), _ROWS)]
            found = [np.concatenate(column) for column in zip(*parts)] if parts else [np.zeros(0)] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], shape.names)

    return table.mapInArrow(score, shape)
