import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import StructType

from lodestep.operators import kmeans, segments as sg
from lodestep.session import materialize


def frame(spark, x, label=None):
    rows = [(i, Vectors.dense(p), int(0 if label is None else label[i])) for i, p in enumerate(x.tolist())]
    return spark.createDataFrame(rows, ["id", "features", "cluster"])


def brute(x, label):
    """Silhouettes by all distances."""
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i, own in enumerate(label):
        mates = (label == own).sum() - 1
        if not mates or len(set(label)) == 1:
            out.append(0.0)
            continue
        a = far[i, label == own].sum() / mates
        b = min(far[i, label == c].mean() for c in set(label) - {own})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.array(out)


@pytest.mark.parametrize("cells, width", [(8, 0.6), (64, 0.25), (1000, 1e-9)])
def test_silhouettes_lie_within_their_bounds(spark, cells, width):
    """Every point's exact score lies between its bounds; with a cell for each point they meet."""
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(c, 0.7, (120, 3)) for c in (0, 2, 5)] + [rng.normal(9, 0.1, (1, 3)), np.ones((40, 3))])
    label = np.array([0] * 120 + [1] * 120 + [2] * 120 + [7] + [0] * 40)
    table = kmeans.stored_points(frame(spark, x, label), "id", "cluster")
    rows = sorted(kmeans.silhouette(table, cells=cells).collect(), key=lambda r: r["id"])
    want = brute(x, label)
    low, mid, high = (np.array([r[c] for r in rows]) for c in ("silhouette_low", "silhouette", "silhouette_high"))
    assert len(rows) == len(x) and (low <= want + 1e-9).all() and (want <= high + 1e-9).all() and (low <= mid + 1e-12).all() and (mid <= high + 1e-12).all()
    assert (high - low).mean() < width and abs(mid.mean() - want.mean()) < width / 4 + 1e-9


def test_silhouette_of_one_cluster_and_of_nothing(spark):
    table = kmeans.stored_points(frame(spark, np.arange(6.0).reshape(3, 2)), "cluster")
    assert [r["silhouette"] for r in kmeans.silhouette(table).collect()] == [0, 0, 0]
    nothing = table.limit(0)
    assert kmeans.silhouette(nothing).count() == 0 and kmeans.fit(nothing, [2], 2)[2][1] == 0


def test_shared_scans_give_each_model_its_own_fit(spark):
    """Models fitted together are those fitted alone; centres are means of their points and no start is cheaper."""
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(c, 0.5, (80, 2)) for c in (0, 3, 7, 12)])
    table = kmeans.stored_points(frame(spark, x))
    both = kmeans.fit(table, [2, 4], 3)
    for k in (2, 4):
        centres, cost = both[k]
        alone, same = kmeans.fit(table, [k], 3)[k]
        assert np.allclose(centres, alone) and cost == pytest.approx(same)
        far = ((x[:, None] - centres[None]) ** 2).sum(-1)
        near = far.argmin(1)
        assert cost == pytest.approx(far.min(1).sum())
        assert all(np.allclose(centres[j], x[near == j].mean(0), atol=0.02) for j in range(k))
    assert sorted(both[4][0][:, 0].round().tolist()) == [0, 3, 7, 12]


def test_a_step_moves_centres_to_means_and_keeps_empty_ones(spark):
    x = np.array([[0.0], [1.0], [10.0]])
    table = kmeans.stored_points(frame(spark, x))
    (moved, n, cost), (other, m, _) = kmeans.step(table, [np.array([[0.0], [9.0], [99.0]]), np.array([[5.0]])])
    assert moved.tolist() == [[0.5], [10.0], [99.0]] and n.tolist() == [2, 1, 0] and cost == 2
    assert other.tolist() == [[11 / 3]] and m.tolist() == [3]


def test_fewer_points_than_clusters(spark):
    points = frame(spark, np.array([[1.0, 2.0]] * 5 + [[3.0, 4.0]]))
    assert len(kmeans.fit(kmeans.stored_points(points), [4], 2)[4][0]) == 2
    assert sg.cluster(points.drop("cluster"), 4, starts=2).select("cluster").distinct().count() == 2


def test_hot_points_weigh_in_the_draw(spark):
    x, weight = kmeans.drawn(kmeans.stored_points(frame(spark, np.array([[0.0]] * 50 + [[float(i)] for i in range(1, 9)]))), n=20)
    assert len(x) == 9 and weight.max() == 50


def test_points_in_one_file_are_dealt_to_tasks(spark, monkeypatch):
    """A step over a small file runs in several tasks with the same result, and distances do not depend on how many are computed at a time."""
    rng = np.random.default_rng(3)
    rows = [(i, Vectors.dense(p)) for i, p in enumerate(rng.normal(size=(300, 3)).tolist())] + [(300, None)]
    points = materialize(spark.createDataFrame(rows, StructType().add("i", "integer").add("features", VectorUDT())).repartition(1))
    whole = kmeans.stored_points(points, "i")
    monkeypatch.setattr(kmeans, "POINTS", 50)
    dealt = kmeans.stored_points(points, "i")
    assert whole.rdd.getNumPartitions() == 1 and dealt.rdd.getNumPartitions() > 1
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, whole.collect())) and dealt.count() == 300
    x, centres = rng.normal(size=(70, 3)), rng.normal(size=(9, 3))
    plain = sum(np.square(x[:, j, None] - centres[None, :, j]) for j in range(3))
    monkeypatch.setattr(kmeans, "_CACHED", 40)
    assert (kmeans._squared(x, centres) == plain).all() and (kmeans._squared(x[:0], centres).shape, kmeans._squared(x, centres[:0]).shape) == ((0, 9), (70, 0))
