"""Node tables: walks, measurements, importances and attributions against fitted models and plain Python."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestep.operators import attribution as at
from lodestep.operators import ensembles as en
from lodestep.operators import models as md

SHAPE = "tree int, node int, left int, right int, feature int, threshold double, cover double, value double, gain double, weight double"
NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(5)
    rows = []
    for i in range(500):
        a, b, c = rng.random(), rng.choice([0, 1, 2]), rng.gauss(0, 1)
        rows.append((f"u{i}", a, b, c, int(rng.random() < 1 / (1 + math.exp(-(4 * a - 2 + b - c))))))
    return spark.createDataFrame(rows, "user_id string, a double, b int, c double, churned int").repartition(3).cache()


@pytest.fixture(scope="module")
def forest(training):
    return md.train(md.ModelSpec("forest", {"numTrees": 15, "maxDepth": 6, "minInstancesPerNode": 4}), training, NAMES, "churned")


@pytest.fixture(scope="module")
def boosted(training):
    return md.train(md.ModelSpec("boosting", {"maxIter": 6, "maxDepth": 3, "stepSize": 0.3}, balanced=False), training, NAMES, "churned")


@pytest.mark.parametrize("kind", [en.FOREST, en.BOOSTING])
def test_scores_make_no_copy_of_a_row_for_a_tree(training, forest, boosted, kind, monkeypatch):
    """Rows walk the trees where they lie: no explode, join or grouping by row. The scores are those of the walk by joins."""
    nodes = en.node_table(forest if kind == en.FOREST else boosted, training.sparkSession)
    scored = en.score(nodes, training, NAMES, ["user_id"], kind)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Generate", "Join", "Aggregate"))
    leaves = nodes.where("left < 0").select("tree", F.col("node").alias("leaf"), "value", "weight")
    ends = en.walk(nodes, training, NAMES, ["user_id"]).join(leaves, ["tree", "leaf"]).groupBy("user_id")
    value = F.avg("value") if kind == en.FOREST else 1 / (1 + F.exp(-2 * F.sum(F.col("value") * F.col("weight"))))
    want = {r["user_id"]: r["w"] for r in ends.agg(value.alias("w")).collect()}
    monkeypatch.setattr(en, "PART_NODES", 60)
    for found in (scored, en.score(nodes, training, NAMES, ["user_id"], kind)):
        got = {r["user_id"]: r["score"] for r in found.collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


@pytest.mark.parametrize("kind", [en.FOREST, en.BOOSTING])
def test_walk_gives_the_fitted_probabilities(spark, training, forest, boosted, kind):
    model = forest if kind == en.FOREST else boosted
    nodes = en.node_table(model, spark)
    fitted = md.score(model, training.unionByName(training), ["user_id", *NAMES]).withColumnRenamed("score", "fitted")
    rows = en.score(nodes, fitted, NAMES, ["user_id", "fitted"], kind).collect()
    assert len(rows) == 1000  # repeated rows each have their score
    assert max(abs(r["score"] - r["fitted"]) for r in rows) < 1e-9


def test_walk_without_broadcast_is_the_same(spark, training, forest):
    nodes = en.node_table(forest, spark)
    want = sorted(map(tuple, en.score(nodes, training, NAMES, ["user_id"]).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = sorted(map(tuple, en.score(nodes, training, NAMES, ["user_id"]).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want])


def test_small_tables_are_walked_in_one_stage(spark, training, forest):
    nodes = en.node_table(forest, spark)
    plan = en.walk(nodes, training, NAMES, ["user_id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("kind", [en.FOREST, en.BOOSTING])
def test_importance_from_stored_gains(spark, forest, boosted, kind):
    model = forest if kind == en.FOREST else boosted
    fitted = dict(zip(NAMES, model.stages[-1].featureImportances.toArray()))
    got = {r["feature"]: r["importance"] for r in en.importance(en.node_table(model, spark), NAMES, kind).collect()}
    assert got == pytest.approx(fitted)


def test_measured_on_the_same_rows_gives_the_grown_tree(spark, training):
    """A single unweighted tree on all rows: covers, values and gains can be measured again."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    tree = RandomForestClassifier(labelCol="churned", numTrees=1, maxDepth=4, featureSubsetStrategy="all", bootstrap=False, seed=1)
    model = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), tree]).fit(training)
    nodes = en.node_table(model, spark)
    got = {r["node"]: r for r in en.measured(nodes, training, NAMES, "churned").collect()}
    for r in nodes.collect():
        assert got[r["node"]]["cover"] == r["cover"] and got[r["node"]]["value"] == pytest.approx(r["value"])
        assert got[r["node"]]["gain"] == pytest.approx(r["gain"], abs=1e-9)


def test_missing_values_unreached_nodes_and_stumps(spark):
    nodes = spark.createDataFrame([(0, 0, 1, 2, 0, 0.5, 0.0, 0.0, 0.0, 1.0), (0, 1, -1, -1, None, None, 0.0, 0.2, 0.0, 1.0),
                                   (0, 2, 3, 4, 0, 9.0, 0.0, 0.0, 0.0, 1.0), (0, 3, -1, -1, None, None, 0.0, 0.4, 0.0, 1.0),
                                   (0, 4, -1, -1, None, None, 0.0, 0.8, 0.0, 1.0), (1, 0, -1, -1, None, None, 0.0, 0.6, 0.0, 1.0)], SHAPE)
    rows = spark.createDataFrame([(1, 0.5, 1), (2, 0.51, 0), (3, None, 1), (4, float("nan"), 1)], "id int, x double, y int")
    got = {r["id"]: r["score"] for r in en.score(nodes, rows, ["x"], ["id"]).collect()}
    assert got == pytest.approx({1: 0.4, 2: 0.5, 3: 0.7, 4: 0.7})
    stats = {(r["tree"], r["node"]): r for r in en.measured(nodes, rows.where("id = 1"), ["x"], "y").collect()}
    assert stats[0, 1]["cover"] == 1 and stats[0, 2]["cover"] == 0 and stats[0, 2]["value"] is None and stats[0, 0]["gain"] == 0
    assert en.height(nodes) == 2
    assert [r["importance"] for r in en.importance(nodes, ["x"]).collect()] == [0.0]
    assert en.score(nodes, rows.limit(0), ["x"], ["id"]).collect() == []


def random_tree(rng, features, depth, number):
    """A tree with repeated features on its paths, and covers that add up."""
    rows = []

    def grow(node, level, cover):
        if level == depth or rng.random() < 0.15 and level:
            rows.append((number, node, -1, -1, -1, None, cover, rng.random()))
            return
        left = rng.uniform(0.05, 0.95) * cover
        rows.append((number, node, 2 * node + 1, 2 * node + 2, rng.randrange(features), rng.random(), cover, 0.0))
        grow(2 * node + 1, level + 1, left)
        grow(2 * node + 2, level + 1, cover - left)

    grow(0, 0, 100.0)
    return pd.DataFrame(rows, columns=["tree", "node", "left", "right", "feature", "threshold", "cover", "value"])


def expected(tree, x, known):
    """Score of a row of which only the features in ``known`` are seen."""
    at_node = tree.set_index("node").to_dict("index")

    def down(n):
        node = at_node[n]
        if node["left"] < 0:
            return node["value"]
        f = node["feature"]
        if f in known:
            return down(node["left"] if x[f] <= node["threshold"] else node["right"])
        left, right = at_node[node["left"]]["cover"], at_node[node["right"]]["cover"]
        return (left * down(node["left"]) + right * down(node["right"])) / node["cover"]

    return down(0)


def shapley(trees, x):
    d = len(x)
    phi = np.zeros(d)
    for i in range(d):
        others = [j for j in range(d) if j != i]
        for k in range(d):
            for s in itertools.combinations(others, k):
                weight = math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d)
                phi[i] += weight * sum(expected(t, x, {*s, i}) - expected(t, x, set(s)) for t in trees) / len(trees)
    return phi


@pytest.mark.parametrize("depth, features", [(1, 2), (2, 3), (3, 4), (5, 4), (6, 5)])
def test_attributions_equal_the_shapley_sum(depth, features):
    rng = random.Random(depth)
    trees = [random_tree(rng, features, depth, k) for k in range(3)]
    groups, base = at.compiled(pd.concat(trees))
    x = np.array([[rng.random() for _ in range(features)] for _ in range(12)])
    x[0, 0] = np.nan
    want = np.array([shapley(trees, row) for row in x])
    assert np.abs(at.row_attributions(x, groups) - want).max() < 1e-10
    assert base == pytest.approx(sum(expected(t, x[0], set()) for t in trees) / 3)


def test_groups_and_stretches_do_not_matter(monkeypatch):
    rng = random.Random(9)
    trees = pd.concat([random_tree(rng, 4, 5, k) for k in range(6)])
    x = np.array([[rng.random() for _ in range(4)] for _ in range(40)])
    whole = at.row_attributions(x, at.compiled(trees)[0])
    monkeypatch.setattr(at, "GROUP_NODES", 1)
    monkeypatch.setattr(at, "AT_ONCE", 50)
    assert np.allclose(at.row_attributions(x, at.compiled(trees)[0]), whole)


def test_deep_trees_cost_no_more_than_their_nodes():
    """A path of 30 features has 2**30 patterns; here it is 60 nodes and 15 points."""
    rows = []
    for k in range(30):
        rows += [(0, 2 * k, 2 * k + 1, 2 * k + 2, k, 0.5, 2.0 ** (30 - k), 0.0), (0, 2 * k + 1, -1, -1, -1, None, 2.0 ** (29 - k), k / 30)]
    rows.append((0, 60, -1, -1, -1, None, 1.0, 1.0))
    tree = pd.DataFrame(rows, columns=["tree", "node", "left", "right", "feature", "threshold", "cover", "value"])
    groups, base = at.compiled(tree)
    x = np.random.default_rng(1).random((50, 30))
    phi = at.row_attributions(x, groups)
    assert np.allclose(phi.sum(1) + base, [expected(tree, row, set(range(30))) for row in x])


def test_parts_add_up(spark, training, forest, monkeypatch):
    monkeypatch.setattr(at, "PART_NODES", 50)
    found, base = at.attributions(forest, training, NAMES)
    scores = md.score(forest, training, ["user_id"])
    sums = found.select("user_id", (F.aggregate("phi", F.lit(0.0), lambda s, v: s + v) + base).alias("p")).join(scores, "user_id")
    assert sums.agg(F.max(F.abs(F.col("p") - F.col("score")))).first()[0] < 1e-9
