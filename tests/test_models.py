"""Features, splits, score evaluation, attribution and segments."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestep.operators import attribution as at
from lodestep.operators import evaluation as ev
from lodestep.operators import features as ft
from lodestep.operators import models as md
from lodestep.operators import segments as sg
from lodestep.session import materialize
from lodestep.sources import mapping


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        a, b, c = rng.random(), rng.choice([0, 1]), rng.gauss(0, 1)
        y = int(rng.random() < 1 / (1 + math.exp(-(3 * a - 1.5 + b - 0.5 * c))))
        rows.append((f"u{i}", a, b, c, y))
    df = spark.createDataFrame(rows, "user_id string, a double, b int, c double, churned int")
    return ft.stratified_split(df, "churned").repartition(4).cache()


def test_split_is_stratified_reproducible_and_keeps_keys_together(spark, training):
    shares = {(r["churned"], r["is_test"]): r["count"] for r in training.groupBy("churned", "is_test").count().collect()}
    for y in (0, 1):
        n = shares[y, 0] + shares[y, 1]
        assert shares[y, 1] == math.floor(n * 0.2)
    again = ft.stratified_split(training.drop("is_test", "fold").repartition(3), "churned")
    same = again.join(training.select("user_id", F.col("is_test").alias("t"), F.col("fold").alias("f")), "user_id")
    assert same.where("is_test <> t OR fold <> f").count() == 0
    folds = [r["count"] for r in training.groupBy("churned", "fold").count().orderBy("churned", "fold").collect()]
    assert max(folds[:5]) - min(folds[:5]) <= 1 and max(folds[5:]) - min(folds[5:]) <= 1
    twice = ft.stratified_split(training.select("user_id", "churned").union(training.select("user_id", "churned")), "churned")
    assert twice.groupBy("user_id").agg(F.count_distinct("is_test").alias("n")).where("n > 1").count() == 0


def test_dummies_drop_the_alphabetically_first(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "channel string")
    coded, names = ft.dummies(df, ["channel"])
    assert names == ["channel_b", "channel_c"]
    assert sorted(tuple(r) for r in coded.collect()) == [(0, 0), (0, 0), (0, 1), (1, 0)]


def test_too_many_categories_are_refused(spark):
    with pytest.raises(ValueError):
        ft.categories(spark.range(1000).select(F.col("id").cast("string").alias("c")), "c")


def test_sparse_vectors_equal_the_dummies(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", None), (None, "x"), ("b", "y")], "channel string, region string")
    coded, names = ft.encoded(df.withColumn("id", F.monotonically_increasing_id()), ["channel", "region"])
    wide, columns = ft.dummies(df.withColumn("id", F.monotonically_increasing_id()), ["channel", "region"])
    place = {f"{c}_{r['value']}": r["position"] for c, table in names.items() for r in table.collect()}
    assert sorted(place) == sorted(columns) and sorted(place.values()) == list(range(len(columns)))
    want = {r["id"]: [r[c] for c in sorted(place, key=place.get)] for r in wide.collect()}
    assert {r["id"]: r["encoded"].toArray().tolist() for r in coded.collect()} == want


def test_thousands_of_categories_are_encoded(spark):
    df = spark.range(20_000).select("id", F.concat(F.lit("v"), F.lpad((F.col("id") % 5000).cast("string"), 5, "0")).alias("c"))
    coded, names = ft.encoded(df, ["c"])
    place = {r["value"]: r["position"] for r in names["c"].collect()}
    assert len(place) == 4999 and "v00000" not in place
    for r in coded.where("id % 997 = 0 OR id % 5000 = 0").collect():
        assert r["encoded"].size == 4999 and r["encoded"].indices.tolist() == ([place[r["c"]]] if r["c"] in place else [])


def test_cap_and_fill(spark):
    df = spark.createDataFrame([(float(i) if i else None, -1.0) for i in range(101)], "h_a double, h_b double")
    out = ft.cap_and_fill(df, ["h_a", "h_b"])
    assert out.agg(F.max("h_a")).first()[0] == pytest.approx(np.quantile(np.arange(1, 101), 0.99))
    assert out.where("h_a IS NULL").count() == 0 and out.agg(F.min("h_a")).first()[0] == 0.0
    # A column that lies below zero throughout is cut at its upper bound last, as in clip(lower, upper).
    assert out.select("h_b").distinct().collect()[0][0] == -1.0


def test_first_transaction_ties(spark):
    df = spark.createDataFrame([("u", "t2", "2024-01-01", 5.0), ("u", "t1", "2024-01-01", 7.0), ("u", "t0", "2024-01-02", 9.0), ("v", "t9", "2024-01-05", 1.0)],
                               "user_id string, txn_id string, d string, amount double")
    df = df.select("user_id", "txn_id", F.to_timestamp("d").alias("txn_time"), "amount", F.lit("transfer").alias("category"), F.lit("success").alias("status"))
    ids = lambda ties: sorted(r["txn_id"] for r in ft.first_transactions(df, ties).collect())
    assert ids("keep") == ["t1", "t2", "t9"] and ids("first") == ["t1", "t9"]


def plain_auc(rows):
    pairs = [(p, n) for p, y in rows if y for n, z in rows if not z]
    return sum((p > n) + (p == n) / 2 for p, n in pairs) / len(pairs)


@pytest.mark.parametrize("cuts", [None, [0.2, 0.55]])
def test_ranking_quality(spark, cuts):
    rng = random.Random(4)
    rows = [(rng.randrange(20) / 20, rng.choice([0, 1, 1])) for _ in range(200)]
    df = spark.createDataFrame(rows, "score double, label int")
    r = ev.ranking_quality(ev.curve_points(df, cuts=cuts)).first()
    assert r["roc_auc"] == pytest.approx(plain_auc(rows))
    total, ap = sum(y for _, y in rows), 0.0
    for s in sorted({s for s, _ in rows}, reverse=True):
        above = [y for v, y in rows if v >= s]
        ap += sum(y for v, y in rows if v == s) / total * sum(above) / len(above)
    assert r["average_precision"] == pytest.approx(ap)


def test_threshold_sweep_counts_equal_scores_as_positive(spark):
    df = spark.createDataFrame([(0.1, 0), (0.5, 1), (0.9, 1), (0.95, 0), (0.02, 1)], "score double, label int")
    sweep = ev.threshold_sweep(df, grid=(0.1, 0.9, 3)).orderBy("threshold").collect()
    assert [round(r["recall"], 6) for r in sweep] == [round(2 / 3, 6), round(2 / 3, 6), round(1 / 3, 6)]
    assert [round(r["precision"], 6) for r in sweep] == [0.5, round(2 / 3, 6), 0.5]
    assert ev.best_threshold(ev.threshold_sweep(df, grid=(0.1, 0.9, 3))).first()["threshold"] == pytest.approx(0.5)


def test_tiers_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.4,), (0.4001,), (0.65,), (1.0,)], "score double")
    assert [r["risk_tier"] for r in ev.risk_tiers(df).orderBy("score").collect()] == [None, "Low", "Medium", "Medium", "High"]


def test_logistic_regression_solves_the_weighted_penalised_problem(training):
    spec = md.ModelSpec("logistic", {"C": 0.5})
    model = md.train(spec, training, ["a", "b", "c"], "churned")
    pdf = training.select("a", "b", "c", "churned").toPandas()
    x = ((pdf[["a", "b", "c"]] - pdf[["a", "b", "c"]].mean()) / pdf[["a", "b", "c"]].std(ddof=0)).to_numpy()
    y = pdf["churned"].to_numpy()
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta = np.zeros(4)
    design = np.column_stack([np.ones(len(y)), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        ridge = np.diag([0, 1, 1, 1.0])
        gradient = 0.5 * design.T @ (w * (y - p)) - ridge @ beta
        beta += np.linalg.solve(0.5 * (design * (w * p * (1 - p))[:, None]).T @ design + ridge, gradient)
    mine = 1 / (1 + np.exp(-design @ beta))
    scores = md.score(model, training, ["user_id", "a", "c"]).toPandas().merge(pdf.assign(p=mine), on=["a", "c"])
    assert np.abs(scores["score"] - scores["p"]).max() < 1e-4


def test_model_comparison_and_cross_validation(training):
    specs = {"logistic_regression": md.ModelSpec("logistic", {"C": 0.5}),
             "random_forest": md.ModelSpec("forest", {"numTrees": 10, "maxDepth": 4, "minInstancesPerNode": 5}),
             "gradient_boosting": md.ModelSpec("boosting", {"maxIter": 3, "maxDepth": 2, "stepSize": 0.1}, balanced=False)}
    rows = md.compare(specs, training, ["a", "b", "c"], "churned").collect()
    assert {r["model"] for r in rows} == set(specs) and sum(r["best"] for r in rows) == 1 and rows[0]["best"]
    assert all(0.55 < r["test_auc"] <= 1 and 0.55 < r["cv_auc"] <= 1 and 0 < r["brier"] < 0.3 for r in rows)


def test_work_is_dealt_by_rows_not_by_bytes(spark, training, monkeypatch):
    """Training, scoring and attribution of a table in one small file use several tasks, and give what one task gives."""
    one = materialize(training.repartition(1))
    spec = md.ModelSpec("forest", {"numTrees": 5, "maxDepth": 3})
    model = md.train(spec, one, ["a", "b", "c"], "churned")
    whole, base = at.attributions(model, one, ["a", "b", "c"])
    scores = md.score(model, one, ["user_id"]).collect()
    monkeypatch.setitem(md.ROWS, "forest", 40)
    monkeypatch.setattr(at, "ROWS", 40)
    assert one.rdd.getNumPartitions() == 1
    dealt = md.build(spec, one, ["a", "b", "c"], "churned")[1]
    assert dealt.rdd.getNumPartitions() > 1 and dealt.count() == one.count()
    apart, again = at.attributions(model, one, ["a", "b", "c"])
    assert apart.rdd.getNumPartitions() > 1 and again == base
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, whole.collect()))
    assert sorted(md.score(model, one, ["user_id"]).collect()) == sorted(scores)


def test_comparison_gives_what_each_model_gives_alone(training):
    specs = {"forest": md.ModelSpec("forest", {"numTrees": 5, "maxDepth": 3}), "logistic": md.ModelSpec("logistic", {"C": 0.5})}
    rows = {r["model"]: r for r in md.compare(specs, training, ["a", "b", "c"], "churned").collect()}
    for name, spec in specs.items():
        mean, deviation = md.cross_validate(spec, training, ["a", "b", "c"], "churned")
        assert (rows[name]["cv_auc"], rows[name]["cv_std"]) == pytest.approx((mean, deviation))


def test_forests_that_fill_the_cores_take_turns(training, monkeypatch):
    """No more than FORESTS of them are fitted at a time, others beside them, and the result is that of all fits at once."""
    specs = {"forest": md.ModelSpec("forest", {"numTrees": 5, "maxDepth": 3}), "logistic": md.ModelSpec("logistic", {"C": 0.5})}
    whole = md.compare(specs, training, ["a", "b", "c"], "churned").collect()
    fit, now, most, kinds = md.train, [], [], []

    def watched(spec, *rest):
        now.append(spec.kind)
        most.append(now.count("forest"))
        kinds.append(spec.kind)
        try:
            return fit(spec, *rest)
        finally:
            now.remove(spec.kind)

    monkeypatch.setattr(md, "train", watched)
    monkeypatch.setattr(md, "spread", lambda df, *rest, **more: df)  # the layout decides which rows a forest draws
    monkeypatch.setitem(md.ROWS, "forest", 40)
    turns = md.compare(specs, training, ["a", "b", "c"], "churned").collect()
    assert max(most) <= md.FORESTS and sorted(kinds) == ["forest"] * 6 + ["logistic"] * 6
    numbers = lambda rows: [v for r in rows for v in r if not isinstance(v, str)]
    assert [r["model"] for r in turns] == [r["model"] for r in whole] and numbers(turns) == pytest.approx(numbers(whole))


def test_attributions_add_up_to_the_prediction(spark, training):
    names = ["a", "b", "c"]
    model = md.train(md.ModelSpec("forest", {"numTrees": 12, "maxDepth": 5, "minInstancesPerNode": 5}), training, names, "churned")
    explained, base = at.attributions(model, training, names)
    sums = explained.select("user_id", (F.aggregate("phi", F.lit(0.0), lambda s, v: s + v) + base).alias("p"))
    worst = sums.join(md.score(model, training, ["user_id"]), "user_id").agg(F.max(F.abs(F.col("p") - F.col("score")))).first()[0]
    assert worst < 1e-9
    table = at.mean_absolute(explained, names).collect()
    assert [r["feature"] for r in table][0] == "a" and len(table) == 3
    kept, _ = at.attributions(model, training, names, ["user_id", *names])
    points = at.sample_points(kept, names, ["a", "c"], size=50)
    assert points.count() == 100 and points.where("scaled_value < 0 OR scaled_value > 1").count() == 0


def test_repeated_feature_on_a_path_is_one_condition():
    nodes = pd.DataFrame([
        (0, 0, 1, 2, 0, 0.5, 10.0, 0.5), (0, 1, 3, 4, 0, 0.2, 6.0, 0.4), (0, 2, -1, -1, -1, None, 4.0, 1.0),
        (0, 3, -1, -1, -1, None, 2.0, 0.0), (0, 4, -1, -1, -1, None, 4.0, 0.6)],
        columns=["tree", "node", "left", "right", "feature", "threshold", "cover", "value"])
    groups, base = at.compiled(nodes)
    phi = at.row_attributions(np.array([[0.1], [0.3], [0.9]]), groups)
    assert phi[:, 0] + base == pytest.approx([0.0, 0.6, 1.0])


def test_segment_names(spark):
    rows = [(0, 10.0, 5.0, 100.0), (1, 90.0, 1.0, 5.0), (2, 20.0, 4.0, 50.0), (3, 30.0, 0.5, 10.0), (4, 25.0, 0.4, 8.0)]
    df = spark.createDataFrame(rows, "cluster int, recency_days double, frequency double, monetary double")
    named = {r["cluster"]: r["segment_name"] for r in sg.name_segments(df).collect()}
    assert named == {0: "Power Users", 2: "Power Users 2", 3: "Dormant", 1: "Dormant 2", 4: "At-Risk"}


def test_clusters_of_separated_points(spark):
    rng = random.Random(0)
    rows = [(f"u{i}", (i % 3) * 50 + rng.random(), (i % 3) * 20 + rng.random()) for i in range(90)]
    df = spark.createDataFrame(rows, "user_id string, recency_days double, frequency double")
    points = sg.clustering_input(df, ["recency_days", "frequency"])
    search = {r["k"]: r for r in sg.choose_k(points, range(2, 6), starts=2).collect()}
    assert search[3]["chosen"] and search[3]["silhouette"] > 0.95
    out = sg.cluster(points, 3, starts=2)
    assert out.groupBy("cluster").count().select("count").distinct().collect()[0][0] == 30
    parts, share = sg.principal_components(points)
    assert sum(share) == pytest.approx(1.0) and parts.count() == 90


def test_profile_grid_is_scaled(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0)], "segment_name string, x double, y double")
    rows = sg.scale_between(df, ["x", "y"], ["segment_name"]).orderBy("segment_name").collect()
    assert rows[0]["x"] == 0 and rows[1]["x"] == pytest.approx(1) and rows[0]["y"] == rows[1]["y"] == 0


def test_lifetime_features_leak_the_label(spark, sf):
    """The event count of the lifetime features holds the label's own event; activation features have no such column."""
    tables = mapping.journeys(spark, sf)
    assert "events_completed" in ft.lifetime_features(tables).columns
    assert "events_completed" not in ft.activation_features(tables).columns


def test_registered_comparison_fits_the_second_generation(monkeypatch):
    from lodestep.plans import models as plans

    monkeypatch.setattr(plans, "_prepared", lambda t: (t, ["a"]))
    monkeypatch.setattr(plans.md, "compare", lambda specs, *rest, **options: specs)
    assert plans.model_comparison(None) == md.SECOND_GENERATION
