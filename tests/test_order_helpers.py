"""Running sums, quantiles and spread joins against plain forms, with slices and hot keys forced."""

import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from lodestep.operators import quantiles as qs
from lodestep.operators.quantiles import LINEAR, UPPER, quantiles
from lodestep.operators.running import order_cuts, running_sums
from lodestep.operators.spread import hot_keys, left_fan_out, spread_join


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(3)
    rows = {(rng.choice(["a", "b", None]), rng.randrange(500)): rng.randrange(-5, 50) for _ in range(1500)}
    return spark.createDataFrame([(g, x, v) for (g, x), v in rows.items()], "g string, x int, v long").repartition(5).cache()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("cuts", [[], [0.0, 100.0, 250.0, 499.0], [float(i) for i in range(0, 500, 7)]])
def test_running_sums_equal_one_window(numbers, descending, by, cuts):
    df = numbers if by else numbers.groupBy("x").agg(F.sum("v").alias("v"))
    got = running_sums(df, "x", {"run": "v"}, by, descending, totals={"whole": "v"}, cuts=cuts)
    key = F.col("x").desc() if descending else F.col("x")
    w = Window.partitionBy(*(by or [F.lit(1)]))
    want = df.select("*", F.sum("v").over(w.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
                     F.sum("v").over(w).alias("whole"))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_cuts_balance_slices(spark):
    df = spark.range(0, 40_000).select((F.col("id") * F.col("id")).alias("x"))
    cuts = order_cuts(df, "x", rows_per_slice=4000)
    assert len(cuts) == 9
    inside = np.histogram(np.arange(40_000.0) ** 2, bins=[-1, *cuts, 1e18])[0]
    assert inside.max() < 8000
    assert order_cuts(df, "x") == []


@pytest.mark.parametrize("descending", [False, True])
def test_many_slices_with_nan_and_null_equal_a_window(spark, descending):
    rng = random.Random(3)
    values = [None, float("nan"), float("inf"), float("-inf"), *rng.sample(range(-900, 900), 700)]
    df = spark.createDataFrame([(None if x is None else float(x), i % 7) for i, x in enumerate(values)], "x double, v long")
    cuts = order_cuts(df, "x", rows_per_slice=3)
    assert len(cuts) > 150
    got = running_sums(df, "x", {"run": "v"}, (), descending, totals={"whole": "v"}, cuts=cuts)
    w = Window.partitionBy(F.lit(1))
    key = F.col("x").desc() if descending else F.col("x")
    want = df.select("*", F.sum("v").over(w.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)).alias("run"), F.sum("v").over(w).alias("whole"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, running_sums(df, "x", {"run": "v"}, (), descending, totals={"whole": "v"}).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("cuts", [[], [10.0, 20.0, 21.0]])
def test_quantiles_match_numpy(spark, cuts):
    rng = random.Random(1)
    rows = [(rng.choice(["p", "q"]), rng.choice([None, 1.0, 2.5, rng.uniform(0, 40)])) for _ in range(401)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in quantiles(df, "v", {"m": (0.5, LINEAR), "p99": (0.99, LINEAR), "up": (0.5, UPPER)}, ["g"], cuts).collect()}
    for g in "pq":
        values = np.sort([v for k, v in rows if k == g and v is not None])
        assert got[g]["m"] == pytest.approx(np.median(values))
        assert got[g]["p99"] == pytest.approx(np.quantile(values, 0.99))
        assert got[g]["up"] == values[len(values) // 2]


def test_upper_median_of_even_count(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)] + [(None,)], "v double")
    assert quantiles(df, "v", {"up": (0.5, UPPER)}).first()["up"] == 3.0


@pytest.fixture(scope="module")
def skewed(spark):
    facts = [("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(3000)] + [(None, 9999)]
    lookup = [("hot", "H"), *[(f"k{i}", f"v{i}") for i in range(40)], ("idle", "none")]
    return spark.createDataFrame(facts, "k string, id long"), spark.createDataFrame(lookup, "k string, name string")


def test_hot_keys_are_few_and_found(skewed):
    found = [r["k"] for r in hot_keys(skewed[0], "k", 20).collect()]
    assert found == ["hot"]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_spread_join_equals_join(skewed, how):
    facts, lookup = skewed
    got = spread_join(facts, lookup, "k", "id", how, slices=20)
    want = facts.join(lookup, "k", how)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_spread_join_spreads_the_hot_key(skewed):
    facts, lookup = skewed
    salted = facts.where("k = 'hot'").select(F.pmod(F.xxhash64("id"), F.lit(20)).alias("s")).groupBy("s").count()
    assert salted.count() == 20 and salted.agg(F.max("count")).first()[0] < 100
    assert spread_join(facts, lookup, "k", "id").count() == facts.join(lookup, "k").count()


def test_left_fan_out_equals_left_join(skewed):
    facts, lookup = skewed
    got = left_fan_out(lookup, facts, "k", "id", slices=20)
    want = lookup.join(facts, "k", "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_few_values_are_written_and_ordered(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), (F.xxhash64("id") / 1e9).alias("v"))
    wanted = {"m": (0.5, LINEAR), "p99": (0.99, LINEAR)}
    inside = qs.bracketed(df, "v", wanted, ["g"]).where("v IS NOT NULL").agg(F.sum("n")).first()[0]
    assert 0 < inside < 0.02 * 200_000
    values = df.toPandas()
    for r in quantiles(df, "v", wanted, ["g"]).collect():
        mine = values[values["g"] == r["g"]]["v"]
        assert r["m"] == pytest.approx(mine.median(), rel=1e-12) and r["p99"] == pytest.approx(mine.quantile(0.99), rel=1e-12)


def test_ranks_outside_their_bracket_are_found(spark, monkeypatch):
    """With a bracket that misses, all values are ordered and the result is the same."""
    df = spark.range(5000).select((F.xxhash64("id") / 1e9).alias("v"))
    want = quantiles(df, "v", {"m": (0.3, LINEAR)}).first()["m"]
    real = qs.bracketed
    monkeypatch.setattr(qs, "bracketed", lambda d, v, w, by=(): real(d, v, {k: (0.9, kind) for k, (_, kind) in w.items()}, by))
    assert quantiles(df, "v", {"m": (0.3, LINEAR)}).first()["m"] == pytest.approx(want)
    assert want == pytest.approx(df.toPandas()["v"].quantile(0.3))


def test_quantiles_of_ties_null_groups_and_nothing(spark):
    rows = [(None, 1.0)] * 50 + [("a", 2.0)] * 900 + [("a", float(i)) for i in range(10)] + [("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in quantiles(df, "v", {"m": (0.5, LINEAR), "up": (0.5, UPPER), "lo": (0.0, LINEAR), "hi": (1.0, LINEAR)}, ["g"]).collect()}
    assert set(got) == {None, "a"} and tuple(got[None])[1:] == (1.0, 1.0, 1.0, 1.0) and tuple(got["a"])[1:] == (2.0, 2.0, 0.0, 9.0)
    assert quantiles(df.where("g = 'b'"), "v", {"m": (0.5, LINEAR)}).first()["m"] is None
