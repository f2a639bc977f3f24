"""Survival operators against plain loops on small data, with slices forced."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestep.functions.stats import _upper_gamma_ratio
from lodestep.operators import cox
from lodestep.operators import survival as sv

ROWS = []
_rng = random.Random(5)
for _ in range(240):
    _x1, _x2 = _rng.random(), _rng.choice([0.0, 1.0])
    _t = min(round(_rng.expovariate(math.exp(0.8 * _x1 - 0.5 * _x2)), 1) + 0.1, 2.0)
    ROWS.append((_rng.choice(["a", "b", "c"]), _t, int(_rng.random() < 0.8), _x1, _x2))


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(ROWS, "g string, duration double, event int, x1 double, x2 double").repartition(4).cache()


def plain_curve(rows):
    s, var, out = 1.0, 0.0, {}
    for t in sorted({r[1] for r in rows}):
        n, d = sum(r[1] >= t for r in rows), sum(r[1] == t and r[2] for r in rows)
        s *= 1 - d / n
        var += d / (n * (n - d)) if d < n else 0
        out[t] = (d, n, s, var)
    return out


@pytest.mark.parametrize("cuts", [[], [0.3, 0.9, 1.4]])
def test_kaplan_meier(data, cuts):
    got = sv.kaplan_meier(data, ["g"], cuts=cuts).collect()
    for g in "abc":
        want = plain_curve([r for r in ROWS if r[0] == g])
        mine = {r["t"]: r for r in got if r["g"] == g}
        assert set(mine) == set(want)
        last = 1.0
        for t, (d, n, s, var) in sorted(want.items()):
            r = mine[t]
            assert (r["d"], r["n"]) == (d, n) and r["s"] == pytest.approx(s, abs=1e-12)
            assert 0 <= r["s_low"] <= r["s"] <= r["s_high"] <= 1 and r["s"] <= last
            last = r["s"]
            if 0 < s < 1:
                width = 1.959963984540054 * math.sqrt(var) / math.log(s)
                assert r["s_low"] == pytest.approx(s ** math.exp(-width)) and r["s_high"] == pytest.approx(s ** math.exp(width))


def test_all_die_ends_at_zero_and_median_is_first_time_at_half(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, 0), (4.0, 1)], "duration double, event int")
    curve = sv.kaplan_meier(df)
    assert [r["s"] for r in curve.orderBy("t").collect()] == pytest.approx([0.75, 0.5, 0.5, 0.0])
    assert sv.median_survival(curve).first()[0] == 2.0
    censored = spark.createDataFrame([(1.0, 1), (2.0, 0), (3.0, 0)], "duration double, event int")
    assert sv.median_survival(sv.kaplan_meier(censored)).first()[0] == math.inf


def test_survival_at_points(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, 0), (4.0, 1)], "duration double, event int")
    rows = {r["time_point"]: r for r in sv.survival_at(sv.kaplan_meier(df), [0.5, 1, 2.5, 9]).collect()}
    assert [rows[p]["s"] for p in (0.5, 1, 2.5, 9)] == pytest.approx([1, 0.75, 0.5, 0])
    assert rows[2.5]["cumulative_pct"] == pytest.approx(50)


def plain_log_rank(rows, groups):
    k = len(groups)
    rows = [r for r in rows if r[0] in groups]
    diff, cov = np.zeros(k), np.zeros((k, k))
    for t in sorted({r[1] for r in rows if r[2]}):
        n = np.array([sum(r[0] == g and r[1] >= t for r in rows) for g in groups], float)
        d = np.array([sum(r[0] == g and r[1] == t and r[2] for r in rows) for g in groups], float)
        total, deaths = n.sum(), d.sum()
        diff += d - deaths * n / total
        if total > 1:
            cov += deaths * (total - deaths) / (total - 1) * (np.diag(n / total) - np.outer(n, n) / total**2)
    z = diff[:-1]
    return float(z @ np.linalg.solve(cov[:-1, :-1], z))


@pytest.mark.parametrize("cuts", [None, [0.5, 1.2]])
def test_log_rank(data, cuts):
    r = sv.log_rank(data, "g", cuts=cuts).first()
    want = plain_log_rank(ROWS, ["a", "b", "c"])
    assert r["chi2"] == pytest.approx(want, rel=1e-9) and r["dof"] == 2
    assert r["p_value"] == pytest.approx(_upper_gamma_ratio(1.0, want / 2))
    pair = sv.pairwise_log_rank(data, "g", "a", "c").first()
    assert pair["chi2"] == pytest.approx(plain_log_rank(ROWS, ["a", "c"]), rel=1e-9)


def test_log_rank_needs_two_groups(data):
    with pytest.raises(ValueError):
        sv.log_rank(data.where("g = 'a'"), "g")


def plain_likelihood(beta, lam=0.0):
    t, e = np.array([r[1] for r in ROWS]), np.array([r[2] for r in ROWS])
    x = np.array([r[3:5] for r in ROWS])
    scale = x.std(axis=0, ddof=1)
    eta = x @ beta
    w = np.exp(eta)
    out = 0.0
    for time in np.unique(t[e == 1]):
        tied, risk = (t == time) & (e == 1), t >= time
        d = tied.sum()
        out += eta[tied].sum() - sum(math.log(w[risk].sum() - i / d * w[tied].sum()) for i in range(d))
    return out - 0.5 * lam * len(ROWS) * ((beta * scale) ** 2).sum()


@pytest.mark.parametrize("penalizer,cuts", [(0.0, None), (0.1, None), (0.1, [0.3, 0.5, 0.9])])
def test_cox_maximises_the_penalised_likelihood(data, penalizer, cuts):
    model = cox.fit(data, ["x1", "x2"], penalizer=penalizer, cuts=cuts)
    f = lambda b: plain_likelihood(np.array(b), penalizer)
    h, b = 1e-4, model.coefficients
    unit = np.eye(2)
    gradient = [(f(b + h * u) - f(b - h * u)) / (2 * h) for u in unit]
    assert gradient == pytest.approx([0, 0], abs=1e-3)
    curvature = np.array([[(f(b + h * (u + v)) - f(b + h * (u - v)) - f(b - h * (u - v)) + f(b - h * (u + v))) / (4 * h * h) for v in unit] for u in unit])
    assert model.covariance == pytest.approx(-np.linalg.inv(curvature), rel=1e-3)


def test_hazard_table(spark, data):
    rows = cox.hazard_ratios(spark, cox.fit(data, ["x1", "x2"])).collect()
    assert [r["HR"] for r in rows] == sorted((r["HR"] for r in rows), reverse=True)
    assert all(r["HR_lower"] < r["HR"] < r["HR_upper"] and 0 <= r["p_value"] <= 1 for r in rows)
    stars = {"***": 0.001, "**": 0.01, "*": 0.05, "": 1.1}
    assert all(r["p_value"] < stars[r["sig"]] for r in rows)


@pytest.mark.parametrize("cuts", [None, [0.4, 1.0]])
def test_concordance_equals_pair_count(spark, cuts):
    rng = random.Random(9)
    rows = [(r[1], r[2], float(rng.randrange(40))) for r in ROWS]
    c = d = ties = 0
    for i, (ti, ei, si) in enumerate(rows):
        for j, (tj, ej, sj) in enumerate(rows):
            if i != j and ei and (tj > ti or (tj == ti and not ej)):
                c, d, ties = c + (si > sj), d + (si < sj), ties + (si == sj)
    df = spark.createDataFrame(rows, "duration double, event int, score double")
    r = cox.concordance(df, F.col("score"), cuts=cuts).first()
    assert (r["concordant"], r["discordant"], r["tied"]) == (c, d, ties)
    assert r["c_index"] == pytest.approx((c + ties / 2) / (c + d + ties))


def test_durations_floor_cap_and_censoring(spark):
    users = spark.createDataFrame([(u, "x") for u in "abcd"], "user_id string, channel string")
    events = spark.createDataFrame(
        [("a", "registration_start", "2024-01-01 00:00:00"), ("a", "first_transaction", "2024-01-03 12:00:00"),
         ("b", "registration_start", "2024-01-05 00:00:00"), ("b", "first_transaction", "2024-01-04 00:00:00"),
         ("c", "registration_start", "2024-01-01 00:00:00"), ("d", "registration_start", "2023-01-01 00:00:00"),
         ("d", "first_transaction", "2024-01-11 00:00:00"),
         # Never registered, so this time does not move the end of the observation.
         ("e", "first_transaction", "2024-06-01 00:00:00")], "user_id string, event_name string, t string",
    ).select("user_id", "event_name", F.to_timestamp("t").alias("event_time"))
    got = {r["user_id"]: (r["duration"], r["event"]) for r in sv.durations(users, events).collect()}
    assert got == {"a": (2.5, 1), "b": (0.01, 1), "c": (10.0, 0), "d": (90.0, 1)}
    censored = {r["user_id"]: r["event"] for r in sv.durations(users, events, cap="censor").collect()}
    assert censored == {"a": 1, "b": 1, "c": 0, "d": 0}
    with pytest.raises(ValueError):
        sv.durations(users, events, cap="drop")


def _crowd(spark):
    """Rows of which a third share one time, with events and censored rows at it."""
    rng = random.Random(12)
    rows = [(5.0 if i % 3 == 0 else float(rng.randint(1, 40)), rng.choice([0, 1, 1]), rng.random(), rng.choice([0, 1])) for i in range(600)]
    return spark.createDataFrame(rows, "duration double, event int, a double, b int")


def test_crowded_times_are_dealt_to_several_buckets(spark):
    df = _crowd(spark)
    plain, dealt = cox.lay_out(df, ["a", "b"]), cox.lay_out(df, ["a", "b"], rows_per_time=20)
    assert not plain.crowded and dealt.crowded
    assert dealt.rows.where("t = 5").select("salt").distinct().count() >= 10
    beta = [0.3, -0.2]
    for x, y in zip(cox.derivatives(plain, beta), cox.derivatives(dealt, beta)):
        assert np.allclose(x, y)
    plain.close()
    dealt.close()
    whole, split = cox.fit(df, ["a", "b"]), cox.fit(df, ["a", "b"], rows_per_time=20)
    assert np.allclose(whole.coefficients, split.coefficients) and np.allclose(whole.covariance, split.covariance)


@pytest.mark.parametrize("rows_per_time", [1_000_000, 20])
def test_no_step_of_a_cox_fit_moves_rows(spark, rows_per_time):
    """Above the scan of the rows, nothing is exchanged before an aggregation has summed them."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    data = cox.lay_out(_crowd(spark), ["a", "b"], rows_per_time=rows_per_time)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        hazard = data.rows.select("t").distinct().selectExpr("t", "1D as A", "0D as own")
        for frame in (data.per_time([0.1, 0.2]), data.second_moments([0.1, 0.2], hazard)):
            plan = frame._jdf.queryExecution().executedPlan().toString().splitlines()
            scan = next(i for i, line in enumerate(plan) if "FileScan" in line and data.table in line)
            depth = re.search(r"\w", plan[scan]).start()
            above = []
            for line in reversed(plan[:scan]):
                if (start := re.search(r"\w", line).start()) < depth:
                    depth = start
                    above.append(line.strip(" :+-*()0123456789"))
            first = next(i for i, line in enumerate(above) if "HashAggregate" in line)
            assert not any("Exchange" in line for line in above[:first]), above
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        data.close()


def test_log_rank_with_groups_as_rows(spark, data):
    want = sv.log_rank_wide(data, "g", "duration", "event", ["a", "b", "c"]).first()
    for cuts in (None, [0.5, 1.0]):
        got = sv.log_rank_long(data, "g", cuts=cuts).first()
        assert got["chi2"] == pytest.approx(want["chi2"], rel=1e-9) and got["dof"] == 2 and got["p_value"] == pytest.approx(want["p_value"], rel=1e-6)


def test_log_rank_of_thousands_of_groups(spark):
    """Against the covariance formed in full."""
    rng = random.Random(7)
    k = 2500
    rows = [(f"g{rng.randrange(k)}", float(rng.randint(1, 30)), rng.choice([0, 1, 1])) for _ in range(12_000)]
    got = sv.log_rank(spark.createDataFrame(rows, "g string, duration double, event int"), "g").first()
    names = sorted({g for g, _, _ in rows})
    place = {g: i for i, g in enumerate(names)}
    g, t, e = (np.array(x) for x in zip(*[(place[a], b, c) for a, b, c in rows]))
    diff, cov = np.zeros(len(names)), np.zeros((len(names), len(names)))
    for at in np.unique(t):
        risk = np.bincount(g[t >= at], minlength=len(names)).astype(float)
        dead = np.bincount(g[(t == at) & (e == 1)], minlength=len(names)).astype(float)
        d, n = dead.sum(), risk.sum()
        diff += dead - d * risk / n
        c = d * (n - d) / (n - 1) if n > 1 else 0.0
        cov += c * (np.diag(risk / n) - np.outer(risk, risk) / n ** 2)
    want = diff[1:] @ np.linalg.lstsq(cov[1:, 1:], diff[1:], rcond=None)[0]
    assert got["dof"] == len(names) - 1 and got["chi2"] == pytest.approx(want, rel=1e-7)
