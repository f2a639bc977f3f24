"""Published results and hand-worked cases for the statistics."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestep.functions.stats import chi_square_tail, normal_cdf, tie_sums, two_sided_p
from lodestep.operators import cohorts as co
from lodestep.operators import experiments as ex

# Group counts and the test results published for them.
CHANNELS = [
    ("referral", 3053, 2792, 1714, 1121, 738), ("paid_social", 2402, 2048, 722, 281, 122), ("organic", 2080, 1820, 874, 445, 245),
    ("paid_search", 1484, 1305, 549, 276, 143), ("partnership", 981, 877, 465, 263, 146),
]
TESTS = [
    ("referral", "paid_social", 0.3672, 0.117, 0.2502, 20.9924, 0.0, 0.6038, True, True),
    ("referral", "organic", 0.3672, 0.2139, 0.1532, 11.7057, 0.0, 0.3402, True, True),
    ("referral", "paid_search", 0.3672, 0.186, 0.1812, 12.4037, 0.0, 0.4102, True, True),
    ("referral", "partnership", 0.3672, 0.2681, 0.0991, 5.6871, 0.0, 0.2134, True, True),
    ("paid_social", "organic", 0.117, 0.2139, -0.097, -8.7862, 0.0, 0.2636, True, True),
    ("paid_social", "paid_search", 0.117, 0.186, -0.069, -5.9636, 0.0, 0.1936, True, True),
    ("paid_social", "partnership", 0.117, 0.2681, -0.1511, -10.8562, 0.0, 0.3903, True, True),
    ("organic", "paid_search", 0.2139, 0.186, 0.028, 2.0482, 0.040539, 0.0699, True, False),
    ("organic", "partnership", 0.2139, 0.2681, -0.0542, -3.3157, 0.000914, 0.1268, True, True),
    ("paid_search", "partnership", 0.186, 0.2681, -0.0821, -4.8276, 0.000001, 0.1967, True, True),
]
COHORTS = [  # cohort and users at the seven stages, then the published activation percentage
    ("2024-01", 934, 837, 414, 331, 307, 252, 147, 27.0), ("2024-02", 882, 764, 364, 287, 257, 202, 127, 22.9),
    ("2024-03", 904, 813, 414, 305, 288, 224, 133, 24.8), ("2024-04", 906, 809, 399, 284, 270, 206, 124, 22.7),
    ("2024-05", 915, 821, 404, 303, 282, 228, 129, 24.9), ("2024-06", 900, 792, 360, 269, 248, 196, 102, 21.8),
    ("2024-07", 916, 812, 409, 306, 284, 216, 113, 23.6), ("2024-08", 931, 800, 397, 289, 261, 212, 121, 22.8),
    ("2024-09", 931, 831, 410, 314, 294, 237, 153, 25.5), ("2024-10", 887, 777, 391, 299, 278, 223, 126, 25.1),
    ("2024-11", 894, 786, 362, 270, 250, 190, 119, 21.3),
]


@pytest.fixture(scope="module")
def groups(spark):
    df = spark.createDataFrame(CHANNELS, "channel string, n_users long, n_verified long, n_kyc_approved long, n_activated long, n_week1 long")
    return df.withColumn("activation_of_registered", F.col("n_activated") / F.col("n_users")).cache()


def test_pairwise_tests_match_published(groups):
    got = {(r["group_a"], r["group_b"]): r for r in ex.pairwise_prop_test(groups).collect()}
    assert len(got) == 10
    for a, b, pa, pb, diff, z, p, h, raw, corrected in TESTS:
        r = got[a, b]
        assert (r["rate_a"], r["rate_b"], r["diff"], r["z_stat"], r["p_value"], r["cohen_h"], r["sig_raw"], r["sig_bonferroni"]) == (
            pa, pb, diff, z, p, h, raw, corrected)


def test_counts_and_largest_effect(groups):
    r = ex.test_counts(ex.pairwise_prop_test(groups)).first()
    assert (r["n_tests"], r["n_sig_raw"], r["n_sig_bonferroni"], r["max_h"], r["max_h_pair"]) == (10, 10, 9, 0.6038, "referral vs paid_social")


def test_display(groups):
    r = {(x["group_a"], x["group_b"]): x for x in ex.test_display(ex.pairwise_prop_test(groups)).collect()}
    assert r["organic", "paid_search"]["p_value"] == "0.0405"
    assert r["organic", "partnership"]["p_value"] == "9.14e-04"
    assert r["referral", "paid_social"]["rate_a_pct"] == 36.7


def test_chi_square(groups):
    r = ex.chi_square(groups).first()
    assert r["chi2"] == pytest.approx(512.7056, abs=1e-4)
    assert r["cramers_v"] == pytest.approx(0.10043, abs=1e-5)
    assert (r["dof"], r["strength"]) == (12, "moderate")
    assert r["p_value"] < 1e-90


def test_chi_square_ignores_row_order_and_floors_cells(spark, groups):
    assert ex.chi_square_statistic(groups.orderBy(F.rand(1))).first()["chi2"] == pytest.approx(512.7056, abs=1e-4)
    zero = spark.createDataFrame([("a", 0, 5), ("b", 3, 9)], "channel string, x long, y long")
    one = spark.createDataFrame([("a", 1, 5), ("b", 3, 9)], "channel string, x long, y long")
    stat = lambda df: ex.chi_square_statistic(df, "channel", ["x", "y"]).first()["chi2"]
    assert stat(zero) == stat(one)


def test_sample_size(groups):
    r = ex.sample_size(groups).first()
    assert (r["n_per_arm"], r["smallest_arm"], r["powered"]) == (6960, 981, False)


def test_power_curve_rises_and_reaches_target(groups):
    rows = ex.power_curve(groups, arms=[500, 6960]).where("n_per_arm = 6960").orderBy("mde").collect()
    powers = [r["power"] for r in rows]
    assert len(rows) == 200 and powers == sorted(powers)
    near = min(rows, key=lambda r: abs(r["mde"] - 0.02))
    assert near["power"] == pytest.approx(0.80, abs=0.02)


def test_p_value_matrix_is_symmetric(groups):
    cells = {(r["group_a"], r["group_b"]): r for r in ex.p_value_matrix(ex.pairwise_prop_test(groups)).collect()}
    assert len(cells) == 25
    assert all(cells[a, b]["p_value"] == cells[b, a]["p_value"] for a, b in cells)
    assert cells["organic", "organic"]["p_value"] is None
    assert cells["paid_search", "organic"]["mark"] == "*" and cells["organic", "referral"]["mark"] == "**"


def test_degenerate_z(spark):
    df = spark.createDataFrame([("a", 10, 0.0), ("b", 5, 0.0)], "channel string, n_users long, activation_of_registered double")
    r = ex.pairwise_prop_test(df).first()
    assert (r["z_stat"], r["p_value"]) == (0.0, 1.0)


def test_one_group_has_no_pairs(spark):
    df = spark.createDataFrame([("a", 10, 0.4)], "channel string, n_users long, activation_of_registered double")
    assert ex.pairwise_z(df).count() == 0


def test_cohort_rates_and_trend(spark):
    names = list(co.FUNNEL_COLUMNS.values())
    df = spark.createDataFrame([row[:8] for row in COHORTS], "cohort string, " + ", ".join(f"{n} long" for n in names))
    rates = co.cohort_rates(df)
    got = {r["cohort"]: r["activation_of_registered"] for r in rates.collect()}
    assert got == {row[0]: row[8] for row in COHORTS}
    line = co.trend(rates, "activation_of_registered", "cohort").first()
    assert round(line["slope_pp_per_period"], 2) == -0.17 and line["direction"] == "declining"
    head = co.cohort_headline(rates).first()
    assert (head["cohorts"], round(head["avg_activation"], 2), round(head["avg_week1_retention"], 2)) == (11, 23.85, 58.41)


def test_a_user_counts_in_every_cohort_of_theirs(spark):
    rows = [("a", "registration_start", "2024-01-05"), ("a", "registration_start", "2024-02-05"), ("a", "registration_start", "2024-02-09"),
            ("a", "first_transaction", "2023-12-01"), ("b", "registration_start", "2024-02-01"), ("c", "first_transaction", "2024-02-01")]
    events = spark.createDataFrame(rows, "user_id string, event_name string, t string").select("user_id", "event_name", F.to_timestamp("t").alias("event_time"))
    got = {r["cohort"]: (r["s1_registered"], r["s6_first_transaction"], r["s7_week1_active"]) for r in co.cohort_funnel(events).collect()}
    assert got == {"2024-01": (1, 1, 0), "2024-02": (2, 1, 0)}
    users = spark.createDataFrame([("a", "x"), ("c", "x")], "user_id string, channel string")
    assert {r["cohort"]: (r["registered"], r["activated"]) for r in co.channel_cohorts(users, events).collect()} == {"2024-01": (1, 1), "2024-02": (1, 1)}


def test_normal_tails(spark):
    df = spark.createDataFrame([(-3.1,), (0.0,), (1.96,), (8.0,), (None,)], "z double")
    rows = df.select("z", normal_cdf("z").alias("c"), two_sided_p("z").alias("p")).collect()
    for r in rows[:-1]:
        assert r["c"] == pytest.approx(NormalDist().cdf(r["z"]), abs=1e-12)
    assert rows[2]["p"] == pytest.approx(0.0499957902964409)
    assert rows[3]["p"] == pytest.approx(1.2441921148543568e-15)
    assert rows[-1]["c"] is None


def test_chi_square_tail_closed_forms(spark):
    df = spark.createDataFrame([(0.0, 2.0), (3.0, 2.0), (40.0, 2.0), (5.0, 4.0), (200.0, 4.0), (3.841458820694124, 1.0)], "x double, k double")
    got = [r[0] for r in df.select(chi_square_tail("x", "k")).collect()]
    four = lambda x: math.exp(-x / 2) * (1 + x / 2)
    want = [1.0, math.exp(-1.5), math.exp(-20), four(5), four(200), 0.05]
    assert got == pytest.approx(want, rel=1e-10)


def test_tie_sums_match_plain_sums():
    deaths, risk, tied = np.array([1.0, 2, 63, 64, 65, 5000]), np.array([3.0, 9, 100, 100, 400, 9000.5]), np.array([1.0, 4, 70, 100, 61, 4100.25])
    logs, inv, inv2 = tie_sums(deaths, risk, tied)
    for i, d in enumerate(deaths.astype(int)):
        u = risk[i] - np.arange(d) / d * tied[i]
        assert logs[i] == pytest.approx(np.log(u).sum(), rel=1e-10)
        assert inv[i] == pytest.approx((1 / u).sum(), rel=1e-10)
        assert inv2[i] == pytest.approx((1 / u**2).sum(), rel=1e-9)
