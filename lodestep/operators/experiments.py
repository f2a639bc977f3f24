"""Experiment statistics on per-group counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import ladder, p_text
from ..functions.numeric import ratio
from ..functions.stats import chi_square_tail, normal_cdf, normal_quantile, two_sided_p
from ..functions.times import period
from .cohorts import best_and_worst
from .stages import reached, user_flags

STAGE_COUNTS = {"verification_submitted": "n_verified", "kyc_approved": "n_kyc_approved",
                "first_transaction": "n_activated", "week1_active": "n_week1"}


def group_metrics(users: DataFrame, events: DataFrame, by: str = "channel") -> DataFrame:
    """Users and stage counts per group; approval and activation per user, retention per activated."""
    flags = user_flags(users.select("user_id", by), events, list(STAGE_COUNTS))
    counts = flags.groupBy(by).agg(F.count(F.lit(1)).alias("n_users"),
                                   *[reached(s).alias(c) for s, c in STAGE_COUNTS.items()])
    return counts.select(
        "*", ratio(F.col("n_kyc_approved"), F.col("n_users")).alias("kyc_rate"),
        ratio(F.col("n_activated"), F.col("n_users")).alias("activation_of_registered"),
        ratio(F.col("n_week1"), F.col("n_activated")).alias("retention_rate"))


def z_two_proportions(n1: Column, p1: Column, n2: Column, p2: Column) -> Column:
    """Pooled two-proportion z; 0 where the standard error vanishes."""
    pooled = (n1 * p1 + n2 * p2) / (n1 + n2)
    se = F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2))
    return F.when(se < 1e-10, F.lit(0.0)).otherwise((p1 - p2) / se)


def cohen_h(p1: Column, p2: Column) -> Column:
    """Difference of two proportions on the arcsine scale."""
    return 2 * F.asin(F.sqrt(p1)) - 2 * F.asin(F.sqrt(p2))


def pairs(groups: DataFrame, group: str, n: str, rate: str) -> DataFrame:
    """Each unordered pair of groups once, larger group first.

    ``groups`` has one row per group. Every row lists the positions behind its own and
    the partner is found by an equi-join on the position.
    """
    order = Window.partitionBy(F.lit(1)).orderBy(F.col(n).desc(), F.col(group))
    k = groups.agg(F.count(F.lit(1))).scalar()
    a = groups.select(F.row_number().over(order).alias("i"), F.col(group).alias("group_a"), F.col(n).cast("double").alias("n_a"),
                      F.col(rate).alias("rate_a"))
    b = a.toDF("j", "group_b", "n_b", "rate_b")
    partners = F.when(F.col("i") < F.col("k"), F.sequence(F.col("i") + 1, F.col("k").cast("int"))).otherwise(F.array())
    return a.withColumn("k", k).withColumn("j", F.explode(partners)).drop("k").join(b, "j")


def pairwise_z(groups: DataFrame, group: str = "channel", n: str = "n_users",
               rate: str = "activation_of_registered") -> DataFrame:
    """z statistic and effect size of every pair of groups."""
    q = pairs(groups, group, n, rate)
    na, pa, nb, pb = (F.col(c) for c in ("n_a", "rate_a", "n_b", "rate_b"))
    return q.select(
        "group_a", "group_b", na.cast("long").alias("n_a"), nb.cast("long").alias("n_b"),
        F.bround(pa, 4).alias("rate_a"), F.bround(pb, 4).alias("rate_b"), F.bround(pa - pb, 4).alias("diff"),
        z_two_proportions(na, pa, nb, pb).alias("z"), F.bround(F.abs(cohen_h(pa, pb)), 4).alias("cohen_h"))


def pairwise_prop_test(groups: DataFrame, group: str = "channel", n: str = "n_users",
                       rate: str = "activation_of_registered", alpha: float = 0.05) -> DataFrame:
    """Two-proportion tests of all pairs with the Bonferroni decision on the rounded p-value."""
    tests = pairwise_z(groups, group, n, rate)
    k = groups.agg(F.count(F.lit(1))).scalar()
    p = F.when(F.col("z") == 0, F.lit(1.0)).otherwise(two_sided_p("z"))
    rounded = tests.select("*", F.bround(p, 6).alias("p_value"), (alpha / (k * (k - 1) / 2)).alias("bonferroni_alpha"))
    return rounded.select(
        "group_a", "group_b", "n_a", "n_b", "rate_a", "rate_b", "diff", F.bround("z", 4).alias("z_stat"), "p_value", "cohen_h",
        (F.col("p_value") < alpha).alias("sig_raw"), (F.col("p_value") < F.col("bonferroni_alpha")).alias("sig_bonferroni"))


def test_counts(tests: DataFrame) -> DataFrame:
    """Tests in all, significant before and after correction, and the largest effect with its pair."""
    pair = F.concat_ws(" vs ", "group_a", "group_b")
    top = F.min(F.struct((-F.col("cohen_h")).alias("minus_h"), pair.alias("pair")))
    return tests.agg(F.count(F.lit(1)).alias("n_tests"), F.count_if("sig_raw").alias("n_sig_raw"),
                     F.count_if("sig_bonferroni").alias("n_sig_bonferroni"), top.alias("top")).select(
        "n_tests", "n_sig_raw", "n_sig_bonferroni", (-F.col("top.minus_h")).alias("max_h"), F.col("top.pair").alias("max_h_pair"))


def test_display(tests: DataFrame) -> DataFrame:
    """Percent view of the test table."""
    return tests.select(
        "group_a", "group_b", F.bround(F.col("rate_a") * 100, 1).alias("rate_a_pct"), F.bround(F.col("rate_b") * 100, 1).alias("rate_b_pct"),
        F.bround(F.col("diff") * 100, 1).alias("diff_pp"), F.bround("cohen_h", 3).alias("cohen_h"), p_text(F.col("p_value")).alias("p_value"),
        F.col("sig_bonferroni").alias("significant"))


def chi_square_statistic(counts: DataFrame, group: str = "channel", columns: Sequence[str] = tuple(STAGE_COUNTS.values())) -> DataFrame:
    """Contingency statistic of groups by columns, its degrees of freedom and Cramer's V.

    Cells are floored at one. Margins come from windows over the small cell table.
    """
    cells = counts.unpivot([group], list(columns), "stage", "n").select(
        group, "stage", F.greatest(F.col("n").cast("double"), F.lit(1.0)).alias("o"))
    whole = cells.agg(F.sum("o")).scalar()
    expected = cells.select(
        group, "stage", "o", whole.alias("total"),
        (F.sum("o").over(Window.partitionBy(group)) * F.sum("o").over(Window.partitionBy("stage"))).alias("product"))
    e = F.col("product") / F.col("total")
    out = expected.agg(
        F.sum(F.pow(F.col("o") - e, 2) / e).alias("chi2"), F.count_distinct(group).alias("r"), F.count_distinct("stage").alias("c"),
        F.max("total").alias("total"))
    return out.select(
        "chi2", ((F.col("r") - 1) * (F.col("c") - 1)).alias("dof"),
        F.sqrt(F.col("chi2") / (F.col("total") * (F.least("r", "c") - 1))).alias("cramers_v"))


def chi_square(counts: DataFrame, group: str = "channel", columns: Sequence[str] = tuple(STAGE_COUNTS.values())) -> DataFrame:
    """The statistic with its p-value and the strength of the association in words."""
    return with_strength(chi_square_statistic(counts, group, columns)).withColumn(
        "p_value", chi_square_tail(F.col("chi2"), F.col("dof").cast("double")))


def with_strength(statistic: DataFrame) -> DataFrame:
    return statistic.withColumn("strength", ladder(F.col("cramers_v"), [(0.3, "strong"), (0.1, "moderate")], "weak", strict=True))


def sample_size(groups: DataFrame, rate: str = "activation_of_registered", n: str = "n_users", mde: float = 0.02,
                alpha: float = 0.05, power: float = 0.80) -> DataFrame:
    """Users needed per arm to see a lift of ``mde`` from the unweighted mean rate."""
    z = normal_quantile(1 - alpha / 2) + normal_quantile(power)
    base = groups.agg(F.avg(rate).alias("baseline"), F.min(n).alias("smallest_arm"))
    p = F.col("baseline")
    need = F.ceil(2 * p * (1 - p) * F.lit(z * z) / F.lit(mde * mde)).cast("long")
    return base.select(F.round("baseline", 6).alias("baseline"), need.alias("n_per_arm"), "smallest_arm",
                       (F.col("smallest_arm") >= need).alias("powered"))


def power_curve(groups: DataFrame, rate: str = "activation_of_registered", n: str = "n_users",
                arms: Sequence[int] = (500, 1000, 2000), low: float = 0.005, high: float = 0.08, steps: int = 200,
                alpha: float = 0.05) -> DataFrame:
    """Power by detectable lift and arm size, the smallest observed arm included."""
    z = normal_quantile(1 - alpha / 2)
    base = groups.agg(F.avg(rate).alias("p"), F.min(n).alias("smallest"))
    rows = base.select("p", F.explode(F.array(*[F.lit(float(a)) for a in arms], F.col("smallest").cast("double"))).alias("arm")).distinct()
    lift = rows.select("p", "arm", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("i")).select(
        "p", "arm", (F.lit(low) + F.col("i") * F.lit((high - low) / (steps - 1))).alias("mde"))
    se = F.sqrt(2 * F.col("p") * (1 - F.col("p")) / F.col("arm"))
    return lift.select(F.col("arm").cast("long").alias("n_per_arm"), F.round("mde", 8).alias("mde"),
                       (F.col("mde") / se - F.lit(z)).alias("z_power")).withColumn("power", normal_cdf("z_power"))


def p_value_matrix(tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Both orders of each pair and an empty diagonal, with significance marks."""
    mark = F.when(F.col("sig_bonferroni"), "**").when(F.col("p_value") < alpha, "*").otherwise("")
    half = tests.select("group_a", "group_b", "p_value", mark.alias("mark"))
    other = half.select(F.col("group_b").alias("group_a"), F.col("group_a").alias("group_b"), "p_value", "mark")
    both = half.unionByName(other)
    diagonal = both.select("group_a").distinct().select(
        "group_a", F.col("group_a").alias("group_b"), F.lit(None).cast("double").alias("p_value"), F.lit("").alias("mark"))
    return both.unionByName(diagonal)


def best_worst_gap(groups: DataFrame, group: str = "channel", rate: str = "activation_of_registered") -> DataFrame:
    """Best and worst group by rate and the distance in percentage points."""
    ends = best_and_worst(groups, group, rate)
    return ends.select("best", "worst", F.round((F.col("best_rate") - F.col("worst_rate")) * 100, 4).alias("gap_pp"))


def difference_intervals(groups: DataFrame, group: str = "channel", n: str = "n_users",
                         rate: str = "activation_of_registered", alpha: float = 0.05) -> DataFrame:
    """Unpooled confidence interval of each pairwise rate difference."""
    q = pairs(groups, group, n, rate)
    na, pa, nb, pb = (F.col(c) for c in ("n_a", "rate_a", "n_b", "rate_b"))
    half = F.sqrt(pa * (1 - pa) / na + pb * (1 - pb) / nb) * normal_quantile(1 - alpha / 2)
    return q.select("group_a", "group_b", F.round(pa - pb, 6).alias("diff"), F.round(pa - pb - half, 6).alias("low"),
                    F.round(pa - pb + half, 6).alias("high"))


def weekly_balance(users: DataFrame, by: str = "channel", min_arm: int = 100, tolerance: float = 0.05) -> DataFrame:
    """Users per week and group, their share, its distance from an even split, and whether both are in bounds."""
    counts = users.groupBy(period(F.col("created_at"), "week").alias("week"), by).agg(F.count(F.lit(1)).alias("n"))
    week = Window.partitionBy("week")
    share = F.col("n") / F.sum("n").over(week)
    even = 1 / F.count(F.lit(1)).over(week)
    return counts.select("week", by, "n", F.round(share, 6).alias("share"), F.round(share - even, 6).alias("imbalance"),
                         (F.col("n") >= min_arm).cast("int").alias("enough"),
                         (F.abs(share - even) <= tolerance).cast("int").alias("balanced"))
