"""Time to event: durations, Kaplan-Meier curves, log-rank tests."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from ..functions.numeric import clip
from ..functions.stats import chi_square_tail, normal_quantile
from ..functions.times import hours_between
from ..session import materialize
from ..sources.tables import Tables
from .features import MAX_CATEGORIES
from .metrics import turnaround_hours
from .quantiles import LINEAR, quantiles
from .running import order_cuts, running_sums
from .spread import left_fan_out
from .stages import stage_times

LOG_UNITS = 1e15
SLACK = 1e-12
UNIT_HOURS = {"hours": 1.0, "days": 24.0}


def durations(users: DataFrame, events: DataFrame, start: str = "registration_start", goal: str = "first_transaction",
              unit: str = "days", floor: float = 0.01, limit: float = 90.0, cap: str = "keep") -> DataFrame:
    """One row per user and start event with (duration, event); users without the goal are censored.

    The clock of the censored stops at the last goal time of these users. Durations above ``limit``
    are cut to it; ``cap="keep"`` leaves the event flag, ``cap="censor"`` clears it.
    """
    starts = events.where(F.col("event_name") == start).select("user_id", F.col("event_time").alias("t_start")).distinct()
    goals = stage_times(events, [goal]).withColumnRenamed(f"t_{goal}", "t_goal")
    rows = starts.join(goals, "user_id", "left").join(users, "user_id")
    ends = rows.agg(F.max("t_goal")).scalar()
    raw = hours_between(F.coalesce(F.col("t_goal"), ends), F.col("t_start")) / UNIT_HOURS[unit]
    happened = F.col("t_goal").isNotNull()
    if cap == "censor":
        happened = happened & (F.greatest(raw, F.lit(floor)) <= limit)
    elif cap != "keep":
        raise ValueError("cap is 'keep' or 'censor'")
    return rows.select(
        "user_id", *[c for c in users.columns if c != "user_id"], "t_start",
        clip(clip(raw, lower=floor), upper=limit).alias("duration"), happened.cast("int").alias("event"))


def with_kyc(dataset: DataFrame, kyc: DataFrame) -> DataFrame:
    """Add kyc_had_failure and kyc_turnaround_h; distinct case outcomes of a user each give a row."""
    cases = kyc.select("user_id", turnaround_hours().alias("kyc_turnaround_h"),
                       F.col("failure_reason").isNotNull().cast("int").alias("kyc_had_failure")).distinct()
    joined = left_fan_out(dataset, cases, "user_id", "kyc_turnaround_h")
    return joined.fillna({"kyc_turnaround_h": 0.0, "kyc_had_failure": 0})


def survival_dataset(tables: Tables, **options) -> DataFrame:
    return with_kyc(durations(tables.users, tables.events, **options), tables.kyc)


def dataset_summary(dataset: DataFrame) -> DataFrame:
    """Users, events, censored and the median duration of the events."""
    event = F.col("event") == 1
    middle = quantiles(dataset.where(event), "duration", {"m": (0.5, LINEAR)}).scalar()
    return dataset.agg(F.count(F.lit(1)).alias("n"), F.count_if(event).alias("events"), F.count_if(~event).alias("censored"),
                       F.round(F.avg("event") * 100, 4).alias("event_pct")).withColumn("median_event_duration", F.round(middle, 4))


def life_table(dataset: DataFrame, by: Sequence[str] = (), time: str = "duration", event: str = "event") -> DataFrame:
    """Events ``d`` and exits ``m`` per distinct time; ties collapse before any ordering."""
    return dataset.groupBy(*by, F.col(time).alias("t")).agg(
        F.sum(event).cast("long").alias("d"), F.count(F.lit(1)).alias("m"))


def kaplan_meier(dataset: DataFrame, by: Sequence[str] = (), time: str = "duration", event: str = "event",
                 alpha: float = 0.05, cuts=None) -> DataFrame:
    """Survival curve per group with a log-log confidence band.

    Rows: group, t, d (events), n (at risk), s, s_low, s_high. The at-risk count is a
    running sum from the end, survival a running sum of logs from the start. Once the
    last subject at risk has the event, survival is 0 from there on. Logs are added as whole
    numbers of ``1 / LOG_UNITS``: such sums do not depend on the order of addition, so the
    curve never rises by a rounding error and repeats exactly. Their total stays within
    the log of the number of subjects.
    """
    table = materialize(life_table(dataset, by, time, event))
    cuts = order_cuts(table, "t") if cuts is None else cuts
    at_risk = running_sums(table, "t", {"n": "m"}, by, descending=True, cuts=cuts, stored=True)
    d, n = F.col("d"), F.col("n")
    steps = at_risk.select(
        *by, "t", "d", "n",
        F.when(d < n, F.round(F.log1p(-d / n) * LOG_UNITS)).otherwise(0.0).cast("long").alias("_log"), (d == n).cast("int").alias("_end"),
        F.when(d < n, d / (n * (n - d))).otherwise(0.0).alias("_var"))
    curve = running_sums(steps, "t", {"_logs": "_log", "_ended": "_end", "_vars": "_var"}, by, cuts=cuts)
    s = F.when(F.col("_ended") > 0, F.lit(0.0)).otherwise(F.exp(F.col("_logs") / LOG_UNITS))
    out = curve.select(*by, "t", "d", "n", s.alias("s"), "_vars")
    width = F.lit(normal_quantile(1 - alpha / 2)) * F.sqrt("_vars") / F.log("s")
    inside = (F.col("s") > 0) & (F.col("s") < 1)
    band = lambda sign: F.when(inside, F.pow(F.col("s"), F.exp(sign * width))).otherwise(F.col("s"))
    return out.select(*by, "t", "d", "n", "s", band(-1).alias("s_low"), band(1).alias("s_high"))


def median_survival(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First time at which survival is at most one half; infinity when it never is.

    The slack covers the rounding of the summed logs, far below the step of one subject.
    """
    grouped = curve.groupBy(*by) if by else curve
    first = F.min(F.when(F.col("s") <= 0.5 + SLACK, F.col("t")))
    return grouped.agg(F.coalesce(first, F.lit(float("inf"))).alias("median_survival"))


def survival_at(curve: DataFrame, points: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Survival and cumulative event percentage at fixed times: the last step at or before each.

    All points come from one aggregation. Survival only falls, so the smallest value at
    or before a point is the last one; before the first step it is 1.
    """
    rows = [F.struct(F.lit(float(p)).alias("time_point"),
                     F.coalesce(F.min(F.when(F.col("t") <= p, F.col("s"))), F.lit(1.0)).alias("s")) for p in points]
    grouped = curve.groupBy(*by) if by else curve
    wide = grouped.agg(F.array(*rows).alias("rows"))
    return wide.select(*by, F.explode("rows").alias("r")).select(
        *by, "r.time_point", F.col("r.s").alias("s"), ((1 - F.col("r.s")) * 100).alias("cumulative_pct"))


def fastest_and_slowest(curve: DataFrame, point: float, by: str) -> DataFrame:
    """Groups with the highest and lowest cumulative share at ``point``; the first name wins ties."""
    at = survival_at(curve, [point], [by])
    return at.agg(F.min(F.struct("s", by)).alias("f"), F.min(F.struct((-F.col("s")).alias("minus_s"), by)).alias("w")).select(
        F.col(f"f.{by}").alias("fastest"), F.round((1 - F.col("f.s")) * 100, 4).alias("fastest_pct"),
        F.col(f"w.{by}").alias("slowest"), F.round((1 + F.col("w.minus_s")) * 100, 4).alias("slowest_pct"))


def _log_rank_statistic(k: int):
    """Quadratic form of k - 1 observed-minus-expected counts over their covariance."""
    def solve(diff: pd.Series, covariance: pd.Series) -> pd.Series:
        out = []
        for d, v in zip(diff, covariance):
            m = np.asarray(v, dtype=float).reshape(k, k)[: k - 1, : k - 1]
            z = np.asarray(d, dtype=float)[: k - 1]
            out.append(float(z @ np.linalg.pinv(m) @ z))
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(solve, DoubleType())


def log_rank(dataset: DataFrame, group: str, time: str = "duration", event: str = "event",
             groups: Sequence[str] | None = None, cuts=None) -> DataFrame:
    """k-sample log-rank statistic, degrees of freedom and p-value, for any number of groups.

    Up to MAX_CATEGORIES groups are columns of one pass, with a k x k covariance; more take :func:`log_rank_long`.
    """
    if groups is None:
        some = dataset.where(F.col(group).isNotNull()).select(group).distinct().limit(MAX_CATEGORIES + 1).collect()
        if len(some) > MAX_CATEGORIES:
            return log_rank_long(dataset, group, time, event, cuts)
        groups = sorted(r[0] for r in some)
    return log_rank_wide(dataset, group, time, event, list(groups), cuts)


def log_rank_wide(dataset: DataFrame, group: str, time: str, event: str, groups: list, cuts=None) -> DataFrame:
    """Per distinct time the groups' exits and events are columns; at-risk counts are running sums from the end. All that leaves the
    cluster is one row with k differences and a k x k covariance.
    """
    k = len(groups)
    if k < 2:
        raise ValueError("a log-rank test needs at least two groups")
    own = lambda g: F.col(group) == g
    per_time = (
        dataset.where(F.col(group).isin(list(groups))).groupBy(F.col(time).alias("t")).agg(
            F.sum(event).cast("double").alias("d"),
            *[F.sum(F.when(own(g), F.col(event)).otherwise(0)).cast("double").alias(f"d{i}") for i, g in enumerate(groups)],
            *[F.count_if(own(g)).cast("double").alias(f"m{i}") for i, g in enumerate(groups)]))
    risk = running_sums(per_time, "t", {f"n{i}": f"m{i}" for i in range(k)}, descending=True, cuts=cuts)
    # Only times with an event contribute.
    risk = risk.where(F.col("d") > 0).withColumn("n", sum((F.col(f"n{i}") for i in range(1, k)), F.col("n0")))
    d, n = F.col("d"), F.col("n")
    share = [F.col(f"n{i}") / n for i in range(k)]
    spread = F.when(n > 1, d * (n - d) / (n - 1)).otherwise(0.0)
    diffs = [F.sum(F.col(f"d{i}") - d * share[i]).alias(f"o{i}") for i in range(k)]
    cov = [F.sum(spread * share[i] * ((1.0 if i == j else 0.0) - share[j])).alias(f"v{i}_{j}") for i in range(k) for j in range(k)]
    one = risk.agg(*diffs, *cov).select(
        F.array(*[f"o{i}" for i in range(k)]).alias("diff"), F.array(*[f"v{i}_{j}" for i in range(k) for j in range(k)]).alias("cov"))
    return one.select(_log_rank_statistic(k)("diff", "cov").alias("chi2"), F.lit(k - 1).alias("dof")).select(
        "chi2", "dof", chi_square_tail(F.col("chi2"), F.col("dof").cast("double")).alias("p_value"))


# Conjugate gradients end at this relative residual; each step takes one direction out of the rest.
RESIDUAL, MOST_STEPS = 1e-12, 500


def log_rank_long(dataset: DataFrame, group: str, time: str = "duration", event: str = "event", cuts=None) -> DataFrame:
    """The k-sample test with groups as rows.

    Cells are (group, time) pairs that occur. The covariance is a diagonal less a sum over times of products of at-risk shares; it is never formed:
    its product with a vector over the groups is two running sums over the times, joined with the cells, and conjugate gradients with the diagonal as
    preconditioner solve for the statistic. The driver holds a few numbers per group.
    """
    cells = materialize(dataset.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("g"), F.col(time).alias("t")).agg(
        F.count(F.lit(1)).cast("double").alias("m"), F.sum(event).cast("double").alias("e")))
    exits = cells.groupBy("t").agg(F.sum("m").alias("m"), F.sum("e").alias("d"))
    cuts = order_cuts(exits, "t") if cuts is None else cuts
    risk = materialize(running_sums(exits, "t", {"n": "m"}, descending=True, cuts=cuts))
    d, n = F.col("d"), F.col("n")
    spread = F.when(n > 1, d * (n - d) / (n - 1)).otherwise(0.0)
    hazards = materialize(risk.select("t", (d / n).alias("h"), (spread / n).alias("v"), (spread / (n * n)).alias("w")))
    summed = running_sums(hazards, "t", {"sum_h": "h", "sum_v": "v"}, cuts=cuts, stored=True).select("t", "sum_h", "sum_v")
    per_group = cells.join(summed, "t").groupBy("g").agg((F.sum("e") - F.sum(F.col("m") * F.col("sum_h"))).alias("u"), F.sum(F.col("m") * F.col("sum_v")).alias("d"))
    table = per_group.toPandas().sort_values("g", ignore_index=True)  # a row per group
    if len(table) < 2:
        raise ValueError("a log-rank test needs at least two groups")
    diff, diagonal = table["u"].to_numpy(), table["d"].to_numpy()
    live = diagonal > 0

    def times(x: np.ndarray) -> np.ndarray:
        values = dataset.sparkSession.createDataFrame(pd.DataFrame({"g": table["g"], "x": x}))
        weighted = cells.join(values, "g").groupBy("t").agg(F.sum(F.col("m") * F.col("x")).alias("mx"))
        at_risk = running_sums(weighted, "t", {"s": "mx"}, descending=True, cuts=cuts).select("t", "s")
        pulls = materialize(hazards.join(at_risk, "t").select("t", (F.col("w") * F.col("s")).alias("ws")))
        met = running_sums(pulls, "t", {"q": "ws"}, cuts=cuts, stored=True).select("t", "q")
        found = cells.join(met, "t").groupBy("g").agg(F.sum(F.col("m") * F.col("q")).alias("p")).toPandas().sort_values("g", ignore_index=True)
        return diagonal * x - found["p"].to_numpy()

    rest = np.where(live, diff, 0.0)
    size = float(np.abs(rest).max())
    chi2, scaled = 0.0, np.divide(rest, diagonal, out=np.zeros_like(rest), where=live)
    way, power = scaled, float(rest @ scaled)
    for _ in range(MOST_STEPS if size > 0 else 0):
        product = np.where(live, times(way), 0.0)
        step = power / float(way @ product)
        chi2 += step * float(diff @ way)
        rest = rest - step * product
        scaled = np.divide(rest, diagonal, out=np.zeros_like(rest), where=live)
        before, power = power, float(rest @ scaled)
        if float(np.abs(rest).max()) <= RESIDUAL * size:
            break
        way = scaled + power / before * way
    out = dataset.sparkSession.createDataFrame([(chi2, len(table) - 1)], "chi2 double, dof int")
    return out.select("chi2", "dof", chi_square_tail(F.col("chi2"), F.col("dof").cast("double")).alias("p_value"))


def pairwise_log_rank(dataset: DataFrame, group: str, a: str, b: str, **options) -> DataFrame:
    """Log-rank test of two groups."""
    return log_rank(dataset, group, groups=[a, b], **options)


