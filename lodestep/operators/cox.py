"""Cox proportional hazards with an L2 penalty, and the concordance index."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.labels import p_stars
from ..functions.stats import normal_quantile, tie_sums, two_sided_p
from ..session import materialize, new_path
from .running import order_cuts, running_sums

MAX_STEPS = 30
TOLERANCE = 1e-9

_TIES = StructType([StructField(n, DoubleType()) for n in ("logs", "inv", "inv2")])


@F.pandas_udf(_TIES)
def _ties(deaths: pd.Series, risk: pd.Series, tied: pd.Series) -> pd.DataFrame:
    logs, inv, inv2 = tie_sums(deaths.to_numpy(), risk.to_numpy(), tied.to_numpy())
    return pd.DataFrame({"logs": logs, "inv": inv, "inv2": inv2})


@dataclass
class CoxModel:
    """Fitted coefficients on the scale of the covariates, with their covariance."""

    covariates: list[str]
    coefficients: np.ndarray
    covariance: np.ndarray
    log_likelihood: float
    steps: int
    converged: bool = True

    def score(self) -> Column:
        """Log partial hazard of a row."""
        return sum((F.col(c) * F.lit(float(b)) for c, b in zip(self.covariates, self.coefficients)), F.lit(0.0))


def _sum(terms):
    terms = list(terms)
    return sum(terms[1:], terms[0])


# Rows of one time are dealt to several buckets from this number on.
ROWS_PER_TIME = 1_000_000


@dataclass
class RiskRows:
    """Rows of a Cox fit, written once: standardised, equal rows as one weighted row, bucketed and sorted by time.

    ``rows`` has key, salt, t, e, x0, x1, ... and w; the key is the time as text, since Spark rewrites floating-point keys and would not see that
    they are bucketed. Where a time has very many rows they have several salts, so no bucket holds them all, and ``keys`` has the (key, salt)
    pairs. The steps of a fit sum the rows where they lie and join them bucket by bucket with one row per time and salt: sums per time move,
    rows never do.
    """

    names: list[str]
    table: str
    rows: DataFrame
    keys: DataFrame
    n: int
    mean: list[float]
    scale: list[float]
    cuts: list[float]
    events: np.ndarray
    crowded: bool

    @property
    def by(self) -> list[str]:
        return ["key", "salt"] if self.crowded else ["key"]

    @property
    def xs(self) -> list[str]:
        return [f"x{i}" for i in range(len(self.names))]

    def scored(self, beta) -> DataFrame:
        risk = F.exp(_sum(F.col(x) * F.lit(float(b)) for x, b in zip(self.xs, beta)))
        return self.rows.withColumn("r", F.col("w") * risk)

    def per_time(self, beta) -> DataFrame:
        """Deaths, risk and risk-weighted covariates per time, of all rows and of deaths alone."""
        r, e = F.col("r"), F.col("e")
        cells = self.scored(beta).groupBy(*self.by).agg(
            F.min("t").alias("t"), F.sum(F.col("w") * e).alias("d"), F.sum(r).alias("s0"), F.sum(e * r).alias("d0"),
            *[F.sum(r * F.col(x)).alias(f"s1_{i}") for i, x in enumerate(self.xs)],
            *[F.sum(e * r * F.col(x)).alias(f"d1_{i}") for i, x in enumerate(self.xs)])
        if not self.crowded:
            return cells.drop("key")
        return cells.groupBy("key").agg(F.min("t").alias("t"), *[F.sum(c).alias(c) for c in cells.columns if c not in ("key", "salt", "t")]).drop("key")

    def second_moments(self, beta, hazard: DataFrame) -> DataFrame:
        """One row of weighted products of covariates; the weight of a row is its risk times the hazard (t, A, own) it has met."""
        weight = F.col("r") * (F.col("A") + F.col("e") * F.col("own"))
        met = hazard.select(_key("t"), "A", "own")
        met = self.keys.join(met, "key") if self.crowded else met
        return self.scored(beta).join(met, self.by).agg(
            *[F.sum(weight * F.col(self.xs[i]) * F.col(self.xs[j])).alias(f"s{i}_{j}") for i, j in _pairs(len(self.xs))])

    def close(self) -> None:
        """Forget the table; its files go with the other intermediates."""
        self.rows.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")


def _key(time: str) -> Column:
    return (F.col(time) + F.lit(0.0)).cast("string").alias("key")  # -0.0 is 0.0


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def lay_out(dataset: DataFrame, covariates: Sequence[str], time: str = "duration", event: str = "event", cuts=None,
            rows_per_time: int = ROWS_PER_TIME) -> RiskRows:
    """Write the rows of a fit to buckets of times, as many as there are shuffle partitions; a time with more rows than ``rows_per_time`` to several."""
    spark = dataset.sparkSession
    names = list(covariates)
    moments = dataset.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(names)],
                          *[F.stddev(c).alias(f"s_{i}") for i, c in enumerate(names)]).first()
    mean = [moments[f"m_{i}"] for i in range(len(names))]
    scale = [moments[f"s_{i}"] or 1.0 for i in range(len(names))]
    xs = [f"x{i}" for i in range(len(names))]
    rows = materialize(dataset.select(
        F.col(time).alias("t"), F.col(event).cast("double").alias("e"),
        *[((F.col(c) - F.lit(float(mean[i]))) / F.lit(float(scale[i]))).alias(xs[i]) for i, c in enumerate(names)],
    ).groupBy("t", "e", *xs).agg(F.count(F.lit(1)).cast("double").alias("w")))
    # Times with many different rows; there are fewer than rows / rows_per_time of them.
    many = materialize(rows.groupBy("t").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_time))
    salt = F.when(F.col("_n").isNotNull(), F.pmod(F.xxhash64("e", *xs), F.ceil(F.col("_n") / rows_per_time))).otherwise(0).cast("int")
    dealt = rows.join(many, "t", "left").select(_key("t"), salt.alias("salt"), "t", "e", *xs, "w")
    crowded = not many.isEmpty()
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ["key", "salt"] if crowded else ["key"]
    table = f"risk_rows_{uuid.uuid4().hex}"
    (dealt.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by).option("path", new_path(spark, "risk")).saveAsTable(table))
    laid = spark.table(table)
    keys = materialize(laid.select("key", "salt", "t").distinct())
    fixed = laid.agg(*[F.sum(F.col("w") * F.col("e") * F.col(x)).alias(x) for x in xs]).first()
    cuts = order_cuts(keys.select("t").distinct(), "t") if cuts is None else cuts
    return RiskRows(names, table, laid, keys.drop("t"), moments["n"], mean, scale, cuts, np.array([fixed[x] or 0.0 for x in xs]),
                    crowded)


def derivatives(data: RiskRows, beta) -> tuple[float, np.ndarray, np.ndarray]:
    """Efron's log partial likelihood at coefficients of standardised covariates, its gradient, and minus its second derivative.

    The rows are read twice: sums per time give the risk sets (running sums from the end), and the second moments are weighted by
    the cumulative hazard at each row's own time. The driver holds the p-vector and the p x p matrix only.
    """
    p = len(data.names)
    pairs = _pairs(p)

    def symmetric(row, prefix):
        m = np.zeros((p, p))
        for i, j in pairs:
            m[i, j] = m[j, i] = row[f"{prefix}{i}_{j}"] or 0.0
        return m

    risk_sets = running_sums(data.per_time(beta), "t", {"risk0": "s0", **{f"risk1_{i}": f"s1_{i}" for i in range(p)}},
                             descending=True, cuts=data.cuts)
    some = F.col("d") > 0
    tied = risk_sets.withColumn("k", _ties(F.greatest("d", F.lit(1.0)), "risk0", F.when(some, F.col("d0")).otherwise(F.col("risk0"))))
    keep = [F.when(some, F.col(f"k.{c}")).otherwise(0.0).alias(c) for c in ("logs", "inv", "inv2")]
    center = [(F.col(f"risk1_{i}") - F.col(f"d1_{i}") * F.col("risk0") / F.col("d0")).alias(f"c{i}") for i in range(p)]
    pull = [(F.col(f"d1_{i}") / F.col("d0")).alias(f"p{i}") for i in range(p)]
    guarded = lambda cols: [F.when(some, c).otherwise(0.0).alias(f"{tag}{i}") for tag, cs in cols for i, c in enumerate(cs)]
    solved = tied.select("t", "d", *keep, *guarded([("c", center), ("p", pull)]),
                         F.when(some, (F.col("d") - F.col("risk0") * F.col("k.inv")) / F.col("d0")).otherwise(0.0).alias("own"))
    solved = solved.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        c = [F.col(f"c{i}") for i in range(p)]
        q = [F.col(f"p{i}") for i in range(p)]
        first = solved.agg(
            F.sum("logs").alias("logs"), *[F.sum(c[i] * F.col("inv") + F.col("d") * q[i]).alias(f"g{i}") for i in range(p)],
            *[F.sum(c[i] * c[j] * F.col("inv2") + (c[i] * q[j] + q[i] * c[j]) * F.col("inv") + F.col("d") * q[i] * q[j]).alias(f"h{i}_{j}")
              for i, j in pairs]).first()
        hazard = running_sums(solved.select("t", "inv", "own"), "t", {"A": "inv"}, cuts=data.cuts, stored=True)
        second = data.second_moments(beta, hazard).first()
    finally:
        solved.unpersist()
    value = float(np.dot(data.events, beta)) - (first["logs"] or 0.0)
    gradient = data.events - np.array([first[f"g{i}"] or 0.0 for i in range(p)])
    return value, gradient, symmetric(second, "s") - symmetric(first, "h")


def fit(dataset: DataFrame, covariates: Sequence[str], time: str = "duration", event: str = "event",
        penalizer: float = 0.1, cuts=None, max_steps: int = MAX_STEPS, strict: bool = True, rows_per_time: int = ROWS_PER_TIME) -> CoxModel:
    """Newton's method on the Efron partial likelihood.

    Covariates are standardised for the fit and the penalty is ``n * penalizer / 2`` times the squared length of those coefficients. The rows are
    laid out once (:class:`RiskRows`); no step moves them. A fit that does not converge raises, or says so in ``converged`` where
    ``strict`` is off.
    """
    data = lay_out(dataset, covariates, time, event, cuts, rows_per_time)
    p, lam = len(data.names), penalizer * data.n

    def evaluate(beta):
        value, gradient, information = derivatives(data, beta)
        return value - 0.5 * lam * float(np.dot(beta, beta)), gradient - lam * beta, information + lam * np.eye(p)

    beta = np.zeros(p)
    try:
        value, gradient, information = evaluate(beta)
        steps, converged = 0, False
        while True:
            move = np.linalg.solve(information, gradient)
            if float(gradient @ move) < TOLERANCE:
                converged = True
                break
            if steps == max_steps:
                break
            steps += 1
            size, better = 1.0, False
            while not better and size >= 1e-4:
                trial = evaluate(beta + size * move)
                better = trial[0] >= value - 1e-9 * abs(value)
                size = size if better else size / 2
            if not better:  # no step along the gradient helps any more
                break
            beta = beta + size * move
            value, gradient, information = trial
    finally:
        data.close()
    if strict and not converged:
        raise RuntimeError(f"the Cox fit did not converge in {steps} steps")
    unscale = 1 / np.array(data.scale)
    return CoxModel(data.names, beta * unscale, np.linalg.inv(information) * np.outer(unscale, unscale), value, steps, converged)


def derivative_rows(spark, names: Sequence[str], gradient: np.ndarray, information: np.ndarray) -> DataFrame:
    """(a, b, information, gradient of a) for every pair of covariates."""
    rows = [(names[i], names[j], float(information[i, j]), float(gradient[i])) for i in range(len(names)) for j in range(len(names))]
    return spark.createDataFrame(rows, "a string, b string, information double, gradient double")


def hazard_ratios(spark, model: CoxModel, alpha: float = 0.05) -> DataFrame:
    """HR with its confidence interval, p-value and stars, highest HR first."""
    z = normal_quantile(1 - alpha / 2)
    rows = []
    for name, b, var in zip(model.covariates, model.coefficients, np.diag(model.covariance)):
        se = math.sqrt(var)
        rows.append((name, float(b), float(math.exp(b)), float(math.exp(b - z * se)), float(math.exp(b + z * se)), float(b / se)))
    df = spark.createDataFrame(rows, "covariate string, coef double, HR double, HR_lower double, HR_upper double, z double")
    return (df.withColumn("p_value", two_sided_p("z")).withColumn("sig", p_stars(F.col("p_value"))).drop("z")
            .orderBy(F.col("HR").desc(), "covariate"))


RADIX = 16


def concordance(dataset: DataFrame, score: Column, time: str = "duration", event: str = "event", cuts=None) -> DataFrame:
    """Share of comparable pairs in which the higher score has the earlier event; score ties count half.

    A pair is comparable when the shorter time is an event; at equal times when exactly one
    of the two is an event, which then counts as the earlier. Pairs are counted, never
    formed: scores become ranks written in base 16, and each pair of different ranks is
    counted at the one digit where the ranks first differ, with a running count over time
    inside each common prefix. Rows are copied once per digit, so the work is n log n.
    """
    packed = materialize(dataset.select(F.col(time).alias("t"), F.col(event).cast("long").alias("e"), score.alias("score"))
                         .groupBy("t", "e", "score").agg(F.count(F.lit(1)).alias("w")))
    values = packed.select("score").distinct().withColumn("one", F.lit(1).cast("long"))
    ranked = materialize(running_sums(values, "score", {"rank": "one"}).select("score", (F.col("rank") - 1).alias("rank")))
    digits, reach = 1, RADIX
    distinct_scores = ranked.count()
    while reach < distinct_scores:
        digits, reach = digits + 1, reach * RADIX
    spread = packed.join(ranked, "score").select("t", "e", "w", "rank", F.explode(F.sequence(F.lit(0), F.lit(digits - 1))).alias("level"))
    power = F.pow(F.lit(float(RADIX)), F.col("level")).cast("long")
    placed = spread.select("t", "e", "w", "level", F.floor(F.col("rank") / (power * RADIX)).cast("long").alias("prefix"),
                           (F.floor(F.col("rank") / power).cast("long") % RADIX).alias("digit"))
    at = lambda g, extra: F.sum(F.when((F.col("digit") == g) & extra, F.col("w")).otherwise(0)).cast("double")
    every = F.lit(True)
    cells = materialize(placed.groupBy("level", "prefix", "t").agg(
        *[at(g, every).alias(f"a{g}") for g in range(RADIX)], *[at(g, F.col("e") == 1).alias(f"v{g}") for g in range(RADIX)]))
    if cuts is None:
        cuts = order_cuts(cells, "t")
    run = running_sums(cells, "t", {f"r{g}": f"a{g}" for g in range(RADIX)}, by=["level", "prefix"], descending=True, cuts=cuts, stored=True)
    # Longer-lived rows per digit: later times, and the censored of the same time.
    longer = [F.col(f"r{g}") - F.col(f"v{g}") for g in range(RADIX)]
    event_at = [F.col(f"v{g}") for g in range(RADIX)]
    lower = _sum(event_at[g] * _sum(longer[:g]) for g in range(1, RADIX))
    higher = _sum(event_at[g] * _sum(longer[g + 1:]) for g in range(RADIX - 1))
    same = F.when(F.col("level") == 0, _sum(event_at[g] * longer[g] for g in range(RADIX))).otherwise(0.0)
    counts = run.agg(F.sum(lower).alias("concordant"), F.sum(higher).alias("discordant"), F.sum(same).alias("tied"))
    pairs = F.col("concordant") + F.col("discordant") + F.col("tied")
    return counts.select("concordant", "discordant", "tied", F.try_divide(F.col("concordant") + F.col("tied") / 2, pairs).alias("c_index"))
