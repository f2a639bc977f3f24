"""Quality of binary scores, from counts per distinct score.

``scores`` holds a 0/1 label and a score per row. Ranks come from running counts over
distinct scores, so no task sorts all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import right_closed_bins
from ..functions.numeric import flag
from .running import running_sums

THRESHOLDS = (0.1, 0.9, 100)
TIERS = ["Low", "Medium", "High"]
GUARD = 1e-9


def score_counts(scores: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return scores.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label)).cast("long").alias("pos"), F.sum(1 - F.col(label)).cast("long").alias("neg"))


def curve_points(scores: DataFrame, label: str = "label", score: str = "score", cuts=None) -> DataFrame:
    """Per distinct score as cut-off: true and false positive rate, precision, recall."""
    run = running_sums(score_counts(scores, label, score), "score", {"tp": "pos", "fp": "neg"}, descending=True,
                       totals={"p": "pos", "n": "neg"}, cuts=cuts)
    return run.select(
        "score", "pos", "neg", "tp", "fp", F.try_divide("fp", "n").alias("fpr"), F.try_divide("tp", "p").alias("tpr"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.try_divide("tp", "p").alias("recall"), "p", "n")


def ranking_quality(points: DataFrame) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (steps, no interpolation)."""
    negatives_below = F.col("n") - F.col("fp")
    u = F.sum(F.col("pos") * (negatives_below + F.col("neg") / 2))
    return points.agg(
        F.try_divide(u, F.max("p").cast("double") * F.max("n")).alias("roc_auc"),
        F.sum(F.try_divide("pos", "p") * F.col("precision")).alias("average_precision"))


def confusion(scores: DataFrame, label: str = "label", score: str = "score", cut: float = 0.5) -> DataFrame:
    """The four cells; a score strictly above ``cut`` predicts 1."""
    return scores.select(F.col(label).cast("int").alias("label"), flag(F.col(score) > cut).alias("predicted")).groupBy(
        "label", "predicted").agg(F.count(F.lit(1)).alias("n"))


def class_report(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of both classes from the four cells."""
    at = lambda actual, said: F.coalesce(F.sum(F.when((F.col("label") == actual) & (F.col("predicted") == said), F.col("n"))), F.lit(0)).cast("double")
    wide = cells.agg(*[at(a, s).alias(f"c{a}{s}") for a in (0, 1) for s in (0, 1)])
    rows = []
    for c in (0, 1):
        hit, other = F.col(f"c{c}{c}"), 1 - c
        rows.append(F.struct(
            F.lit(c).alias("label"), F.coalesce(F.try_divide(hit, hit + F.col(f"c{other}{c}")), F.lit(0.0)).alias("precision"),
            F.coalesce(F.try_divide(hit, hit + F.col(f"c{c}{other}")), F.lit(0.0)).alias("recall"),
            (hit + F.col(f"c{c}{other}")).cast("long").alias("support")))
    out = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    p, r = F.col("precision"), F.col("recall")
    return out.select("label", "precision", "recall", F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"), "support")


def brier(scores: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return scores.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def threshold_sweep(scores: DataFrame, label: str = "label", score: str = "score",
                    grid: tuple[float, float, int] = THRESHOLDS) -> DataFrame:
    """Precision, recall and F1 for ``score >= threshold`` on an even grid.

    Rows are counted into the intervals between thresholds; the sweep sums those few
    intervals from the top.
    """
    low, high, steps = grid
    thresholds = [low + i * (high - low) / (steps - 1) for i in range(steps)]
    binned = Bucketizer(splits=[float("-inf"), *thresholds, float("inf")], inputCol="_s", outputCol="bin").transform(
        scores.select(F.col(label).cast("long").alias("y"), F.col(score).cast("double").alias("_s")))
    counts = binned.groupBy(F.col("bin").cast("int").alias("bin")).agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
    bins = scores.sparkSession.range(steps + 1).select(F.col("id").cast("int").alias("bin"))
    full = bins.join(counts, "bin", "left").fillna(0)
    above = Window.partitionBy(F.lit(1)).orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = full.select("bin", F.sum("p").over(above).alias("tp"), F.sum("n").over(above).alias("fp"),
                       F.sum("p").over(Window.partitionBy(F.lit(1))).alias("p")).where(F.col("bin") > 0)
    table = F.array(*[F.lit(t) for t in thresholds])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("p") - F.col("tp")
    rated = sums.select(F.element_at(table, F.col("bin")).alias("threshold"), (tp / (tp + fp + GUARD)).alias("precision"),
                        (tp / (tp + fn + GUARD)).alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("f1", 2 * p * r / (p + r + GUARD))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Lowest threshold with the highest F1."""
    top = sweep.agg(F.min(F.struct((-F.col("f1")).alias("minus_f1"), "threshold")).alias("b"))
    return top.select("b.threshold", (-F.col("b.minus_f1")).alias("f1"))


def calibration(scores: DataFrame, label: str = "label", score: str = "score", bins: int = 10) -> DataFrame:
    """Mean score against event rate in equal-width bins of the score."""
    number = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scores.groupBy(number.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("event_rate"))


def risk_tier(score: Column, edges: Sequence[float] = (0.0, 0.40, 0.65, 1.0), names: Sequence[str] = TIERS) -> Column:
    return right_closed_bins(score, list(edges), list(names))


def risk_tiers(scores: DataFrame, score: str = "score", edges: Sequence[float] = (0.0, 0.40, 0.65, 1.0)) -> DataFrame:
    return scores.withColumn("risk_tier", risk_tier(F.col(score), edges))


def high_risk_summary(tiered: DataFrame, average_precision: Column, conversion: float = 0.5) -> DataFrame:
    """Users in the top tier, their share, and the churns outreach could prevent."""
    counts = tiered.agg(F.count_if(F.col("risk_tier") == "High").alias("high_risk"), F.count(F.lit(1)).alias("n"))
    return counts.select("high_risk", F.round(F.col("high_risk") / F.col("n") * 100, 4).alias("high_risk_pct"),
                         F.floor(F.col("high_risk") * average_precision * conversion).cast("long").alias("preventable"))


def tier_counts(tiered: DataFrame) -> DataFrame:
    return tiered.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))


def top_risk(tiered: DataFrame, key: str = "user_id", score: str = "score", k: int = 10) -> DataFrame:
    """The ``k`` highest scores of the top tier; the key decides ties."""
    return tiered.where(F.col("risk_tier") == "High").orderBy(F.col(score).desc(), key).limit(k)
