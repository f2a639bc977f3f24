"""Where time goes: hours by category, loads and targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.labels import title_text
from ..functions.times import period

# Days tracked, value-adding categories, verdict bands and target bands.
TRACKED_DAYS = 90
VALUE_ADD = ("deep_work", "documentation")
MEETINGS, TRAINING = "stakeholder_meetings", "training"
TARGETS = {  # category: (target, low, high) percent
    "deep_work": (40.0, 35.0, 45.0), "stakeholder_meetings": (30.0, 25.0, 35.0), "training": (12.0, 10.0, 15.0),
    "admin": (12.0, 10.0, 15.0), "documentation": (6.0, 5.0, 10.0),
}


def allocation(calendar: DataFrame, by: str = "category", hours: str = "duration_hours") -> DataFrame:
    """Hours and percent of all hours by category."""
    sums = calendar.groupBy(by).agg(F.sum(hours).alias("total_hours"))
    # One row per category is left.
    whole = F.sum("total_hours").over(Window.partitionBy(F.lit(1)))
    return sums.select(by, "total_hours", F.bround(F.col("total_hours") / whole * 100, 1).alias("percentage"))


def _share(categories: Sequence[str]):
    return F.sum(F.when(F.col("category").isin(list(categories)), F.col("duration_hours")).otherwise(0.0))


def load_summary(calendar: DataFrame, tracked_days: int = TRACKED_DAYS) -> DataFrame:
    """Total hours, hours per workday, value-adding share, and meeting and training loads with their verdicts."""
    sums = calendar.agg(F.sum("duration_hours").alias("all"), _share(VALUE_ADD).alias("value"),
                        _share([MEETINGS]).alias("meet"), _share([TRAINING]).alias("train"))
    percent = lambda c: F.col(c) / F.col("all") * 100
    meeting, training = percent("meet"), percent("train")
    return sums.select(
        F.round("all", 2).alias("total_hours"),
        F.round(F.col("all") / tracked_days * 7 / 5, 4).alias("hours_per_workday"),
        F.round("value", 2).alias("value_add_hours"), F.round(percent("value"), 4).alias("value_add_pct"),
        F.round(meeting, 4).alias("meeting_pct"), F.round(F.col("meet") / tracked_days * 7, 4).alias("meeting_hours_per_week"),
        F.when(meeting > 35, "high").when(meeting < 20, "low").otherwise("healthy").alias("meeting_verdict"),
        F.round(training, 4).alias("training_pct"),
        F.when(training < 5, "low").when(training > 15, "high").otherwise("balanced").alias("training_verdict"))


def dominant_category(calendar: DataFrame) -> DataFrame:
    top = allocation(calendar).orderBy(F.col("total_hours").desc(), "category").limit(1)
    return top.select(title_text(F.col("category")).alias("category"), F.round("total_hours", 2).alias("total_hours"), "percentage")


def targets_gap(alloc: DataFrame, targets: dict[str, tuple[float, float, float]] = TARGETS) -> DataFrame:
    """Percent against its target and whether it lies in the target range; unknown categories give NULL."""
    def of(i: int):
        pairs = F.create_map(*[F.lit(x) for c, t in targets.items() for x in (c, t[i])])
        return F.try_element_at(pairs, F.col("category"))

    return alloc.select("category", "percentage", of(0).alias("target"), of(1).alias("target_low"), of(2).alias("target_high"),
                        F.round(F.col("percentage") - of(0), 2).alias("gap_pp"),
                        F.col("percentage").between(of(1), of(2)).cast("int").alias("in_range"))


def weekly_allocation(calendar: DataFrame) -> DataFrame:
    """Percent by category within each week."""
    cells = calendar.groupBy(period(F.col("date"), "week").alias("week"), "category").agg(F.sum("duration_hours").alias("h"))
    weeks = cells.groupBy("week").agg(F.sum("h").alias("all"))
    return cells.join(weeks, "week").select("week", "category", F.round("h", 2).alias("hours"),
                                            F.round(F.col("h") / F.col("all") * 100, 1).alias("percentage"))
