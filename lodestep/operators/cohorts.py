"""Cohorts by calendar period of the first stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import pct_even
from ..functions.times import period
from .stages import reached

FUNNEL_COLUMNS = {
    "registration_start": "s1_registered", "verification_submitted": "s2_verified", "kyc_approved": "s3_kyc_approved",
    "account_created": "s4_account_created", "first_funding": "s5_first_funding",
    "first_transaction": "s6_first_transaction", "week1_active": "s7_week1_active",
}


def cohort_flags(events: DataFrame, stages: Sequence[str], start: str = "registration_start", grain: str = "month") -> DataFrame:
    """(user_id, cohort, one 0/1 column per stage): a row per user and period with a ``start`` event.

    One scan serves memberships and flags: events are reduced to a row per user and period
    (one more for the other stages), and the flags then spread over the few rows of their
    user. It replaces a self-join of the events per stage.
    """
    name = F.col("event_name")
    label = F.when(name == start, period(F.col("event_time"), grain))
    cells = (events.where(name.isin([start, *stages])).groupBy("user_id", label.alias("cohort"))
             .agg(*[F.max(F.when(name == s, 1).otherwise(0)).alias(s) for s in stages]))
    user = Window.partitionBy("user_id")
    return cells.select("user_id", "cohort", *[F.max(s).over(user).alias(s) for s in stages]).where(F.col("cohort").isNotNull())


def cohort_funnel(events: DataFrame, columns: dict[str, str] = FUNNEL_COLUMNS, start: str = "registration_start",
                  grain: str = "month") -> DataFrame:
    """Users of each cohort that ever reached each stage; a user may be in several cohorts."""
    stages = [s for s in columns if s != start]
    counts = [F.count(F.lit(1)).alias(columns[start])] + [reached(s).alias(columns[s]) for s in stages]
    return cohort_flags(events, stages, start, grain).groupBy("cohort").agg(*counts).select("cohort", *columns.values())


def cohort_rates(cohorts: DataFrame, columns: dict[str, str] = FUNNEL_COLUMNS) -> DataFrame:
    """Stage percentages of the registered, activation, and week-1 share of the activated."""
    base, *rest = columns.values()
    out = cohorts.select(
        "*", *[pct_even(F.col(c), F.col(base)).alias(f"{c}_pct") for c in rest],
        pct_even(F.col(columns["first_transaction"]), F.col(base)).alias("activation_of_registered"),
        pct_even(F.col(columns["week1_active"]), F.col(columns["first_transaction"])).alias("week1_ret_of_actv"))
    return out


def channel_cohorts(users: DataFrame, events: DataFrame, by: str = "channel", grain: str = "month") -> DataFrame:
    """Registered, activated and retained users per group and cohort, with rates."""
    members = cohort_flags(events, ["first_transaction", "week1_active"], grain=grain).join(users.select("user_id", by), "user_id")
    counts = members.groupBy(by, "cohort").agg(
        F.count(F.lit(1)).alias("registered"), reached("first_transaction").alias("activated"),
        reached("week1_active").alias("week1_retained"))
    return counts.select(
        "*", pct_even(F.col("activated"), F.col("registered")).alias("activation_of_registered"),
        pct_even(F.col("week1_retained"), F.col("activated")).alias("retention_rate"))


def grid(df: DataFrame, row: str, column: str, value: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Long to wide: one column per value of ``column``, or per listed value; absent cells are NULL."""
    return df.groupBy(row).pivot(column, None if columns is None else list(columns)).agg(F.first(value))


def stage_matrix(rates: DataFrame, columns: dict[str, str] = FUNNEL_COLUMNS) -> DataFrame:
    """(stage, cohort, pct) from the cohort rates, ready for a stage by cohort grid."""
    stages = [f"{c}_pct" for c in list(columns.values())[1:]]
    return rates.unpivot(["cohort"], stages, "stage", "pct").select("stage", "cohort", "pct")


def trend(df: DataFrame, value: str, order: str) -> DataFrame:
    """Least-squares line of ``value`` over the position in ``order`` (0, 1, ...); NULL takes the mean.

    ``df`` has one row per period.
    """
    indexed = df.select(
        (F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(order)) - 1).cast("double").alias("x"), F.col(value).alias("y"))
    filled = indexed.select("x", F.coalesce("y", df.agg(F.avg(value)).scalar()).alias("y"))
    line = filled.agg(F.regr_slope("y", "x").alias("s"), F.regr_intercept("y", "x").alias("i"), F.avg("y").alias("m"))
    return line.select(
        F.round("s", 6).alias("slope_pp_per_period"), F.round("i", 6).alias("intercept"), F.round("m", 6).alias("mean_value"),
        F.when(F.col("s") > 0, "improving").otherwise("declining").alias("direction"))


def mean_of_rates(df: DataFrame, group: str, value: str) -> DataFrame:
    """Unweighted mean of the rates of a group; differs from the pooled rate."""
    return df.groupBy(group).agg(F.avg(value).alias("mean_rate"))


def best_and_worst(df: DataFrame, group: str, value: str) -> DataFrame:
    """Group with the highest and the lowest value; the first name wins a tie."""
    rated = df.where(F.col(value).isNotNull())
    ends = rated.agg(F.min(F.struct((-F.col(value)).alias("v"), group)).alias("b"), F.min(F.struct(F.col(value).alias("v"), group)).alias("w"))
    return ends.select(F.col(f"b.{group}").alias("best"), (-F.col("b.v")).alias("best_rate"),
                       F.col(f"w.{group}").alias("worst"), F.col("w.v").alias("worst_rate"))


def cohort_headline(rates: DataFrame) -> DataFrame:
    """Unweighted means over cohorts."""
    return rates.agg(F.count(F.lit(1)).alias("cohorts"), F.round(F.avg("activation_of_registered"), 4).alias("avg_activation"),
                     F.round(F.avg("week1_ret_of_actv"), 4).alias("avg_week1_retention"))
