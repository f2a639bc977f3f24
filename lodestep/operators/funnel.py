"""Funnels, overall and by group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import or_zero, pct, pct_even, ratio
from .stages import reached, stage_flags, stage_totals, user_flags


def funnel(events: DataFrame, stages: Sequence[str], entity: str = "user_id") -> DataFrame:
    """Users per stage in order, percent of the previous and of the first stage.

    One scan and one shuffle on the entity; the single row of totals is then turned
    into one row per stage, where each row knows its neighbours without a window.
    """
    totals = stage_totals(stage_flags(events, stages, entity), stages)
    rows = []
    for i, stage in enumerate(stages):
        previous = F.col(stages[i - 1]) if i else F.lit(None).cast("long")
        rows.append(F.struct(
            F.lit(stage).alias("stage"), F.lit(i + 1).alias("stage_order"), F.col(stage).alias("users"),
            previous.alias("previous"), F.col(stages[0]).alias("first")))
    return totals.select(F.explode(F.array(*rows)).alias("s")).select("s.*").select(
        "stage", "stage_order", "users",
        pct(F.col("users"), F.col("previous")).alias("conversion_from_previous"),
        pct(F.col("users"), F.col("first")).alias("conversion_from_start"),
    )


def funnel_counts(events: DataFrame, stages: Sequence[str], entity: str = "user_id") -> DataFrame:
    """Users per stage, and percent of the previous stage with the first stage at 100."""
    f = funnel(events, stages, entity)
    step = F.when(F.col("stage_order") == 1, F.lit(100.0)).otherwise(F.col("conversion_from_previous"))
    return f.select("stage", "stage_order", "users", step.alias("step_pct"))


def wide_funnel(events: DataFrame, stages: Sequence[str], entity: str = "user_id") -> DataFrame:
    """All stage counts in a single row."""
    return stage_totals(stage_flags(events, stages, entity), stages)


def channel_funnel(users: DataFrame, events: DataFrame, registration: str = "registration_start",
                   approved: str = "kyc_approved", activated: str = "first_transaction",
                   retained: str = "week1_active", by: str = "channel") -> DataFrame:
    """Stage counts by group for groups with any event; approval and activation of the approved.

    A stage nobody of the group reached is NULL, as in a pivot.
    """
    stages = [registration, approved, activated, retained]
    counts = users.select("user_id", by).join(stage_flags(events, stages), "user_id").groupBy(by).agg(
        *[F.nullif(reached(s), F.lit(0)).alias(s) for s in stages])
    return counts.select(
        by, *stages,
        pct(F.col(approved), F.col(registration)).alias("kyc_approval_rate"),
        pct(F.col(activated), F.col(approved)).alias("activation_of_kyc"),
    )


def channel_performance(users: DataFrame, events: DataFrame, by: str = "channel") -> DataFrame:
    """Dashboard view by group: users, approval, activation of approved, retention; 0 for an empty base."""
    stages = ["registration_start", "kyc_approved", "first_transaction", "week1_active"]
    counts = user_flags(users.select("user_id", by), events, stages).groupBy(by).agg(
        F.count(F.lit(1)).alias("users"), *[reached(s).alias(s) for s in stages])
    rate = lambda n, d: F.round(or_zero(ratio(F.col(n), F.col(d), 100.0)), 4)
    return counts.select(
        by, "users",
        rate("kyc_approved", "registration_start").alias("kyc_approval_rate"),
        rate("first_transaction", "kyc_approved").alias("activation_of_kyc"),
        rate("week1_active", "first_transaction").alias("week1_retention"),
    )


def account_funnel(users: DataFrame, events: DataFrame, by: str = "channel") -> DataFrame:
    """Stage counts by group over all users; activation of accounts and week-1 retention."""
    stages = ["registration_start", "verification_submitted", "kyc_approved", "account_created",
              "first_transaction", "week1_active"]
    counts = user_flags(users.select("user_id", by), events, stages).groupBy(by).agg(
        *[reached(s).alias(s) for s in stages])
    return counts.select(
        by, *stages,
        pct_even(F.col("first_transaction"), F.col("account_created"), 2).alias("activation_of_account"),
        pct_even(F.col("week1_active"), F.col("first_transaction"), 2).alias("week1_retention"),
    )


def channel_retention(users: DataFrame, events: DataFrame, by: str = "channel") -> DataFrame:
    """Week-1 retention of activated users by group; groups without events stay."""
    counts = user_flags(users.select("user_id", by), events, ["first_transaction", "week1_active"]).groupBy(by).agg(
        reached("first_transaction").alias("activated_users"),
        reached("week1_active").alias("week1_active_users"))
    return counts.withColumn("week1_retention_rate", pct(F.col("week1_active_users"), F.col("activated_users")))
