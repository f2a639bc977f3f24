"""Named operational metrics over the five tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import or_zero, pct, ratio, total
from ..functions.times import hours_between, period
from ..session import materialize
from ..sources.tables import Tables
from .funnel import wide_funnel
from .quantiles import LINEAR, UPPER, quantiles, quantiles_of_counts, value_counts
from .stages import stage_flags, stage_times

LEGS = {
    "registration_to_kyc": ("registration_start", "kyc_approved"),
    "kyc_to_first_transaction": ("kyc_approved", "first_transaction"),
    "registration_to_first_transaction": ("registration_start", "first_transaction"),
}


def time_to_stage(events: DataFrame, legs: Mapping[str, tuple[str, str]] = LEGS, required: str = "kyc_approved") -> DataFrame:
    """Hours from stage to stage over users that reached ``required``: mean, upper median, extremes.

    All legs come from one stage frame as (metric, hours) rows, so one aggregation
    serves every leg.
    """
    stages = sorted({s for leg in legs.values() for s in leg} | {required})
    times = stage_times(events, stages).where(F.col(f"t_{required}").isNotNull())
    rows = [F.struct(F.lit(metric).alias("metric"),
                     F.round(hours_between(F.col(f"t_{end}"), F.col(f"t_{start}")), 2).alias("hours"))
            for metric, (start, end) in legs.items()]
    long = times.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where(F.col("hours").isNotNull())
    counts = materialize(long.groupBy("metric", "hours").agg(F.count(F.lit(1)).alias("n")))
    spread = counts.groupBy("metric").agg(
        F.round(F.sum(F.col("hours") * F.col("n")) / F.sum("n"), 1).alias("avg_hours"),
        F.min("hours").alias("min_hours"), F.max("hours").alias("max_hours"))
    middle = quantiles_of_counts(counts, "hours", {"median_hours": (0.5, UPPER)}, by=["metric"], stored=True)
    return spread.join(middle, "metric").select("metric", "avg_hours", "median_hours", "min_hours", "max_hours")


def stage_hours(events: DataFrame, start: str = "registration_start", end: str = "verification_submitted") -> DataFrame:
    """Hours from one stage to another per user that reached both."""
    times = stage_times(events, [start, end])
    return (times.where(F.col(f"t_{start}").isNotNull() & F.col(f"t_{end}").isNotNull())
            .select("user_id", F.round(hours_between(F.col(f"t_{end}"), F.col(f"t_{start}")), 4).alias("hours")))


def kyc_failures(kyc: DataFrame, by: Sequence[str] = ("device_os", "region"), min_cases: int = 10) -> DataFrame:
    """Decisions by segment with the list of failure reasons; small segments are left out.

    Cases are first counted per segment and reason, so the reason list is built from
    the few distinct reasons of a segment, not from its cases.
    """
    per_reason = kyc.groupBy(*by, "failure_reason").agg(
        F.count(F.lit(1)).alias("n"), total(F.col("decision") == "approved").alias("a"),
        total(F.col("decision") == "rejected").alias("r"))
    return (
        per_reason.groupBy(*by)
        .agg(F.sum("n").alias("total_cases"), F.sum("a").alias("approved"), F.sum("r").alias("rejected"),
             F.array_join(F.array_sort(F.collect_set("failure_reason")), ",").alias("reasons"))
        .where(F.col("total_cases") >= min_cases)
        .select(*by, "total_cases", "approved", "rejected",
                pct(F.col("rejected"), F.col("total_cases")).alias("rejection_rate"),
                F.nullif(F.col("reasons"), F.lit("")).alias("failure_reasons"))
    )


def tickets_per_thousand(users: DataFrame, tickets: DataFrame, by: str = "channel") -> DataFrame:
    """Ticket load by group; users without tickets count in the base.

    Tickets are summed per user first: one row per user enters the join.
    """
    per_user = tickets.groupBy("user_id").agg(
        F.count("ticket_id").alias("tickets"), F.sum("resolution_time_min").alias("minutes"),
        F.count("resolution_time_min").alias("timed"))
    return (
        users.select("user_id", by).join(per_user, "user_id", "left").groupBy(by)
        .agg(F.count(F.lit(1)).alias("total_users"),
             F.coalesce(F.sum("tickets"), F.lit(0)).cast("long").alias("total_tickets"),
             F.round(ratio(F.sum("minutes"), F.sum("timed")), 1).alias("avg_resolution_time_min"))
        .select(by, "total_users", "total_tickets",
                F.round(ratio(F.col("total_tickets"), F.col("total_users"), 1000.0), 2).alias("tickets_per_1k_users"),
                "avg_resolution_time_min")
    )


def tickets_by_topic(tickets: DataFrame) -> DataFrame:
    """Tickets per topic with their share of all tickets."""
    m = F.col("resolution_time_min")
    topics = tickets.groupBy("topic").agg(
        F.count(F.lit(1)).alias("ticket_count"), F.round(F.avg(m), 1).alias("avg_resolution_min"),
        F.round(F.min(m), 1).alias("min_resolution_min"), F.round(F.max(m), 1).alias("max_resolution_min"))
    # One row per topic is left, so the total is a window over those few rows and not a second scan.
    everything = F.sum("ticket_count").over(Window.partitionBy(F.lit(1)))
    return topics.select("topic", "ticket_count", pct(F.col("ticket_count"), everything).alias("pct_of_total"),
                         "avg_resolution_min", "min_resolution_min", "max_resolution_min")


def activation_14d(events: DataFrame, days: int = 14) -> DataFrame:
    """Users with an account, those that transacted, and those within ``days`` of an account event.

    A transaction before the account event also counts as within. The first transaction
    is within ``days`` of some account event exactly when it is within ``days`` of the
    last one, so the per-user extremes decide.
    """
    per_user = events.where(F.col("event_name").isin("account_created", "first_transaction")).groupBy("user_id").agg(
        F.max(F.when(F.col("event_name") == "account_created", F.col("event_time"))).alias("account"),
        F.min(F.when(F.col("event_name") == "first_transaction", F.col("event_time"))).alias("txn"),
    ).where(F.col("account").isNotNull())
    within = hours_between(F.col("txn"), F.col("account")) <= days * 24
    return per_user.agg(
        F.count(F.lit(1)).alias("users_with_accounts"), F.count("txn").alias("users_with_transactions"),
        total(within).alias("activated_within_14d"),
    ).withColumn("activation_14d", pct(F.col("activated_within_14d"), F.col("users_with_accounts")))


def transactions_by_category(transactions: DataFrame) -> DataFrame:
    """Outcome per category; the mean amount is over all statuses."""
    is_ = lambda s: F.col("status") == s
    return transactions.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_transactions"), total(is_("success")).alias("successful"),
        total(is_("failed")).alias("failed"), total(is_("pending")).alias("pending"),
        F.round(F.avg("amount"), 2).alias("avg_amount"),
    ).select("category", "total_transactions", "successful", "failed", "pending",
             pct(F.col("successful"), F.col("total_transactions")).alias("success_rate"), "avg_amount")


def turnaround_hours() -> Column:
    return hours_between(F.col("decision_time"), F.col("submitted_time"))


def kyc_turnaround(kyc: DataFrame) -> DataFrame:
    """Turnaround by decision with the shares inside 24 and 48 hours."""
    cases = kyc.select("decision", F.round(turnaround_hours(), 2).alias("h"))
    return cases.groupBy("decision").agg(
        F.count(F.lit(1)).alias("cases"), F.round(F.avg("h"), 1).alias("avg_hours"),
        F.round(F.min("h"), 1).alias("min_hours"), F.round(F.max("h"), 1).alias("max_hours"),
        total(F.col("h") <= 24).alias("within_24h"), total(F.col("h") <= 48).alias("within_48h"),
    ).withColumn("pct_within_48h", pct(F.col("within_48h"), F.col("cases")))


def kyc_summary(kyc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Decisions and mean turnaround, in one row or by group."""
    grouped = kyc.groupBy(*by) if by else kyc
    return grouped.agg(
        F.count(F.lit(1)).alias("total_cases"), total(F.col("decision") == "approved").alias("approved"),
        total(F.col("decision") == "rejected").alias("rejected"),
        F.round(F.avg(turnaround_hours()), 1).alias("avg_turnaround_hours"),
    ).select(*by, "total_cases", "approved", "rejected",
             pct(F.col("rejected"), F.col("total_cases")).alias("rejection_rate"), "avg_turnaround_hours")


def kyc_by_channel(users: DataFrame, kyc: DataFrame, by: str = "channel") -> DataFrame:
    """KYC outcome by acquisition group; cases are counted per user before the join."""
    per_user = kyc.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), total(F.col("decision") == "approved").alias("a"),
        F.sum(turnaround_hours()).alias("h"), F.count(turnaround_hours()).alias("hn"))
    return (users.select("user_id", by).join(per_user, "user_id").groupBy(by)
            .agg(F.sum("n").alias("total_cases"), F.sum("a").alias("approved"),
                 F.round(ratio(F.sum("h"), F.sum("hn")), 1).alias("avg_turnaround_hours"))
            .withColumn("approval_rate", pct(F.col("approved"), F.col("total_cases"))))


def transaction_summary(transactions: DataFrame) -> DataFrame:
    """One row; the mean amount is over successes only."""
    ok = F.col("status") == "success"
    return transactions.agg(
        F.count(F.lit(1)).alias("total_transactions"), total(ok).alias("successful"),
        F.round(F.avg(F.when(ok, F.col("amount"))), 2).alias("avg_amount"),
    ).select("total_transactions", "successful",
             pct(F.col("successful"), F.col("total_transactions")).alias("success_rate"), "avg_amount")


def kpi_summary(tables: Tables) -> DataFrame:
    """Headline KPIs as (kpi_name, value) rows; each value is what its name says.

    ``kyc_rejection_rate`` and ``avg_kyc_turnaround_hours`` are the figures some reports
    print under the names of the approval rate and the median.
    """
    col = F.col
    stages = ["registration_start", "account_created", "first_transaction", "week1_active"]
    kyc = tables.kyc.agg(
        total(col("decision") == "approved").alias("a"), total(col("decision") == "rejected").alias("r"),
        F.count(F.lit(1)).alias("n"), F.avg(turnaround_hours()).alias("h"))
    hours = tables.kyc.select(F.round(turnaround_hours(), 6).alias("h"))
    users = tables.users.agg(F.count_distinct("user_id").alias("users"))
    tickets = tables.tickets.agg(F.count(F.lit(1))).scalar()
    ok = total(col("status") == "success")
    wide = [
        users.select(col("users").cast("double").alias("total_users"),
                     ratio(tickets, col("users"), 1000.0).alias("tickets_per_1k_users")),
        wide_funnel(tables.events, stages).select(
            col("registration_start").cast("double").alias("registered_users"),
            ratio(col("first_transaction"), col("account_created"), 100.0).alias("activation_of_account"),
            ratio(col("week1_active"), col("first_transaction"), 100.0).alias("week1_retention_rate")),
        kyc.select(ratio(col("a"), col("n"), 100.0).alias("kyc_approval_rate"),
                   ratio(col("r"), col("n"), 100.0).alias("kyc_rejection_rate"),
                   col("h").alias("avg_kyc_turnaround_hours")),
        quantiles(hours, "h", {"median_kyc_turnaround_hours": (0.5, LINEAR)}),
        tables.transactions.agg(ratio(ok, F.count(F.lit(1)), 100.0).alias("transaction_success_rate")),
    ]
    rows = [w.unpivot([], w.columns, "kpi_name", "value") for w in wide]
    return reduce(DataFrame.unionByName, rows).select("kpi_name", F.round("value", 1).alias("value"))


def executive_strip(tables: Tables) -> DataFrame:
    """Users, activation, KYC approval and retention of a (sliced) table set; 0 for an empty base."""
    f = wide_funnel(tables.events, ["account_created", "first_transaction", "week1_active"])
    k = tables.kyc.agg(total(F.col("decision") == "approved").alias("a"), F.count(F.lit(1)).alias("n"))
    approval = k.select(or_zero(ratio(F.col("a"), F.col("n"), 100.0))).scalar()
    n_users = tables.users.agg(F.count(F.lit(1))).scalar()
    return f.select(
        n_users.alias("total_users"),
        F.round(or_zero(ratio(F.col("first_transaction"), F.col("account_created"), 100.0)), 4).alias("activation_of_account"),
        F.round(approval, 4).alias("kyc_approval_rate"),
        F.round(or_zero(ratio(F.col("week1_active"), F.col("first_transaction"), 100.0)), 4).alias("week1_retention"),
    )


def insight_ratios(events: DataFrame) -> DataFrame:
    """Share of registrations that pass KYC and of accounts that transact; NULL for an empty base."""
    f = wide_funnel(events, ["registration_start", "kyc_approved", "account_created", "first_transaction"])
    return f.select(
        F.round(ratio(F.col("kyc_approved"), F.col("registration_start"), 100.0), 4).alias("registration_to_kyc"),
        F.round(ratio(F.col("first_transaction"), F.col("account_created"), 100.0), 4).alias("account_to_transaction"))


def mean_and_median(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    counts = materialize(value_counts(df, value, by))
    grouped = counts.groupBy(*by) if by else counts
    mean = grouped.agg(F.round(F.sum(F.col(value) * F.col("n")) / F.sum("n"), 4).alias("mean"))
    middle = quantiles_of_counts(counts, value, {"m": (0.5, LINEAR)}, by, stored=True)
    if not by:
        return mean.select("mean", F.round(middle.scalar(), 4).alias("median"))
    return mean.join(middle, list(by)).select(*by, "mean", F.round("m", 4).alias("median"))


def histogram(df: DataFrame, value: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Rows per equal-width bin between the overall minimum and maximum; the top edge is closed."""
    rows = df.where(F.col(value).isNotNull())
    low, high = rows.agg(F.min(value)).scalar(), rows.agg(F.max(value)).scalar()
    width = (high - low) / bins
    number = F.least(F.coalesce(F.floor(F.try_divide(F.col(value) - low, width)), F.lit(0)), F.lit(bins - 1))
    counted = rows.select(*by, number.cast("int").alias("bin")).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*by, "bin", F.round(low + F.col("bin") * width, 4).alias("bin_start"), "n")


def kyc_turnaround_profile(kyc: DataFrame) -> DataFrame:
    return mean_and_median(kyc.select(F.round(turnaround_hours(), 6).alias("h")), "h")


def kyc_turnaround_histogram(kyc: DataFrame, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    return histogram(kyc.select(*by, F.round(turnaround_hours(), 6).alias("hours")), "hours", bins, by)


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Value counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def ticket_overview(tickets: DataFrame) -> DataFrame:
    """Tickets in all with their mean resolution, and per topic."""
    topic = F.coalesce(F.col("topic"), F.lit("(none)"))
    return (tickets.withColumn("topic", topic)
            .groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.sum("resolution_time_min").alias("s"),
                                  F.count("resolution_time_min").alias("c"))
            .rollup("topic").agg(F.sum("n").alias("tickets"),
                                 F.round(ratio(F.sum("s"), F.sum("c")), 4).alias("avg_resolution_min"))
            .select(F.coalesce("topic", F.lit("ALL")).alias("topic"), "tickets", "avg_resolution_min"))


def transactions_overview(transactions: DataFrame) -> DataFrame:
    """Total, success percentage and mean success amount in one row."""
    ok = F.col("status") == "success"
    return transactions.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.round(ratio(total(ok), F.count(F.lit(1)), 100.0), 4).alias("success_rate"),
        F.round(F.avg(F.when(ok, F.col("amount"))), 4).alias("avg_success_amount"))


def cross_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts per pair of values that occurs (long form)."""
    return df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))


def cross_table(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts as a zero-filled table with one column per value."""
    wide = cross_counts(df, row, column).groupBy(row).pivot(column, list(values)).agg(F.sum("n"))
    return wide.fillna(0, subset=list(values))


def volumes(tables: Tables, grain: str = "month") -> DataFrame:
    """KYC cases, tickets and transactions per calendar period."""
    sources = [("kyc_cases", tables.kyc, "submitted_time"), ("support_tickets", tables.tickets, "created_time"),
               ("transactions", tables.transactions, "txn_time")]
    parts = [df.select(F.lit(name).alias("source"), period(F.col(time), grain).alias("period"))
             .groupBy("source", "period").agg(F.count(F.lit(1)).alias("n")) for name, df, time in sources]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def reached_but_not(events: DataFrame, later: str, earlier: str) -> DataFrame:
    """Users that reached ``later`` without ``earlier``: a set difference from one flag frame."""
    flags = stage_flags(events, [later, earlier])
    return flags.where((F.col(later) == 1) & (F.col(earlier) == 0)).select("user_id")
