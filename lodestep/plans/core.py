"""Funnel, operations and dashboard metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import funnel as fn
from ..operators import metrics as m
from ..operators.running import running_sums
from ..operators.quantiles import LINEAR, quantiles
from ..operators.slices import slice_tables
from ..operators.stages import stage_times
from ..session import materialize, new_path
from ..sources import mapping, tables as tb
from ..sources.schemas import SCHEMAS, STAGES, STATUSES
from ..sources.snapshots import Snapshots

SLICE = {"channel": "referral", "region": "ASIA", "device_os": None}


def _journeys(operator):
    return lambda spark, sf: operator(mapping.journeys(spark, sf))


def _commerce(operator):
    return lambda spark, sf: operator(mapping.commerce(spark, sf))


def _lifecycles(operator):
    return lambda spark, sf: operator(*mapping.lifecycles(spark, sf))


def _sliced(operator):
    return lambda spark, sf: operator(slice_tables(mapping.journeys(spark, sf), **SLICE))


def csv_round_trip(spark, sf):
    """Write transactions as CSV, read them under the schema, summarise what came back."""
    path = new_path(spark, "transactions")
    tb.write_result(mapping.commerce(spark, sf).transactions, path, "csv")
    back = tb.read_csv(spark, path, SCHEMAS["transactions"])
    return back.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"),
                                      F.date_format(F.max("txn_time"), "yyyy-MM-dd").alias("last_day"))


def typed_load(spark, sf):
    """CSV folder to typed parquet with rows per table; one table is left out on purpose."""
    csv_dir, out_dir = new_path(spark, "csv"), new_path(spark, "typed")
    named = mapping.commerce(spark, sf).named()
    for name in ["users", "transactions", "support_tickets"]:
        tb.write_result(named[name], f"{csv_dir}/{name}.csv", "csv")
    return tb.load_csv_tables(spark, csv_dir, out_dir, ["users", "transactions", "support_tickets", "kyc_cases"])


def loaded_tables(spark, sf):
    """Rows of the five tables after storing them as parquet folders and loading them from there."""
    path = new_path(spark, "tables")
    for name, df in mapping.journeys(spark, sf).named().items():
        df.write.parquet(f"{path}/{name}")
    return tb.row_counts(tb.load(spark, path).named(), spark)


def cached_tables(spark, sf):
    """Rows of the five tables, counted from cached ones that are released afterwards."""
    kept = tb.cached(mapping.journeys(spark, sf))
    counted = materialize(tb.row_counts(kept.named(), spark))
    tb.release(kept)
    return counted


def snapshot_tables(spark, sf):
    """Rows of the five tables, counted from versions that are taken on first use and deleted afterwards."""
    now = mapping.journeys(spark, sf)
    shared = Snapshots(spark, {name: lambda df=df: df for name, df in now.named().items()})
    with shared.tables() as kept:
        counted = materialize(tb.row_counts(kept.named(), spark))
    shared.close()
    return counted


def stored_result(spark, sf):
    """Write a result, read it again when it exists; an absent one reads as None."""
    path = new_path(spark, "result")
    assert tb.load_result(spark, path) is None
    tb.write_result(m.transactions_by_category(mapping.commerce(spark, sf).transactions), path, "parquet")
    return tb.load_result(spark, path).select("category", "total_transactions")


def stage_durations(t):
    """Last time per stage and journey, as text, with the journey's first event."""
    frame = stage_times(t.events, ["registration_start", "first_transaction"], extra={"first_event": F.min("event_time")})
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return frame.select("user_id", text("t_registration_start"), text("t_first_transaction"), text("first_event"))


def running_users(users, events):
    """Registrations up to and including each month."""
    monthly = (events.where(F.col("event_name") == "registration_start")
               .groupBy(F.date_format("event_time", "yyyyMM").cast("int").alias("month"))
               .agg(F.count_distinct("user_id").alias("registrations")))
    return running_sums(monthly, "month", {"so_far": "registrations"}).select("month", "registrations", "so_far")


def amount_quantiles(t):
    wanted = {"p25": (0.25, LINEAR), "p50": (0.5, LINEAR), "p75": (0.75, LINEAR), "p99": (0.99, LINEAR)}
    q = quantiles(t.transactions, "amount", wanted, by=["category"])
    return q.select("category", *[F.round(name, 4).alias(name) for name in wanted])


QUERIES = {
    # sources and sinks
    "source_csv_round_trip": csv_round_trip,
    "source_typed_load": typed_load,
    "source_stored_result": stored_result,
    "source_loaded_tables": loaded_tables,
    "source_cached_tables": cached_tables,
    "source_snapshot_tables": snapshot_tables,
    "source_row_counts": lambda s, sf: tb.row_counts(mapping.journeys(s, sf).named(), s),
    # stage frame and funnels
    "stage_times": _journeys(stage_durations),
    "funnel_overall": _journeys(lambda t: fn.funnel(t.events, STAGES)),
    "funnel_overall_lifecycles": _lifecycles(lambda u, e: fn.funnel(e, STAGES)),
    "funnel_counts": _journeys(lambda t: fn.funnel_counts(t.events, STAGES[1:])),
    "funnel_wide": _lifecycles(lambda u, e: fn.wide_funnel(e, STAGES[1:])),
    "funnel_by_channel": _journeys(lambda t: fn.channel_funnel(t.users, t.events)),
    "funnel_by_channel_accounts": _journeys(lambda t: fn.account_funnel(t.users, t.events)),
    "channel_performance": _journeys(lambda t: fn.channel_performance(t.users, t.events)),
    "time_to_stage": _journeys(lambda t: m.time_to_stage(t.events)),
    "time_to_stage_lifecycles": _lifecycles(lambda u, e: m.time_to_stage(e)),
    "registration_to_verification_hours": _journeys(lambda t: m.stage_hours(t.events)),
    "week1_retention_by_channel": _journeys(lambda t: fn.channel_retention(t.users, t.events)),
    "activation_14d": _lifecycles(lambda u, e: m.activation_14d(e)),
    # operations
    "kyc_failures_by_device_region": _commerce(lambda t: m.kyc_failures(t.kyc)),
    "tickets_per_1000_by_channel": _journeys(lambda t: m.tickets_per_thousand(t.users, t.tickets)),
    "tickets_by_topic": _commerce(lambda t: m.tickets_by_topic(t.tickets)),
    "transactions_by_category": _commerce(lambda t: m.transactions_by_category(t.transactions)),
    "kyc_turnaround_sla": _journeys(lambda t: m.kyc_turnaround(t.kyc)),
    "kyc_summary": _commerce(lambda t: m.kyc_summary(t.kyc)),
    "kyc_by_channel": _commerce(lambda t: m.kyc_by_channel(t.users, t.kyc)),
    "transaction_summary": _commerce(lambda t: m.transaction_summary(t.transactions)),
    "kpi_summary": _journeys(m.kpi_summary),
    "volumes_by_month": _commerce(m.volumes),
    "transaction_amount_quantiles": _commerce(amount_quantiles),
    "registrations_running": _lifecycles(running_users),
    "transacted_without_account": _journeys(lambda t: m.reached_but_not(t.events, "first_transaction", "account_created")),
    # slices and dashboard
    "slice_executive_strip": _sliced(m.executive_strip),
    "slice_funnel": _sliced(lambda t: fn.funnel_counts(t.events, STAGES[1:])),
    "slice_all_executive_strip": _journeys(lambda t: m.executive_strip(slice_tables(t, channel="All", region=None))),
    "slice_kyc_turnaround": _sliced(lambda t: m.kyc_turnaround_profile(t.kyc)),
    "slice_tickets": _sliced(lambda t: m.ticket_overview(t.tickets)),
    "slice_transactions": _sliced(lambda t: m.transactions_overview(t.transactions)),
    "slice_transactions_by_status": _sliced(lambda t: m.cross_counts(t.transactions, "category", "status")),
    "insight_ratios": _journeys(lambda t: m.insight_ratios(t.events)),
    "kyc_turnaround_histogram": _commerce(lambda t: m.kyc_turnaround_histogram(t.kyc)),
    "kyc_turnaround_histogram_by_decision": _commerce(lambda t: m.kyc_turnaround_histogram(t.kyc, 30, ["decision"])),
    "category_status_table": _commerce(lambda t: m.cross_table(t.transactions, "category", "status", STATUSES)),
    "topic_frequency": _commerce(lambda t: m.frequency(t.tickets, "topic")),
}
