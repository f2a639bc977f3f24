"""Data-quality and time-allocation runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import allocation as al
from ..operators import quality as q
from ..sources import mapping
from ..sources.schemas import CHANNELS

# One channel is taken off the allow-list so that the enum rule has something to find.
ALLOWED = CHANNELS[:4]


def journey_issues(spark, sf) -> DataFrame:
    t = mapping.journeys(spark, sf)
    found = q.run_rules(t.named(), q.domain_rules(ALLOWED)).unionByName(q.logic_issues(t))
    people = mapping.identities(spark, sf)
    return reduce(DataFrame.unionByName, [found, q.duplicate_issues(people, "email", "identities"),
                                          q.run_rules({"identities": people}, identity_rules())])


def identity_rules() -> list[q.Rule]:
    return [
        q.Rule("DQ_MISS_101", "identities", "channel", "rows without channel", q.missing("channel"), q.MISSING_CHANNEL),
        q.Rule("DQ_MISS_102", "identities", "region", "rows without region", q.missing("region"), q.MISSING_REGION),
        q.Rule("DQ_ENUM_101", "identities", "channel", "rows with an undeclared channel", q.outside("channel", CHANNELS), q.INVALID_ENUM),
        q.Rule("DQ_DATE_101", "identities", "created_at", "timestamps that do not parse", q.unparseable("created_at"), q.BAD_DATE),
    ]


def clean_report(spark, sf) -> DataFrame:
    """Issues of the identities that break no rule (an empty report) next to those of all identities."""
    people = mapping.identities(spark, sf)
    broken = reduce(lambda a, b: a | b, [r.violated for r in identity_rules()])
    issues = lambda df: q.triage(q.run_rules({"identities": df}, identity_rules())).agg(F.count(F.lit(1)).alias("issues"))
    return issues(people.where(~broken)).select(F.lit("clean").alias("rows"), "issues").unionByName(
        issues(people).select(F.lit("all").alias("rows"), "issues"))


def tables_with_issues(spark, sf):
    return {**mapping.journeys(spark, sf).named(), "identities": mapping.identities(spark, sf)}


def report(spark, sf) -> DataFrame:
    return q.triage(journey_issues(spark, sf))


def future(spark, sf):
    """Events later than the middle of the observed span."""
    e = mapping.journeys(spark, sf).events
    middle = e.agg(F.timestamp_micros(((F.min(F.unix_micros("event_time")) + F.max(F.unix_micros("event_time"))) / 2).cast("long"))).scalar()
    return q.future_rows(e, "event_time", middle).groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))


def repeated_people(spark, sf) -> DataFrame:
    """Identities, every 23rd of them twice."""
    people = mapping.identities(spark, sf).select("user_id")
    return people.unionByName(people.where(F.col("user_id").cast("long") % 23 == 0))


def _spoiled(tables, operator):
    return lambda spark, sf: operator(mapping.spoiled(tables(spark, sf)))


def _journeys(operator):
    return lambda spark, sf: operator(mapping.journeys(spark, sf))


def _commerce(operator):
    return lambda spark, sf: operator(mapping.commerce(spark, sf))


def _calendar(operator):
    return lambda spark, sf: operator(mapping.calendar(spark, sf))


QUERIES = {
    "quality_duplicate_identifiers": lambda s, sf: q.duplicate_identifiers(mapping.identities(s, sf), "email"),
    "quality_labelled_duplicates": lambda s, sf: q.triage(q.labelled_duplicates(
        mapping.identities(s, sf).withColumn("issue_id", F.concat(F.lit("DQ"), F.col("user_id"))), "identities"))
        .select("issue_id", "issue_description", "triage_score", "priority"),
    "quality_duplicate_phones": lambda s, sf: q.duplicate_identifiers(mapping.identities(s, sf), "phone_number"),
    "quality_identity_rules": lambda s, sf: q.affected_by_rule(mapping.identities(s, sf), identity_rules()),
    "quality_user_rules": _journeys(lambda t: q.affected_by_rule(t.users, [r for r in q.domain_rules(ALLOWED) if r.table == "users"])),
    "quality_kyc_rules": _spoiled(mapping.commerce, lambda t: q.affected_by_rule(t.kyc, [r for r in q.domain_rules() if r.table == "kyc_cases"])),
    "quality_transaction_rules": _spoiled(mapping.commerce, lambda t: q.affected_by_rule(t.transactions, [r for r in q.domain_rules() if r.table == "transactions"])),
    "quality_event_rules": _spoiled(mapping.journeys, lambda t: q.affected_by_rule(t.events, [r for r in q.domain_rules() if r.table == "onboarding_events"])),
    "quality_ticket_rules": _spoiled(mapping.commerce, lambda t: q.affected_by_rule(t.tickets, [r for r in q.domain_rules() if r.table == "support_tickets"])),
    "quality_repeated_users": lambda s, sf: q.repeated_keys(repeated_people(s, sf), ["user_id"]),
    "quality_transactions_without_account": _journeys(lambda t: q.reached_but_not(t.events, "first_transaction", "account_created")),
    "quality_repeated_user_events": _journeys(lambda t: q.repeated_keys(t.events, ["user_id", "event_name"])),
    "quality_conflicting_decisions": _commerce(lambda t: q.conflicting_decisions(t.kyc)),
    "quality_rows_before_signup": _commerce(lambda t: q.events_before_signup(t.users, t.transactions, "txn_time")),
    "quality_approved_without_verification": _journeys(lambda t: q.missing_prerequisite(t.events, "kyc_approved", "verification_submitted")),
    "quality_paid_without_account": _journeys(lambda t: q.success_without_account(t.transactions, t.events)),
    "quality_orphans": _commerce(lambda t: q.orphans(t.tickets, t.users.where(F.col("user_id").cast("long") % 7 != 0))),
    "quality_stages_out_of_order": lambda s, sf: q.stages_out_of_order(mapping.lifecycles(s, sf)[1]),
    "quality_future_events": future,
    "quality_clean_report": clean_report,
    "quality_issues": journey_issues,
    "quality_triage": lambda s, sf: report(s, sf).select("issue_id", "triage_score", "priority", "recommendation"),
    "quality_priority_counts": lambda s, sf: q.priority_counts(report(s, sf)),
    "quality_top_issues": lambda s, sf: q.top_issues(report(s, sf)),
    "quality_scores": lambda s, sf: q.dq_score(journey_issues(s, sf), tables_with_issues(s, sf)),
    "time_allocation": _calendar(lambda c: al.allocation(c).withColumn("total_hours", F.round("total_hours", 2))),
    "time_load_summary": _calendar(al.load_summary),
    "time_dominant_category": _calendar(al.dominant_category),
    "time_targets_gap": _calendar(lambda c: al.targets_gap(al.allocation(c))),
    "time_weekly": _calendar(al.weekly_allocation),
}
