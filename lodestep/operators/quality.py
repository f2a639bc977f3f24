"""Data-quality rules, triage and scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import ladder, title_text
from ..functions.times import lenient_timestamp
from ..session import materialize
from ..sources.schemas import (AGE_BANDS, CATEGORIES, CHANNELS, DECISIONS, DEVICES, EVENT_NAMES, FAILURE_REASONS,
                               STAGES, STATUSES, TOPICS)
from ..sources.tables import Tables
from .metrics import reached_but_not
from .spread import spread_join
from .stages import stage_times

# Severity, impact weight and downstream usage per check.
DUPLICATE = ("duplicate_identifier", "HIGH", 9, 10)
MISSING_CHANNEL = ("missing_field", "MEDIUM", 6, 8)
MISSING_REGION = ("missing_field", "MEDIUM", 5, 7)
INVALID_ENUM = ("invalid_enum", "HIGH", 8, 9)
BAD_DATE = ("date_format_error", "CRITICAL", 10, 10)
LOGIC = ("business_logic_violation", "HIGH", 9, 8)

# Priority ladder, score target and advice per check.
PRIORITIES = [(75, "P0_CRITICAL"), (50, "P1_HIGH"), (25, "P2_MEDIUM")]
LOWEST_PRIORITY = "P3_LOW"
SCORE_TARGET = 99.5
RECOMMENDATIONS = {
    "duplicate_identifier": "Deduplicate records, add unique constraint, investigate root cause in signup flow",
    "missing_field": "Make field required in UI/API, backfill missing values where possible",
    "invalid_enum": "Add validation at ingestion, standardize existing values, document allowed values",
    "date_format_error": "Parse and reformat to ISO 8601, fix upstream data sources",
    "business_logic_violation": "Add application-layer checks, investigate how state was reached",
}
DEFAULT_RECOMMENDATION = "Investigate and remediate based on impact"


@dataclass(frozen=True)
class Rule:
    """A row condition on one table; every row that meets it is an affected record."""

    issue_id: str
    table: str
    column: str
    text: str
    violated: Column
    check: tuple[str, str, int, int]


def missing(column: str) -> Column:
    return F.col(column).isNull()


def outside(column: str, allowed: Sequence[str]) -> Column:
    """Present but not in the allow-list."""
    return F.col(column).isNotNull() & ~F.col(column).isin(list(allowed))


def unparseable(column: str) -> Column:
    return F.col(column).isNotNull() & lenient_timestamp(F.col(column)).isNull()


def _issues(affected: DataFrame, rule_rows: Mapping[str, Rule]) -> DataFrame:
    """(issue_id, affected) rows to issue rows; rules without affected records give none."""
    def lookup(value):
        out = None
        for issue_id, rule in rule_rows.items():
            hit = F.col("issue_id") == issue_id
            out = F.when(hit, F.lit(value(rule))) if out is None else out.when(hit, F.lit(value(rule)))
        return out

    return affected.where(F.col("affected") > 0).select(
        "issue_id", lookup(lambda r: r.check[0]).alias("check_type"), lookup(lambda r: r.table).alias("table_name"),
        lookup(lambda r: r.column).alias("column_name"),
        F.concat_ws(" ", F.col("affected").cast("string"), lookup(lambda r: r.text)).alias("issue_description"),
        F.col("affected").cast("long").alias("affected_records"), lookup(lambda r: r.check[1]).alias("severity"),
        lookup(lambda r: r.check[2]).cast("int").alias("impact_weight"), F.col("affected").cast("long").alias("frequency"),
        lookup(lambda r: r.check[3]).cast("int").alias("downstream_usage_score"))


def affected_by_rule(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(issue_id, affected) of all row rules on one table, from a single pass without a shuffle of rows."""
    counts = df.agg(*[F.count_if(r.violated).alias(r.issue_id) for r in rules])
    return counts.unpivot([], [r.issue_id for r in rules], "issue_id", "affected")


def run_rules(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Issue rows of all violated row rules; each table is read once."""
    parts = []
    for name in dict.fromkeys(r.table for r in rules):
        own = [r for r in rules if r.table == name]
        parts.append(_issues(affected_by_rule(tables[name], own), {r.issue_id: r for r in own}))
    return reduce(DataFrame.unionByName, parts)


def set_issue(members: DataFrame, rule: Rule) -> DataFrame:
    """Issue row for a rule whose affected records are the rows of ``members``."""
    counted = members.agg(F.lit(rule.issue_id).alias("issue_id"), F.count(F.lit(1)).alias("affected"))
    return _issues(counted, {rule.issue_id: rule})


def domain_rules(channels: Sequence[str] = CHANNELS) -> list[Rule]:
    """Allowed values, mandatory fields and positive amounts of the five tables."""
    enum = lambda i, t, c, allowed: Rule(f"DQ_ENUM_{i:03d}", t, c, f"rows with an undeclared {c}", outside(c, allowed), INVALID_ENUM)
    need = lambda i, t, c, check=BAD_DATE: Rule(f"DQ_MISS_{i:03d}", t, c, f"rows without {c}", missing(c), check)
    return [
        need(1, "users", "channel", MISSING_CHANNEL), need(2, "users", "region", MISSING_REGION),
        enum(1, "users", "channel", channels), enum(2, "users", "device_os", DEVICES), enum(3, "users", "age_band", AGE_BANDS),
        enum(4, "onboarding_events", "event_name", EVENT_NAMES), need(3, "onboarding_events", "event_time"),
        enum(5, "kyc_cases", "decision", DECISIONS), enum(6, "kyc_cases", "failure_reason", FAILURE_REASONS),
        need(4, "kyc_cases", "submitted_time"), need(5, "kyc_cases", "decision_time"),
        Rule("DQ_ORDER_001", "kyc_cases", "decision_time", "decisions before their submission",
             F.col("decision_time") < F.col("submitted_time"), LOGIC),
        enum(7, "transactions", "category", CATEGORIES), enum(8, "transactions", "status", STATUSES),
        Rule("DQ_RANGE_001", "transactions", "amount", "transactions without a positive amount", F.col("amount") <= 0, INVALID_ENUM),
        enum(9, "support_tickets", "topic", TOPICS),
    ]


def duplicate_identifiers(df: DataFrame, identifier: str, entity: str = "user_id") -> DataFrame:
    """Identifiers shared by several entities, with their number."""
    return (df.where(F.col(identifier).isNotNull()).groupBy(identifier)
            .agg(F.count_distinct(entity).alias("entities")).where(F.col("entities") > 1))


def duplicate_issues(df: DataFrame, identifier: str, table: str) -> DataFrame:
    """One issue per shared identifier."""
    check, severity, impact, usage = DUPLICATE
    return duplicate_identifiers(df, identifier).select(
        F.concat(F.lit(f"DQ_DUP_{identifier}_"), F.col(identifier)).alias("issue_id"), F.lit(check).alias("check_type"),
        F.lit(table).alias("table_name"), F.lit(identifier).alias("column_name"),
        F.concat_ws(" ", F.lit(f"{identifier}"), F.col(identifier), F.lit("belongs to several users")).alias("issue_description"),
        F.col("entities").alias("affected_records"), F.lit(severity).alias("severity"), F.lit(impact).alias("impact_weight"),
        F.col("entities").alias("frequency"), F.lit(usage).alias("downstream_usage_score"))


def labelled_duplicates(df: DataFrame, table: str = "data_quality_issues", identifier: str = "email") -> DataFrame:
    """One issue per row that an earlier process labelled as a duplicate identifier; the label is taken as given."""
    check, severity, impact, usage = DUPLICATE
    return df.where(F.col("issue_type") == check).select(
        "issue_id", F.lit(check).alias("check_type"), F.lit(table).alias("table_name"), F.lit(identifier).alias("column_name"),
        F.concat_ws(" ", F.lit(identifier), F.col(identifier), F.lit("labelled as shared by several users")).alias("issue_description"),
        F.lit(1).cast("long").alias("affected_records"), F.lit(severity).alias("severity"), F.lit(impact).alias("impact_weight"),
        F.lit(1).cast("long").alias("frequency"), F.lit(usage).alias("downstream_usage_score"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def conflicting_decisions(kyc: DataFrame) -> DataFrame:
    """Users with an approved and a rejected case; two flags per user, no list of cases."""
    both = kyc.groupBy("user_id").agg(
        F.max(F.when(F.col("decision") == "approved", 1).otherwise(0)).alias("a"),
        F.max(F.when(F.col("decision") == "rejected", 1).otherwise(0)).alias("r"))
    return both.where((F.col("a") == 1) & (F.col("r") == 1)).select("user_id")


def events_before_signup(users: DataFrame, rows: DataFrame, time: str) -> DataFrame:
    """Users with a row before their sign-up and how many, from per-user, per-time counts."""
    packed = rows.groupBy("user_id", time).agg(F.count(F.lit(1)).alias("n"))
    owned = spread_join(packed, users.select("user_id", "created_at"), "user_id", time)
    early = owned.where(F.col(time) < F.col("created_at"))
    return early.groupBy("user_id").agg(F.sum("n").alias("n"))


def missing_prerequisite(events: DataFrame, later: str, earlier: str) -> DataFrame:
    return reached_but_not(events, later, earlier)


def success_without_account(transactions: DataFrame, events: DataFrame) -> DataFrame:
    """Users with a successful transaction but no account event."""
    paid = transactions.where(F.col("status") == "success").select("user_id").distinct()
    return paid.join(events.where(F.col("event_name") == "account_created").select("user_id").distinct(), "user_id", "left_anti")


def orphans(child: DataFrame, parent: DataFrame, key: str = "user_id") -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with their rows; keys are grouped before the join."""
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(key).distinct(), key, "left_anti")


def out_of_order(stages: Sequence[str] = STAGES) -> Column:
    """On a stage-time frame: some reached stage lies before an earlier stage."""
    bad, latest = F.lit(False), F.col(f"t_{stages[0]}")
    for stage in stages[1:]:
        now = F.col(f"t_{stage}")
        bad = bad | F.coalesce(now < latest, F.lit(False))
        latest = F.greatest(latest, now)
    return bad


def stages_out_of_order(events: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Users whose stage times decrease somewhere along the stages they reached."""
    return stage_times(events, stages).where(out_of_order(stages)).select("user_id")


def future_rows(df: DataFrame, time: str, now: Column) -> DataFrame:
    return df.where(F.col(time) > now)


def stage_rules() -> list[Rule]:
    """Rules on the stage-time frame of a user."""
    has = lambda s: F.col(f"t_{s}").isNotNull()
    rule = lambda i, c, text, bad: Rule(i, "onboarding_events", c, text, bad, LOGIC)
    return [
        rule("DQ_LOGIC_001", "event_name", "users transacted without an account", has("first_transaction") & ~has("account_created")),
        rule("DQ_LOGIC_002", "event_name", "users approved without verification", has("kyc_approved") & ~has("verification_submitted")),
        rule("DQ_ORDER_002", "event_time", "users with stages out of order", out_of_order()),
    ]


def logic_issues(tables: Tables) -> DataFrame:
    """Issue rows of the rules that need more than one row or table.

    The events are read once, into a stored row per user and event name that the stage rules, the repeated pairs and
    the accounts of payers share.
    """
    pairs = materialize(tables.events.groupBy("user_id", "event_name").agg(
        F.max("event_time").alias("event_time"), F.count(F.lit(1)).alias("n")))
    rule = lambda i, t, c, text, check=LOGIC: Rule(i, t, c, text, F.lit(True), check)
    found = [
        run_rules({"onboarding_events": stage_times(pairs, STAGES)}, stage_rules()),
        set_issue(success_without_account(tables.transactions, pairs),
                  rule("DQ_LOGIC_003", "transactions", "user_id", "users paid without an account event")),
        set_issue(conflicting_decisions(tables.kyc),
                  rule("DQ_LOGIC_004", "kyc_cases", "decision", "users both approved and rejected")),
        set_issue(orphans(tables.tickets, tables.users),
                  rule("DQ_REF_001", "support_tickets", "user_id", "ticket owners missing from users")),
        set_issue(repeated_keys(tables.users, ["user_id"]),
                  rule("DQ_DUP_001", "users", "user_id", "user ids occur more than once", DUPLICATE)),
        set_issue(pairs.where("n > 1"),
                  rule("DQ_DUP_002", "onboarding_events", "event_name", "user and event pairs occur more than once", DUPLICATE)),
    ]
    return reduce(DataFrame.unionByName, found)


def triage(issues: DataFrame) -> DataFrame:
    """Score (impact x capped frequency x usage, highest = 100), priority and advice per issue.

    The checks run once: their issues are written before the maximum is taken.
    """
    raw = materialize(issues).withColumn("raw", F.col("impact_weight") * F.least(F.col("frequency"), F.lit(100)) / 100 * F.col("downstream_usage_score"))
    top = raw.agg(F.max("raw")).scalar()
    score = F.when(top > 0, F.bround(F.col("raw") / top * 100, 1)).otherwise(F.col("raw"))
    scored = raw.withColumn("triage_score", score).drop("raw")
    return scored.withColumn("priority", priority(F.col("triage_score"))).withColumn("recommendation", recommendation(F.col("check_type")))


def priority(score: Column) -> Column:
    return ladder(score, PRIORITIES, LOWEST_PRIORITY)


def recommendation(check_type: Column) -> Column:
    advice = F.create_map(*[F.lit(x) for pair in RECOMMENDATIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(advice, check_type), F.lit(DEFAULT_RECOMMENDATION))


def priority_counts(report: DataFrame) -> DataFrame:
    """Issues per priority; priorities without issues show zero."""
    names = [name for _, name in PRIORITIES] + [LOWEST_PRIORITY]
    wide = report.agg(*[F.count_if(F.col("priority") == n).alias(n) for n in names])
    return wide.unpivot([], names, "priority", "n")


def top_issues(report: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` highest scores; the issue id decides ties."""
    return report.orderBy(F.col("triage_score").desc(), "issue_id").limit(k).select(
        "issue_id", title_text(F.col("check_type")).alias("check"), "table_name", "column_name", "triage_score",
        "priority", "recommendation")


def dq_score(issues: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Share of unaffected records per table with issues, against the target; NULL for a table that is not given."""
    totals = reduce(DataFrame.unionByName, [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("total")) for name, df in tables.items()])
    affected = issues.groupBy("table_name").agg(F.sum("affected_records").alias("affected"))
    score = F.when(F.col("total") > 0, (F.col("total") - F.col("affected")) / F.col("total") * 100).when(F.col("total") == 0, 100.0)
    return affected.join(totals, "table_name", "left").select(
        "table_name", "affected", "total", F.round(score, 2).alias("dq_score"), (score >= SCORE_TARGET).cast("int").alias("meets_target"))


