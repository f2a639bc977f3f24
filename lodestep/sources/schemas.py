"""Schemas of the logical tables and the values their columns may take."""

from __future__ import annotations

from pyspark.sql import types as T

# The domains the tables declare.
CHANNELS = ["paid_social", "referral", "organic", "paid_search", "partnership"]
DEVICES = ["iOS", "Android", "Web"]
AGE_BANDS = ["18-24", "25-34", "35-44", "45-54", "55+"]
STAGES = [
    "app_install", "registration_start", "verification_submitted", "kyc_approved",
    "account_created", "first_funding", "first_transaction", "week1_active",
]
EVENT_NAMES = [*STAGES, "kyc_failed"]
DECISIONS = ["approved", "rejected"]
FAILURE_REASONS = ["document_quality", "identity_mismatch", "age_restriction", "duplicate_account", "watchlist_hit"]
CATEGORIES = ["transfer", "bill_payment", "mobile_topup", "purchase", "withdrawal"]
STATUSES = ["success", "failed", "pending"]
TOPICS = ["kyc_delay", "transaction_failed", "login_issue", "card_request", "account_question", "technical_bug", "fraud_concern"]
TIME_CATEGORIES = ["deep_work", "stakeholder_meetings", "training", "admin", "documentation"]


def _struct(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _T, _D, _L = T.StringType(), T.TimestampType(), T.DoubleType(), T.LongType()

SCHEMAS = {
    "users": _struct(user_id=_S, created_at=_T, channel=_S, device_os=_S, region=_S, age_band=_S),
    "onboarding_events": _struct(event_id=_L, user_id=_S, event_time=_T, event_name=_S, event_value=_S, attempt_id=_S),
    "kyc_cases": _struct(case_id=_S, user_id=_S, submitted_time=_T, decision_time=_T, decision=_S,
                         failure_reason=_S, device_os=_S, region=_S),
    "transactions": _struct(txn_id=_S, user_id=_S, txn_time=_T, amount=_D, category=_S, status=_S),
    "support_tickets": _struct(ticket_id=_S, user_id=_S, created_time=_T, topic=_S, resolution_time_min=_D),
    # Dirty text on purpose: every column stays a string.
    "data_quality_issues": _struct(issue_id=_S, user_id=_S, phone_number=_S, email=_S, created_at=_S,
                                   channel=_S, device_os=_S, region=_S, issue_type=_S),
    "calendar_events": _struct(event_id=_S, date=T.DateType(), category=_S, duration_hours=_D, description=_S),
    "kpi_dictionary": _struct(kpi_name=_S, business_definition=_S, sql_definition=_S, numerator=_S, denominator=_S,
                              time_window=_S, segmentation_dimensions=_S, caveats_edge_cases=_S, owner=_S),
}

MAIN_TABLES = ["users", "onboarding_events", "kyc_cases", "transactions", "support_tickets"]

ISSUE_SCHEMA = _struct(
    issue_id=_S, check_type=_S, table_name=_S, column_name=_S, issue_description=_S, affected_records=_L,
    severity=_S, impact_weight=T.IntegerType(), frequency=_L, downstream_usage_score=T.IntegerType(),
)
REPORT_SCHEMA = T.StructType([*ISSUE_SCHEMA.fields, T.StructField("triage_score", _D), T.StructField("priority", _S)])
