"""SQL for data quality and time allocation."""

from __future__ import annotations

from .base import CALENDAR, COMMERCE, IDENTITIES, JOURNEYS, LIFECYCLES

# Fixed values in this module: allowed values, weights and advice, which must equal the published ones.
_ALLOWED = "('paid_social','referral','organic','paid_search')"
_CHANNELS = "('paid_social','referral','organic','paid_search','partnership')"
_BAD_DATE = "created_at IS NOT NULL AND TRY_CAST(created_at AS TIMESTAMP) IS NULL"

_IDENTITY_COUNTS = f"""
 SELECT 'DQ_MISS_101' AS issue_id, COUNT(*) FILTER (channel IS NULL) AS affected FROM identities
 UNION ALL SELECT 'DQ_MISS_102', COUNT(*) FILTER (region IS NULL) FROM identities
 UNION ALL SELECT 'DQ_ENUM_101', COUNT(*) FILTER (channel NOT IN {_CHANNELS}) FROM identities
 UNION ALL SELECT 'DQ_DATE_101', COUNT(*) FILTER ({_BAD_DATE}) FROM identities"""



def _spoil(table, number, changes):
    """A table in which every k-th row has another value in a column."""
    replaced = ", ".join(f"CASE WHEN {number} % {k} = 0 THEN {value} ELSE {c} END AS {c}" for c, (k, value) in changes.items())
    return f", dirty AS (SELECT * REPLACE ({replaced}) FROM {table}) "


def _number(column):
    return f"CAST(regexp_extract({column}, '([0-9]+)', 1) AS BIGINT)"


_DIRTY_CASES = _spoil("kyc_cases", _number("case_id"), {
    "decision": (11, "'undeclared'"), "failure_reason": (13, "'undeclared'"), "submitted_time": (17, "NULL"), "decision_time": (19, "NULL")})
_DIRTY_TRANSACTIONS = _spoil("transactions", _number("txn_id"), {"category": (11, "'undeclared'"), "status": (13, "'undeclared'"), "amount": (17, "-amount")})
_DIRTY_EVENTS = _spoil("onboarding_events", "(epoch_us(event_time) // 1000000)", {"event_name": (11, "'undeclared'"), "event_time": (13, "NULL")})
_DIRTY_TICKETS = _spoil("support_tickets", _number("ticket_id"), {"topic": (11, "'undeclared'")})

_IDENT_CTE = "identities AS (" + IDENTITIES.split("identities AS (", 1)[1]
_JI = JOURNEYS + ",\n" + _IDENT_CTE

# Every issue of the journey run: id, check, table, column, severity, impact, usage, affected.
_ISSUES = _JI + f""", per_stage AS (
  SELECT user_id, COUNT(*) FILTER (event_name = 'account_created') AS acc, COUNT(*) FILTER (event_name = 'first_transaction') AS txn,
         COUNT(*) FILTER (event_name = 'kyc_approved') AS kyc, COUNT(*) FILTER (event_name = 'verification_submitted') AS ver
  FROM onboarding_events GROUP BY user_id),
stage_at AS (
  SELECT user_id, CASE event_name WHEN 'app_install' THEN 1 WHEN 'registration_start' THEN 2 WHEN 'verification_submitted' THEN 3
         WHEN 'kyc_approved' THEN 4 WHEN 'account_created' THEN 5 WHEN 'first_funding' THEN 6 WHEN 'first_transaction' THEN 7
         WHEN 'week1_active' THEN 8 END AS o, MAX(event_time) AS t
  FROM onboarding_events WHERE event_name <> 'kyc_failed' GROUP BY 1, 2),
raw_issues AS (
  SELECT 'DQ_ENUM_001' AS issue_id, 'invalid_enum' AS check_type, 'users' AS table_name, 'channel' AS column_name, 'HIGH' AS severity,
         8 AS impact_weight, 9 AS downstream_usage_score, 'rows with an undeclared channel' AS txt,
         (SELECT COUNT(*) FROM users WHERE channel NOT IN {_ALLOWED}) AS n
  UNION ALL SELECT 'DQ_LOGIC_001', 'business_logic_violation', 'onboarding_events', 'event_name', 'HIGH', 9, 8, 'users transacted without an account',
         (SELECT COUNT(*) FROM per_stage WHERE txn > 0 AND acc = 0)
  UNION ALL SELECT 'DQ_LOGIC_002', 'business_logic_violation', 'onboarding_events', 'event_name', 'HIGH', 9, 8, 'users approved without verification',
         (SELECT COUNT(*) FROM per_stage WHERE kyc > 0 AND ver = 0)
  UNION ALL SELECT 'DQ_LOGIC_003', 'business_logic_violation', 'transactions', 'user_id', 'HIGH', 9, 8, 'users paid without an account event',
         (SELECT COUNT(DISTINCT user_id) FROM transactions WHERE status = 'success'
            AND user_id NOT IN (SELECT user_id FROM onboarding_events WHERE event_name = 'account_created'))
  UNION ALL SELECT 'DQ_LOGIC_004', 'business_logic_violation', 'kyc_cases', 'decision', 'HIGH', 9, 8, 'users both approved and rejected',
         (SELECT COUNT(*) FROM (SELECT user_id FROM kyc_cases GROUP BY user_id HAVING COUNT(DISTINCT decision) > 1))
  UNION ALL SELECT 'DQ_ORDER_002', 'business_logic_violation', 'onboarding_events', 'event_time', 'HIGH', 9, 8, 'users with stages out of order',
         (SELECT COUNT(DISTINCT a.user_id) FROM stage_at a JOIN stage_at b ON a.user_id = b.user_id AND a.o < b.o AND a.t > b.t)
  UNION ALL SELECT 'DQ_DUP_002', 'duplicate_identifier', 'onboarding_events', 'event_name', 'HIGH', 9, 10, 'user and event pairs occur more than once',
         (SELECT COUNT(*) FROM (SELECT 1 FROM onboarding_events GROUP BY user_id, event_name HAVING COUNT(*) > 1))
  UNION ALL SELECT 'DQ_ORDER_001', 'business_logic_violation', 'kyc_cases', 'decision_time', 'HIGH', 9, 8, 'decisions before their submission',
         (SELECT COUNT(*) FROM kyc_cases WHERE decision_time < submitted_time)
  UNION ALL SELECT 'DQ_RANGE_001', 'invalid_enum', 'transactions', 'amount', 'HIGH', 8, 9, 'transactions without a positive amount',
         (SELECT COUNT(*) FROM transactions WHERE amount <= 0)
  UNION ALL SELECT 'DQ_MISS_101', 'missing_field', 'identities', 'channel', 'MEDIUM', 6, 8, 'rows without channel', (SELECT COUNT(*) FROM identities WHERE channel IS NULL)
  UNION ALL SELECT 'DQ_MISS_102', 'missing_field', 'identities', 'region', 'MEDIUM', 5, 7, 'rows without region', (SELECT COUNT(*) FROM identities WHERE region IS NULL)
  UNION ALL SELECT 'DQ_ENUM_101', 'invalid_enum', 'identities', 'channel', 'HIGH', 8, 9, 'rows with an undeclared channel',
         (SELECT COUNT(*) FROM identities WHERE channel NOT IN {_CHANNELS})
  UNION ALL SELECT 'DQ_DATE_101', 'date_format_error', 'identities', 'created_at', 'CRITICAL', 10, 10, 'timestamps that do not parse',
         (SELECT COUNT(*) FROM identities WHERE {_BAD_DATE})),
issues AS (
  SELECT issue_id, check_type, table_name, column_name, n || ' ' || txt AS issue_description, n AS affected_records, severity,
         impact_weight, n AS frequency, downstream_usage_score FROM raw_issues WHERE n > 0
  UNION ALL SELECT 'DQ_DUP_email_' || email, 'duplicate_identifier', 'identities', 'email', 'email ' || email || ' belongs to several users',
         COUNT(DISTINCT user_id), 'HIGH', 9, COUNT(DISTINCT user_id), 10 FROM identities GROUP BY email HAVING COUNT(DISTINCT user_id) > 1),
scored AS (
  SELECT *, impact_weight * LEAST(frequency, 100) / 100 * downstream_usage_score AS raw FROM issues),
rep AS (
  SELECT *, round_even(raw / MAX(raw) OVER () * 100, 1) AS triage_score FROM scored),
report AS (
  SELECT *, CASE WHEN triage_score >= 75 THEN 'P0_CRITICAL' WHEN triage_score >= 50 THEN 'P1_HIGH' WHEN triage_score >= 25 THEN 'P2_MEDIUM' ELSE 'P3_LOW' END AS priority,
    CASE check_type WHEN 'duplicate_identifier' THEN 'Deduplicate records, add unique constraint, investigate root cause in signup flow'
      WHEN 'missing_field' THEN 'Make field required in UI/API, backfill missing values where possible'
      WHEN 'invalid_enum' THEN 'Add validation at ingestion, standardize existing values, document allowed values'
      WHEN 'date_format_error' THEN 'Parse and reformat to ISO 8601, fix upstream data sources'
      WHEN 'business_logic_violation' THEN 'Add application-layer checks, investigate how state was reached'
      ELSE 'Investigate and remediate based on impact' END AS recommendation FROM rep)"""

_LOAD = """, s AS (SELECT SUM(duration_hours) AS a, SUM(duration_hours) FILTER (category IN ('deep_work', 'documentation')) AS v,
    SUM(duration_hours) FILTER (category = 'stakeholder_meetings') AS m, SUM(duration_hours) FILTER (category = 'training') AS t FROM calendar_events)"""
_ALLOC = """, al AS (SELECT category, SUM(duration_hours) AS h, round_even(SUM(duration_hours) / (SELECT SUM(duration_hours) FROM calendar_events) * 100, 1) AS p
    FROM calendar_events GROUP BY category)"""

SQL = {
    "quality_duplicate_identifiers": f"{IDENTITIES} SELECT email, COUNT(DISTINCT user_id) AS entities FROM identities GROUP BY email HAVING COUNT(DISTINCT user_id) > 1",
    "quality_labelled_duplicates": f"""{IDENTITIES} SELECT 'DQ' || user_id AS issue_id, 'email ' || email || ' labelled as shared by several users' AS issue_description,
      100.0::DOUBLE AS triage_score, 'P0_CRITICAL' AS priority FROM identities WHERE CAST(user_id AS BIGINT) >= 1000""",
    "quality_duplicate_phones": f"{IDENTITIES} SELECT phone_number, COUNT(DISTINCT user_id) AS entities FROM identities GROUP BY phone_number HAVING COUNT(DISTINCT user_id) > 1",
    "quality_identity_rules": IDENTITIES + _IDENTITY_COUNTS,
    "quality_user_rules": f"""{JOURNEYS} SELECT 'DQ_MISS_001' AS issue_id, COUNT(*) FILTER (channel IS NULL) AS affected FROM users
      UNION ALL SELECT 'DQ_MISS_002', COUNT(*) FILTER (region IS NULL) FROM users
      UNION ALL SELECT 'DQ_ENUM_001', COUNT(*) FILTER (channel NOT IN {_ALLOWED}) FROM users
      UNION ALL SELECT 'DQ_ENUM_002', COUNT(*) FILTER (device_os NOT IN ('iOS', 'Android', 'Web')) FROM users
      UNION ALL SELECT 'DQ_ENUM_003', COUNT(*) FILTER (age_band NOT IN ('18-24', '25-34', '35-44', '45-54', '55+')) FROM users""",
    "quality_kyc_rules": f"""{COMMERCE}{_DIRTY_CASES} SELECT 'DQ_ENUM_005' AS issue_id, COUNT(*) FILTER (decision NOT IN ('approved', 'rejected')) AS affected FROM dirty
      UNION ALL SELECT 'DQ_ENUM_006', COUNT(*) FILTER (failure_reason NOT IN ('document_quality', 'identity_mismatch', 'age_restriction', 'duplicate_account', 'watchlist_hit')) FROM dirty
      UNION ALL SELECT 'DQ_MISS_004', COUNT(*) FILTER (submitted_time IS NULL) FROM dirty
      UNION ALL SELECT 'DQ_MISS_005', COUNT(*) FILTER (decision_time IS NULL) FROM dirty
      UNION ALL SELECT 'DQ_ORDER_001', COUNT(*) FILTER (decision_time < submitted_time) FROM dirty""",
    "quality_transaction_rules": f"""{COMMERCE}{_DIRTY_TRANSACTIONS} SELECT 'DQ_ENUM_007' AS issue_id,
        COUNT(*) FILTER (category NOT IN ('transfer', 'bill_payment', 'mobile_topup', 'purchase', 'withdrawal')) AS affected FROM dirty
      UNION ALL SELECT 'DQ_ENUM_008', COUNT(*) FILTER (status NOT IN ('success', 'failed', 'pending')) FROM dirty
      UNION ALL SELECT 'DQ_RANGE_001', COUNT(*) FILTER (amount <= 0) FROM dirty""",
    "quality_event_rules": f"""{JOURNEYS}{_DIRTY_EVENTS} SELECT 'DQ_ENUM_004' AS issue_id, COUNT(*) FILTER (event_name NOT IN ('app_install', 'registration_start',
        'verification_submitted', 'kyc_approved', 'kyc_failed', 'account_created', 'first_funding', 'first_transaction', 'week1_active')) AS affected FROM dirty
      UNION ALL SELECT 'DQ_MISS_003', COUNT(*) FILTER (event_time IS NULL) FROM dirty""",
    "quality_ticket_rules": f"""{COMMERCE}{_DIRTY_TICKETS} SELECT 'DQ_ENUM_009' AS issue_id, COUNT(*) FILTER (topic NOT IN ('kyc_delay', 'transaction_failed', 'login_issue',
        'card_request', 'account_question', 'technical_bug', 'fraud_concern')) AS affected FROM dirty""",
    "quality_repeated_users": f"""{IDENTITIES} SELECT user_id, COUNT(*) AS n FROM (SELECT user_id FROM identities
      UNION ALL SELECT user_id FROM identities WHERE CAST(user_id AS BIGINT) % 23 = 0) GROUP BY user_id HAVING COUNT(*) > 1""",
    "quality_transactions_without_account": f"""{JOURNEYS} SELECT DISTINCT user_id FROM onboarding_events a WHERE event_name = 'first_transaction'
      AND NOT EXISTS (SELECT 1 FROM onboarding_events b WHERE b.user_id = a.user_id AND b.event_name = 'account_created')""",
    "quality_repeated_user_events": f"{JOURNEYS} SELECT user_id, event_name, COUNT(*) AS n FROM onboarding_events GROUP BY ALL HAVING COUNT(*) > 1",
    "quality_conflicting_decisions": f"{COMMERCE} SELECT user_id FROM kyc_cases GROUP BY user_id HAVING COUNT(DISTINCT decision) > 1",
    "quality_rows_before_signup": f"""{COMMERCE} SELECT user_id, COUNT(*) AS n FROM transactions JOIN users USING (user_id)
      WHERE txn_time < created_at GROUP BY user_id""",
    "quality_approved_without_verification": f"""{JOURNEYS} SELECT user_id FROM onboarding_events WHERE event_name = 'kyc_approved'
      EXCEPT SELECT user_id FROM onboarding_events WHERE event_name = 'verification_submitted'""",
    "quality_paid_without_account": f"""{JOURNEYS} SELECT user_id FROM transactions WHERE status = 'success'
      EXCEPT SELECT user_id FROM onboarding_events WHERE event_name = 'account_created'""",
    "quality_orphans": f"""{COMMERCE} SELECT user_id, COUNT(*) AS n FROM support_tickets
      WHERE user_id NOT IN (SELECT user_id FROM users WHERE CAST(user_id AS BIGINT) % 7 <> 0) GROUP BY user_id""",
    "quality_stages_out_of_order": f"""{LIFECYCLES}, s AS (
        SELECT user_id, CASE event_name WHEN 'registration_start' THEN 2 WHEN 'verification_submitted' THEN 3 WHEN 'kyc_approved' THEN 4
               WHEN 'account_created' THEN 5 WHEN 'first_funding' THEN 6 WHEN 'first_transaction' THEN 7 WHEN 'week1_active' THEN 8 END AS o,
               MAX(event_time) AS t FROM onboarding_events GROUP BY 1, 2)
      SELECT DISTINCT a.user_id FROM s a JOIN s b ON a.user_id = b.user_id AND a.o < b.o AND a.t > b.t""",
    "quality_future_events": f"""{JOURNEYS}, mid AS (SELECT CAST((MIN(epoch_us(event_time)) + MAX(epoch_us(event_time))) // 2 AS BIGINT) AS m FROM onboarding_events)
      SELECT event_name, COUNT(*) AS n FROM onboarding_events, mid WHERE epoch_us(event_time) > m GROUP BY event_name""",
    "quality_clean_report": f"""{IDENTITIES}, c AS ({_IDENTITY_COUNTS}) SELECT 'clean' AS rows, 0 AS issues UNION ALL
      SELECT 'all', COUNT(*) FILTER (affected > 0) FROM c""",
    "quality_issues": _ISSUES + " SELECT * FROM issues",
    "quality_triage": _ISSUES + " SELECT issue_id, triage_score, priority, recommendation FROM report",
    "quality_priority_counts": _ISSUES + """ SELECT p AS priority, (SELECT COUNT(*) FROM report WHERE priority = p) AS n
      FROM (VALUES ('P0_CRITICAL'), ('P1_HIGH'), ('P2_MEDIUM'), ('P3_LOW')) v(p)""",
    "quality_top_issues": _ISSUES + """, top AS (SELECT * FROM report ORDER BY triage_score DESC, issue_id LIMIT 5)
      SELECT issue_id, CASE check_type WHEN 'duplicate_identifier' THEN 'Duplicate Identifier' WHEN 'missing_field' THEN 'Missing Field'
        WHEN 'invalid_enum' THEN 'Invalid Enum' WHEN 'date_format_error' THEN 'Date Format Error' ELSE 'Business Logic Violation' END AS "check",
        table_name, column_name, triage_score, priority, recommendation FROM top""",
    "quality_scores": _ISSUES + """, totals AS (
        SELECT 'users' AS table_name, COUNT(*) AS total FROM users UNION ALL SELECT 'onboarding_events', COUNT(*) FROM onboarding_events
        UNION ALL SELECT 'kyc_cases', COUNT(*) FROM kyc_cases UNION ALL SELECT 'transactions', COUNT(*) FROM transactions
        UNION ALL SELECT 'support_tickets', COUNT(*) FROM support_tickets UNION ALL SELECT 'identities', COUNT(*) FROM identities),
      af AS (SELECT table_name, CAST(SUM(affected_records) AS BIGINT) AS affected FROM issues GROUP BY table_name)
      SELECT table_name, affected, total, ROUND((total - affected)::DOUBLE / total * 100, 2) AS dq_score,
             CAST((total - affected)::DOUBLE / total * 100 >= 99.5 AS INTEGER) AS meets_target FROM af JOIN totals USING (table_name)""",
    "time_allocation": CALENDAR + _ALLOC + " SELECT category, ROUND(h, 2) AS total_hours, p AS percentage FROM al",
    "time_load_summary": CALENDAR + _LOAD + """ SELECT ROUND(a, 2) AS total_hours, ROUND(a / 90 * 7 / 5, 4) AS hours_per_workday,
      ROUND(v, 2) AS value_add_hours, ROUND(v / a * 100, 4) AS value_add_pct, ROUND(m / a * 100, 4) AS meeting_pct,
      ROUND(m / 90 * 7, 4) AS meeting_hours_per_week, CASE WHEN m / a * 100 > 35 THEN 'high' WHEN m / a * 100 < 20 THEN 'low' ELSE 'healthy' END AS meeting_verdict,
      ROUND(t / a * 100, 4) AS training_pct, CASE WHEN t / a * 100 < 5 THEN 'low' WHEN t / a * 100 > 15 THEN 'high' ELSE 'balanced' END AS training_verdict FROM s""",
    "time_dominant_category": CALENDAR + _ALLOC + """ SELECT CASE category WHEN 'deep_work' THEN 'Deep Work' WHEN 'stakeholder_meetings' THEN 'Stakeholder Meetings'
      WHEN 'training' THEN 'Training' WHEN 'admin' THEN 'Admin' ELSE 'Documentation' END AS category, ROUND(h, 2) AS total_hours, p AS percentage
      FROM (SELECT * FROM al ORDER BY h DESC, category LIMIT 1)""",
    "time_targets_gap": CALENDAR + _ALLOC + """, tg AS (SELECT category, tgt::DOUBLE AS tgt, lo::DOUBLE AS lo, hi::DOUBLE AS hi FROM (VALUES
        ('deep_work', 40, 35, 45), ('stakeholder_meetings', 30, 25, 35), ('training', 12, 10, 15), ('admin', 12, 10, 15),
        ('documentation', 6, 5, 10)) v(category, tgt, lo, hi))
      SELECT category, p AS percentage, tgt AS target, lo AS target_low, hi AS target_high, ROUND(p - tgt, 2) AS gap_pp,
             CAST(p BETWEEN lo AND hi AS INTEGER) AS in_range FROM al JOIN tg USING (category)""",
    "time_weekly": f"""{CALENDAR}, c AS (SELECT strftime(date_trunc('week', date), '%Y-%m-%d') AS week, category, SUM(duration_hours) AS h FROM calendar_events GROUP BY 1, 2)
      SELECT week, category, ROUND(h, 2) AS hours, ROUND(h / SUM(h) OVER (PARTITION BY week) * 100, 1) AS percentage FROM c""",
}
