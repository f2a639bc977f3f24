"""SQL for the funnel, operations and dashboard metrics."""

from __future__ import annotations

from .base import COMMERCE, JOURNEYS, LIFECYCLES

_STAGE8 = """(VALUES (1,'app_install'),(2,'registration_start'),(3,'verification_submitted'),(4,'kyc_approved'),
 (5,'account_created'),(6,'first_funding'),(7,'first_transaction'),(8,'week1_active')) AS s(stage_order, stage)"""
_STAGE7 = """(VALUES (1,'registration_start'),(2,'verification_submitted'),(3,'kyc_approved'),
 (4,'account_created'),(5,'first_funding'),(6,'first_transaction'),(7,'week1_active')) AS s(stage_order, stage)"""


def _funnel(base, stages=_STAGE8, source="onboarding_events"):
    return f"""{base}, counted AS (
      SELECT s.stage, s.stage_order, COUNT(DISTINCT e.user_id) AS users
      FROM {stages} LEFT JOIN {source} e ON e.event_name = s.stage GROUP BY s.stage, s.stage_order)"""


_RATES = """
 SELECT stage, CAST(stage_order AS INTEGER) AS stage_order, users,
        ROUND(100.0 * users / NULLIF(LAG(users) OVER (ORDER BY stage_order), 0), 2) AS conversion_from_previous,
        ROUND(100.0 * users / NULLIF(FIRST_VALUE(users) OVER (ORDER BY stage_order), 0), 2) AS conversion_from_start
 FROM counted"""
_STEPS = """
 SELECT stage, CAST(stage_order AS INTEGER) AS stage_order, users,
        CASE WHEN stage_order = 1 THEN 100.0::DOUBLE
             ELSE ROUND(100.0 * users / NULLIF(LAG(users) OVER (ORDER BY stage_order), 0), 2) END AS step_pct
 FROM counted"""


def _n(stage):
    return f"COUNT(DISTINCT CASE WHEN e.event_name = '{stage}' THEN e.user_id END)"


def _hours(end, start):
    return f"(epoch_us({end}) - epoch_us({start})) / 3600000000.0::DOUBLE"


def _time_to_stage(base):
    legs = [("registration_to_kyc", "t1", "t2"), ("kyc_to_first_transaction", "t2", "t3"),
            ("registration_to_first_transaction", "t1", "t3")]
    long = " UNION ALL ".join(f"SELECT '{name}' AS metric, ROUND({_hours(b, a)}, 2) AS h FROM st" for name, a, b in legs)
    return f"""{base}, st AS (
      SELECT user_id, MAX(event_time) FILTER (event_name = 'registration_start') AS t1,
             MAX(event_time) FILTER (event_name = 'kyc_approved') AS t2,
             MAX(event_time) FILTER (event_name = 'first_transaction') AS t3
      FROM onboarding_events GROUP BY user_id HAVING t2 IS NOT NULL),
    long AS ({long}),
    ranked AS (SELECT metric, h, ROW_NUMBER() OVER (PARTITION BY metric ORDER BY h) AS rn,
                      COUNT(*) OVER (PARTITION BY metric) AS n FROM long WHERE h IS NOT NULL)
    SELECT metric, ROUND(AVG(h), 1) AS avg_hours, MAX(CASE WHEN rn = n // 2 + 1 THEN h END) AS median_hours,
           MIN(h) AS min_hours, MAX(h) AS max_hours FROM ranked GROUP BY metric"""


_SLICED = JOURNEYS.replace("WITH\n", "WITH ", 1) + """,
su AS (SELECT * FROM users WHERE channel = 'referral' AND region = 'ASIA'),
se AS (SELECT * FROM onboarding_events WHERE user_id IN (SELECT user_id FROM su)),
sk AS (SELECT * FROM kyc_cases WHERE user_id IN (SELECT user_id FROM su)),
st AS (SELECT * FROM support_tickets WHERE user_id IN (SELECT user_id FROM su)),
sx AS (SELECT * FROM transactions WHERE user_id IN (SELECT user_id FROM su))"""


def _strip(base, users, events, kyc):
    return f"""{base}, c AS (
      SELECT {_n('account_created')} AS a, {_n('first_transaction')} AS t, {_n('week1_active')} AS w FROM {events} e)
    SELECT (SELECT COUNT(*) FROM {users}) AS total_users,
           ROUND(COALESCE(100.0 * t / NULLIF(a, 0), 0), 4) AS activation_of_account,
           ROUND((SELECT COALESCE(100.0 * COUNT(*) FILTER (decision = 'approved') / NULLIF(COUNT(*), 0), 0) FROM {kyc}), 4) AS kyc_approval_rate,
           ROUND(COALESCE(100.0 * w / NULLIF(t, 0), 0), 4) AS week1_retention
    FROM c"""


def _histogram(by=""):
    cols = "decision, " if by else ""
    return f"""{COMMERCE}, h AS (SELECT {cols} ROUND({_hours('decision_time', 'submitted_time')}, 6) AS x FROM kyc_cases),
    e AS (SELECT MIN(x) AS lo, MAX(x) AS hi, (MAX(x) - MIN(x)) / 30 AS w FROM h)
    SELECT {cols} CAST(LEAST(FLOOR((x - lo) / w), 29) AS INTEGER) AS bin,
           ROUND(lo + CAST(LEAST(FLOOR((x - lo) / w), 29) AS INTEGER) * w, 4) AS bin_start, COUNT(*) AS n
    FROM h, e GROUP BY {cols} bin, bin_start"""


SQL = {
    "source_csv_round_trip": f"""{COMMERCE} SELECT status, COUNT(*) AS n, ROUND(SUM(amount), 2) AS amount,
      strftime(MAX(txn_time), '%Y-%m-%d') AS last_day FROM transactions GROUP BY status""",
    "source_typed_load": f"""{COMMERCE} SELECT 'users' AS table_name, COUNT(*) AS row_count FROM users
      UNION ALL SELECT 'transactions', COUNT(*) FROM transactions UNION ALL SELECT 'support_tickets', COUNT(*) FROM support_tickets""",
    "source_stored_result": f"{COMMERCE} SELECT category, COUNT(*) AS total_transactions FROM transactions GROUP BY category",
    "source_row_counts": f"""{JOURNEYS} SELECT 'users' AS table_name, COUNT(*) AS row_count FROM users
      UNION ALL SELECT 'onboarding_events', COUNT(*) FROM onboarding_events
      UNION ALL SELECT 'kyc_cases', COUNT(*) FROM kyc_cases
      UNION ALL SELECT 'transactions', COUNT(*) FROM transactions
      UNION ALL SELECT 'support_tickets', COUNT(*) FROM support_tickets""",
    "stage_times": f"""{JOURNEYS} SELECT user_id,
        strftime(MAX(event_time) FILTER (event_name = 'registration_start'), '%Y-%m-%d %H:%M:%S') AS t_registration_start,
        strftime(MAX(event_time) FILTER (event_name = 'first_transaction'), '%Y-%m-%d %H:%M:%S') AS t_first_transaction,
        strftime(MIN(event_time), '%Y-%m-%d %H:%M:%S') AS first_event
      FROM onboarding_events GROUP BY user_id""",
    "funnel_overall": _funnel(JOURNEYS) + _RATES,
    "funnel_overall_lifecycles": _funnel(LIFECYCLES) + _RATES,
    "funnel_counts": _funnel(JOURNEYS, _STAGE7) + _STEPS,
    "funnel_wide": f"""{LIFECYCLES} SELECT {', '.join(_n(s) + ' AS ' + s for s in
      ['registration_start', 'verification_submitted', 'kyc_approved', 'account_created', 'first_funding', 'first_transaction', 'week1_active'])}
      FROM onboarding_events e""",
    "funnel_by_channel": f"""{JOURNEYS}, g AS (
        SELECT channel, NULLIF({_n('registration_start')}, 0) AS registration_start, NULLIF({_n('kyc_approved')}, 0) AS kyc_approved,
               NULLIF({_n('first_transaction')}, 0) AS first_transaction, NULLIF({_n('week1_active')}, 0) AS week1_active
        FROM onboarding_events e JOIN users USING (user_id)
        WHERE event_name IN ('registration_start', 'kyc_approved', 'first_transaction', 'week1_active') GROUP BY channel)
      SELECT *, ROUND(100.0 * kyc_approved / registration_start, 2) AS kyc_approval_rate,
             ROUND(100.0 * first_transaction / kyc_approved, 2) AS activation_of_kyc FROM g""",
    "funnel_by_channel_accounts": f"""{JOURNEYS}, g AS (
        SELECT channel, {_n('registration_start')} AS registration_start, {_n('verification_submitted')} AS verification_submitted,
               {_n('kyc_approved')} AS kyc_approved, {_n('account_created')} AS account_created,
               {_n('first_transaction')} AS first_transaction, {_n('week1_active')} AS week1_active
        FROM users LEFT JOIN onboarding_events e USING (user_id) GROUP BY channel)
      SELECT *, ROUND(first_transaction::DOUBLE / NULLIF(account_created, 0) * 100, 2) AS activation_of_account,
             ROUND(week1_active::DOUBLE / NULLIF(first_transaction, 0) * 100, 2) AS week1_retention FROM g""",
    "channel_performance": f"""{JOURNEYS}, g AS (
        SELECT channel, COUNT(DISTINCT users.user_id) AS users, {_n('registration_start')} AS r, {_n('kyc_approved')} AS k,
               {_n('first_transaction')} AS t, {_n('week1_active')} AS w
        FROM users LEFT JOIN onboarding_events e ON e.user_id = users.user_id GROUP BY channel)
      SELECT channel, users, ROUND(COALESCE(100.0 * k / NULLIF(r, 0), 0), 4) AS kyc_approval_rate,
             ROUND(COALESCE(100.0 * t / NULLIF(k, 0), 0), 4) AS activation_of_kyc,
             ROUND(COALESCE(100.0 * w / NULLIF(t, 0), 0), 4) AS week1_retention FROM g""",
    "time_to_stage": _time_to_stage(JOURNEYS),
    "time_to_stage_lifecycles": _time_to_stage(LIFECYCLES),
    "registration_to_verification_hours": f"""{JOURNEYS}, p AS (
        SELECT user_id, MAX(event_time) FILTER (event_name = 'registration_start') AS a,
               MAX(event_time) FILTER (event_name = 'verification_submitted') AS b FROM onboarding_events GROUP BY user_id)
      SELECT user_id, ROUND({_hours('b', 'a')}, 4) AS hours FROM p WHERE a IS NOT NULL AND b IS NOT NULL""",
    "week1_retention_by_channel": f"""{JOURNEYS}, g AS (
        SELECT channel, {_n('first_transaction')} AS activated_users, {_n('week1_active')} AS week1_active_users
        FROM users LEFT JOIN onboarding_events e USING (user_id) GROUP BY channel)
      SELECT *, ROUND(100.0 * week1_active_users / NULLIF(activated_users, 0), 2) AS week1_retention_rate FROM g""",
    "activation_14d": f"""{LIFECYCLES}, a AS (SELECT DISTINCT user_id, event_time FROM onboarding_events WHERE event_name = 'account_created'),
      f AS (SELECT user_id, MIN(event_time) AS event_time FROM onboarding_events WHERE event_name = 'first_transaction' GROUP BY user_id),
      c AS (SELECT COUNT(DISTINCT a.user_id) AS users_with_accounts, COUNT(DISTINCT f.user_id) AS users_with_transactions,
                   COUNT(DISTINCT CASE WHEN epoch_us(f.event_time) - epoch_us(a.event_time) <= 14 * 86400000000 THEN f.user_id END) AS activated_within_14d
            FROM a LEFT JOIN f USING (user_id))
      SELECT *, ROUND(100.0 * activated_within_14d / NULLIF(users_with_accounts, 0), 2) AS activation_14d FROM c""",
    "kyc_failures_by_device_region": f"""{COMMERCE} SELECT device_os, region, COUNT(*) AS total_cases,
        COUNT(*) FILTER (decision = 'approved') AS approved, COUNT(*) FILTER (decision = 'rejected') AS rejected,
        ROUND(100.0 * COUNT(*) FILTER (decision = 'rejected') / COUNT(*), 2) AS rejection_rate,
        string_agg(DISTINCT failure_reason, ',' ORDER BY failure_reason) AS failure_reasons
      FROM kyc_cases GROUP BY device_os, region HAVING COUNT(*) >= 10""",
    "tickets_per_1000_by_channel": f"""{JOURNEYS} SELECT channel, COUNT(DISTINCT u.user_id) AS total_users,
        COUNT(DISTINCT ticket_id) AS total_tickets, ROUND(1000.0 * COUNT(DISTINCT ticket_id) / COUNT(DISTINCT u.user_id), 2) AS tickets_per_1k_users,
        ROUND(AVG(resolution_time_min), 1) AS avg_resolution_time_min
      FROM users u LEFT JOIN support_tickets t ON t.user_id = u.user_id GROUP BY channel""",
    "tickets_by_topic": f"""{COMMERCE} SELECT topic, COUNT(*) AS ticket_count,
        ROUND(100.0 * COUNT(*) / (SELECT COUNT(*) FROM support_tickets), 2) AS pct_of_total,
        ROUND(AVG(resolution_time_min), 1) AS avg_resolution_min, ROUND(MIN(resolution_time_min), 1) AS min_resolution_min,
        ROUND(MAX(resolution_time_min), 1) AS max_resolution_min FROM support_tickets GROUP BY topic""",
    "transactions_by_category": f"""{COMMERCE} SELECT category, COUNT(*) AS total_transactions,
        COUNT(*) FILTER (status = 'success') AS successful, COUNT(*) FILTER (status = 'failed') AS failed,
        COUNT(*) FILTER (status = 'pending') AS pending,
        ROUND(100.0 * COUNT(*) FILTER (status = 'success') / COUNT(*), 2) AS success_rate, ROUND(AVG(amount), 2) AS avg_amount
      FROM transactions GROUP BY category""",
    "kyc_turnaround_sla": f"""{JOURNEYS}, d AS (SELECT decision, ROUND({_hours('decision_time', 'submitted_time')}, 2) AS h FROM kyc_cases)
      SELECT decision, COUNT(*) AS cases, ROUND(AVG(h), 1) AS avg_hours, ROUND(MIN(h), 1) AS min_hours, ROUND(MAX(h), 1) AS max_hours,
        COUNT(*) FILTER (h <= 24) AS within_24h, COUNT(*) FILTER (h <= 48) AS within_48h,
        ROUND(100.0 * COUNT(*) FILTER (h <= 48) / COUNT(*), 2) AS pct_within_48h FROM d GROUP BY decision""",
    "kyc_summary": f"""{COMMERCE} SELECT COUNT(*) AS total_cases, COUNT(*) FILTER (decision = 'approved') AS approved,
        COUNT(*) FILTER (decision = 'rejected') AS rejected,
        ROUND(100.0 * COUNT(*) FILTER (decision = 'rejected') / COUNT(*), 2) AS rejection_rate,
        ROUND(AVG({_hours('decision_time', 'submitted_time')}), 1) AS avg_turnaround_hours FROM kyc_cases""",
    "kyc_by_channel": f"""{COMMERCE} SELECT channel, COUNT(*) AS total_cases, COUNT(*) FILTER (decision = 'approved') AS approved,
        ROUND(AVG({_hours('decision_time', 'submitted_time')}), 1) AS avg_turnaround_hours,
        ROUND(100.0 * COUNT(*) FILTER (decision = 'approved') / COUNT(*), 2) AS approval_rate
      FROM kyc_cases JOIN users USING (user_id) GROUP BY channel""",
    "transaction_summary": f"""{COMMERCE} SELECT COUNT(*) AS total_transactions, COUNT(*) FILTER (status = 'success') AS successful,
        ROUND(100.0 * COUNT(*) FILTER (status = 'success') / COUNT(*), 2) AS success_rate,
        ROUND(AVG(amount) FILTER (status = 'success'), 2) AS avg_amount FROM transactions""",
    "kpi_summary": f"""{JOURNEYS}, c AS (
        SELECT {_n('registration_start')} AS r, {_n('account_created')} AS a, {_n('first_transaction')} AS t, {_n('week1_active')} AS w
        FROM onboarding_events e),
      k AS (SELECT 100.0 * COUNT(*) FILTER (decision = 'approved') / COUNT(*) AS ap, 100.0 * COUNT(*) FILTER (decision = 'rejected') / COUNT(*) AS re,
                   AVG({_hours('decision_time', 'submitted_time')}) AS h, MEDIAN(ROUND({_hours('decision_time', 'submitted_time')}, 6)) AS med FROM kyc_cases),
      x AS (SELECT 100.0 * COUNT(*) FILTER (status = 'success') / COUNT(*) AS s FROM transactions),
      n AS (SELECT (SELECT COUNT(*) FROM users) AS u, (SELECT COUNT(*) FROM support_tickets) AS st),
      rows AS (
        SELECT 'total_users' AS kpi_name, u::DOUBLE AS value FROM n
        UNION ALL SELECT 'tickets_per_1k_users', 1000.0 * st / u FROM n
        UNION ALL SELECT 'registered_users', r::DOUBLE FROM c
        UNION ALL SELECT 'activation_of_account', 100.0 * t / a FROM c
        UNION ALL SELECT 'week1_retention_rate', 100.0 * w / t FROM c
        UNION ALL SELECT 'kyc_approval_rate', ap FROM k UNION ALL SELECT 'kyc_rejection_rate', re FROM k
        UNION ALL SELECT 'avg_kyc_turnaround_hours', h FROM k UNION ALL SELECT 'median_kyc_turnaround_hours', med FROM k
        UNION ALL SELECT 'transaction_success_rate', s FROM x)
      SELECT kpi_name, ROUND(value, 1) AS value FROM rows""",
    "volumes_by_month": f"""{COMMERCE}
        SELECT 'kyc_cases' AS source, strftime(submitted_time, '%Y-%m') AS period, COUNT(*) AS n FROM kyc_cases GROUP BY ALL
        UNION ALL SELECT 'support_tickets', strftime(created_time, '%Y-%m'), COUNT(*) FROM support_tickets GROUP BY ALL
        UNION ALL SELECT 'transactions', strftime(txn_time, '%Y-%m'), COUNT(*) FROM transactions GROUP BY ALL""",
    "transaction_amount_quantiles": f"""{COMMERCE} SELECT category, ROUND(quantile_cont(amount, 0.25), 4) AS p25,
        ROUND(quantile_cont(amount, 0.5), 4) AS p50, ROUND(quantile_cont(amount, 0.75), 4) AS p75,
        ROUND(quantile_cont(amount, 0.99), 4) AS p99 FROM transactions GROUP BY category""",
    "registrations_running": f"""{LIFECYCLES}, g AS (
        SELECT CAST(strftime(event_time, '%Y%m') AS INTEGER) AS month, COUNT(DISTINCT user_id) AS registrations
        FROM onboarding_events WHERE event_name = 'registration_start' GROUP BY 1)
      SELECT month, registrations, CAST(SUM(registrations) OVER (ORDER BY month) AS BIGINT) AS so_far FROM g""",
    "transacted_without_account": f"""{JOURNEYS}
      SELECT user_id FROM onboarding_events WHERE event_name = 'first_transaction'
      EXCEPT SELECT user_id FROM onboarding_events WHERE event_name = 'account_created'""",
    "slice_executive_strip": _strip(_SLICED, "su", "se", "sk"),
    "slice_funnel": _funnel(_SLICED, _STAGE7, "se") + _STEPS,
    "slice_all_executive_strip": _strip(JOURNEYS, "users", "onboarding_events", "kyc_cases"),
    "slice_kyc_turnaround": f"""{_SLICED}, h AS (SELECT ROUND({_hours('decision_time', 'submitted_time')}, 6) AS x FROM sk)
      SELECT ROUND(AVG(x), 4) AS mean, ROUND(MEDIAN(x), 4) AS median FROM h""",
    "slice_tickets": f"""{_SLICED} SELECT topic, COUNT(*) AS tickets, ROUND(AVG(resolution_time_min), 4) AS avg_resolution_min FROM st GROUP BY topic
      UNION ALL SELECT 'ALL', COUNT(*), ROUND(AVG(resolution_time_min), 4) FROM st""",
    "slice_transactions": f"""{_SLICED} SELECT COUNT(*) AS total_transactions,
        ROUND(100.0 * COUNT(*) FILTER (status = 'success') / NULLIF(COUNT(*), 0), 4) AS success_rate,
        ROUND(AVG(amount) FILTER (status = 'success'), 4) AS avg_success_amount FROM sx""",
    "slice_transactions_by_status": f"{_SLICED} SELECT category, status, COUNT(*) AS n FROM sx GROUP BY ALL",
    "insight_ratios": f"""{JOURNEYS} SELECT ROUND(100.0 * {_n('kyc_approved')} / NULLIF({_n('registration_start')}, 0), 4) AS registration_to_kyc,
        ROUND(100.0 * {_n('first_transaction')} / NULLIF({_n('account_created')}, 0), 4) AS account_to_transaction FROM onboarding_events e""",
    "kyc_turnaround_histogram": _histogram(),
    "kyc_turnaround_histogram_by_decision": _histogram("decision"),
    "category_status_table": f"""{COMMERCE} SELECT category, COUNT(*) FILTER (status = 'success') AS success,
        COUNT(*) FILTER (status = 'failed') AS failed, COUNT(*) FILTER (status = 'pending') AS pending FROM transactions GROUP BY category""",
    "topic_frequency": f"{COMMERCE} SELECT topic, COUNT(*) AS n FROM support_tickets GROUP BY topic",
}
SQL["source_loaded_tables"] = SQL["source_cached_tables"] = SQL["source_snapshot_tables"] = SQL["source_row_counts"]
