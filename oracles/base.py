"""The table mappings again, as SQL common table expressions."""

from __future__ import annotations

_CUSTOMERS = """
cust AS (
  SELECT c_custkey AS custkey,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'paid_social' WHEN 'BUILDING' THEN 'referral'
              WHEN 'FURNITURE' THEN 'organic' WHEN 'HOUSEHOLD' THEN 'paid_search'
              WHEN 'MACHINERY' THEN 'partnership' END AS channel,
         CASE c_custkey % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END AS device_os,
         r_name AS region,
         CASE LEAST(GREATEST(CAST(FLOOR((c_acctbal + 1000) / 2200) AS BIGINT), 0), 4)
              WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44' WHEN 3 THEN '45-54' ELSE '55+' END AS age_band
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

_JOURNEY_ROWS = """
jrow AS (
  SELECT event_id, user_id AS custkey, user_id || '@' || strftime(ts, '%Y-%m-%d') AS user_id, ts, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events
)"""

_JOURNEY_EVENTS = """
onboarding_events AS (
  SELECT event_id, user_id, event_time, event_name,
         CASE WHEN event_name = 'first_funding' THEN
              CASE WHEN k % 10 < 7 THEN 'success' WHEN k % 10 < 9 THEN 'failed' END END AS event_value
  FROM (
    SELECT event_id, user_id, ts AS event_time, k,
           CASE WHEN event_type = 'signup' AND k < 50 THEN 'app_install'
                WHEN event_type = 'signup' THEN 'registration_start'
                WHEN event_type = 'view' AND k < 50 THEN 'verification_submitted'
                WHEN event_type = 'view' THEN 'kyc_approved'
                WHEN event_type = 'click' AND k < 50 THEN 'account_created'
                WHEN event_type = 'click' THEN 'first_funding'
                WHEN event_type = 'purchase' AND k < 50 THEN 'first_transaction'
                WHEN event_type = 'purchase' THEN 'week1_active'
                WHEN event_type = 'error' AND k < 50 THEN 'kyc_failed' END AS event_name
    FROM jrow) named
  WHERE event_name IS NOT NULL
)"""

JOURNEYS = "WITH" + _CUSTOMERS + "," + _JOURNEY_ROWS + """,
users AS (
  SELECT s.user_id, s.created_at, channel, device_os, region, age_band
  FROM (SELECT DISTINCT custkey, user_id, date_trunc('day', ts)::TIMESTAMP AS created_at FROM jrow) s
  JOIN cust USING (custkey)
  UNION ALL
  SELECT custkey || '@none', TIMESTAMP '2024-01-01', channel, device_os, region, age_band
  FROM cust WHERE custkey NOT IN (SELECT custkey FROM jrow)
),""" + _JOURNEY_EVENTS + """,
kyc_cases AS (
  SELECT CAST(event_id AS VARCHAR) AS case_id, user_id, ts AS submitted_time,
         ts + to_microseconds(CAST(round(value * 3.6e9) AS BIGINT)) AS decision_time,
         CASE WHEN k % 4 = 0 THEN 'rejected' ELSE 'approved' END AS decision,
         CASE WHEN k % 4 = 0 THEN CASE k % 5 WHEN 0 THEN 'document_quality' WHEN 1 THEN 'identity_mismatch'
              WHEN 2 THEN 'age_restriction' WHEN 3 THEN 'duplicate_account' ELSE 'watchlist_hit' END END AS failure_reason,
         device_os, region
  FROM jrow JOIN cust USING (custkey) WHERE event_type = 'view'
),
transactions AS (
  SELECT CAST(event_id AS VARCHAR) AS txn_id, user_id, ts AS txn_time, value AS amount,
         CASE k % 5 WHEN 0 THEN 'transfer' WHEN 1 THEN 'bill_payment' WHEN 2 THEN 'mobile_topup'
              WHEN 3 THEN 'purchase' ELSE 'withdrawal' END AS category,
         CASE WHEN k % 10 < 8 THEN 'success' WHEN k % 10 = 8 THEN 'failed' ELSE 'pending' END AS status
  FROM jrow WHERE event_type = 'purchase'
),
support_tickets AS (
  SELECT CAST(event_id AS VARCHAR) AS ticket_id, user_id, ts AS created_time,
         CASE k % 7 WHEN 0 THEN 'kyc_delay' WHEN 1 THEN 'transaction_failed' WHEN 2 THEN 'login_issue'
              WHEN 3 THEN 'card_request' WHEN 4 THEN 'account_question' WHEN 5 THEN 'technical_bug'
              ELSE 'fraud_concern' END AS topic,
         value AS resolution_time_min
  FROM jrow WHERE event_type = 'error'
)"""

COMMERCE = "WITH" + _CUSTOMERS + "," + _JOURNEY_ROWS + """,
users AS (
  SELECT CAST(custkey AS VARCHAR) AS user_id,
         TIMESTAMP '1995-01-01' + to_days(CAST(custkey % 2000 AS INTEGER)) AS created_at,
         channel, device_os, region, age_band FROM cust
),
transactions AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS txn_id, CAST(o_custkey AS VARCHAR) AS user_id, o_orderdate AS txn_time,
         o_totalprice AS amount,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'transfer' WHEN '2-HIGH' THEN 'bill_payment'
              WHEN '3-MEDIUM' THEN 'mobile_topup' WHEN '4-NOT SPECIFIED' THEN 'purchase'
              WHEN '5-LOW' THEN 'withdrawal' END AS category,
         CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'failed' WHEN 'P' THEN 'pending' END AS status
  FROM orders
),
kyc_cases AS (
  SELECT l_orderkey || '-' || l_linenumber AS case_id, CAST(o_custkey AS VARCHAR) AS user_id,
         o_orderdate AS submitted_time, l_shipdate AS decision_time,
         CASE WHEN l_returnflag = 'R' THEN 'rejected' ELSE 'approved' END AS decision,
         CASE WHEN l_returnflag = 'R' THEN CASE l_linestatus WHEN 'F' THEN 'document_quality'
              WHEN 'O' THEN 'identity_mismatch' END END AS failure_reason,
         device_os, region
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN cust ON o_custkey = custkey
),
support_tickets AS (
  SELECT CAST(event_id AS VARCHAR) AS ticket_id, CAST(custkey AS VARCHAR) AS user_id, ts AS created_time,
         CASE k % 7 WHEN 0 THEN 'kyc_delay' WHEN 1 THEN 'transaction_failed' WHEN 2 THEN 'login_issue'
              WHEN 3 THEN 'card_request' WHEN 4 THEN 'account_question' WHEN 5 THEN 'technical_bug'
              ELSE 'fraud_concern' END AS topic,
         value AS resolution_time_min
  FROM jrow WHERE event_type = 'error'
),
owner_events AS (
  SELECT event_id, split_part(user_id, '@', 1) AS user_id, event_time, event_name, event_value FROM (
    SELECT event_id, user_id, ts AS event_time,
           CASE WHEN event_type = 'signup' AND k < 50 THEN 'app_install'
                WHEN event_type = 'signup' THEN 'registration_start'
                WHEN event_type = 'view' AND k < 50 THEN 'verification_submitted'
                WHEN event_type = 'view' THEN 'kyc_approved'
                WHEN event_type = 'click' AND k < 50 THEN 'account_created'
                WHEN event_type = 'click' THEN 'first_funding'
                WHEN event_type = 'purchase' AND k < 50 THEN 'first_transaction'
                WHEN event_type = 'purchase' THEN 'week1_active'
                WHEN event_type = 'error' AND k < 50 THEN 'kyc_failed' END AS event_name,
           NULL AS event_value
    FROM jrow) n WHERE event_name IS NOT NULL
)"""

LIFECYCLES = """WITH
users AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS user_id, o_orderdate AS created_at,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'paid_social' WHEN '2-HIGH' THEN 'referral'
              WHEN '3-MEDIUM' THEN 'organic' WHEN '4-NOT SPECIFIED' THEN 'paid_search'
              WHEN '5-LOW' THEN 'partnership' END AS channel,
         CASE o_orderstatus WHEN 'O' THEN 'iOS' WHEN 'F' THEN 'Android' WHEN 'P' THEN 'Web' END AS device_os,
         'R' || (o_custkey % 5) AS region,
         CASE LEAST(CAST(FLOOR(o_totalprice / 100000) AS BIGINT), 4)
              WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44' WHEN 3 THEN '45-54' ELSE '55+' END AS age_band
  FROM orders
),
onboarding_events AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS user_id, l_shipdate AS event_time,
         CASE l_linenumber WHEN 1 THEN 'registration_start' WHEN 2 THEN 'verification_submitted'
              WHEN 3 THEN 'kyc_approved' WHEN 4 THEN 'account_created' WHEN 5 THEN 'first_funding'
              WHEN 6 THEN 'first_transaction' WHEN 7 THEN 'week1_active' END AS event_name
  FROM lineitem
)"""

CALENDAR = """WITH calendar_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS DATE) AS date,
         CASE event_type WHEN 'click' THEN 'deep_work' WHEN 'error' THEN 'stakeholder_meetings'
              WHEN 'purchase' THEN 'training' WHEN 'signup' THEN 'admin' WHEN 'view' THEN 'documentation' END AS category,
         value AS duration_hours
  FROM events
)"""

IDENTITIES = "WITH" + _CUSTOMERS + """,
identities AS (
  SELECT CAST(custkey AS VARCHAR) AS user_id, '+20-' || (custkey % 1200) AS phone_number,
         'u' || (custkey % 1000) || '@example.com' AS email,
         CASE WHEN custkey % 20 = 0 THEN strftime(TIMESTAMP '2024-01-01' + to_days(CAST(custkey % 300 AS INTEGER)), '%d/%m/%Y')
              ELSE strftime(TIMESTAMP '2024-01-01' + to_days(CAST(custkey % 300 AS INTEGER)), '%Y-%m-%d %H:%M:%S') END AS created_at,
         CASE WHEN custkey % 13 = 0 THEN NULL WHEN custkey % 17 = 0 THEN 'UNKNOWN_CHANNEL' ELSE channel END AS channel,
         device_os, CASE WHEN custkey % 19 <> 0 THEN region END AS region
  FROM cust
)"""
