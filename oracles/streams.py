"""SQL for the streaming runs."""

from __future__ import annotations

SQL = {
    "stream_stage_users": """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type AS event_name, COUNT(DISTINCT user_id) AS users
      FROM events WHERE event_type IN ('signup', 'view', 'click', 'purchase') GROUP BY ALL""",
    "stream_stage_changes": """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type AS event_name, COUNT(DISTINCT user_id) AS users
      FROM events WHERE event_type IN ('signup', 'view', 'click', 'purchase') GROUP BY ALL""",
    "stream_rule_counts": """SELECT 'DQ_ENUM_201' AS issue_id, COUNT(*) FILTER (event_type NOT IN ('signup', 'view', 'click', 'purchase')) AS affected FROM events
      UNION ALL SELECT 'DQ_MISS_201', COUNT(*) FILTER (ts IS NULL) FROM events""",
}
