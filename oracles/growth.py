"""SQL for the KPI catalogue, cohorts and experiments."""

from __future__ import annotations

from .base import COMMERCE, JOURNEYS, LIFECYCLES

_DAY = "86400000000"
_STAGES = {"s1_registered": "registration_start", "s2_verified": "verification_submitted", "s3_kyc_approved": "kyc_approved",
           "s4_account_created": "account_created", "s5_first_funding": "first_funding",
           "s6_first_transaction": "first_transaction", "s7_week1_active": "week1_active"}




def _hours(end, start):
    return f"(epoch_us({end}) - epoch_us({start})) / 3600000000.0::DOUBLE"


def _within(start, goal, days, dims, extra=""):
    cols = ", ".join(dims)
    return f"""{LIFECYCLES}, s AS (SELECT user_id, MIN(event_time) AS a FROM onboarding_events WHERE event_name = '{start}' GROUP BY user_id),
    g AS (SELECT user_id, MIN(event_time) AS b FROM onboarding_events WHERE event_name = '{goal}' GROUP BY user_id),
    r AS (SELECT {cols}, COUNT(*) FILTER (epoch_us(b) - epoch_us(a) <= {days} * {_DAY}) AS numerator, COUNT(*) AS denominator
          FROM s LEFT JOIN g USING (user_id) JOIN users USING (user_id)
          WHERE epoch_us((SELECT MAX(event_time) FROM onboarding_events)) - epoch_us(a) >= {days} * {_DAY} GROUP BY {cols})
    SELECT *, ROUND(100.0 * numerator / NULLIF(denominator, 0), 4) AS value {extra} FROM r"""


def _n(stage):
    return f"COUNT(DISTINCT CASE WHEN e.event_name = '{stage}' THEN e.user_id END)"


def _cohorts(base, fmt):
    counts = ", ".join(f"COUNT(DISTINCT e{i}.user_id) AS {c}" for i, c in enumerate(_STAGES) if i)
    joins = " ".join(f"LEFT JOIN onboarding_events e{i} ON e{i}.user_id = e0.user_id AND e{i}.event_name = '{s}'"
                     for i, s in enumerate(_STAGES.values()) if i)
    pcts = ", ".join(f"round_even({c}::DOUBLE / s1_registered * 100, 1) AS {c}_pct" for c in list(_STAGES)[1:])
    return f"""{base}, c0 AS (
      SELECT strftime(e0.event_time, '{fmt}') AS cohort, COUNT(DISTINCT e0.user_id) AS s1_registered, {counts}
      FROM (SELECT DISTINCT user_id, event_time FROM onboarding_events WHERE event_name = 'registration_start') e0 {joins} GROUP BY 1),
    rates AS (SELECT *, {pcts}, round_even(s6_first_transaction::DOUBLE / s1_registered * 100, 1) AS activation_of_registered,
      round_even(s7_week1_active::DOUBLE / NULLIF(s6_first_transaction, 0) * 100, 1) AS week1_ret_of_actv FROM c0)"""


def _channel_cohorts(fmt):
    return f"""{LIFECYCLES}, cc0 AS (
      SELECT channel, strftime(r.event_time, '{fmt}') AS cohort, COUNT(DISTINCT r.user_id) AS registered,
             COUNT(DISTINCT t.user_id) AS activated, COUNT(DISTINCT w.user_id) AS week1_retained
      FROM users JOIN onboarding_events r ON r.user_id = users.user_id AND r.event_name = 'registration_start'
      LEFT JOIN onboarding_events t ON t.user_id = users.user_id AND t.event_name = 'first_transaction'
      LEFT JOIN onboarding_events w ON w.user_id = users.user_id AND w.event_name = 'week1_active'
      GROUP BY 1, 2),
    cc AS (SELECT *, round_even(activated::DOUBLE / registered * 100, 1) AS activation_of_registered,
                  round_even(week1_retained::DOUBLE / NULLIF(activated, 0) * 100, 1) AS retention_rate FROM cc0)"""


_GROUPS = f"""{LIFECYCLES}, counted AS (
  SELECT channel, COUNT(DISTINCT users.user_id) AS n_users, {_n('verification_submitted')} AS n_verified, {_n('kyc_approved')} AS n_kyc_approved,
         {_n('first_transaction')} AS n_activated, {_n('week1_active')} AS n_week1
  FROM users LEFT JOIN onboarding_events e ON e.user_id = users.user_id GROUP BY channel),
gm AS (SELECT *, n_kyc_approved::DOUBLE / n_users AS kyc_rate, n_activated::DOUBLE / n_users AS activation_of_registered,
              n_week1::DOUBLE / NULLIF(n_activated, 0) AS retention_rate FROM counted)"""

_PAIRS = _GROUPS + """, ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY n_users DESC, channel) AS i FROM gm),
pr AS (SELECT a.channel AS group_a, b.channel AS group_b, a.n_users AS n_a, b.n_users AS n_b,
              a.activation_of_registered AS pa, b.activation_of_registered AS pb,
              (a.n_activated + b.n_activated)::DOUBLE / (a.n_users + b.n_users) AS pp
       FROM ranked a JOIN ranked b ON a.i < b.i)"""

_CHI = _GROUPS + """, cells AS (
  SELECT channel, s, GREATEST(o, 1)::DOUBLE AS o FROM (
    SELECT channel, 'v' AS s, n_verified AS o FROM gm UNION ALL SELECT channel, 'k', n_kyc_approved FROM gm
    UNION ALL SELECT channel, 'a', n_activated FROM gm UNION ALL SELECT channel, 'w', n_week1 FROM gm)),
rt AS (SELECT channel, SUM(o) AS r FROM cells GROUP BY channel), ct AS (SELECT s, SUM(o) AS c FROM cells GROUP BY s),
nt AS (SELECT SUM(o) AS n FROM cells),
x AS (SELECT SUM((o - r * c / n) * (o - r * c / n) / (r * c / n)) AS chi2 FROM cells JOIN rt USING (channel) JOIN ct USING (s), nt),
xx AS (SELECT chi2, ((SELECT COUNT(*) FROM rt) - 1) * ((SELECT COUNT(*) FROM ct) - 1) AS dof,
              SQRT(chi2 / (n * (LEAST((SELECT COUNT(*) FROM rt), (SELECT COUNT(*) FROM ct)) - 1))) AS v FROM x, nt)
SELECT ROUND(chi2, 6) AS chi2, dof, ROUND(v, 6) AS cramers_v,
       CASE WHEN v > 0.3 THEN 'strong' WHEN v > 0.1 THEN 'moderate' ELSE 'weak' END AS strength FROM xx"""

# Two-sided normal tails by Simpson's rule over [|z|, |z| + 10].
_TESTS = _PAIRS + """, zs AS (SELECT *, (pa - pb) / SQRT(pp * (1 - pp) * (1.0 / n_a + 1.0 / n_b)) AS z FROM pr),
tail AS (SELECT group_a, group_b, SUM(CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
           * EXP(-POW(ABS(z) + i * 0.0025::DOUBLE, 2) / 2)) * 0.0025::DOUBLE / 3 * 2 / SQRT(2 * PI()) AS p
         FROM zs, range(4001) r(i) GROUP BY group_a, group_b),
ts0 AS (SELECT zs.*, round_even(p, 6) AS p_value, (SELECT COUNT(*) FROM pr) AS m FROM zs JOIN tail USING (group_a, group_b)),
ts AS (SELECT group_a, group_b, n_a, n_b, round_even(pa, 4) AS rate_a, round_even(pb, 4) AS rate_b, round_even(pa - pb, 4) AS diff,
              round_even(z, 4) AS z_stat, p_value, round_even(ABS(2 * (ASIN(SQRT(pa)) - ASIN(SQRT(pb)))), 4) AS cohen_h,
              p_value < 0.05 AS sig_raw, p_value < 0.05::DOUBLE / m AS sig_bonferroni FROM ts0)"""

# The chi-square tail for 12 degrees of freedom has a closed form.
_CHI_TAIL = "WITH st AS (" + _CHI + """), k AS (SELECT chi2, dof, cramers_v, strength, chi2 / 2 AS h FROM st)
SELECT chi2, dof, cramers_v, strength, ROUND(EXP(-h) * (1 + h + POW(h, 2) / 2 + POW(h, 3) / 6 + POW(h, 4) / 24 + POW(h, 5) / 120), 6) AS p_value FROM k"""

_POWER = _GROUPS + """, b AS (SELECT AVG(activation_of_registered) AS p, MIN(n_users) AS s FROM gm),
arms AS (SELECT DISTINCT arm FROM (SELECT UNNEST([500, 1000, 2000]) AS arm UNION ALL SELECT s FROM b)),
g AS (SELECT arm, p, 0.005::DOUBLE + i * ((0.08::DOUBLE - 0.005::DOUBLE) / 199) AS mde FROM arms, b, range(200) r(i)),
zz AS (SELECT arm, mde, mde / SQRT(2 * p * (1 - p) / arm) - 1.959963984540054 AS z FROM g),
cdf AS (SELECT arm, mde, z, 0.5 + SIGN(z) * SUM(CASE WHEN i = 0 OR i = 400 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
          * EXP(-POW(ABS(z) * i / 400.0::DOUBLE, 2) / 2)) * ABS(z) / 400 / 3 / SQRT(2 * PI()) AS c FROM zz, range(401) r(i) GROUP BY arm, mde, z)
SELECT arm AS n_per_arm, ROUND(mde, 8) AS mde, ROUND(z, 6) AS z_power, ROUND(c, 6) AS power FROM cdf"""



def _share(start, goal, days, where="TRUE"):
    """Conversion within a window over journeys whose window has closed, as a scalar subquery."""
    return f"""(SELECT 100.0 * COUNT(*) FILTER (epoch_us(b) - epoch_us(a) <= {days} * {_DAY}) / NULLIF(COUNT(*), 0)
      FROM (SELECT user_id, MIN(event_time) AS a FROM onboarding_events WHERE event_name = '{start}' GROUP BY user_id) s
      LEFT JOIN (SELECT user_id, MIN(event_time) AS b FROM onboarding_events WHERE event_name = '{goal}' GROUP BY user_id) g USING (user_id)
      JOIN users USING (user_id)
      WHERE epoch_us((SELECT MAX(event_time) FROM onboarding_events)) - epoch_us(a) >= {days} * {_DAY} AND {where})"""


def _users_at(stage):
    return f"(SELECT COUNT(DISTINCT user_id) FROM onboarding_events WHERE event_name = '{stage}')"


_REPORT = [
    ("onboarding_completion_rate", "7 days from registration_start", "Product Analytics Team", _share("registration_start", "kyc_approved", 7)),
    ("activation_rate", "14 days from account_created", "Growth Team", _share("account_created", "first_transaction", 14)),
    ("week1_retention_proxy", "7 days from first_transaction", "Retention Team", f"(100.0 * {_users_at('week1_active')} / {_users_at('first_transaction')})"),
    ("median_kyc_turnaround_time", "Per KYC case", "Operations Team", f"(SELECT MEDIAN(ROUND({_hours('decision_time', 'submitted_time')}, 6)) FROM kyc_cases)"),
    ("kyc_failure_rate", "Per submission", "Risk & Compliance Team", "(SELECT 100.0 * COUNT(*) FILTER (decision = 'rejected') / COUNT(*) FROM kyc_cases)"),
    ("ticket_rate_per_1000_users", "Lifetime or specified cohort period", "Customer Support Team", "(1000.0 * (SELECT COUNT(*) FROM support_tickets) / (SELECT COUNT(*) FROM users))"),
    ("median_time_to_first_transaction", "Per user who transacts", "Product Analytics Team", f"""(SELECT MEDIAN(ROUND({_hours('b', 'a')}, 6)) FROM (
        SELECT MIN(event_time) FILTER (event_name = 'account_created') AS a, MIN(event_time) FILTER (event_name = 'first_transaction') AS b
        FROM onboarding_events GROUP BY user_id) x WHERE a IS NOT NULL AND b IS NOT NULL)"""),
    ("funding_success_rate", "Per funding attempt", "Payments Team", "(SELECT 100.0 * COUNT(*) FILTER (event_value = 'success') / COUNT(event_value) FROM onboarding_events WHERE event_name = 'first_funding')"),
    ("txn_success_rate", "Rolling 7-day, 30-day, or all-time", "Payments Team", "(SELECT 100.0 * COUNT(*) FILTER (status = 'success') / COUNT(*) FROM transactions)"),
    ("dropout_rate_at_verification", "30 days from registration_start", "Product Team", f"(100.0 - {_share('registration_start', 'verification_submitted', 30)})"),
    ("account_creation_rate", "7 days from kyc_approved", "Engineering Team", _share("kyc_approved", "account_created", 7)),
    ("conversion_paid_social_vs_referral", "Same period for both channels", "Marketing Team",
     "(" + _share("account_created", "first_transaction", 14, "channel = 'paid_social'") + " / "
     + _share("account_created", "first_transaction", 14, "channel = 'referral'") + ")"),
    ("avg_transaction_value", "Rolling 30-day or per cohort", "Finance Team", "(SELECT AVG(amount) FROM transactions WHERE status = 'success')"),
]

SQL = {
    "kpi_report": JOURNEYS + " " + " UNION ALL ".join(
        f"SELECT '{name}' AS kpi_name, '{window}' AS time_window, '{owner}' AS owner, ROUND({value}::DOUBLE, 4) AS value" for name, window, owner, value in _REPORT),
    "kpi_onboarding_completion": _within("registration_start", "kyc_approved", 7, ["channel", "device_os"]),
    "kpi_activation": _within("account_created", "first_transaction", 14, ["channel"]),
    "kpi_retention_by_cohort": f"""{LIFECYCLES}, r AS (
        SELECT channel, strftime(created_at, '%Y-%m') AS cohort_month, {_n('week1_active')} AS numerator, {_n('first_transaction')} AS denominator
        FROM users LEFT JOIN onboarding_events e USING (user_id) GROUP BY 1, 2)
      SELECT *, ROUND(100.0 * numerator / NULLIF(denominator, 0), 4) AS value FROM r""",
    "kpi_retained_by_activity": f"""{JOURNEYS}, s AS (
        SELECT user_id, MIN(event_time) AS t0 FROM onboarding_events WHERE event_name = 'first_transaction' GROUP BY user_id),
      tx AS (SELECT user_id, COUNT(*) AS n FROM s JOIN transactions USING (user_id)
             WHERE epoch_us(txn_time) - epoch_us(t0) BETWEEN 0 AND 7 * {_DAY} GROUP BY user_id),
      lg AS (SELECT s.user_id, COUNT(*) AS n FROM s JOIN onboarding_events e ON e.user_id = s.user_id AND e.event_name = 'app_install'
             WHERE epoch_us(event_time) - epoch_us(t0) BETWEEN 0 AND 7 * {_DAY} GROUP BY s.user_id),
      r AS (SELECT channel, COUNT(*) FILTER (COALESCE(tx.n, 0) >= 2 OR COALESCE(lg.n, 0) >= 3) AS numerator, COUNT(*) AS denominator
            FROM s JOIN users USING (user_id) LEFT JOIN tx USING (user_id) LEFT JOIN lg USING (user_id) GROUP BY channel)
      SELECT *, ROUND(100.0 * numerator / NULLIF(denominator, 0), 4) AS value FROM r""",
    "kpi_kyc_turnaround": f"""{COMMERCE}, h AS (SELECT decision, device_os, ROUND({_hours('decision_time', 'submitted_time')}, 6) AS h FROM kyc_cases)
      SELECT decision, device_os, ROUND(MEDIAN(h), 4) AS value, ROUND(quantile_cont(h, 0.9), 4) AS p90,
             CAST(quantile_cont(h, 0.9) < 48 AS INTEGER) AS within_sla FROM h GROUP BY decision, device_os""",
    "kpi_kyc_failure": f"""{COMMERCE} SELECT device_os, region, COUNT(*) FILTER (decision = 'rejected') AS numerator, COUNT(*) AS denominator,
        ROUND(100.0 * COUNT(*) FILTER (decision = 'rejected') / COUNT(*), 4) AS value FROM kyc_cases GROUP BY device_os, region""",
    "kpi_ticket_rate": f"""{JOURNEYS} SELECT channel, COUNT(DISTINCT ticket_id) AS numerator, COUNT(DISTINCT u.user_id) AS denominator,
        ROUND(1000.0 * COUNT(DISTINCT ticket_id) / COUNT(DISTINCT u.user_id), 4) AS value
      FROM users u LEFT JOIN support_tickets t ON t.user_id = u.user_id GROUP BY channel""",
    "kpi_ticket_rate_by_topic": f"""{JOURNEYS} SELECT topic, COUNT(*) AS numerator, (SELECT COUNT(*) FROM users) AS denominator,
        ROUND(1000.0 * COUNT(*) / (SELECT COUNT(*) FROM users), 4) AS value FROM support_tickets GROUP BY topic""",
    "kpi_ticket_rate_by_channel_topic": f"""{JOURNEYS}, n AS (SELECT channel, COUNT(*) AS denominator FROM users GROUP BY channel),
      c AS (SELECT channel, topic, COUNT(*) AS numerator FROM support_tickets JOIN users USING (user_id) GROUP BY channel, topic)
      SELECT c.channel, topic, numerator, denominator, ROUND(1000.0 * numerator / denominator, 4) AS value
      FROM c JOIN n ON c.channel IS NOT DISTINCT FROM n.channel""",
    "kpi_ticket_rate_by_tenure": f"""{COMMERCE}, u AS (
        SELECT user_id, CAST(FLOOR((epoch_us((SELECT MAX(event_time) FROM owner_events)) - epoch_us(created_at)) / {_DAY}.0 / 30) AS INTEGER) AS user_tenure FROM users)
      SELECT user_tenure, COUNT(DISTINCT ticket_id) AS numerator, COUNT(DISTINCT u.user_id) AS denominator,
        ROUND(1000.0 * COUNT(DISTINCT ticket_id) / COUNT(DISTINCT u.user_id), 4) AS value
      FROM u LEFT JOIN support_tickets t ON t.user_id = u.user_id GROUP BY user_tenure""",
    "kpi_time_to_first_transaction": f"""{LIFECYCLES}, p AS (
        SELECT user_id, MIN(event_time) FILTER (event_name = 'account_created') AS a, MIN(event_time) FILTER (event_name = 'first_transaction') AS b
        FROM onboarding_events GROUP BY user_id)
      SELECT channel, ROUND(MEDIAN(ROUND({_hours('b', 'a')}, 6)), 4) AS value FROM p JOIN users USING (user_id)
      WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY channel""",
    "kpi_funding_success": f"""{JOURNEYS} SELECT COUNT(*) FILTER (event_value = 'success') AS numerator, COUNT(event_value) AS denominator,
        ROUND(100.0 * COUNT(*) FILTER (event_value = 'success') / NULLIF(COUNT(event_value), 0), 4) AS value
      FROM onboarding_events WHERE event_name = 'first_funding'""",
    "kpi_transaction_success": f"""{COMMERCE} SELECT category, COUNT(*) FILTER (status = 'success') AS numerator, COUNT(*) AS denominator,
        ROUND(100.0 * COUNT(*) FILTER (status = 'success') / COUNT(*), 4) AS value FROM transactions GROUP BY category""",
    "kpi_transaction_success_7d": f"""{COMMERCE}, d AS (SELECT category, CAST(txn_time AS DATE) AS day, COUNT(*) FILTER (status = 'success') AS s, COUNT(*) AS n
        FROM transactions GROUP BY ALL)
      SELECT x.category, CAST(x.day AS VARCHAR) AS day, ROUND(100.0 * SUM(y.s) / SUM(y.n), 4) AS value
      FROM d x JOIN d y ON x.category = y.category AND y.day BETWEEN x.day - 6 AND x.day GROUP BY ALL""",
    "kpi_transaction_success_30d": f"""{COMMERCE}, d AS (SELECT CAST(txn_time AS DATE) AS day, COUNT(*) FILTER (status = 'success') AS s, COUNT(*) AS n
        FROM transactions GROUP BY ALL)
      SELECT CAST(x.day AS VARCHAR) AS day, ROUND(100.0 * SUM(y.s) / SUM(y.n), 4) AS value
      FROM d x JOIN d y ON y.day BETWEEN x.day - 29 AND x.day GROUP BY ALL""",
    # From the words of the numerator: registered, and no verification submitted within the window.
    "kpi_dropout_at_verification": f"""{LIFECYCLES}, s AS (SELECT user_id, MIN(event_time) AS a FROM onboarding_events WHERE event_name = 'registration_start' GROUP BY user_id),
      r AS (SELECT channel, device_os, COUNT(*) FILTER (NOT EXISTS (SELECT 1 FROM onboarding_events v WHERE v.user_id = s.user_id
                AND v.event_name = 'verification_submitted' AND epoch_us(v.event_time) - epoch_us(a) <= 30 * {_DAY})) AS numerator, COUNT(*) AS denominator
            FROM s JOIN users USING (user_id)
            WHERE epoch_us((SELECT MAX(event_time) FROM onboarding_events)) - epoch_us(a) >= 30 * {_DAY} GROUP BY channel, device_os)
      SELECT *, ROUND(100.0 * numerator / NULLIF(denominator, 0), 4) AS value FROM r""",
    "kpi_account_creation": _within("kyc_approved", "account_created", 7, ["channel"],
                                    ", CAST(ROUND(100.0 * numerator / NULLIF(denominator, 0), 4) < 95 AS INTEGER) AS alert"),
    "kpi_channel_ratio": f"""WITH rates AS ({_within('account_created', 'first_transaction', 14, ['channel'])}),
      v AS (SELECT (SELECT numerator::DOUBLE / denominator FROM rates WHERE channel = 'paid_social')
                   / (SELECT numerator::DOUBLE / denominator FROM rates WHERE channel = 'referral') AS x)
      SELECT ROUND(x, 4) AS value, CAST(ROUND(x, 4) BETWEEN 0.6 AND 0.8 AS INTEGER) AS in_target FROM v""",
    "kpi_average_transaction_value": f"""{COMMERCE} SELECT category, region, ROUND(AVG(amount), 4) AS value
      FROM transactions JOIN users USING (user_id) WHERE status = 'success' GROUP BY category, region""",
    "kpi_average_transaction_value_30d": f"""{COMMERCE}, d AS (SELECT CAST(txn_time AS DATE) AS day, SUM(amount) AS s, COUNT(amount) AS n
        FROM transactions WHERE status = 'success' GROUP BY ALL)
      SELECT CAST(x.day AS VARCHAR) AS day, ROUND(SUM(y.s) / SUM(y.n), 4) AS value
      FROM d x JOIN d y ON y.day BETWEEN x.day - 29 AND x.day GROUP BY ALL""",
    "cohort_funnel_monthly": _cohorts(LIFECYCLES, "%Y-%m") + " SELECT * FROM rates",
    "cohort_funnel_daily_journeys": _cohorts(JOURNEYS, "%Y-%m-%d") + " SELECT * FROM rates",
    "cohort_by_channel": _channel_cohorts("%Y-%m") + " SELECT * FROM cc",
    "cohort_channel_grid": _channel_cohorts("%Y") + " SELECT channel, " + ", ".join(
        f"MAX(activation_of_registered) FILTER (cohort = '{y}') AS \"{y}\"" for y in range(1995, 2002)) + " FROM cc GROUP BY channel",
    "cohort_activation_trend": _cohorts(LIFECYCLES, "%Y-%m") + """,
      t AS (SELECT (ROW_NUMBER() OVER (ORDER BY cohort) - 1)::DOUBLE AS x,
                   COALESCE(activation_of_registered, AVG(activation_of_registered) OVER ()) AS y FROM rates)
      SELECT ROUND(regr_slope(y, x), 6) AS slope_pp_per_period, ROUND(regr_intercept(y, x), 6) AS intercept, ROUND(AVG(y), 6) AS mean_value,
             CASE WHEN regr_slope(y, x) > 0 THEN 'improving' ELSE 'declining' END AS direction FROM t""",
    "cohort_best_worst_channel": _channel_cohorts("%Y-%m") + """,
      mr AS (SELECT channel, AVG(activation_of_registered) AS r FROM cc GROUP BY channel)
      SELECT (SELECT channel FROM mr ORDER BY r DESC, channel LIMIT 1) AS best, ROUND(MAX(r), 4) AS best_rate,
             (SELECT channel FROM mr ORDER BY r, channel LIMIT 1) AS worst, ROUND(MIN(r), 4) AS worst_rate FROM mr""",
    "cohort_stage_matrix": _cohorts(LIFECYCLES, "%Y-%m") + " " + " UNION ALL ".join(
        f"SELECT '{c}_pct' AS stage, cohort, {c}_pct AS pct FROM rates" for c in list(_STAGES)[1:]),
    "cohort_headline": _cohorts(LIFECYCLES, "%Y-%m") + """ SELECT COUNT(*) AS cohorts, ROUND(AVG(activation_of_registered), 4) AS avg_activation,
      ROUND(AVG(week1_ret_of_actv), 4) AS avg_week1_retention FROM rates""",
    "experiment_group_metrics": _GROUPS + """ SELECT channel, n_users, n_verified, n_kyc_approved, n_activated, n_week1, ROUND(kyc_rate, 6) AS kyc_rate,
      ROUND(activation_of_registered, 6) AS activation_of_registered, ROUND(retention_rate, 6) AS retention_rate FROM gm""",
    "experiment_pairwise_z": _PAIRS + """ SELECT group_a, group_b, n_a, n_b, round_even(pa, 4) AS rate_a, round_even(pb, 4) AS rate_b,
      round_even(pa - pb, 4) AS diff, ROUND((pa - pb) / SQRT(pp * (1 - pp) * (1.0 / n_a + 1.0 / n_b)), 4) AS z,
      round_even(ABS(2 * (ASIN(SQRT(pa)) - ASIN(SQRT(pb)))), 4) AS cohen_h FROM pr""",
    "experiment_pairwise_tests": _TESTS + """ SELECT group_a, group_b, n_a, n_b, rate_a, rate_b, diff, z_stat, p_value, cohen_h, sig_raw, sig_bonferroni FROM ts""",
    "experiment_test_counts": _TESTS + """ SELECT COUNT(*) AS n_tests, COUNT(*) FILTER (sig_raw) AS n_sig_raw, COUNT(*) FILTER (sig_bonferroni) AS n_sig_bonferroni,
      MAX(cohen_h) AS max_h, (SELECT group_a || ' vs ' || group_b AS x FROM ts ORDER BY cohen_h DESC, x LIMIT 1) AS max_h_pair FROM ts""",
    "experiment_test_display": _TESTS + """ SELECT group_a, group_b, round_even(rate_a * 100, 1) AS rate_a_pct, round_even(rate_b * 100, 1) AS rate_b_pct,
      round_even(diff * 100, 1) AS diff_pp, round_even(cohen_h, 3) AS cohen_h, CASE WHEN p_value < 0.001 THEN printf('%.2e', p_value) ELSE printf('%.4f', p_value) END AS p_value,
      sig_bonferroni AS significant FROM ts""",
    "experiment_p_value_matrix": _TESTS + """, mk AS (SELECT group_a, group_b, p_value, CASE WHEN sig_bonferroni THEN '**' WHEN p_value < 0.05 THEN '*' ELSE '' END AS mark FROM ts)
      SELECT * FROM mk UNION ALL SELECT group_b, group_a, p_value, mark FROM mk UNION ALL SELECT channel, channel, NULL, '' FROM gm""",
    "experiment_chi_square_statistic": _CHI,
    "experiment_chi_square": _CHI_TAIL,
    "experiment_power_curve": _POWER,
    "experiment_sample_size": _GROUPS + """, b AS (SELECT AVG(activation_of_registered) AS p, MIN(n_users) AS smallest_arm FROM gm),
      k AS (SELECT p, smallest_arm, CAST(CEIL(2 * p * (1 - p) * POW(1.959963984540054 + 0.8416212335729143, 2) / 0.0004) AS BIGINT) AS n FROM b)
      SELECT ROUND(p, 6) AS baseline, n AS n_per_arm, smallest_arm, CAST(smallest_arm >= n AS INTEGER) AS powered FROM k""",
    "experiment_best_worst_gap": _GROUPS + """ SELECT (SELECT channel FROM gm ORDER BY activation_of_registered DESC, channel LIMIT 1) AS best,
      (SELECT channel FROM gm ORDER BY activation_of_registered, channel LIMIT 1) AS worst,
      ROUND((MAX(activation_of_registered) - MIN(activation_of_registered)) * 100, 4) AS gap_pp FROM gm""",
    "experiment_difference_intervals": _PAIRS + """, h AS (SELECT *, 1.959963984540054 * SQRT(pa * (1 - pa) / n_a + pb * (1 - pb) / n_b) AS w FROM pr)
      SELECT group_a, group_b, ROUND(pa - pb, 6) AS diff, ROUND(pa - pb - w, 6) AS low, ROUND(pa - pb + w, 6) AS high FROM h""",
    "experiment_weekly_balance": f"""{LIFECYCLES}, c AS (
        SELECT strftime(date_trunc('week', created_at), '%Y-%m-%d') AS week, channel, COUNT(*) AS n FROM users GROUP BY 1, 2),
      w AS (SELECT week, SUM(n) AS t, COUNT(*) AS k FROM c GROUP BY week)
      SELECT week, channel, n, ROUND(n::DOUBLE / t, 6) AS share, ROUND(n::DOUBLE / t - 1.0::DOUBLE / k, 6) AS imbalance,
             CAST(n >= 100 AS INTEGER) AS enough, CAST(ABS(n::DOUBLE / t - 1.0::DOUBLE / k) <= 0.05 AS INTEGER) AS balanced
      FROM c JOIN w USING (week)""",
}
