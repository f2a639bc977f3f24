"""SQL for survival data and curves, features, score evaluation and segment profiles."""

from __future__ import annotations

from .base import COMMERCE, JOURNEYS, LIFECYCLES

_CHANNELS = ["paid_social", "referral", "organic", "paid_search", "partnership"]


def _h(end, start):
    return f"((epoch_us({end}) - epoch_us({start})) / 3600000000.0::DOUBLE)"


def _durations(base, per, limit):
    reached = _h("COALESCE(g.t, (SELECT x FROM last_goal))", "s.event_time")
    return f"""{base}, last_goal AS (SELECT MAX(e.event_time) AS x FROM onboarding_events e JOIN users USING (user_id)
      WHERE e.event_name = 'first_transaction' AND e.user_id IN (SELECT user_id FROM onboarding_events WHERE event_name = 'registration_start')),
    dur AS (
      SELECT u.*, s.event_time AS t_start, CASE WHEN g.t IS NULL THEN 0 ELSE 1 END AS event,
             LEAST(GREATEST({reached} / {per}, 0.01::DOUBLE), {limit}.0::DOUBLE) AS duration
      FROM (SELECT DISTINCT user_id, event_time FROM onboarding_events WHERE event_name = 'registration_start') s
      JOIN users u USING (user_id)
      LEFT JOIN (SELECT user_id, MAX(event_time) AS t FROM onboarding_events WHERE event_name = 'first_transaction' GROUP BY user_id) g USING (user_id))"""


_JD = _durations(JOURNEYS, "1.0", "24")
_LD = _durations(LIFECYCLES, "24.0", "90")

_CASES = """, cases AS (SELECT DISTINCT user_id, (epoch_us(decision_time) - epoch_us(submitted_time)) / 3600000000.0::DOUBLE AS kyc_turnaround_h,
    CASE WHEN failure_reason IS NULL THEN 0 ELSE 1 END AS kyc_had_failure FROM kyc_cases)"""


def _curve(base, by):
    return f"""{base}, lt AS (SELECT {by}, duration AS t, SUM(event) AS d, COUNT(*) AS m FROM dur GROUP BY 1, 2),
    ar AS (SELECT {by}, t, d, SUM(m) OVER (PARTITION BY {by} ORDER BY t DESC) AS n FROM lt),
    st AS (SELECT *, CASE WHEN d < n THEN LN(1 - d::DOUBLE / n) ELSE 0 END AS lg, CASE WHEN d = n THEN 1 ELSE 0 END AS fin,
                  CASE WHEN d < n THEN d::DOUBLE / (n * (n - d)::DOUBLE) ELSE 0 END AS vr FROM ar),
    cu AS (SELECT {by}, t, d, n, SUM(vr) OVER w AS vs,
                  CASE WHEN SUM(fin) OVER w > 0 THEN 0.0::DOUBLE ELSE EXP(SUM(lg) OVER w) END AS s
           FROM st WINDOW w AS (PARTITION BY {by} ORDER BY t))"""


_LC = _curve(_LD, "channel")

_TIMES = """, tm AS (SELECT user_id, MAX(event_time) FILTER (event_name = 'registration_start') AS r, MAX(event_time) FILTER (event_name = 'verification_submitted') AS v,
    MAX(event_time) FILTER (event_name = 'kyc_approved') AS k, MAX(event_time) FILTER (event_name = 'account_created') AS a,
    MAX(event_time) FILTER (event_name = 'first_funding') AS f, MAX(event_time) FILTER (event_name = 'first_transaction') AS x,
    MAX(event_time) FILTER (event_name = 'week1_active') AS w, COUNT(DISTINCT event_name) AS nev FROM onboarding_events GROUP BY user_id)"""
_KF = """, kf AS (SELECT user_id, (epoch_us(decision_time) - epoch_us(submitted_time)) / 3600000000.0::DOUBLE AS h,
    CASE WHEN failure_reason IS NULL THEN 0 ELSE 1 END AS fail, CASE WHEN decision = 'approved' THEN 1 ELSE 0 END AS appr FROM kyc_cases)"""

_LIFETIME = JOURNEYS + _TIMES + _KF + f""",
tx AS (SELECT user_id, COUNT(*) AS n, COUNT(*) FILTER (status = 'success') AS s, COUNT(*) FILTER (status = 'failed') AS f,
              AVG(amount) FILTER (status = 'success') AS am, COUNT(DISTINCT category) AS c FROM transactions GROUP BY user_id),
tk AS (SELECT user_id, COUNT(*) AS n, AVG(resolution_time_min) AS m FROM support_tickets GROUP BY user_id),
lf AS (SELECT u.user_id, channel, region, device_os, age_band, {_h('v', 'r')} AS h_reg_to_verify, {_h('k', 'v')} AS h_verify_to_kyc,
         {_h('x', 'k')} AS h_kyc_to_txn, {_h('tm.f', 'a')} AS h_account_to_fund, nev AS events_completed,
         COALESCE(tx.n, 0) AS n_transactions, COALESCE(s, 0) AS n_success, COALESCE(tx.f, 0) AS n_failed, COALESCE(am, 0) AS avg_amount,
         COALESCE(c, 0) AS n_categories, COALESCE(tk.n, 0) AS n_tickets, COALESCE(m, 0) AS avg_resolution_min,
         CASE WHEN w IS NULL THEN 1 ELSE 0 END AS churned, COALESCE(kf.h, 0) AS kyc_turnaround_h, COALESCE(fail, 0) AS kyc_had_failure, COALESCE(appr, 0) AS kyc_approved
       FROM users u JOIN tm USING (user_id) LEFT JOIN kf USING (user_id) LEFT JOIN tx USING (user_id) LEFT JOIN tk USING (user_id) WHERE x IS NOT NULL)"""

_ACT = JOURNEYS + _TIMES + _KF + f""",
ft AS (SELECT user_id, amount, CASE WHEN status = 'success' THEN 1 ELSE 0 END AS ok FROM transactions t
       WHERE txn_time = (SELECT MIN(txn_time) FROM transactions z WHERE z.user_id = t.user_id)),
pt AS (SELECT s.user_id, COUNT(*) AS n FROM support_tickets s JOIN tm USING (user_id) WHERE created_time <= x GROUP BY s.user_id),
af AS (SELECT u.user_id, channel, region, device_os, age_band, {_h('v', 'r')} AS h_reg_to_verify, {_h('k', 'v')} AS h_verify_to_kyc,
         {_h('a', 'k')} AS h_kyc_to_account, {_h('f', 'a')} AS h_account_to_fund, {_h('x', 'f')} AS h_fund_to_txn, {_h('x', 'r')} AS h_total_onboarding,
         COALESCE(amount, 0) AS first_txn_amount, COALESCE(ok, 0) AS first_txn_success, COALESCE(pt.n, 0) AS n_pre_tickets,
         CASE WHEN w IS NULL THEN 1 ELSE 0 END AS churned, COALESCE(kf.h, 0) AS kyc_turnaround_h, COALESCE(fail, 0) AS kyc_had_failure, COALESCE(appr, 0) AS kyc_approved
       FROM users u JOIN tm USING (user_id) LEFT JOIN kf USING (user_id) LEFT JOIN ft USING (user_id) LEFT JOIN pt USING (user_id) WHERE x IS NOT NULL)"""

_TIMING = ["h_reg_to_verify", "h_verify_to_kyc", "h_kyc_to_account", "h_account_to_fund", "h_fund_to_txn", "h_total_onboarding"]
_ACT_ROUNDED = [c for c in [*_TIMING, "first_txn_amount", "kyc_turnaround_h"]]


def _select(table, rounded, plain, places=4):
    return "SELECT " + ", ".join([*plain, *[f"ROUND({c}, {places}) AS {c}" for c in rounded]]) + f" FROM {table}"


_ORDERS = "WITH sc AS (SELECT o_orderkey AS user_id, o_totalprice / 500000 AS score, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders)"
_TIED = """WITH sc AS (SELECT event_id AS user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) / 100.0::DOUBLE AS score,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label FROM events)"""
_POINTS = """, c AS (SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg FROM sc GROUP BY score),
t AS (SELECT SUM(pos) AS p, SUM(neg) AS n FROM c),
r AS (SELECT score, pos, neg, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp FROM c WINDOW w AS (ORDER BY score DESC))"""
_RANKING = _POINTS + """ SELECT ROUND(SUM(pos * (n - fp + neg / 2.0::DOUBLE)) / (MAX(p)::DOUBLE * MAX(n)), 6) AS roc_auc,
  ROUND(SUM(pos::DOUBLE / p * tp / (tp + fp)), 6) AS average_precision FROM r, t"""
_CELLS = """, k AS (SELECT COUNT(*) FILTER (label = 1 AND score > 0.5)::DOUBLE AS tp, COUNT(*) FILTER (label = 0 AND score > 0.5)::DOUBLE AS fp,
  COUNT(*) FILTER (label = 1 AND score <= 0.5)::DOUBLE AS fn, COUNT(*) FILTER (label = 0 AND score <= 0.5)::DOUBLE AS tn FROM sc),
pr AS (SELECT 1 AS label, tp / NULLIF(tp + fp, 0) AS p, tp / NULLIF(tp + fn, 0) AS r, CAST(tp + fn AS BIGINT) AS support FROM k
       UNION ALL SELECT 0, tn / NULLIF(tn + fn, 0), tn / NULLIF(tn + fp, 0), CAST(tn + fp AS BIGINT) FROM k)
SELECT label, ROUND(COALESCE(p, 0), 6) AS precision, ROUND(COALESCE(r, 0), 6) AS recall, ROUND(COALESCE(2 * p * r / NULLIF(p + r, 0), 0), 6) AS f1, support FROM pr"""
_SWEEP = """, g AS (SELECT 0.1::DOUBLE + i * (0.9::DOUBLE - 0.1::DOUBLE) / 99 AS th FROM range(100) x(i)),
w AS (SELECT th, COUNT(*) FILTER (label = 1 AND score >= th) AS tp, COUNT(*) FILTER (label = 0 AND score >= th) AS fp,
             COUNT(*) FILTER (label = 1 AND score < th) AS fn FROM g, sc GROUP BY th),
pr AS (SELECT th, tp / (tp + fp + 1e-9::DOUBLE) AS p, tp / (tp + fn + 1e-9::DOUBLE) AS r FROM w),
sw AS (SELECT th AS threshold, p AS precision, r AS recall, 2 * p * r / (p + r + 1e-9::DOUBLE) AS f1 FROM pr)"""
_TIER = "CASE WHEN score > 0 AND score <= 0.4 THEN 'Low' WHEN score > 0.4 AND score <= 0.65 THEN 'Medium' WHEN score > 0.65 AND score <= 1 THEN 'High' END"


def _rfm(base, events):
    return f"""{base}, snap AS (SELECT MAX(txn_time) AS s FROM transactions),
    ts AS (SELECT user_id, {_h('(SELECT s FROM snap)', 'MAX(txn_time)')} / 24 AS recency_days, COUNT(*) AS frequency,
             SUM(CASE WHEN status = 'success' THEN amount ELSE 0 END) AS monetary, AVG(amount) FILTER (status = 'success') AS avg_txn_value,
             COUNT(DISTINCT category) AS n_categories, COUNT(*) FILTER (status = 'failed') AS n_failed_txns,
             COUNT(*) / GREATEST(1.0::DOUBLE, {_h('(SELECT s FROM snap)', 'MIN(txn_time)')} / 24) AS txn_rate_per_day FROM transactions GROUP BY user_id),
    ob AS (SELECT user_id, COUNT(DISTINCT event_name) AS events_count,
             {_h("MAX(event_time) FILTER (event_name = 'first_transaction')", 'MIN(event_time)')} AS hh FROM {events} GROUP BY user_id),
    sp AS (SELECT user_id, COUNT(*) AS n FROM support_tickets GROUP BY user_id),
    rf AS (SELECT u.user_id, channel, region, age_band, device_os, recency_days, frequency, monetary, avg_txn_value, n_categories, n_failed_txns,
             txn_rate_per_day, events_count, COALESCE(hh, 0) AS h_reg_to_first_txn, COALESCE(sp.n, 0) AS n_tickets
           FROM users u JOIN ts USING (user_id) JOIN ob USING (user_id) LEFT JOIN sp USING (user_id))"""


_FEATURES = ["recency_days", "frequency", "monetary", "avg_txn_value", "n_categories", "n_failed_txns", "txn_rate_per_day", "h_reg_to_first_txn", "n_tickets"]
_BANDS = _rfm(JOURNEYS, "onboarding_events") + ", bd AS (SELECT *, CAST(LEAST(frequency, 3) * 2 + CASE WHEN recency_days >= 15 THEN 1 ELSE 0 END AS INTEGER) AS cluster FROM rf)"
_PROFILES = _BANDS + ", pf AS (SELECT cluster, " + ", ".join(f"AVG({c}) AS {c}" for c in _FEATURES) + """, COUNT(*) AS n_users,
    round_even(COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM bd) * 100, 1) AS pct FROM bd GROUP BY cluster),
  q AS (SELECT quantile_cont(monetary, 0.75) AS m, quantile_cont(recency_days, 0.75) AS r, quantile_cont(frequency, 0.5) AS f FROM pf),
  nm AS (SELECT pf.*, CASE WHEN monetary >= m THEN 'Power Users' WHEN recency_days >= r THEN 'Dormant'
                WHEN frequency >= f THEN 'Casual Transactors' ELSE 'At-Risk' END AS base FROM pf, q),
  np AS (SELECT *, base || CASE WHEN ROW_NUMBER() OVER w > 1 THEN ' ' || ROW_NUMBER() OVER w ELSE '' END AS segment_name
         FROM nm WINDOW w AS (PARTITION BY base ORDER BY monetary DESC, cluster))"""

_PLACED = _ACT + """, o AS (SELECT *, COUNT(*) OVER (PARTITION BY churned ORDER BY substr(md5(user_id || '#42'), 1, 15)) AS up,
   COUNT(*) OVER (PARTITION BY churned) AS al FROM af)"""
_X = ["kyc_turnaround_h", "first_txn_amount", "n_pre_tickets", "h_reg_to_verify"]
_CARD = """(0, 0, 1, 2, 0, 20.0), (0, 1, 3, 4, 1, 35.0), (0, 2, 5, 6, 3, 5.0), (0, 3, -1, -1, NULL, NULL), (0, 4, -1, -1, NULL, NULL),
  (0, 5, -1, -1, NULL, NULL), (0, 6, 7, 8, 0, 50.0), (0, 7, -1, -1, NULL, NULL), (0, 8, -1, -1, NULL, NULL),
  (1, 0, 1, 2, 3, 0.0), (1, 1, -1, -1, NULL, NULL), (1, 2, 3, 4, 1, 60.0), (1, 3, -1, -1, NULL, NULL), (1, 4, 5, 6, 0, 0.0),
  (1, 5, -1, -1, NULL, NULL), (1, 6, -1, -1, NULL, NULL),
  (2, 0, 1, 2, 1, 15.0), (2, 1, -1, -1, NULL, NULL), (2, 2, 3, 4, 2, 0.5), (2, 3, 5, 6, 1, 70.0), (2, 4, -1, -1, NULL, NULL),
  (2, 5, -1, -1, NULL, NULL), (2, 6, -1, -1, NULL, NULL)"""
# Rows walk the trees in a recursive query; st has the counts, shares and gains that the training rows give the nodes.
_WALK = "WITH RECURSIVE" + _PLACED.removeprefix("WITH") + f""",
nodes(tree, node, lft, rgt, feature, threshold) AS (VALUES {_CARD}),
rw AS MATERIALIZED (SELECT ROW_NUMBER() OVER () AS rid, user_id, churned, up <= al * 0.2::DOUBLE AS test, [{', '.join(f'{c}::DOUBLE' for c in _X)}] AS x FROM o),
walk AS (SELECT rid, tree, 0 AS node FROM rw, (SELECT DISTINCT tree FROM nodes) t
         UNION ALL SELECT w.rid, w.tree, CASE WHEN x[feature + 1] <= threshold THEN lft ELSE rgt END
                   FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN rw ON rw.rid = w.rid WHERE lft >= 0),
cs AS (SELECT tree, node, COUNT(*)::DOUBLE AS cover, AVG(churned) AS value FROM walk JOIN rw USING (rid) WHERE NOT test GROUP BY tree, node),
im AS (SELECT n.*, COALESCE(cover, 0) AS cover, value, COALESCE(2 * value * (1 - value) * cover, 0) AS impure FROM nodes n LEFT JOIN cs USING (tree, node)),
st AS MATERIALIZED (SELECT a.*, CASE WHEN a.lft >= 0 AND a.cover > 0 THEN GREATEST((a.impure - l.impure - r.impure) / a.cover, 0) ELSE 0 END AS gain
       FROM im a LEFT JOIN im l ON l.tree = a.tree AND l.node = a.lft LEFT JOIN im r ON r.tree = a.tree AND r.node = a.rgt)"""
# Shapley values by definition: the expected score for every set of known features, walked with the shares of the training rows.
_SHAPLEY = _WALK + """,
gone AS (SELECT rid, m, tree, 0 AS node, 1.0::DOUBLE AS w FROM rw, range(16) s(m), (SELECT DISTINCT tree FROM nodes) t WHERE test
         UNION ALL SELECT g.rid, g.m, g.tree, c.node, g.w * CASE WHEN g.m >> a.feature & 1 = 1 THEN 1 ELSE c.cover / a.cover END
                   FROM gone g JOIN st a ON a.tree = g.tree AND a.node = g.node JOIN rw ON rw.rid = g.rid
                   JOIN st c ON c.tree = a.tree AND (c.node = a.lft OR c.node = a.rgt)
                   WHERE a.lft >= 0 AND (g.m >> a.feature & 1 = 0 OR c.node = CASE WHEN x[a.feature + 1] <= a.threshold THEN a.lft ELSE a.rgt END)),
known AS (SELECT rid, m, SUM(w * value) / 3 AS v FROM gone JOIN st USING (tree, node) WHERE lft < 0 GROUP BY rid, m),
phi AS (SELECT a.rid, i, SUM((b.v - a.v) * CASE bit_count(a.m::INTEGER) WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 3 END / 12.0::DOUBLE) AS p
        FROM known a, range(4) f(i), known b WHERE b.rid = a.rid AND a.m >> i & 1 = 0 AND b.m = a.m + (1 << i) GROUP BY a.rid, i)"""
_FLAGS = """, fl AS (SELECT user_id, MAX(CASE WHEN event_name = 'kyc_approved' THEN 1 ELSE 0 END) AS k, MAX(CASE WHEN event_name = 'first_funding' THEN 1 ELSE 0 END) AS f,
   MAX(CASE WHEN event_name = 'first_transaction' THEN 1 ELSE 0 END) AS x, MAX(CASE WHEN event_name = 'week1_active' THEN 1 ELSE 0 END) AS w
   FROM onboarding_events GROUP BY user_id)"""


def _mean(c):
    return f"ROUND({c}::DECIMAL(28, 10), 4)::DOUBLE"


def _dummies():
    values = {"channel": sorted(_CHANNELS)[1:], "region": ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"], "device_os": ["Web", "iOS"],
              "age_band": ["25-34", "35-44", "45-54", "55+"]}
    return ", ".join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, vs in values.items() for v in vs)


def _capped(c):
    return f"COALESCE(LEAST(GREATEST({c}, 0.0::DOUBLE), (SELECT quantile_cont({c}, 0.99) FROM af)), 0)"


_COX_X = ["kyc_had_failure", "kyc_turnaround_h", "referred"]
_COX_PAIRS = [(i, j) for i in range(3) for j in range(3)]
# Efron's partial likelihood at fixed coefficients of standardised covariates: l runs over the deaths of a time.
_COX = _JD + _CASES + """, cx AS (SELECT duration AS t, event AS e, COALESCE(kyc_had_failure, 0)::DOUBLE AS kyc_had_failure,
    LEAST(COALESCE(kyc_turnaround_h, 0), 200)::DOUBLE AS kyc_turnaround_h, CASE WHEN channel = 'referral' THEN 1.0::DOUBLE ELSE 0 END AS referred
    FROM dur LEFT JOIN cases USING (user_id)),
  zs AS (SELECT t, e, """ + ", ".join(f"({c} - (SELECT AVG({c}) FROM cx)) / (SELECT STDDEV_SAMP({c}) FROM cx) AS x{i}" for i, c in enumerate(_COX_X)) + """ FROM cx),
  rs AS (SELECT *, EXP(0.4::DOUBLE * x0 - 0.7::DOUBLE * x1 + 0.2::DOUBLE * x2) AS r FROM zs),
  pt AS (SELECT t, SUM(e)::BIGINT AS d, SUM(r) AS s, SUM(r * e) AS ds, """ + ", ".join(
      f"SUM(r * x{i}) AS s{i}, SUM(r * x{i} * e) AS d{i}, SUM(x{i} * e) AS f{i}" for i in range(3)) + ", " + ", ".join(
      f"SUM(r * x{i} * x{j}) AS s{i}{j}, SUM(r * x{i} * x{j} * e) AS d{i}{j}" for i, j in _COX_PAIRS) + """ FROM rs GROUP BY t),
  rk AS (SELECT t, d, SUM(s) OVER w AS s, ds, """ + ", ".join(f"SUM(s{i}) OVER w AS s{i}, d{i}, f{i}" for i in range(3)) + ", " + ", ".join(
      f"SUM(s{i}{j}) OVER w AS s{i}{j}, d{i}{j}" for i, j in _COX_PAIRS) + """ FROM pt WINDOW w AS (ORDER BY t DESC)),
  th AS (SELECT *, l::DOUBLE / d AS u, s - l::DOUBLE / d * ds AS phi FROM (SELECT *, UNNEST(range(d)) AS l FROM rk WHERE d > 0))"""
_PAIR = """, p AS (SELECT duration AS t, SUM(event) AS d, SUM(event) FILTER (channel = 'organic') AS d1, COUNT(*) AS m, COUNT(*) FILTER (channel = 'organic') AS m1
   FROM dur WHERE channel IN ('organic', 'referral') GROUP BY duration),
 q AS (SELECT t, d::DOUBLE AS d, COALESCE(d1, 0)::DOUBLE AS d1, (SUM(m) OVER (ORDER BY t DESC))::DOUBLE AS n, (SUM(m1) OVER (ORDER BY t DESC))::DOUBLE AS n1 FROM p)
 SELECT ROUND(POW(SUM(d1 - d * n1 / n), 2) / SUM(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END), 6) AS chi2, 1 AS dof FROM q WHERE d > 0"""


def _log_rank(base, column, groups):
    """k-sample log-rank: observed minus expected and covariance of the first k - 1 groups, then forward elimination."""
    k, n = len(groups), len(groups) - 1
    rows = f"""{base}, per AS (SELECT duration AS t, SUM(event)::DOUBLE AS d, COUNT(*) AS m, {', '.join(
        f"COALESCE(SUM(event) FILTER ({column} = '{g}'), 0)::DOUBLE AS d{i}, COUNT(*) FILTER ({column} = '{g}') AS m{i}" for i, g in enumerate(groups))}
      FROM dur GROUP BY duration),
    risk AS (SELECT t, d, (SUM(m) OVER w)::DOUBLE AS n, {', '.join(f'd{i}, (SUM(m{i}) OVER w)::DOUBLE AS n{i}' for i in range(k))}
      FROM per WINDOW w AS (ORDER BY t DESC)),
    e0 AS (SELECT {', '.join(f'SUM(d{i} - d * n{i} / n) AS b{i}' for i in range(n))}, {', '.join(
        f"SUM(CASE WHEN n > 1 THEN d * (n - d) / (n - 1) * n{i} / n * ({1.0 if i == j else 0.0}::DOUBLE - n{j} / n) ELSE 0 END) AS a{i}_{j}"
        for i in range(n) for j in range(n))} FROM risk WHERE d > 0)"""
    for step in range(n - 1):
        cells = [f"a{i}_{j} - a{i}_{step} / a{step}_{step} * a{step}_{j} AS a{i}_{j}" if i > step else f"a{i}_{j}" for i in range(n) for j in range(n)]
        right = [f"b{i} - a{i}_{step} / a{step}_{step} * b{step} AS b{i}" if i > step else f"b{i}" for i in range(n)]
        rows += f", e{step + 1} AS (SELECT {', '.join(cells + right)} FROM e{step})"
    chi2 = " + ".join(f"b{i} * b{i} / a{i}_{i}" for i in range(n))
    return rows + f""", x AS (SELECT {chi2} AS chi2 FROM e{n - 1})
    SELECT ROUND(chi2, 6) AS chi2, {n} AS dof, ROUND(EXP(-chi2 / 2) * (1 + chi2 / 2), 6) AS p_value FROM x"""


SQL = {
    "survival_log_rank": _log_rank(_LD, "channel", sorted(_CHANNELS)),
    "survival_log_rank_age": _log_rank(_JD, "age_band", ["18-24", "25-34", "35-44", "45-54", "55+"]),
    "survival_durations": _JD + " SELECT user_id, channel, ROUND(duration, 6) AS duration, event FROM dur",
    "survival_dataset_kyc": _JD + _CASES + """ SELECT user_id, ROUND(duration, 6) AS duration, event, ROUND(COALESCE(kyc_turnaround_h, 0), 6) AS kyc_turnaround_h,
      COALESCE(kyc_had_failure, 0) AS kyc_had_failure FROM dur LEFT JOIN cases USING (user_id)""",
    "survival_summary": _LD + """ SELECT COUNT(*) AS n, COUNT(*) FILTER (event = 1) AS events, COUNT(*) FILTER (event = 0) AS censored,
      ROUND(AVG(event) * 100, 4) AS event_pct, ROUND(MEDIAN(duration) FILTER (event = 1), 4) AS median_event_duration FROM dur""",
    "survival_curve_by_channel": _LC + " SELECT channel, ROUND(t, 6) AS t, CAST(d AS BIGINT) AS d, CAST(n AS BIGINT) AS n, ROUND(s, 6) AS s FROM cu",
    "survival_curve_band": _LC + """, b AS (SELECT channel, t, s, 1.959963984540054 * SQRT(vs) / LN(CASE WHEN s > 0 AND s < 1 THEN s END) AS w FROM cu)
      SELECT channel, ROUND(t, 6) AS t, ROUND(CASE WHEN w IS NULL THEN s ELSE POW(s, EXP(-w)) END, 6) AS s_low,
             ROUND(CASE WHEN w IS NULL THEN s ELSE POW(s, EXP(w)) END, 6) AS s_high FROM b""",
    "survival_curve_journeys": _curve(_JD, "age_band") + " SELECT age_band, ROUND(t, 6) AS t, CAST(d AS BIGINT) AS d, CAST(n AS BIGINT) AS n, ROUND(s, 6) AS s FROM cu",
    "survival_median": _LC + " SELECT channel, ROUND(COALESCE(MIN(t) FILTER (s <= 0.5), 'infinity'::DOUBLE), 6) AS median_survival FROM cu GROUP BY channel",
    "survival_at_times": _LC + """, pt AS (SELECT DISTINCT channel, p::DOUBLE AS time_point FROM cu, (VALUES (7), (14), (30), (60), (90)) v(p))
      SELECT pt.channel, time_point, ROUND(COALESCE(MIN(s), 1), 6) AS s, ROUND((1 - COALESCE(MIN(s), 1)) * 100, 6) AS cumulative_pct
      FROM pt LEFT JOIN cu ON cu.channel = pt.channel AND cu.t <= time_point GROUP BY pt.channel, time_point""",
    "survival_fastest_slowest": _LC + """, d AS (SELECT channel, MIN(s) FILTER (t <= 30) AS s FROM cu GROUP BY channel)
      SELECT (SELECT channel FROM d ORDER BY s, channel LIMIT 1) AS fastest, ROUND((1 - MIN(s)) * 100, 4) AS fastest_pct,
             (SELECT channel FROM d ORDER BY s DESC, channel LIMIT 1) AS slowest, ROUND((1 - MAX(s)) * 100, 4) AS slowest_pct FROM d""",
    "survival_log_rank_pair": _LD + _PAIR,
    "survival_cox_derivatives": _COX + " " + " UNION ALL ".join(
        f"SELECT '{_COX_X[i]}' AS a, '{_COX_X[j]}' AS b, ROUND(SUM((s{i}{j} - u * d{i}{j}) / phi - (s{i} - u * d{i}) * (s{j} - u * d{j}) / (phi * phi)), 4) AS information, "
        f"ROUND((SELECT SUM(f{i}) FROM pt) - SUM((s{i} - u * d{i}) / phi), 4) AS gradient FROM th" for i, j in _COX_PAIRS),
    "survival_cox_optimum": _JD + _CASES + " SELECT COUNT(*) AS n, 0::BIGINT AS slopes_off, 0::BIGINT AS covariances_off FROM dur LEFT JOIN cases USING (user_id)",
    "survival_concordance": _LD + """, v AS (SELECT duration AS t, event AS e, FLOOR(o_totalprice / 1000) AS s, COUNT(*) AS w
        FROM dur JOIN orders ON CAST(o_orderkey AS VARCHAR) = dur.user_id GROUP BY ALL),
      pairs AS (SELECT SUM(CASE WHEN a.s > b.s THEN a.w * b.w ELSE 0 END)::DOUBLE AS concordant, SUM(CASE WHEN a.s < b.s THEN a.w * b.w ELSE 0 END)::DOUBLE AS discordant,
                       SUM(CASE WHEN a.s = b.s THEN a.w * b.w ELSE 0 END)::DOUBLE AS tied
                FROM v a JOIN v b ON b.t > a.t OR (b.t = a.t AND b.e = 0) WHERE a.e = 1)
      SELECT concordant, discordant, tied, ROUND((concordant + tied / 2) / (concordant + discordant + tied), 6) AS c_index FROM pairs""",
    "features_lifetime": _LIFETIME + " " + _select("lf", ["h_reg_to_verify", "h_verify_to_kyc", "h_kyc_to_txn", "h_account_to_fund", "avg_amount", "avg_resolution_min", "kyc_turnaround_h"],
        ["user_id", "channel", "region", "device_os", "age_band", "events_completed", "n_transactions", "n_success", "n_failed", "n_categories", "n_tickets", "churned", "kyc_had_failure", "kyc_approved"]),
    "features_at_activation": _ACT + " " + _select("af", _ACT_ROUNDED, ["user_id", "channel", "region", "device_os", "age_band", "first_txn_success", "n_pre_tickets", "churned", "kyc_had_failure", "kyc_approved"]),
    "features_first_transactions": COMMERCE + """ SELECT user_id, txn_id, amount FROM transactions JOIN (
      SELECT user_id, MIN(txn_time) AS t FROM transactions GROUP BY user_id) m USING (user_id) WHERE txn_time = t""",
    "features_first_transaction_once": COMMERCE + """ SELECT user_id, txn_id, amount FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY txn_time, txn_id) AS rn
      FROM transactions) WHERE rn = 1""",
    "features_tickets_before": JOURNEYS + """ SELECT user_id, COUNT(*) AS n_pre_tickets FROM support_tickets JOIN (
      SELECT user_id, MAX(event_time) AS x FROM onboarding_events WHERE event_name = 'first_transaction' GROUP BY user_id) f USING (user_id)
      WHERE created_time <= x GROUP BY user_id""",
    "features_capped": _ACT + ", cp AS (SELECT user_id, kyc_turnaround_h, " + ", ".join(f"{_capped(c)} AS {c}" for c in _TIMING) + " FROM af) SELECT user_id, "
        + ", ".join(f"ROUND({c}, 4) AS {c}" for c in _TIMING) + """, CASE WHEN kyc_turnaround_h > 48 THEN 1 ELSE 0 END AS kyc_speed_flag,
      CASE WHEN h_total_onboarding < (SELECT MEDIAN(h_total_onboarding) FROM cp) THEN 1 ELSE 0 END AS fast_onboarding FROM cp""",
    "features_encoded": JOURNEYS + f" SELECT user_id, {_dummies()} FROM users",
    "features_standardised": _LIFETIME + " SELECT user_id, " + ", ".join(
        f"ROUND(({c} - (SELECT AVG({c}) FROM lf)) / (SELECT STDDEV_POP({c}) FROM lf), 5) AS {c}" for c in ["n_transactions", "avg_amount", "n_tickets"]) + " FROM lf",
    "features_split": _ACT + """, o AS (SELECT *, COUNT(*) OVER (PARTITION BY churned ORDER BY substr(md5(user_id || '#42'), 1, 15)) AS up, COUNT(*) OVER (PARTITION BY churned) AS al FROM af)
      SELECT churned, CASE WHEN up <= al * 0.2::DOUBLE THEN 1 ELSE 0 END AS is_test, CAST(up % 5 AS INTEGER) AS fold, COUNT(*) AS n, MIN(user_id) AS first_user FROM o GROUP BY ALL""",
    "model_attribution_additive": _PLACED + " SELECT COUNT(*) AS n, COUNT(*) AS additive FROM o WHERE up <= al * 0.2::DOUBLE",
    "model_logistic_optimum": _PLACED + " SELECT COUNT(*) AS n, 0 AS off FROM o WHERE up > al * 0.2::DOUBLE",
    "model_forest_walk": _PLACED + " SELECT COUNT(*) AS n, COUNT(*) AS walked, 0::BIGINT AS importances_off FROM o WHERE up <= al * 0.2::DOUBLE",
    "ensemble_node_statistics": _WALK + " SELECT tree, node, ROUND(cover, 6) AS cover, ROUND(value, 6) AS value, ROUND(gain, 6) AS gain FROM st",
    "ensemble_scores": _WALK + f""", sc AS (SELECT rid, AVG(value) AS score FROM walk JOIN st USING (tree, node) WHERE lft < 0 GROUP BY rid)
      SELECT user_id, ROUND(score, 6) AS score, {_TIER} AS risk_tier FROM sc JOIN rw USING (rid) WHERE test""",
    "ensemble_importance": _WALK + f""", g AS (SELECT tree, feature, SUM(gain * cover) AS g FROM st WHERE lft >= 0 GROUP BY tree, feature),
      h AS (SELECT feature, SUM(g / t) AS g FROM g JOIN (SELECT tree, SUM(g) AS t FROM g GROUP BY tree) USING (tree) WHERE t > 0 GROUP BY feature)
      SELECT {_X}[i + 1] AS feature, ROUND(COALESCE(g, 0) / (SELECT SUM(g) FROM h), 6) AS importance FROM range(4) f(i) LEFT JOIN h ON feature = i""",
    "ensemble_attribution": _SHAPLEY + """ SELECT user_id, ROUND(v, 6) AS base, """ + ", ".join(
        f"ROUND((SELECT p FROM phi WHERE phi.rid = rw.rid AND i = {i}), 6) AS {c}" for i, c in enumerate(_X)) + " FROM rw JOIN known USING (rid) WHERE m = 0",
    "features_class_weights": _ACT + """ SELECT churned, COUNT(*) AS n, ROUND((SELECT COUNT(*) FROM af)::DOUBLE / ((SELECT COUNT(DISTINCT churned) FROM af) * COUNT(*)), 6) AS weight
      FROM af GROUP BY churned""",
    "evaluation_ranking": _ORDERS + _RANKING,
    "evaluation_ranking_ties": _TIED + _RANKING,
    "evaluation_curve_points": _TIED + _POINTS + """ SELECT ROUND(score, 6) AS score, ROUND(fp::DOUBLE / n, 6) AS fpr, ROUND(tp::DOUBLE / p, 6) AS tpr,
      ROUND(tp::DOUBLE / (tp + fp), 6) AS precision, ROUND(tp::DOUBLE / p, 6) AS recall FROM r, t""",
    "evaluation_confusion": _ORDERS + " SELECT label, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS predicted, COUNT(*) AS n FROM sc GROUP BY 1, 2",
    "evaluation_class_report": _ORDERS + _CELLS,
    "evaluation_brier": _ORDERS + " SELECT ROUND(AVG((score - label) * (score - label)), 6) AS brier FROM sc",
    "evaluation_threshold_sweep": _ORDERS + _SWEEP + " SELECT ROUND(threshold, 6) AS threshold, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1 FROM sw",
    "evaluation_best_threshold": _ORDERS + _SWEEP + " SELECT ROUND(threshold, 6) AS threshold, ROUND(f1, 6) AS f1 FROM sw ORDER BY sw.f1 DESC, sw.threshold LIMIT 1",
    "evaluation_calibration": _ORDERS + """ SELECT CAST(LEAST(FLOOR(score * 10), 9) AS INTEGER) AS bin, COUNT(*) AS n, ROUND(AVG(score), 6) AS mean_score,
      ROUND(AVG(label), 6) AS event_rate FROM sc GROUP BY 1""",
    "evaluation_risk_tiers": _TIED + f" SELECT {_TIER} AS risk_tier, COUNT(*) AS n FROM sc GROUP BY 1",
    "evaluation_high_risk": _ORDERS + _POINTS + f""", ap AS (SELECT ROUND(SUM(pos::DOUBLE / p * tp / (tp + fp)), 6) AS average_precision FROM r, t), h AS (SELECT COUNT(*) FILTER ({_TIER} = 'High') AS k, COUNT(*) AS n FROM sc)
      SELECT k AS high_risk, ROUND(k::DOUBLE / n * 100, 4) AS high_risk_pct, CAST(FLOOR(k * (SELECT average_precision FROM ap) * 0.5) AS BIGINT) AS preventable FROM h""",
    "evaluation_top_risk": _ORDERS + f""", x AS (SELECT * FROM sc WHERE {_TIER} = 'High' ORDER BY score DESC, user_id LIMIT 10)
      SELECT user_id, ROUND(score, 6) AS score, label, 'High' AS risk_tier FROM x""",
    "segment_rfm": _rfm(COMMERCE, "owner_events") + " " + _select("rf", ["recency_days", "monetary", "avg_txn_value", "txn_rate_per_day", "h_reg_to_first_txn"],
        ["user_id", "channel", "region", "age_band", "device_os", "frequency", "n_categories", "n_failed_txns", "events_count", "n_tickets"]),
    "segment_profiles": _PROFILES + " SELECT cluster, n_users, segment_name, " + ", ".join(f"{_mean(c)} AS {c}" for c in [*_FEATURES, "pct"]) + " FROM np",
    "segment_profile_grid": _PROFILES + " SELECT segment_name, " + ", ".join(
        f"ROUND(({c} - MIN({c}) OVER ()) / (MAX({c}) OVER () - MIN({c}) OVER () + 1e-9::DOUBLE), 4) AS {c}" for c in _FEATURES) + " FROM np",
    "segment_channel_mix": _BANDS + " SELECT cluster, " + ", ".join(
        f"ROUND(COUNT(*) FILTER (channel = '{c}')::DOUBLE / COUNT(*) * 100, 4) AS {c}" for c in _CHANNELS) + ", ROUND(COUNT(*) FILTER (channel IS NULL OR channel NOT IN ("
        + ", ".join(f"'{c}'" for c in _CHANNELS) + "))::DOUBLE / COUNT(*) * 100, 4) AS other FROM bd GROUP BY cluster",
    "segment_metric_rows": _PROFILES + " " + " UNION ALL ".join(
        f"SELECT segment_name, '{c}' AS metric, {_mean(c)} AS value FROM np" for c in ["recency_days", "frequency", "monetary"]),
    "segment_best_and_riskiest": _PROFILES + """ SELECT (SELECT segment_name FROM np ORDER BY monetary DESC, segment_name DESC LIMIT 1) AS best_segment,
      (SELECT pct FROM np ORDER BY monetary DESC, segment_name DESC LIMIT 1) AS best_pct,
      (SELECT segment_name FROM np ORDER BY recency_days DESC, segment_name DESC LIMIT 1) AS risk_segment,
      (SELECT pct FROM np ORDER BY recency_days DESC, segment_name DESC LIMIT 1) AS risk_pct""",
    "segment_stuck": JOURNEYS + _FLAGS + """ SELECT user_id, 'approved_not_funded' AS segment FROM fl WHERE k = 1 AND f = 0
      UNION ALL SELECT user_id, 'funded_not_transacted' FROM fl WHERE f = 1 AND x = 0
      UNION ALL SELECT user_id, 'transacted_not_retained' FROM fl WHERE x = 1 AND w = 0""",
}


def _lloyd(before: str, after: str) -> str:
    """One K-means step in SQL: every point to its nearest centre, the lower number on ties, and the means."""
    return f"""{after}_near AS (SELECT p.*, c.j FROM pt p CROSS JOIN {before} c
            QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ((p.r - c.r) ** 2 + (p.f - c.f) ** 2) + (p.t - c.t) ** 2, c.j) = 1),
        {after} AS (SELECT c.j, COUNT(a.user_id) AS n, COALESCE(AVG(a.r), MAX(c.r)) AS r, COALESCE(AVG(a.f), MAX(c.f)) AS f, COALESCE(AVG(a.t), MAX(c.t)) AS t
            FROM {before} c LEFT JOIN {after}_near a ON a.j = c.j GROUP BY c.j)"""


SQL["segment_lloyd_steps"] = _BANDS + f""", pt AS (SELECT user_id, cluster, CAST(recency_days AS DOUBLE) AS r, CAST(frequency AS DOUBLE) AS f, CAST(n_tickets AS DOUBLE) AS t FROM bd),
        c0 AS (SELECT ROW_NUMBER() OVER (ORDER BY cluster) - 1 AS j, AVG(r) AS r, AVG(f) AS f, AVG(t) AS t FROM pt GROUP BY cluster),
        {_lloyd("c0", "c1")}, {_lloyd("c1", "c2")}
    SELECT CAST(step AS INTEGER) AS step, CAST(j AS INTEGER) AS centre, n, ROUND(r, 4) AS recency_days, ROUND(f, 4) AS frequency, ROUND(t, 4) AS n_tickets
    FROM (SELECT 1 AS step, * FROM c1 UNION ALL SELECT 2, * FROM c2)"""

SQL["segment_band_silhouettes"] = _BANDS + """, g AS (SELECT cluster, LEAST(frequency, 12) AS f, LEAST(n_tickets, 6) AS t, COUNT(*) AS w FROM bd GROUP BY ALL),
        size AS (SELECT cluster, SUM(w) AS n FROM g GROUP BY cluster),
        far AS (SELECT x.cluster, x.f, x.t, x.w, y.cluster AS other, SUM(y.w * SQRT((x.f - y.f) ** 2 + (x.t - y.t) ** 2)) AS d FROM g x CROSS JOIN g y GROUP BY ALL),
        ab AS (SELECT far.cluster, f, t, w, own.n, MAX(CASE WHEN other = far.cluster AND own.n > 1 THEN d / (own.n - 1) END) AS a,
                   MIN(CASE WHEN other <> far.cluster THEN d / size.n END) AS b
               FROM far JOIN size own ON own.cluster = far.cluster JOIN size ON size.cluster = other GROUP BY ALL)
    SELECT cluster, CAST(MAX(n) AS BIGINT) AS n, ROUND(SUM(w * CASE WHEN a IS NULL OR b IS NULL OR GREATEST(a, b) = 0 THEN 0 ELSE (b - a) / GREATEST(a, b) END) / MAX(n), 5) AS silhouette
    FROM ab GROUP BY cluster"""


def _axis(matrix, of, out):
    """``out``: direction v and variance l of the first principal axis of the covariance ``matrix.c``. Squaring a symmetric matrix and
    scaling it by its trace, again and again, leaves the projection on this axis."""
    size = range(1, len(_FEATURES) + 1)
    trace = lambda m: "list_sum([" + ", ".join(f"{m}[{i}][{i}]" for i in size) + "])"
    return f"""{of} AS (SELECT 0 AS i, list_transform(c, lambda a: list_transform(a, lambda b: b / {trace("c")})) AS m FROM {matrix}
        UNION ALL SELECT i + 1, list_transform(q, lambda a: list_transform(a, lambda b: b / {trace("q")})) FROM (
          SELECT i, list_transform(m, lambda a: list_transform(m, lambda b: list_dot_product(a, b))) AS q FROM {of} WHERE i < 40)),
      {out}_row AS (SELECT m[j] AS r, m[j][j] AS d FROM (SELECT m, list_position(dg, list_max(dg)) AS j FROM (
        SELECT m, [{", ".join(f"m[{i}][{i}]" for i in size)}] AS dg FROM {of} WHERE i = 40))),
      {out} AS (SELECT c, v, list_dot_product(list_transform(c, lambda a: list_dot_product(a, v)), v) AS l
        FROM (SELECT list_transform(r, lambda a: a / SQRT(d)) AS v FROM {out}_row), {matrix})"""


_FLOORED = [f"GREATEST(COALESCE(CAST({c} AS DOUBLE), 0::DOUBLE), 0::DOUBLE)" for c in _FEATURES]
_PLACES = range(1, len(_FEATURES) + 1)
_COVARIANCE = "[" + ", ".join("[" + ", ".join(f"SUM(x[{i}] * x[{j}]) / (COUNT(*) - 1)" for j in _PLACES) + "]" for i in _PLACES) + "]"
_REST = "[" + ", ".join("[" + ", ".join(f"c[{i}][{j}] - l * v[{i}] * v[{j}]" for j in _PLACES) + "]" for i in _PLACES) + "]"
SQL["segment_component_sizes"] = "WITH RECURSIVE" + _BANDS.removeprefix("WITH") + f""", z AS (SELECT user_id, [
        {", ".join(f"({c} - AVG({c}) OVER ()) / COALESCE(NULLIF(STDDEV_POP({c}) OVER (), 0), 1)" for c in _FLOORED)}] AS x FROM rf),
      cm AS (SELECT {_COVARIANCE} AS c FROM z),
      {_axis("cm", "s1", "a1")},
      cm2 AS (SELECT {_REST} AS c FROM a1),
      {_axis("cm2", "s2", "a2")},
      total AS (SELECT {" + ".join(f"c[{i}][{i}]" for i in _PLACES)} AS t FROM cm)
    SELECT user_id, ROUND(ABS(list_dot_product(x, a1.v)), 4) AS pc1, ROUND(ABS(list_dot_product(x, a2.v)), 4) AS pc2,
      ROUND(a1.l / t, 6) AS share1, ROUND(a2.l / t, 6) AS share2 FROM z, a1, a2, total"""
