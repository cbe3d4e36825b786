"""An independent SQL statement per registered query, written for DuckDB."""

from __future__ import annotations

NATIONS = [f"NATION_{i}" for i in range(25)]

# --- activity view -------------------------------------------------------------------

_EVENTS = """
raw_events AS (
    SELECT event_id, user_id AS credit_id, ts, event_type, value,
           CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 10 AS digit
    FROM events
),
ev AS (
    SELECT event_id, credit_id, strftime(ts, '{format}') AS period, event_type,
           CAST(round_even(value * 100, 0) AS BIGINT) * CASE WHEN event_type = 'view' THEN -1 ELSE 1 END AS cents,
           CASE WHEN digit < 7 THEN 'on_time' WHEN digit < 9 THEN 'late' ELSE 'unpaid' END AS status
    FROM raw_events
),"""

_ACTIVITY = """
activity AS (
    SELECT credit_id, period,
           arg_min_null(status, event_id) FILTER (WHERE event_type = 'purchase') AS due_status,
           arg_min(cents, event_id) FILTER (WHERE event_type = 'purchase') AS due_cents,
           CAST(coalesce(sum(cents) FILTER (WHERE event_type IN ('click', 'view')), 0) AS BIGINT) AS movement_cents,
           CAST(coalesce(sum(cents) FILTER (WHERE event_type = 'error'), 0) AS BIGINT) AS overdraft_cents
    FROM ev
    GROUP BY credit_id, period
    HAVING count(*) FILTER (WHERE event_type = 'purchase') > 0
)"""

# Months of customers: orders as instalments, order lines as movements (the seventh as an overdraft).
_HISTORY = """
ev AS (
    SELECT o_orderkey * 8 AS event_id, o_custkey AS credit_id, strftime(o_orderdate, '%Y-%m') AS period, 'purchase' AS event_type,
           CAST(round_even(o_totalprice * 100, 0) AS BIGINT) AS cents,
           CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'unpaid' WHEN '2' THEN 'late' WHEN '3' THEN NULL ELSE 'on_time' END AS status
    FROM orders
    UNION ALL
    SELECT l_orderkey * 8 + l_linenumber, o_custkey, strftime(l_shipdate, '%Y-%m'),
           CASE WHEN l_linenumber = 7 THEN 'error' ELSE 'click' END,
           CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END, NULL
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
),"""

_RAW = _EVENTS
_EVENTS = _RAW + _ACTIVITY

_DERIVED = """,
numbered AS (
    SELECT *, row_number() OVER w AS position,
           CAST(sum(movement_cents) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance_cents
    FROM activity
    WINDOW w AS (PARTITION BY credit_id ORDER BY period)
),
features AS (
    SELECT credit_id, period, due_status,
           CAST(position - coalesce(max(CASE WHEN due_status IS NULL OR due_status = 'on_time' THEN position END)
                OVER (w ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS late_streak,
           balance_cents / 100.0::DOUBLE AS balance,
           CAST(sum(balance_cents) OVER (w ROWS 2 PRECEDING) AS DOUBLE) / (100 * count(*) OVER (w ROWS 2 PRECEDING)) AS balance_avg_3,
           CAST(sum(balance_cents) OVER (w ROWS 5 PRECEDING) AS DOUBLE) / (100 * count(*) OVER (w ROWS 5 PRECEDING)) AS balance_avg_6,
           CAST(sum(balance_cents) OVER (w ROWS 11 PRECEDING) AS DOUBLE) / (100 * count(*) OVER (w ROWS 11 PRECEDING)) AS balance_avg_12,
           avg(CASE WHEN overdraft_cents > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) OVER (w ROWS 2 PRECEDING) AS overdraft_ratio_3,
           avg(CASE WHEN due_status = 'unpaid' THEN 1.0::DOUBLE WHEN due_status IS NOT NULL THEN 0.0::DOUBLE END) OVER (w ROWS 5 PRECEDING) AS incident_freq_6
    FROM numbered
    WINDOW w AS (PARTITION BY credit_id ORDER BY period)
)"""

_FEATURES = _EVENTS + _DERIVED
_HISTORY_FEATURES = _HISTORY + _ACTIVITY + _DERIVED
_ODD = _RAW.replace(
    "CASE WHEN digit < 7 THEN 'on_time' WHEN digit < 9 THEN 'late' ELSE 'unpaid' END",
    "CASE WHEN digit < 5 THEN 'on_time' WHEN digit = 5 THEN 'disputed' WHEN digit = 6 THEN NULL WHEN digit < 9 THEN 'late' ELSE 'unpaid' END",
) + _ACTIVITY

_CREDITS = """,
credits AS (
    SELECT o_custkey AS credit_id, arg_min(o_totalprice, o_orderkey) AS principal,
           'P' || substr(arg_min(o_orderpriority, o_orderkey), 1, 1) AS credit_type, 6 + o_custkey % 31 AS term
    FROM orders GROUP BY o_custkey
),
clients AS (
    SELECT c_custkey AS client_id, n_name AS country FROM customer JOIN nation ON n_nationkey = c_nationkey
)"""

_PANEL = (
    _FEATURES
    + _CREDITS
    + """,
aged AS (
    SELECT f.credit_id, f.period, 30 * f.late_streak AS dpd,
           row_number() OVER (PARTITION BY f.credit_id ORDER BY f.period) - 1 AS elapsed
    FROM features f
),
panel AS (
    SELECT a.credit_id, a.period, a.dpd,
           CASE WHEN a.dpd >= 90 THEN 3 WHEN a.dpd >= 30 THEN 2 ELSE 1 END AS stage,
           round_even(c.principal * greatest(0.0::DOUBLE, 1.0::DOUBLE
               - CASE WHEN a.dpd >= 30 THEN a.elapsed - a.dpd / 30.0::DOUBLE ELSE a.elapsed::DOUBLE END / c.term), 0) AS outstanding
    FROM aged a JOIN credits c ON c.credit_id = a.credit_id
)"""
)

_SCORE = """
round_even(greatest(0.0::DOUBLE, least(1.0::DOUBLE,
    0.35::DOUBLE * least(late_streak / 6.0::DOUBLE, 1.0::DOUBLE)
    + 0.25::DOUBLE * CASE WHEN balance_avg_12 <= 0 OR balance_avg_3 >= balance_avg_12 THEN 0.0::DOUBLE
          ELSE least(((balance_avg_3 - balance_avg_12) / abs(balance_avg_12)) / (-0.5::DOUBLE), 1.0::DOUBLE) END
    + 0.2::DOUBLE * least(overdraft_ratio_3, 1.0::DOUBLE)
    + 0.2::DOUBLE * least(incident_freq_6, 1.0::DOUBLE))), 4)"""

_STATE = (
    _PANEL
    + f""",
last_panel AS (
    SELECT credit_id, stage, outstanding FROM panel
    QUALIFY row_number() OVER (PARTITION BY credit_id ORDER BY period DESC) = 1
),
last_features AS (
    SELECT * FROM features
    QUALIFY row_number() OVER (PARTITION BY credit_id ORDER BY period DESC) = 1
),
state AS (
    SELECT p.credit_id, p.stage, p.outstanding, f.late_streak, f.balance_avg_3, f.balance_avg_12,
           f.overdraft_ratio_3, f.incident_freq_6, a.client_id, a.credit_type, a.country
    FROM last_panel p
    JOIN last_features f ON f.credit_id = p.credit_id
    LEFT JOIN (SELECT c.credit_id, k.client_id, c.credit_type, k.country
               FROM credits c JOIN clients k ON k.client_id = c.credit_id) a ON a.credit_id = p.credit_id
),
scored AS (
    SELECT *, CASE WHEN score >= 0.6 THEN 'high' WHEN score >= 0.3 THEN 'medium' ELSE 'low' END AS alert_level,
           round_even(outstanding * CASE stage WHEN 1 THEN 0.01::DOUBLE WHEN 2 THEN 0.1::DOUBLE ELSE 0.6::DOUBLE END, 0) AS ecl
    FROM (SELECT *, {_SCORE} AS score FROM state)
)"""
)

_LABELS = (
    _PANEL
    + """,
ahead AS (
    SELECT *, coalesce(max(CASE WHEN stage = 3 THEN 1 ELSE 0 END)
        OVER (PARTITION BY credit_id ORDER BY period ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), 0) AS default_within_3
    FROM panel
),
training AS (
    SELECT f.late_streak, f.balance_avg_3, f.balance_avg_6, f.balance_avg_12, f.overdraft_ratio_3, f.incident_freq_6,
           a.default_within_3, f.credit_id, f.period
    FROM features f JOIN ahead a ON a.credit_id = f.credit_id AND a.period = f.period
    WHERE a.stage <> 3
)"""
)

_JUDGED = (
    _LABELS
    + f""",
judged AS (
    SELECT *, CASE WHEN score >= 0.3 THEN 1 ELSE 0 END AS prediction
    FROM (SELECT *, {_SCORE} AS score FROM training)
)"""
)

_BY_SCORE = """,
per_score AS (
    SELECT score AS threshold, sum(default_within_3) AS pos, sum(1 - default_within_3) AS neg FROM judged GROUP BY score
),
cumulative AS (
    SELECT threshold, CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
           CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp
    FROM per_score
),
totals AS (SELECT max(tp) AS all_pos, max(fp) AS all_neg FROM cumulative)"""

_CURVE = _JUDGED + _BY_SCORE
_UNROUNDED = """,
judged AS (SELECT 0.0::DOUBLE - balance_avg_12 AS score, default_within_3 FROM training)""" + _BY_SCORE

_BENT = """,
bent AS (
    SELECT *, coalesce(lead(tp) OVER w - 2 * tp + lag(tp) OVER w <> 0 OR lead(fp) OVER w - 2 * fp + lag(fp) OVER w <> 0, true) AS kept
    FROM cumulative WINDOW w AS (ORDER BY threshold DESC)
)"""

_ROC = """
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT threshold, fp / all_neg::DOUBLE AS fpr, tp / all_pos::DOUBLE AS tpr FROM {points}, totals"""

# Mean of the known values of a feature and its decimals, as a sum over a count.
_MEANS = {"avg_incident_freq": ("incident_freq_6", 4), "avg_late_streak": ("late_streak", 2), "avg_overdraft_ratio": ("overdraft_ratio_3", 4)}
_TOTALS = ", ".join(f"sum({f}) AS sum_{f}, count({f}) AS n_{f}" for f, _ in _MEANS.values())
_RISK_SUMMARY = f"""
SELECT country, period, n_credits, {", ".join(f"round(sum_{f} / n_{f}::DOUBLE, {d}) AS {name}" for name, (f, d) in _MEANS.items())}
FROM (
    SELECT n_name AS country, period, count(credit_id) AS n_credits, {_TOTALS}
    FROM nation, customer, features WHERE n_nationkey = c_nationkey AND c_custkey = credit_id GROUP BY ALL
)"""

# --- monthly view --------------------------------------------------------------------

_MONTHS = """
loans AS (
    SELECT o_orderkey AS credit_id, o_custkey AS client_id, o_totalprice AS principal,
           6 + o_orderkey % 31 AS term, (o_orderkey * 7) % 36 AS granted
    FROM orders
),
months AS (
    SELECT *, unnest(range(granted, least(granted + term, 36))) AS mi FROM loans
),
drawn AS (
    SELECT *, mi - granted AS elapsed, (credit_id * 13 + mi * 29) % 100 AS u FROM months
),
delayed AS (
    SELECT *, CASE WHEN u < 80 THEN 0 WHEN u < 92 THEN 10 WHEN u < 98 THEN 45 ELSE 95 END AS dpd FROM drawn
),
valued AS (
    SELECT *, CASE WHEN dpd >= 90 THEN 3 WHEN dpd >= 30 THEN 2 ELSE 1 END AS stage,
           round_even(principal * greatest(0.0::DOUBLE, 1.0::DOUBLE
               - CASE WHEN dpd >= 30 THEN elapsed - dpd / 30.0::DOUBLE ELSE elapsed::DOUBLE END / term), 0) AS outstanding
    FROM delayed
),
monthly AS (
    SELECT credit_id, client_id, CAST(mi AS INTEGER) AS month_index, dpd, stage, outstanding,
           CASE WHEN u % 7 = 0 THEN round_even(outstanding * 0.25::DOUBLE, 0) ELSE 0.0::DOUBLE END AS overdraft_amount,
           DATE '2022-01-01' + to_months(CAST(mi AS INTEGER)) AS stated, principal, term
    FROM valued
)"""

_MONTHLY_LABELS = (
    _MONTHS
    + """,
monthly_ahead AS (
    SELECT *, coalesce(max(CASE WHEN stage = 3 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), 0) AS default_within_3,
           max(CASE WHEN stage = 3 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING) AS default_within_6,
           count(*) OVER (w ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING) AS seen,
           lag(stage, 1, 1) OVER w AS previous_stage
    FROM monthly
    WINDOW w AS (PARTITION BY credit_id ORDER BY month_index)
)"""
)

_MONTHLY_EVENTS = (
    _MONTHS
    + """,
described AS (
    SELECT p.*, CASE WHEN n.n_regionkey < 4 THEN 'N' || lpad(n.n_nationkey::VARCHAR, 2, '0') END AS country_code
    FROM monthly p JOIN customer c ON c.c_custkey = p.client_id JOIN nation n ON n.n_nationkey = c.c_nationkey
),
kinds AS (
    SELECT *, 'instalment' AS kind FROM described
    UNION ALL
    SELECT *, 'overdraft' AS kind FROM described WHERE overdraft_amount > 0
),
emitted AS (
    SELECT 'EVT' || md5(credit_id::VARCHAR || '|' || month_index::VARCHAR || '|' || kind) AS event_id,
           kind, credit_id, client_id, strftime(stated, '%Y-%m-%d') AS event_date,
           CASE kind WHEN 'instalment' THEN round_even(principal / term, 0) ELSE overdraft_amount END AS amount,
           CASE WHEN kind = 'instalment' THEN CASE WHEN dpd >= 30 THEN 'unpaid' WHEN dpd > 0 THEN 'late' ELSE 'on_time' END END AS due_status,
           country_code, CAST(year(stated) AS INTEGER) AS year, CAST(month(stated) AS INTEGER) AS month
    FROM kinds
)"""
)


def _daily(template: str) -> str:
    return "WITH" + template.replace("{format}", "%Y-%m-%d")


def _by_month(template: str) -> str:
    return "WITH" + template.replace("{format}", "%Y-%m")


_ACTIVITY_COLUMNS = """
SELECT credit_id, period, due_status, due_cents / 100.0::DOUBLE AS due_amount,
       movement_cents / 100.0::DOUBLE AS net_movement, overdraft_cents / 100.0::DOUBLE AS overdraft_amount
FROM activity"""

# A run begins where no row of equal, known lateness stands right before; runs and places follow from these beginnings.
_ISLANDS = """,
placed AS (
    SELECT credit_id, period, due_status <> 'on_time' AS late,
           (SELECT count(*) FROM activity e WHERE e.credit_id = a.credit_id AND e.period <= a.period) AS place
    FROM activity a
),
beginnings AS (
    SELECT credit_id, place AS start FROM placed p
    WHERE NOT EXISTS (FROM placed q WHERE q.credit_id = p.credit_id AND q.place = p.place - 1 AND q.late = p.late)
)
SELECT credit_id, period, CAST(max(start) = place AS INTEGER) AS changed, count(start) AS island,
       CAST(place - max(start) + 1 AS INTEGER) AS island_rank
FROM placed JOIN beginnings USING (credit_id) WHERE start <= place
GROUP BY credit_id, period, place"""

_FEATURE_COLUMNS = """
SELECT credit_id, period, due_status, late_streak, balance, balance_avg_3, balance_avg_6, balance_avg_12,
       overdraft_ratio_3, incident_freq_6
FROM features"""

_WATCH_LIST = """
SELECT credit_id, country, credit_type, score, alert_level, stage, outstanding, late_streak
FROM scored WHERE score >= 0.3 ORDER BY score DESC, credit_id LIMIT 100"""

_CORRELATIONS = " UNION ALL ".join(
    f"SELECT '{name}' AS feature, round(corr({name}::DOUBLE, default_within_3::DOUBLE), 6) AS correlation FROM training"
    for name in ("late_streak", "balance_avg_3", "balance_avg_12", "overdraft_ratio_3", "incident_freq_6")
)

_PIVOT = ", ".join(f"max(CASE WHEN country = '{n}' THEN avg_incident_freq END) AS \"{n}\"" for n in NATIONS)

_SCORE_COLUMNS = "SELECT credit_id, score, alert_level, late_streak, stage FROM scored"

_PERCENT_RANK = """(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE) / count({c}) OVER ()"""


_TALLY = """,
tally AS (
    SELECT count(*) FILTER (WHERE default_within_3 = 1 AND prediction = 1) AS tp,
           count(*) FILTER (WHERE default_within_3 = 0 AND prediction = 1) AS fp,
           count(*) FILTER (WHERE default_within_3 = 1 AND prediction = 0) AS fn
    FROM judged
)"""

_SHARES = """round_even(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END, 4) AS precision_positive,
       round_even(CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END, 4) AS recall_positive,
       round_even(CASE WHEN tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0 END, 4) AS f1_positive"""

_STRIPS = """,
strips AS (
    SELECT ((fp - lag(fp, 1, 0) OVER w) * (tp + lag(tp, 1, 0) OVER w))::DOUBLE AS roc,
           (tp - lag(tp, 1, 0) OVER w) * (tp / (tp + fp)::DOUBLE
               + coalesce(lag(tp / (tp + fp)::DOUBLE) OVER w, tp / (tp + fp)::DOUBLE)) AS pr
    FROM cumulative WINDOW w AS (ORDER BY threshold DESC)
)"""

_AREAS = ("sum(roc) / (2.0::DOUBLE * max(all_pos) * max(all_neg))", "sum(pr) / (2.0::DOUBLE * max(all_pos))")

# The rows on one side of the split by credit.
_TRAINING_SIDE = """,
side AS (
    SELECT * FROM training
    WHERE CAST(concat('0x', substr(md5(credit_id::VARCHAR), 1, 8)) AS BIGINT) % 100 {test} 75
)"""

_SCALED = (
    " SELECT credit_id, period, "
    + ", ".join(
        f"round(CASE WHEN stddev_samp({c}) OVER () > 0 THEN {c}::DOUBLE / stddev_samp({c}) OVER () ELSE 0 END, 6) AS {c}"
        for c in ("late_streak", "balance_avg_3", "balance_avg_6", "balance_avg_12", "overdraft_ratio_3", "incident_freq_6")
    )
    + " FROM side"
)


def _newton(steps: int) -> str:
    """Newton steps on the training side written out one by one, each with the elimination that solves for its step."""
    names = ("late_streak", "balance_avg_3", "balance_avg_6", "balance_avg_12", "overdraft_ratio_3", "incident_freq_6")
    n = len(names) + 1
    made = [
        """,
sizes AS (SELECT count(*) AS n, sum(default_within_3) AS n1 FROM training),
weighed AS MATERIALIZED (
    SELECT t.*, CASE WHEN default_within_3 = 1 THEN n / (2.0::DOUBLE * n1) ELSE n / (2.0::DOUBLE * (n - n1)) END AS w,
           CAST(concat('0x', substr(md5(credit_id::VARCHAR), 1, 8)) AS BIGINT) % 100 < 75 AS in_train
    FROM training t, sizes
)""",
        "spread AS (SELECT " + ", ".join(f"stddev_samp({c}::DOUBLE) AS d{i}" for i, c in enumerate(names)) + " FROM weighed WHERE in_train)",
        "points AS MATERIALIZED (SELECT weighed.*, " + ", ".join(f"{c}::DOUBLE / d{i} AS x{i}" for i, c in enumerate(names))
        + f", 1.0::DOUBLE AS x{n - 1} FROM weighed, spread)",
        "beta0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS b{i}" for i in range(n)) + ")",
    ]
    margin = " + ".join(f"b{i} * x{i}" for i in range(n))
    for k in range(steps):
        sums = [f"sum(e * x{i}) AS g{i}" for i in range(n)] + [f"sum(c * x{i} * x{j}) AS h{i}{j}" for i in range(n) for j in range(i, n)]
        made.append(
            f"system{k}_0 AS MATERIALIZED (SELECT {', '.join(sums)} FROM (SELECT *, w * (p - default_within_3) AS e, w * p * (1 - p) AS c "
            f"FROM (SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM points, beta{k} WHERE in_train)))"
        )
        for i in range(n - 1):
            left = [f"h{a}{b}" for a in range(i + 1) for b in range(a, n)] + [f"g{a}" for a in range(i + 1)]
            left += [f"h{a}{b} - h{i}{a} / h{i}{i} * h{i}{b} AS h{a}{b}" for a in range(i + 1, n) for b in range(a, n)]
            left += [f"g{a} - h{i}{a} / h{i}{i} * g{i} AS g{a}" for a in range(i + 1, n)]
            made.append(f"system{k}_{i + 1} AS MATERIALIZED (SELECT {', '.join(left)} FROM system{k}_{i})")
        back = [
            f"(g{i}{''.join(f' - h{i}{j} * s{j}' for j in range(i + 1, n))}) / h{i}{i} AS s{i}" for i in reversed(range(n))
        ]
        made.append(f"step{k} AS MATERIALIZED (SELECT {', '.join(back)} FROM system{k}_{n - 1})")
        made.append(f"beta{k + 1} AS MATERIALIZED (SELECT {', '.join(f'b{i} - s{i} AS b{i}' for i in range(n))} FROM beta{k}, step{k})")
    made.append(
        f"predicted AS (SELECT *, 1 / (1 + exp(-score)) AS probability, CASE WHEN 1 / (1 + exp(-score)) > 0.5 THEN 1 ELSE 0 END AS prediction "
        f"FROM (SELECT *, {margin} AS score FROM points, beta{steps} WHERE NOT in_train))"
    )
    return ",\n".join(made)


# Nine steps: the sixth already moves no coefficient any more.
_PREDICTED = _daily(_LABELS) + _newton(9)

_EVALUATED = _BY_SCORE + _STRIPS + _TALLY + f""",
areas AS (SELECT round_even({_AREAS[0]}, 4) AS auc_roc, round_even({_AREAS[1]}, 4) AS auc_pr FROM strips, totals)
SELECT auc_roc, auc_pr, {_SHARES} FROM areas, tally"""


ORACLE_SQL: dict[str, str] = {
    "daily_activity": _daily(_EVENTS) + _ACTIVITY_COLUMNS,
    "daily_activity_joined": _daily(_EVENTS) + _ACTIVITY_COLUMNS,
    "late_streak": _daily(_FEATURES) + " SELECT credit_id, period, due_status, late_streak FROM features",
    "status_islands": _daily(_EVENTS) + _ISLANDS,
    "balance_trend": _daily(_FEATURES)
    + " SELECT credit_id, period, balance, balance_avg_3, balance_avg_6, balance_avg_12 FROM features",
    "overdraft_ratio": _daily(_FEATURES) + " SELECT credit_id, period, overdraft_ratio_3 FROM features",
    "incident_frequency": _daily(_FEATURES) + " SELECT credit_id, period, incident_freq_6 FROM features",
    "behaviour_features": _daily(_FEATURES) + _FEATURE_COLUMNS,
    "monthly_features": _by_month(_FEATURES) + _FEATURE_COLUMNS,
    "odd_status_activity": _daily(_ODD) + _ACTIVITY_COLUMNS,
    "odd_status_features": _daily(_ODD + _DERIVED) + _FEATURE_COLUMNS,
    "monthly_history_features": "WITH" + _HISTORY_FEATURES + _FEATURE_COLUMNS,
    "appended_features": "WITH" + _HISTORY_FEATURES + _FEATURE_COLUMNS.replace("credit_id", "credit_id::VARCHAR AS credit_id"),
    "risk_by_country_period": _daily(_FEATURES) + _RISK_SUMMARY,
    "risk_by_country_period_sql": _daily(_FEATURES) + _RISK_SUMMARY,
    "credit_panel": "WITH" + _MONTHS + """
SELECT credit_id, client_id, month_index, dpd, stage, outstanding, overdraft_amount,
       strftime(stated, '%Y-%m-%d') AS statement_date FROM monthly""",
    "credit_panel_thirty_day": "WITH" + _MONTHS + """
SELECT credit_id, month_index, strftime(DATE '2022-01-01' + 30 * month_index, '%Y-%m-%d') AS statement_date FROM monthly""",
    "instalment_events": "WITH" + _MONTHLY_EVENTS + " SELECT * FROM emitted",
    "event_partitions": "WITH" + _MONTHLY_EVENTS
    + " SELECT country_code, year, month, count(*) AS n_events FROM emitted GROUP BY ALL",
    "default_labels": "WITH" + _MONTHLY_LABELS + """
SELECT credit_id, client_id, month_index, strftime(stated, '%Y-%m-%d') AS statement_date, stage, default_within_3
FROM monthly_ahead WHERE stage <> 3""",
    "default_labels_uncensored": "WITH" + _MONTHLY_LABELS + """
SELECT credit_id, client_id, month_index, strftime(stated, '%Y-%m-%d') AS statement_date, stage, default_within_6
FROM monthly_ahead WHERE stage <> 3 AND seen = 6""",
    "default_entries": "WITH" + _MONTHLY_LABELS + """
SELECT credit_id, month_index, previous_stage, stage FROM monthly_ahead WHERE stage = 3 AND previous_stage <> 3""",
    "latest_panel": "WITH" + _MONTHS + """
SELECT credit_id, month_index, stage, outstanding,
       round_even(outstanding * CASE stage WHEN 1 THEN 0.01::DOUBLE WHEN 2 THEN 0.1::DOUBLE ELSE 0.6::DOUBLE END, 0) AS ecl
FROM monthly QUALIFY row_number() OVER (PARTITION BY credit_id ORDER BY month_index DESC) = 1""",
    "portfolio_state": _daily(_STATE) + " SELECT * FROM state",
    "risk_score": _daily(_STATE) + "\n" + _SCORE_COLUMNS,
    "credit_lookup": _daily(_STATE)
    + f"\n{_SCORE_COLUMNS} WHERE credit_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
    "credit_score": _daily(_STATE) + f"\n{_SCORE_COLUMNS} WHERE credit_id = 7",
    "at_risk_top": _daily(_STATE) + _WATCH_LIST,
    "at_risk_display": _daily(_STATE) + f"""
SELECT credit_id AS "Credit", country, credit_type AS "Type of credit", score, alert_level AS "Alert",
       stage, outstanding, late_streak AS "Late in a row"
FROM ({_WATCH_LIST})""",
    "portfolio_overview": _daily(_STATE) + """
SELECT count(*) AS n_credits, count(*) FILTER (WHERE alert_level = 'low') AS n_low,
       count(*) FILTER (WHERE alert_level = 'medium') AS n_medium, count(*) FILTER (WHERE alert_level = 'high') AS n_high,
       sum(ecl) AS total_ecl FROM scored""",
    "ecl_by_country": _daily(_STATE)
    + " SELECT country, count(*) AS n_credits, sum(ecl) AS ecl FROM scored WHERE country IS NOT NULL GROUP BY country",
    "provision_stress": _daily(_STATE) + """,
ranked AS (
    SELECT *, row_number() OVER (ORDER BY score DESC, credit_id) <= floor((SELECT count(*) FROM scored)::DOUBLE * 0.1::DOUBLE) AS chosen
    FROM scored
),
stressed AS (
    SELECT chosen, ecl, CASE WHEN chosen THEN round_even(outstanding * CASE WHEN stage = 1 THEN 0.1::DOUBLE ELSE 0.6::DOUBLE END, 0) ELSE ecl END AS ecl2
    FROM ranked
)
SELECT count(*) FILTER (WHERE chosen) AS n_downgraded, sum(ecl) AS ecl_before, sum(ecl2) AS ecl_after,
       round_even(CASE WHEN sum(ecl) <> 0 THEN (sum(ecl2) - sum(ecl)) / sum(ecl) * 100 ELSE 0 END, 2) AS variation_pct
FROM stressed""",
    "training_set": _daily(_LABELS) + " SELECT * FROM training",
    "class_weights": _daily(_LABELS) + """,
sizes AS (
    SELECT default_within_3, count(*) AS n FROM training GROUP BY default_within_3
)
SELECT default_within_3, sum(n) OVER () / (2.0::DOUBLE * n) AS weight, n FROM sizes""",
    "hash_split": _daily(_LABELS) + """,
bucketed AS (
    SELECT credit_id, CAST(CAST(concat('0x', substr(md5(credit_id::VARCHAR), 1, 8)) AS BIGINT) % 100 AS INTEGER) AS bucket
    FROM training
)
SELECT credit_id, bucket, CASE WHEN bucket < 75 THEN 1 ELSE 0 END AS in_train, count(*) AS n FROM bucketed GROUP BY ALL""",
    "stage_share": "WITH" + _MONTHS + """
SELECT strftime(stated, '%Y-%m-%d') AS statement_date,
       avg(CASE WHEN stage >= 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS pct_degraded
FROM monthly GROUP BY stated""",
    "panel_facts": "WITH" + _MONTHS + """
SELECT CASE WHEN credit_id IS NULL THEN 'date' ELSE 'credit' END AS by, strftime(stated, '%Y-%m-%d') AS statement_date, credit_id,
       n, n_staged, n_degraded, ever_default
FROM (SELECT stated, NULL::BIGINT AS credit_id, count(*) AS n, count(stage) AS n_staged, count(*) FILTER (stage >= 2) AS n_degraded,
             max(CASE WHEN stage = 3 THEN 1 ELSE 0 END) AS ever_default FROM monthly GROUP BY stated
      UNION ALL
      SELECT NULL, credit_id, count(*), count(stage), count(*) FILTER (stage >= 2), max(CASE WHEN stage = 3 THEN 1 ELSE 0 END)
      FROM monthly GROUP BY credit_id)""",
    "panel_report": "WITH" + _MONTHLY_LABELS + """,
ever AS (SELECT credit_id, max(CASE WHEN stage = 3 THEN 1 ELSE 0 END) AS hit FROM monthly GROUP BY credit_id),
labelled AS (SELECT default_within_3 FROM monthly_ahead WHERE stage <> 3)
SELECT 'pct_degraded ' || strftime(stated, '%Y-%m-%d') AS figure,
       count(*) FILTER (stage >= 2) / count(*)::DOUBLE * 100 AS value FROM monthly GROUP BY stated
UNION ALL SELECT 'n_credits', count(*) FROM ever
UNION ALL SELECT 'n_defaulted', sum(hit) FROM ever
UNION ALL SELECT 'default_rate', avg(hit::DOUBLE) FROM ever
UNION ALL SELECT 'n_panel', count(*) FROM monthly
UNION ALL SELECT 'n_labels', count(*) FROM labelled
UNION ALL SELECT 'prevalence', avg(default_within_3::DOUBLE) FROM labelled""",
    "client_counts": "SELECT n_name AS country, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name",
    "credit_type_counts": "SELECT o_orderpriority AS credit_type, count(*) AS n FROM orders GROUP BY o_orderpriority",
    "label_correlation": _daily(_LABELS) + "\n" + _CORRELATIONS,
    "incident_pivot": _daily(_FEATURES) + f"""
SELECT period, {_PIVOT} FROM ({_RISK_SUMMARY}) GROUP BY period""",
    "label_prevalence": "WITH" + _MONTHLY_LABELS + """
SELECT (SELECT count(*) FROM monthly) AS n_panel, count(*) AS n_labels, avg(default_within_3::DOUBLE) AS prevalence
FROM monthly_ahead WHERE stage <> 3""",
    "ever_default_rate": "WITH" + _MONTHS + """,
ever AS (SELECT credit_id, max(CASE WHEN stage = 3 THEN 1 ELSE 0 END) AS hit FROM monthly GROUP BY credit_id)
SELECT count(*) AS n_credits, CAST(sum(hit) AS BIGINT) AS n_defaulted, avg(hit::DOUBLE) AS default_rate FROM ever""",
    "confusion_matrix": _daily(_JUDGED) + """,
grid AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(label, prediction))
SELECT g.label, g.prediction, count(j.credit_id) AS n
FROM grid g LEFT JOIN judged j ON j.default_within_3 = g.label AND j.prediction = g.prediction
GROUP BY g.label, g.prediction""",
    "alert_metrics": _daily(_JUDGED) + _TALLY + f"\nSELECT {_SHARES} FROM tally",
    "roc_points": _daily(_CURVE) + _ROC.format(points="cumulative"),
    "roc_points_thinned": _daily(_CURVE) + _BENT + _ROC.format(points="(SELECT * FROM bent WHERE kept)"),
    "roc_points_unrounded": _daily(_LABELS + _UNROUNDED) + _BENT + _ROC.format(points="(SELECT * FROM bent WHERE kept)"),
    "pr_points": _daily(_CURVE) + """
SELECT CAST(NULL AS DOUBLE) AS threshold, 1.0::DOUBLE AS precision, 0.0::DOUBLE AS recall
UNION ALL
SELECT threshold, tp / (tp + fp)::DOUBLE, tp / all_pos::DOUBLE FROM cumulative, totals""",
    "auc_exact": _daily(_CURVE) + _STRIPS + f"\nSELECT round({_AREAS[0]}, 6) AS auc_roc, round({_AREAS[1]}, 6) AS auc_pr FROM strips, totals",
    "pct_rank_avg_ties": "WITH amounts AS (SELECT o_orderkey, CAST(floor(o_totalprice / 100) AS BIGINT) AS hundreds FROM orders) "
    + "SELECT o_orderkey, hundreds, "
    + _PERCENT_RANK.format(c="hundreds")
    + " AS pct_rank FROM amounts",
    "risk_percentile_scaled": "WITH profile AS (SELECT c_custkey, c_acctbal, 1 + c_custkey % 180 AS tenure FROM customer), "
    + "ranks AS (SELECT c_custkey, "
    + _PERCENT_RANK.format(c="c_acctbal")
    + " AS r1, "
    + _PERCENT_RANK.format(c="tenure")
    + " AS r2 FROM profile), "
    + "weighed AS (SELECT c_custkey, 0.5::DOUBLE * (1 - r1) + 0.3::DOUBLE * (1 - r2) AS w FROM ranks) "
    + "SELECT c_custkey AS client_id, round((w - min(w) OVER ()) / (max(w) OVER () - min(w) OVER ()), 9) AS latent_risk FROM weighed",
    "rate_clip": "SELECT l_orderkey, l_linenumber, "
    "round_even(greatest(5.0::DOUBLE, least(45.0::DOUBLE, l_extendedprice / 1000)), 2) AS annual_rate_pct FROM lineitem",
    "roundtrip_jsonl": "WITH" + _MONTHLY_EVENTS + """
SELECT event_id, kind, credit_id::VARCHAR AS credit_id, client_id::VARCHAR AS client_id, event_date, amount, due_status,
       country_code, year, month FROM emitted""",
    "roundtrip_csv": "WITH" + _MONTHS + """
SELECT credit_id::VARCHAR AS credit_id, client_id::VARCHAR AS client_id, month_index, dpd, stage, outstanding, overdraft_amount,
       strftime(stated, '%Y-%m-%d') AS statement_date FROM monthly""",
    "roundtrip_labels": "WITH" + _MONTHLY_LABELS + """
SELECT credit_id::VARCHAR AS credit_id, client_id::VARCHAR AS client_id, month_index,
       strftime(stated, '%Y-%m-%d') AS statement_date, stage, default_within_3
FROM monthly_ahead WHERE stage <> 3""",
    "roundtrip_summary": _by_month(_FEATURES) + _RISK_SUMMARY,
    "roundtrip_history": "WITH" + _HISTORY_FEATURES + _FEATURE_COLUMNS.replace("credit_id", "credit_id::VARCHAR AS credit_id")
    + " WHERE period BETWEEN '1994-03' AND '1996-08'",
    "roundtrip_predictions": _daily(_JUDGED) + """
SELECT credit_id::VARCHAR AS credit_id, substr(period, 1, 7) AS period, default_within_3, score AS probability_positive,
       prediction::DOUBLE AS prediction FROM judged""",
    "scaled_features": _daily(_LABELS) + _TRAINING_SIDE.format(test="<") + _SCALED,
    "model_optimality": "SELECT unnest(['late_streak', 'balance_avg_3', 'balance_avg_6', 'balance_avg_12', 'overdraft_ratio_3', "
    "'incident_freq_6', 'intercept']) AS term, 0.0::DOUBLE AS gradient",
    "model_test_rows": _daily(_LABELS) + _TRAINING_SIDE.format(test=">=")
    + " SELECT credit_id::VARCHAR AS credit_id, strftime(date_trunc('month', period::DATE), '%Y-%m-%d') AS period, default_within_3 FROM side",
    "roundtrip_metrics": _daily(_JUDGED) + _EVALUATED,
    "model_predictions": _PREDICTED
    + " SELECT credit_id, period, default_within_3, round(probability, 6) AS probability_positive, prediction::DOUBLE AS prediction FROM predicted",
    "model_metrics": _PREDICTED + ", judged AS (SELECT score, default_within_3, prediction FROM predicted)" + _EVALUATED,
    "roundtrip_model": _daily(_LABELS) + _TRAINING_SIDE.format(test=">=") + " SELECT credit_id, period, default_within_3, true AS agrees FROM side",
    "portfolio_from_files": _by_month(_FEATURES) + "," + _MONTHS + """
SELECT p.credit_id::VARCHAR AS credit_id, p.stage, p.outstanding, f.late_streak, f.balance_avg_3, f.balance_avg_12, f.overdraft_ratio_3,
       f.incident_freq_6, p.client_id::VARCHAR AS client_id, o_orderpriority AS credit_type, n_name AS country
FROM (SELECT * FROM monthly QUALIFY row_number() OVER (PARTITION BY credit_id ORDER BY month_index DESC) = 1) p
JOIN (SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY credit_id ORDER BY period DESC) = 1) f ON f.credit_id = p.credit_id
JOIN orders ON o_orderkey = p.credit_id JOIN customer ON c_custkey = p.client_id JOIN nation ON n_nationkey = c_nationkey""",
    "report_files": _daily(_JUDGED) + "," + _MONTHLY_LABELS + """,
counted AS (
    SELECT 'clients' AS name, count(*) AS n FROM customer UNION ALL SELECT 'credits', count(*) FROM orders
    UNION ALL SELECT 'panel', count(*) FROM monthly
    UNION ALL SELECT 'features', count(DISTINCT (credit_id, substr(period, 1, 7))) FROM activity
    UNION ALL SELECT 'labels', count(*) FROM monthly_ahead WHERE stage <> 3
    UNION ALL SELECT 'summary', count(DISTINCT (n_name, period)) FROM features JOIN customer ON c_custkey = credit_id JOIN nation ON n_nationkey = c_nationkey
    UNION ALL SELECT 'predictions', count(*) FROM judged UNION ALL SELECT 'metrics', 1
)
SELECT name, CASE WHEN name <> 'metrics' THEN n END AS n_written, n AS n_read FROM counted""",
    "roundtrip_parquet": _by_month(_FEATURES) + _FEATURE_COLUMNS.replace("credit_id", "credit_id::VARCHAR AS credit_id"),
}
