"""DuckDB oracles for the quality / profiling reports, chart data and event features."""

from __future__ import annotations

from tidemark.plans.oracle import draw, mean, pct, position_quantile, r, with_base

mavg = mean

# Columns of the customer table by kind, and the validity rules of the quality report.
NUM_COLS = [
    "customer_id", "age", "company_size", "monthly_revenue", "feature_usage_score", "churn_risk_score",
    "customer_satisfaction_score", "activation_completed", "transaction_volume", "support_tickets", "days_since_last_login",
    "total_sessions", "avg_session_duration", "api_calls_per_month", "integration_count", "team_size",
    "annual_contract_value", "onboarding_completion_rate", "feature_adoption_score",
]
STR_COLS = ["industry", "subscription_tier", "payment_method", "referral_source", "location"]
RAW_COLS = [*NUM_COLS, *STR_COLS, "signup_date"]
VALID = {
    "customer_id": "COUNT(*) = COUNT(DISTINCT customer_id)",
    "monthly_revenue": "COUNT(*) FILTER (monthly_revenue < 0) = 0",
    "churn_risk_score": "COUNT(*) FILTER (churn_risk_score < 0 OR churn_risk_score > 1) = 0",
    "customer_satisfaction_score": "COUNT(*) FILTER (customer_satisfaction_score < 1 OR customer_satisfaction_score > 5) = 0",
}


def median_list(c: str) -> str:
    """The sorted list of a column's values."""
    return f"LIST(CAST({c} AS DOUBLE) ORDER BY {c}) FILTER ({c} IS NOT NULL)"


def quality_report_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST(COUNT(*) AS BIGINT) AS total_records, CAST(COUNT({c}) AS BIGINT) AS non_null_count, "
        f"CAST(COUNT(DISTINCT {c}) AS BIGINT) AS unique_count, {r(pct(f'COUNT({c})', 'COUNT(*)'), 2)} AS completeness_pct, "
        f"IF({ok}, 'PASS', 'FAIL') AS uniqueness_check FROM cust"
        for c, ok in VALID.items()
    ]
    return with_base("SELECT * FROM (" + " UNION ALL ".join(parts) + ") q")


def outlier_report_sql() -> str:
    """The two kinds counted one by one, against fences from the sorted list of revenues."""
    v = "vals"
    fences = f"""fences AS (SELECT total, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM
  (SELECT {position_quantile(v, 0.25)} AS q1, {position_quantile(v, 0.75)} AS q3, total
   FROM (SELECT {median_list("monthly_revenue")} AS vals, COUNT(*) AS total FROM cust) l) q)"""
    parts = [
        f"""SELECT '{name}' AS revenue_outlier_flag, CAST(COUNT(*) AS BIGINT) AS customer_count,
  {r("100.0 * COUNT(*) / ANY_VALUE(total)", 2)} AS percentage, {r(mean("monthly_revenue"), 2)} AS avg_revenue,
  {r("MIN(monthly_revenue)", 2)} AS min_revenue, {r("MAX(monthly_revenue)", 2)} AS max_revenue
FROM cust, fences WHERE {keep} HAVING COUNT(*) > 0"""
        for name, keep in (
            ("NORMAL", "monthly_revenue IS NULL OR monthly_revenue BETWEEN low AND high"),
            ("OUTLIER", "monthly_revenue NOT BETWEEN low AND high"),
        )
    ]
    return with_base(" UNION ALL ".join(parts), fences)


def cleaning_summary_sql() -> str:
    """Corrections by comparing raw and clean columns; the stages' shares from a total looked up apart."""
    pairs = {"age": "cleaned_age", "revenue": "cleaned_monthly_revenue", "industry": "standardized_industry"}
    raw = {"age": "age", "revenue": "monthly_revenue", "industry": "industry"}
    count = {k: f"COUNT(*) FILTER ({raw[k]} IS NOT NULL AND {c} IS DISTINCT FROM {raw[k]})" for k, c in pairs.items()}
    rate = {k: r(pct(c, "COUNT(*)"), 2) for k, c in count.items()}
    number = lambda k: f"CAST({count[k]} AS BIGINT)"
    return with_base(
        f"""
SELECT 'Data Cleaning Summary' AS report_section, CAST(COUNT(*) AS BIGINT) AS total_records,
  {number("age")} AS age_corrections, {number("revenue")} AS revenue_corrections,
  {number("industry")} AS industry_standardizations, {rate["age"]} AS age_correction_rate,
  {rate["revenue"]} AS revenue_correction_rate, {rate["industry"]} AS industry_standardization_rate FROM clean
UNION ALL BY NAME
SELECT 'Lifecycle Distribution' AS report_section, CAST(COUNT(*) AS BIGINT) AS total_records FROM clean
UNION ALL BY NAME
SELECT customer_lifecycle_stage AS report_section, CAST(COUNT(*) AS BIGINT) AS total_records,
  {r(pct("COUNT(*)", "(SELECT COUNT(*) FROM clean)"), 2)} AS age_correction_rate
FROM clean GROUP BY customer_lifecycle_stage"""
    )


def lifecycle_distribution_sql() -> str:
    return with_base(
        f"SELECT customer_lifecycle_stage, CAST(COUNT(*) AS BIGINT) AS customer_count, "
        f"{r(pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()'), 2)} AS share_pct FROM clean GROUP BY customer_lifecycle_stage"
    )


def cardinality_report_sql() -> str:
    return with_base(
        "SELECT 'Index Recommendations' AS analysis_type, 'High cardinality columns need indexes' AS recommendation, "
        "CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS unique_customer_ids, CAST(COUNT(DISTINCT industry) AS BIGINT) AS unique_industries, "
        "CAST(COUNT(DISTINCT subscription_tier) AS BIGINT) AS unique_tiers, CAST(COUNT(DISTINCT location) AS BIGINT) AS unique_locations FROM cust"
    )


def missing_report_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS missing_count, "
        f"{r(pct(f'COUNT(*) - COUNT({c})', 'COUNT(*)'), 6)} AS missing_percentage FROM cust"
        for c in RAW_COLS
    ]
    return with_base("SELECT * FROM (" + " UNION ALL ".join(parts) + ") q ORDER BY missing_percentage DESC, column_name")


def missing_summary_sql() -> str:
    miss = " + ".join(f"(COUNT(*) - COUNT({c}))" for c in RAW_COLS)
    anym = " + ".join(f"(CASE WHEN COUNT(*) - COUNT({c}) > 0 THEN 1 ELSE 0 END)" for c in RAW_COLS)
    n = len(RAW_COLS)
    return with_base(
        f"SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST({n} AS BIGINT) AS n_columns, CAST({miss} AS BIGINT) AS total_missing, "
        f"CAST({anym} AS BIGINT) AS columns_with_missing, {r(f'100.0 * ({miss}) / (COUNT(*) * {n})', 6)} AS missing_cell_pct FROM cust"
    )


def iqr_outliers_sql() -> str:
    qs = ", ".join(
        f"quantile_cont({c}, 0.25) AS q1_{i}, quantile_cont({c}, 0.75) AS q3_{i}" for i, c in enumerate(NUM_COLS)
    )
    parts = []
    for i, c in enumerate(NUM_COLS):
        lo = f"(q.q1_{i} - 1.5 * (q.q3_{i} - q.q1_{i}))"
        hi = f"(q.q3_{i} + 1.5 * (q.q3_{i} - q.q1_{i}))"
        cnt = f"COUNT(CASE WHEN c.{c} < {lo} OR c.{c} > {hi} THEN 1 END)"
        parts.append(
            f"SELECT '{c}' AS column_name, CAST({cnt} AS BIGINT) AS outlier_count, "
            f"{r(pct(cnt, 'COUNT(*)'), 6)} AS outlier_percentage FROM cust c CROSS JOIN qq q"
        )
    return with_base(" UNION ALL ".join(parts), f"qq AS (SELECT {qs} FROM cust)")


def describe_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST(COUNT({c}) AS BIGINT) AS count, {r(f'AVG({c})', 6)} AS mean, "
        f"{r(f'STDDEV_SAMP({c})', 6)} AS std, {r(f'CAST(MIN({c}) AS DOUBLE)', 6)} AS min, "
        f"{r(f'quantile_cont({c}, 0.25)', 6)} AS p25, {r(f'quantile_cont({c}, 0.5)', 6)} AS p50, "
        f"{r(f'quantile_cont({c}, 0.75)', 6)} AS p75, {r(f'CAST(MAX({c}) AS DOUBLE)', 6)} AS max FROM cust"
        for c in NUM_COLS
    ]
    return with_base(" UNION ALL ".join(parts))


def univariate_sql() -> str:
    parts = []
    for c in NUM_COLS:
        m = f"(SELECT AVG({c}) FROM cust)"
        m2 = f"AVG(POWER({c} - {m}, 2))"
        m3 = f"AVG(POWER({c} - {m}, 3))"
        parts.append(
            f"SELECT '{c}' AS column_name, {r(f'AVG({c})', 6)} AS mean, {r(position_quantile('(' + median_list(c) + ')', 0.5), 6)} AS median, "
            f"{r(f'STDDEV_SAMP({c})', 6)} AS std, {r(f'{m3} / POWER({m2}, 1.5)', 6)} AS skewness FROM cust"
        )
    return with_base(" UNION ALL ".join(parts))


def categorical_report_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST((SELECT COUNT(DISTINCT {c}) FROM cust) AS BIGINT) AS unique_count, "
        f"(SELECT CAST({c} AS VARCHAR) FROM cust WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} ASC LIMIT 1) AS most_common"
        for c in STR_COLS
    ]
    return with_base(" UNION ALL ".join(parts))


def duplicate_count_sql() -> str:
    cols = ", ".join(RAW_COLS)
    return with_base(
        f"SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT COUNT(*) AS c FROM cust GROUP BY {cols}) g"
    )


def value_counts_sql() -> str:
    cols = ("subscription_tier", "industry", "location", "referral_source")
    parts = [
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, CAST(COUNT(*) AS BIGINT) AS count, "
        f"{r(pct('COUNT(*)', '(SELECT COUNT(*) FROM cust)'), 6)} AS share_pct FROM cust WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in cols
    ]
    return with_base(" UNION ALL ".join(parts))


def crosstab_sql() -> str:
    return with_base(
        "SELECT referral_source, activation_completed, CAST(COUNT(*) AS BIGINT) AS count, "
        f"{r('CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY referral_source)', 6)} AS row_share "
        "FROM cust WHERE referral_source IS NOT NULL AND activation_completed IS NOT NULL GROUP BY referral_source, activation_completed"
    )


def overview_sql() -> str:
    return with_base(
        f"SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST({len(RAW_COLS)} AS BIGINT) AS n_columns, "
        "CAST(ROUND(SUM(CAST(monthly_revenue AS DECIMAL(18,6))), 2) AS DOUBLE) AS total_monthly_revenue, "
        f"{r(mavg('monthly_revenue'), 2)} AS avg_monthly_revenue, {r('AVG(activation_completed)', 6)} AS activation_rate, "
        f"{r(mavg('churn_risk_score'), 6)} AS avg_churn_risk, {r(mavg('customer_satisfaction_score'), 6)} AS avg_satisfaction FROM cust"
    )


def histogram_sql(cols, bins=20) -> str:
    parts = []
    for c in cols:
        b = (f"CASE WHEN mx = mn THEN 1 ELSE LEAST({bins}, CAST(FLOOR((CAST({c} AS DOUBLE) - mn) / (mx - mn) * {bins}) AS INTEGER) + 1) END")
        w = f"((mx - mn) / {bins})"
        parts.append(
            f"SELECT '{c}' AS column_name, bin, {r(f'mn + (bin - 1) * {w}', 6)} AS bin_lower, {r(f'mn + bin * {w}', 6)} AS bin_upper, "
            f"CAST(COUNT(*) AS BIGINT) AS count FROM (SELECT {b} AS bin, mn, mx FROM cust, "
            f"(SELECT CAST(MIN({c}) AS DOUBLE) AS mn, CAST(MAX({c}) AS DOUBLE) AS mx FROM cust) WHERE {c} IS NOT NULL) GROUP BY bin, mn, mx"
        )
    return with_base(" UNION ALL ".join(parts))


def box_stats_sql(value, group) -> str:
    ctes = f"""q AS (SELECT {group}, CAST(COUNT(*) AS BIGINT) AS n, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
   quantile_cont({value}, 0.75) AS q3 FROM clean WHERE {value} IS NOT NULL GROUP BY {group}),
qb AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
w AS (SELECT c.{group}, CAST(MIN(CASE WHEN c.{value} >= qb.lo THEN c.{value} END) AS DOUBLE) AS wl,
   CAST(MAX(CASE WHEN c.{value} <= qb.hi THEN c.{value} END) AS DOUBLE) AS wh,
   CAST(COUNT(CASE WHEN c.{value} < qb.lo OR c.{value} > qb.hi THEN 1 END) AS BIGINT) AS outliers
   FROM clean c JOIN qb ON c.{group} = qb.{group} WHERE c.{value} IS NOT NULL GROUP BY c.{group})"""
    body = f"""SELECT qb.{group}, qb.n, {r('q1', 6)} AS q1, {r('median', 6)} AS median, {r('q3', 6)} AS q3,
  {r('wl', 6)} AS whisker_low, {r('wh', 6)} AS whisker_high, outliers FROM qb JOIN w ON qb.{group} = w.{group}"""
    return with_base(body, ctes)


def journey_funnel_sql() -> str:
    ctes = f"""a AS (SELECT subscription_tier, AVG(activation_completed) AS act, {mavg('feature_adoption_score')} AS adopt,
   {mavg('customer_satisfaction_score')} / 5 AS sat FROM cust GROUP BY subscription_tier)"""
    body = (
        f"SELECT subscription_tier, 'Activation' AS stage, {r('act', 6)} AS score FROM a UNION ALL "
        f"SELECT subscription_tier, 'Feature Adoption', {r('adopt', 6)} FROM a UNION ALL "
        f"SELECT subscription_tier, 'Satisfaction', {r('sat', 6)} FROM a"
    )
    return with_base(body, ctes)


def revenue_hierarchy_sql() -> str:
    return with_base(
        "SELECT industry, subscription_tier, referral_source, "
        "CAST(GROUPING(industry, subscription_tier, referral_source) AS BIGINT) AS level_id, "
        "CAST(ROUND(SUM(CAST(monthly_revenue AS DECIMAL(18,6))), 2) AS DOUBLE) AS revenue "
        "FROM cust GROUP BY ROLLUP (industry, subscription_tier, referral_source)"
    )


RULE_PRED = """rp AS (SELECT CAST(COALESCE(churn_risk_score > 0.5, FALSE) AS INTEGER) AS label,
  days_since_last_login / 60.0 AS score, CAST(days_since_last_login / 60.0 > 0.5 AS INTEGER) AS prediction FROM cust)"""


def confusion_rule_sql() -> str:
    return with_base("SELECT label, prediction, CAST(COUNT(*) AS BIGINT) AS count FROM rp GROUP BY label, prediction", RULE_PRED)


def summary_metrics_rule_sql() -> str:
    return with_base(
        f"""SELECT {r("AVG(IF(label = prediction, 1.0, 0.0))", 6)} AS accuracy,
  {r("IFNULL(2.0 * SUM(label * prediction) / NULLIF(SUM(label) + SUM(prediction), 0), 0)", 6)} AS f1 FROM rp WHERE prediction IS NOT NULL""",
        RULE_PRED,
    )


def classification_report_rule_sql() -> str:
    parts = []
    for cls in (0, 1):
        o = 1 - cls
        tp = f"CAST(COUNT(CASE WHEN label = {cls} AND prediction = {cls} THEN 1 END) AS DOUBLE)"
        fp = f"CAST(COUNT(CASE WHEN label = {o} AND prediction = {cls} THEN 1 END) AS DOUBLE)"
        fn = f"CAST(COUNT(CASE WHEN label = {cls} AND prediction = {o} THEN 1 END) AS DOUBLE)"
        prec = f"(CASE WHEN {tp} + {fp} > 0 THEN {tp} / ({tp} + {fp}) ELSE 0.0 END)"
        rec = f"(CASE WHEN {tp} + {fn} > 0 THEN {tp} / ({tp} + {fn}) ELSE 0.0 END)"
        f1 = f"(CASE WHEN {prec} + {rec} > 0 THEN 2 * {prec} * {rec} / ({prec} + {rec}) ELSE 0.0 END)"
        parts.append(
            f"SELECT {cls} AS class, {r(prec, 6)} AS precision, {r(rec, 6)} AS recall, {r(f1, 6)} AS f1, "
            f"CAST({tp} + {fn} AS BIGINT) AS support FROM rp"
        )
    return with_base(" UNION ALL ".join(parts), RULE_PRED)


def roc_points_rule_sql() -> str:
    ctes = RULE_PRED + """,
h AS (SELECT CAST(score AS DOUBLE) AS score, COUNT(CASE WHEN label = 1 THEN 1 END) AS pos, COUNT(CASE WHEN label = 0 THEN 1 END) AS neg
  FROM rp GROUP BY score),
c AS (SELECT score, pos, neg, SUM(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
  SUM(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn, SUM(pos) OVER () AS P, SUM(neg) OVER () AS N FROM h)"""
    body = (
        f"SELECT {r('score', 6)} AS threshold, CAST(cp AS BIGINT) AS tp, CAST(cn AS BIGINT) AS fp, "
        f"{r('CAST(cp AS DOUBLE) / P', 6)} AS tpr, {r('CAST(cn AS DOUBLE) / N', 6)} AS fpr, "
        f"{r('CAST(cp AS DOUBLE) / (CAST(cp AS DOUBLE) + CAST(cn AS DOUBLE))', 6)} AS precision FROM c"
    )
    return with_base(body, ctes)


def roc_auc_rule_sql() -> str:
    ctes = RULE_PRED + """,
h AS (SELECT CAST(score AS DOUBLE) AS score, COUNT(CASE WHEN label = 1 THEN 1 END) AS pos, COUNT(CASE WHEN label = 0 THEN 1 END) AS neg
  FROM rp GROUP BY score),
c AS (SELECT pos, neg, SUM(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
  CAST(SUM(pos) OVER () AS DOUBLE) AS P, CAST(SUM(neg) OVER () AS DOUBLE) AS N FROM h)"""
    return with_base(f"SELECT {r('SUM(neg / N * (2 * cp - pos) / (2 * P))', 6)} AS roc_auc FROM c", ctes)


def daily_alerts_sql() -> str:
    return with_base(
        """SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, churn_risk_score AS churn_probability
FROM events JOIN cust ON customer_id = user_id WHERE churn_risk_score > 0.7"""
    )


EVENTS_CTE = f"""feat AS (SELECT DATE_TRUNC('day', ts) AS window_start, DATE_TRUNC('day', ts) + INTERVAL 1 DAY AS window_end, user_id,
  CAST(COUNT(*) AS BIGINT) AS events, CAST(COUNT(*) FILTER (event_type = 'login') AS BIGINT) AS logins,
  CAST(COUNT(DISTINCT event_type) AS BIGINT) AS event_types, CAST(SUM(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS value_sum,
  {r("CAST(SUM(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / COUNT(value)", 6)} AS value_avg
  FROM events GROUP BY ALL)"""
RISK = r("0.5 * IF(logins > 0, 0.0, 1.0) + 0.3 * (1.0 / (1 + events)) + 0.2 * (1.0 / (1 + event_types))", 6)


def event_features_sql() -> str:
    return f"WITH {EVENTS_CTE} SELECT * FROM feat"


def event_scores_sql() -> str:
    return f"WITH {EVENTS_CTE} SELECT *, {RISK} AS churn_probability FROM feat"


def event_alerts_sql() -> str:
    return f"WITH {EVENTS_CTE} SELECT window_start, user_id, {RISK} AS churn_probability FROM feat WHERE {RISK} > 0.7"


def user_scores_sql(quiet_hours: int = 6, late: str = "1 DAY") -> str:
    """A user is quiet if the last event is older than the newest one by more than both spans (in whole milliseconds)."""
    risk = r("IF(quiet OR logins = 0, 0.5, 0.0) + 0.3 * (1.0 / (1 + events)) + 0.2 * (1.0 / (1 + event_types))", 6)
    return f"""
WITH u AS (SELECT user_id, CAST(COUNT(*) AS BIGINT) AS events, CAST(COUNT(*) FILTER (event_type = 'login') AS BIGINT) AS logins,
  CAST(COUNT(DISTINCT event_type) AS BIGINT) AS event_types, CAST(SUM(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS value_sum,
  COUNT(value) AS vn, MAX(ts) AS last_seen FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY user_id),
q AS (SELECT *, EPOCH_MS(last_seen + INTERVAL {quiet_hours} HOUR)
  < EPOCH_MS((SELECT MAX(ts) FROM events WHERE user_id IS NOT NULL) - INTERVAL {late}) AS quiet FROM u)
SELECT user_id, quiet, events, logins, event_types, value_sum, {r("value_sum / vn", 6)} AS value_avg, last_seen,
  {risk} AS churn_probability FROM q"""


def session_features_sql() -> str:
    """A session starts where no event of the user lies in the 30 minutes before."""
    return """
WITH e AS (SELECT user_id, ts, ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE AS gap FROM events),
s AS (SELECT user_id, ts, SUM(IF(gap IS NULL OR gap, 1, 0)) OVER (PARTITION BY user_id ORDER BY ts, gap ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end, user_id, CAST(COUNT(*) AS BIGINT) AS events
FROM s GROUP BY user_id, k"""


def sample_points_sql(fraction: float) -> str:
    key = "(CAST(customer_id AS VARCHAR) || '/' || standardized_subscription_tier)"
    return with_base(
        "SELECT customer_id, monthly_revenue, feature_usage_score, customer_satisfaction_score, standardized_subscription_tier, "
        f"company_size FROM clean WHERE {draw(key, 0)} < {fraction}"
    )


def density_sql(c: str, grid: int = 200, bins: int = 512) -> str:
    """The kernel sum over every pair of grid point and histogram cell."""
    ctes = f"""st AS (SELECT MIN({c}) AS mn, MAX({c}) AS mx, COUNT({c}) AS n, STDDEV_SAMP({c}) AS sd FROM cust),
cell AS (SELECT LEAST({bins - 1}, CAST(FLOOR(({c} - mn) / ((mx - mn) / {bins})) AS INTEGER)) AS bin, COUNT(*) AS c
  FROM cust, st WHERE {c} IS NOT NULL GROUP BY 1),
pts AS (SELECT i, mn + i * (mx - mn) / {grid - 1} AS x, sd * POWER(n, -0.2) AS bw, n, mn, (mx - mn) / {bins} AS w FROM st, range({grid}) g(i))"""
    z = "((x - (mn + (bin + 0.5) * w)) / bw)"
    return with_base(
        f"""SELECT '{c}' AS column_name, {r("ANY_VALUE(x)", 6)} AS x,
  CAST(ROUND(SUM(c * EXP(-0.5 * {z} * {z})) / (ANY_VALUE(n) * ANY_VALUE(bw) * SQRT(2 * PI())), 9) AS DOUBLE) AS density
FROM pts, cell GROUP BY i""",
        ctes,
    )


def psi_sql(cols, bins=10) -> str:
    probs = [i / bins for i in range(1, bins)]
    parts = []
    for c in cols:
        qs = ", ".join(f"quantile_cont({c}, {p}) AS e{k}" for k, p in enumerate(probs))
        b = " + ".join(f"CAST({c} > e{k} AS INTEGER)" for k in range(len(probs)))
        parts.append(f"""
SELECT '{c}' AS column_name, bin, COUNT(CASE WHEN grp = 'p' THEN 1 END) AS n_p, COUNT(CASE WHEN grp = 'q' THEN 1 END) AS n_q
FROM (SELECT CASE WHEN signup_date < DATE '2023-01-01' THEN 'p' ELSE 'q' END AS grp, {b} AS bin
      FROM cust, (SELECT {qs} FROM cust WHERE signup_date < DATE '2023-01-01') ee WHERE {c} IS NOT NULL) t
GROUP BY bin""")
    ctes = "cnt AS (" + " UNION ALL ".join(parts) + "),\ntot AS (SELECT column_name, SUM(n_p) AS tp, SUM(n_q) AS tq FROM cnt GROUP BY column_name)"
    term = "((CAST(n_q AS DOUBLE) / tq - CAST(n_p AS DOUBLE) / tp) * LN((CAST(n_q AS DOUBLE) / tq + 1e-6) / (CAST(n_p AS DOUBLE) / tp + 1e-6)))"
    body = f"""
SELECT c.column_name, {r(f'SUM({term})', 6)} AS psi,
  CASE WHEN {r(f'SUM({term})', 6)} < 0.1 THEN 'stable' WHEN {r(f'SUM({term})', 6)} < 0.25 THEN 'moderate' ELSE 'significant' END AS drift
FROM cnt c JOIN tot t ON c.column_name = t.column_name GROUP BY c.column_name"""
    return with_base(body, ctes)
