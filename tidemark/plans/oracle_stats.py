"""DuckDB oracles for the statistical tests, segments and model inputs.

Moments and correlations are DuckDB's own aggregates. Tail probabilities are
Simpson sums of the densities over ``range()``; t quantiles are the
Cornish-Fisher series in the normal quantile.
"""

from __future__ import annotations

from itertools import combinations

from tidemark.plans.oracle import draw, kept, position_quantile, r, with_base

PANELS = 4000


def simpson(density: str, upper: str, source: str, keys: str) -> str:
    """Per row of ``source`` (with ``keys``): the integral of ``density`` (of ``x``) from 0 to ``upper``."""
    weight = f"CASE WHEN i = 0 OR i = {PANELS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"""(SELECT {keys}, SUM({weight} * ({density})) * ANY_VALUE(top) / {PANELS} / 3 AS area
  FROM (SELECT *, i * top / {PANELS} AS x FROM (SELECT *, {upper} AS top FROM {source}) q, range({PANELS + 1}) g(i)) p GROUP BY {keys})"""


T_DENSITY = "EXP(lgamma((dof + 1) / 2.0) - lgamma(dof / 2.0) - 0.5 * LN(dof * PI()) - (dof + 1) / 2.0 * LN(1 + x * x / dof))"
NORMAL_DENSITY = "EXP(-x * x / 2) / SQRT(2 * PI())"
#: of the square root of a chi-square variable, which has no singular end
CHI_DENSITY = "IF(x = 0 AND dof > 1, 0, EXP((1 - dof / 2.0) * LN(2) + (dof - 1) * LN(GREATEST(x, 1e-300)) - x * x / 2 - lgamma(dof / 2.0)))"
#: of Beta(d2/2, d1/2)
BETA_DENSITY = (
    "IF(x = 0, 0, EXP(lgamma((d1 + d2) / 2.0) - lgamma(d1 / 2.0) - lgamma(d2 / 2.0) "
    "+ (d2 / 2.0 - 1) * LN(GREATEST(x, 1e-300)) + (d1 / 2.0 - 1) * LN(1 - x)))"
)


def _pair(value, group, a, b) -> str:
    cols = ", ".join(
        f"CAST(COUNT({value}) FILTER ({group} = '{g}') AS DOUBLE) AS n_{t}, AVG({value}) FILTER ({group} = '{g}') AS m_{t}, "
        f"VAR_SAMP({value}) FILTER ({group} = '{g}') AS v_{t}"
        for t, g in (("a", a), ("b", b))
    )
    return f"two AS (SELECT {cols} FROM {{src}})"


POOLED = "((n_a - 1) * v_a + (n_b - 1) * v_b) / (n_a + n_b - 2)"
ERROR2 = "(v_a / n_a + v_b / n_b)"
WELCH_DF = f"(POWER({ERROR2}, 2) / (POWER(v_a / n_a, 2) / (n_a - 1) + POWER(v_b / n_b, 2) / (n_b - 1)))"


def ttest_sql(value, group, a, b, equal_var=True, src="clean", extra_ctes="", with_p=False) -> str:
    if equal_var:
        t, dof = f"(m_a - m_b) / SQRT({POOLED} * (1 / n_a + 1 / n_b))", "(n_a + n_b - 2)"
    else:
        t, dof = f"(m_a - m_b) / SQRT({ERROR2})", WELCH_DF
    test = f"test AS (SELECT *, {t} AS t, {dof} AS dof FROM two)"
    tail = f"tail AS (SELECT 1 - 2 * area AS p FROM {simpson(T_DENSITY, 'ABS(t)', 'test', 't')} s)"
    extra = f", {r('p', 6)} AS p_value, {r('p', 6)} < 0.05 AS significant" if with_p else ""
    body = f"""
SELECT '{a}' AS group_a, '{b}' AS group_b, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, {r("m_a", 6)} AS mean_a,
  {r("m_b", 6)} AS mean_b, {r("t", 6)} AS t_stat, {r("dof", 6)} AS df, {r("m_a - m_b", 6)} AS mean_diff,
  {r(f"m_a - m_b - 1.96 * SQRT({ERROR2})", 6)} AS ci_lower, {r(f"m_a - m_b + 1.96 * SQRT({ERROR2})", 6)} AS ci_upper{extra}
FROM test{", tail" if with_p else ""}"""
    return with_base(body, extra_ctes, _pair(value, group, a, b).format(src=src), test, tail if with_p else "")


def cohens_d_sql(value, group, a, b, average_variance=False) -> str:
    sd = "SQRT((v_a + v_b) / 2)" if average_variance else f"SQRT({POOLED})"
    return with_base(
        f"""SELECT '{a}' AS group_a, '{b}' AS group_b, {r("d", 6)} AS cohens_d,
  ['Small', 'Medium', 'Large'][1 + CAST(ABS(d) >= 0.5 AS INTEGER) + CAST(ABS(d) >= 0.8 AS INTEGER)] AS effect_size
FROM (SELECT (m_a - m_b) / {sd} AS d FROM two) e""",
        _pair(value, group, a, b).format(src="clean"),
    )


def _rates(flag: str, group: str, a: str, b: str, src: str) -> str:
    return f"""rates AS (SELECT *, (p_a - p_b) / SQRT(p * (1 - p) * (1 / z_a + 1 / z_b)) AS z FROM
  (SELECT x_a, x_b, z_a, z_b, x_a / z_a AS p_a, x_b / z_b AS p_b, (x_a + x_b) / (z_a + z_b) AS p FROM
    (SELECT SUM(IF({group} = '{a}' AND {flag}, 1.0, 0.0))::DOUBLE AS x_a, SUM(IF({group} = '{a}', 1.0, 0.0))::DOUBLE AS z_a,
       SUM(IF({group} = '{b}' AND {flag}, 1.0, 0.0))::DOUBLE AS x_b, SUM(IF({group} = '{b}', 1.0, 0.0))::DOUBLE AS z_b FROM {src}) c) q)"""


RATE_COLUMNS = f"""CAST(x_a AS BIGINT) AS successes_a, CAST(z_a AS BIGINT) AS n_a, CAST(x_b AS BIGINT) AS successes_b,
  CAST(z_b AS BIGINT) AS n_b, {r("p_a", 6)} AS rate_a, {r("p_b", 6)} AS rate_b, {r("z", 6)} AS z_stat"""


def ztest_sql(group, a, b, with_p=False) -> str:
    tail = f"tail AS (SELECT 1 - 2 * area AS p2 FROM {simpson(NORMAL_DENSITY, 'ABS(z)', 'rates', 'z')} s)"
    return with_base(
        f"SELECT '{a}' AS group_a, '{b}' AS group_b, {RATE_COLUMNS}{f', {r("p2", 6)} AS p_value' if with_p else ''} "
        f"FROM rates{', tail' if with_p else ''}",
        _rates("activation_completed = 1", group, a, b, "clean"),
        tail if with_p else "",
    )


def anova_sql(value, group, groups=None, with_p=False) -> str:
    chosen = f" AND {group} IN ({', '.join(repr(g) for g in groups)})" if groups else ""
    rows = f"""rows_ AS (SELECT {value} AS v, {group} AS g, AVG({value}) OVER (PARTITION BY {group}) AS own, AVG({value}) OVER () AS grand
  FROM clean WHERE {value} IS NOT NULL AND {group} IS NOT NULL{chosen})"""
    test = """test AS (SELECT k, n, k - 1 AS d1, n - k AS d2, (between_ / (k - 1)) / (within_ / (n - k)) AS f FROM
  (SELECT COUNT(DISTINCT g) AS k, COUNT(*) AS n, SUM(POWER(own - grand, 2)) AS between_, SUM(POWER(v - own, 2)) AS within_ FROM rows_) s)"""
    tail = f"tail AS (SELECT area AS p FROM {simpson(BETA_DENSITY, 'd2 / (d2 + d1 * f)', 'test', 'f')} s)"
    return with_base(
        f"""SELECT '{value}' AS value, '{group}' AS factor, CAST(k AS BIGINT) AS n_groups, CAST(n AS BIGINT) AS n,
  {r("f", 6)} AS f_stat{f", {r('p', 6)} AS p_value" if with_p else ""} FROM test{", tail" if with_p else ""}""",
        rows,
        test,
        tail if with_p else "",
    )


def chi2_sql(a, b, with_p=False) -> str:
    cells = f"""cells AS (SELECT o, e, lines, cols FROM
  (SELECT x.a, y.b, (SELECT COUNT(*) FROM known k WHERE k.a = x.a AND k.b = y.b) AS o, x.n * y.n / CAST(t.n AS DOUBLE) AS e,
     x.lines, y.cols FROM (SELECT a, COUNT(*) AS n, COUNT(*) OVER () AS lines FROM known GROUP BY a) x,
     (SELECT b, COUNT(*) AS n, COUNT(*) OVER () AS cols FROM known GROUP BY b) y, (SELECT COUNT(*) AS n FROM known) t) c)"""
    test = """test AS (SELECT (ANY_VALUE(lines) - 1) * (ANY_VALUE(cols) - 1) AS dof,
  SUM(POWER(IF((lines - 1) * (cols - 1) = 1, GREATEST(ABS(o - e) - 0.5, 0), o - e), 2) / e) AS chi2 FROM cells)"""
    tail = f"tail AS (SELECT 1 - area AS p FROM {simpson(CHI_DENSITY, 'SQRT(chi2)', 'test', 'chi2')} s)"
    return with_base(
        f"""SELECT '{a}' AS row_var, '{b}' AS col_var, {r("chi2", 6)} AS chi2, CAST(dof AS BIGINT) AS dof
  {f", {r('p', 6)} AS p_value" if with_p else ""} FROM test{", tail" if with_p else ""}""",
        f"known AS (SELECT {a} AS a, {b} AS b FROM cust WHERE {a} IS NOT NULL AND {b} IS NOT NULL)",
        cells,
        test,
        tail if with_p else "",
    )


def mean_ci_sql(cols) -> str:
    """95 % intervals; the t quantile from its series in the normal quantile."""
    z = 1.959963984540054
    terms = [
        z,
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    t = " + ".join(f"{c!r} / POWER(n - 1, {k})" for k, c in enumerate(terms))
    parts = [
        f"SELECT '{c}' AS metric, COUNT({c}) AS n, AVG({c}) AS m, STDDEV_SAMP({c}) / SQRT(COUNT({c})) AS e FROM clean" for c in cols
    ]
    return with_base(
        f"""SELECT metric, CAST(n AS BIGINT) AS n, {r("m", 6)} AS mean, {r("e", 6)} AS sem,
  {r(f"m - ({t}) * e", 6)} AS ci_lower, {r(f"m + ({t}) * e", 6)} AS ci_upper FROM ({" UNION ALL ".join(parts)}) q"""
    )


def _pairs(cols, src) -> str:
    rows = [
        f"SELECT '{x}' AS var1, '{y}' AS var2, COUNT(*) AS n, CORR({x}, {y}) AS rho FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL"
        for x, y in combinations(cols, 2)
    ]
    return f"pr AS ({' UNION ALL '.join(rows)})"


def pearson_sql(cols, top=None, with_p=False, strong=False) -> str:
    select = f"var1, var2, CAST(n AS BIGINT) AS n, {r('rho', 6)} AS pearson_r"
    if not with_p:
        order = f" ORDER BY ABS(rho) DESC, var1, var2 LIMIT {top}" if top else ""
        return with_base(f"SELECT {select} FROM pr{order}", _pairs(cols, "clean"))
    only = " WHERE ABS(rho) > 0.3" if strong else ""  # the others need no integral
    test = f"test AS (SELECT *, CAST(n - 2 AS DOUBLE) AS dof, rho * SQRT((n - 2) / (1 - rho * rho)) AS t FROM pr{only})"
    tail = f"tail AS (SELECT var1, var2, 1 - 2 * area AS q FROM {simpson(T_DENSITY, 'ABS(t)', 'test', 'var1, var2')} s)"
    p = r("q", 6)
    is_strong = f"ABS(rho) > 0.3 AND {p} < 0.05"
    return with_base(
        f"""SELECT {select}, {p} AS p_value, {p} < 0.05 AS significant,
  ['*', '**', '***'][1 + CAST({p} < 0.01 AS INTEGER) + CAST({p} < 0.001 AS INTEGER)] AS stars
  {"" if strong else f", {is_strong} AS strong"} FROM test JOIN tail USING (var1, var2){f" WHERE {is_strong}" if strong else ""}""",
        _pairs(cols, "clean"),
        test,
        tail,
    )


def spearman_sql(cols, top=None) -> str:
    """Ranks on each pair's own complete rows: a value's rank is the mean of the places of its rows."""
    parts = []
    for x, y in combinations(cols, 2):
        place = lambda c: f"AVG(place_{c}) OVER (PARTITION BY {c})"
        parts.append(f"""SELECT '{x}' AS var1, '{y}' AS var2, COUNT(*) AS n, CORR(rx, ry) AS rho FROM
  (SELECT {place(x)} AS rx, {place(y)} AS ry FROM
    (SELECT {x}, {y}, ROW_NUMBER() OVER (ORDER BY {x}) AS place_{x}, ROW_NUMBER() OVER (ORDER BY {y}) AS place_{y}
     FROM clean WHERE {x} IS NOT NULL AND {y} IS NOT NULL) a) b""")
    order = f" ORDER BY ABS(rho) DESC, var1, var2 LIMIT {top}" if top else ""
    return with_base(
        f"SELECT var1, var2, CAST(n AS BIGINT) AS n, {r('rho', 6)} AS spearman_rho FROM pr{order}",
        f"pr AS ({' UNION ALL '.join(parts)})",
    )


VALUE_SCORE = "(monthly_revenue * 0.4 + feature_usage_score * 1000 * 0.3 + customer_satisfaction_score * 2000 * 0.3)"
_CUTS = ", ".join(f"{position_quantile('v', p)} AS q{i}" for i, p in enumerate((0.25, 0.5, 0.75), 1))
SEG_CTES = f"""scored AS (SELECT *, {VALUE_SCORE} AS customer_value_score FROM cust),
cuts AS (SELECT {_CUTS} FROM (SELECT LIST(customer_value_score ORDER BY customer_value_score)
  FILTER (customer_value_score IS NOT NULL) AS v FROM scored) l),
seg AS (SELECT scored.*, ['At Risk', 'Low Value', 'Medium Value', 'High Value'][1 + IFNULL(CAST(customer_value_score >= q1 AS INTEGER)
  + CAST(customer_value_score >= q2 AS INTEGER) + CAST(customer_value_score >= q3 AS INTEGER), 0)] AS value_segment FROM scored, cuts)"""


def value_segments_sql() -> str:
    return with_base("SELECT customer_id, customer_value_score, value_segment FROM seg", SEG_CTES)


def segment_report_sql() -> str:
    return with_base(
        f"""SELECT value_segment, {r("AVG(monthly_revenue)", 2)} AS revenue_mean, {r("STDDEV_SAMP(monthly_revenue)", 2)} AS revenue_std,
  CAST(COUNT(monthly_revenue) AS BIGINT) AS revenue_count, {r("AVG(churn_risk_score)", 2)} AS churn_risk_mean,
  {r("AVG(customer_satisfaction_score)", 2)} AS satisfaction_mean, {r("AVG(activation_completed)", 2)} AS activation_mean
FROM seg GROUP BY value_segment""",
        SEG_CTES,
    )


def segment_ttest_sql() -> str:
    return ttest_sql("monthly_revenue", "value_segment", "High Value", "At Risk", True, src="seg", extra_ctes=SEG_CTES)


def revenue_concentration_sql() -> str:
    return with_base(
        f"""SELECT 'High Value' AS segment,
  {r("100.0 * SUM(monthly_revenue) FILTER (value_segment = 'High Value') / SUM(monthly_revenue)", 6)} AS revenue_share_pct FROM seg""",
        SEG_CTES,
    )


def prob_greater_sql(value, group, a, b) -> str:
    test = f"test AS (SELECT (m_a - m_b) / SQRT({ERROR2}) AS z FROM two)"
    return with_base(
        f"SELECT '{a}' AS group_a, '{b}' AS group_b, {r('0.5 + SIGN(z) * area', 6)} AS prob_a_greater "
        f"FROM {simpson(NORMAL_DENSITY, 'ABS(z)', 'test', 'z')} s",
        _pair(value, group, a, b).format(src="clean"),
        test,
    )


SEG_FEATURES = [
    "monthly_revenue", "transaction_volume", "feature_usage_score", "total_sessions", "avg_session_duration",
    "api_calls_per_month", "customer_satisfaction_score", "company_size", "annual_contract_value",
    "revenue_per_session", "api_efficiency", "engagement_score", "days_since_signup",
]


def _filled(cols) -> str:
    """Columns with NULL replaced by the median of the others."""
    return ", ".join(f"IFNULL(CAST({c} AS DOUBLE), CAST(MEDIAN({c}) OVER () AS DOUBLE)) AS {c}" for c in cols)


FEATURES_CTE = f"""made AS (SELECT *, monthly_revenue / (total_sessions + 1) AS revenue_per_session,
  api_calls_per_month / (total_sessions + 1) AS api_efficiency,
  feature_usage_score * 0.3 + avg_session_duration / 30 * 0.3 + (1 - churn_risk_score) * 0.4 AS engagement_score,
  CAST(DATE '2024-01-01' - signup_date AS INTEGER) AS days_since_signup FROM cust),
features AS (SELECT * REPLACE ({_filled(SEG_FEATURES)}),
  ['New', 'Growing', 'Mature', 'Veteran'][1 + IFNULL(CAST(made.days_since_signup > 30 AS INTEGER) + CAST(made.days_since_signup > 90 AS INTEGER)
    + CAST(made.days_since_signup > 180 AS INTEGER), 3)] AS lifecycle_stage FROM made)"""


def segmentation_features_sql() -> str:
    return with_base("SELECT * FROM features", FEATURES_CTE)


def target_correlation_sql(target: str = "monthly_revenue", top: int = 5) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ABS({r(f'CORR({target}, {c})', 6)}) AS abs_corr FROM features" for c in SEG_FEATURES if c != target
    )
    return with_base(f"SELECT * FROM ({rows}) q ORDER BY abs_corr DESC, feature LIMIT {top}", FEATURES_CTE)


def _z(c: str) -> str:
    return f"IF(STDDEV_POP({c}) OVER () = 0, 0, ({c} - AVG({c}) OVER ()) / STDDEV_POP({c}) OVER ())"


def z_scores_sql() -> str:
    return with_base(f"SELECT customer_id, {', '.join(f'{r(_z(c), 6)} AS z_{c}' for c in SEG_FEATURES)} FROM features", FEATURES_CTE)


def cluster_quality_sql() -> str:
    """Long form: a row per customer, labelling and feature. A point's mean squared distance to a cluster is the sum
    over features of z^2 - 2 z mean + mean square; to its own cluster it counts itself out."""
    rich, risky = "CAST(monthly_revenue > 100 AS INTEGER)", "CAST(IFNULL(churn_risk_score > 0.5, FALSE) AS INTEGER)"
    rules = {"by_revenue": rich, "by_risk": risky, "by_both": f"2 * {rich} + {risky}"}
    columns = ", ".join(f"{_z(c)} AS z_{c}" for c in SEG_FEATURES)
    rule = " UNION ALL ".join(f"SELECT '{name}' AS labelling, customer_id, {expr} AS c FROM features" for name, expr in rules.items())
    return with_base(
        f"""SELECT labelling, CAST(k AS INTEGER) AS n_clusters, {r("ss", 6)} AS inertia, {r("sil", 6)} AS silhouette,
  {r("(between_ / (k - 1)) / (ss / (n - k))", 6)} AS calinski_harabasz, {r("db", 6)} AS davies_bouldin,
  IFNULL(ROW_NUMBER() OVER (ORDER BY sil DESC NULLS LAST, labelling) = 1 AND sil IS NOT NULL, FALSE) AS is_best
FROM spread JOIN silhouettes USING (labelling) JOIN bouldin USING (labelling)""",
        FEATURES_CTE,
        f"""zs AS (UNPIVOT (SELECT customer_id, {columns} FROM features) ON COLUMNS(* EXCLUDE customer_id) INTO NAME f VALUE z),
rules AS ({rule}),
points AS (SELECT labelling, customer_id, c, f, z FROM rules JOIN zs USING (customer_id)),
centre AS (SELECT labelling, c, f, COUNT(*) AS n, AVG(z) AS m, AVG(z * z) AS s FROM points GROUP BY ALL),
own AS (SELECT labelling, c, customer_id, SUM((z - m) * (z - m)) AS d2 FROM points JOIN centre USING (labelling, c, f) GROUP BY ALL),
spread AS (SELECT labelling, COUNT(DISTINCT c) AS k, COUNT(*) AS n, SUM(d2) AS ss,
    (SELECT SUM(e.n * POWER(e.m - g.m, 2)) FROM centre e JOIN (SELECT f, AVG(z) AS m FROM zs GROUP BY f) g USING (f)
     WHERE e.labelling = own.labelling) AS between_ FROM own GROUP BY labelling),
far AS (SELECT p.labelling, p.customer_id, p.c, e.c AS other, ANY_VALUE(e.n) AS n, SUM(p.z * p.z - 2 * p.z * e.m + e.s) AS d
  FROM points p JOIN centre e ON e.labelling = p.labelling AND e.f = p.f GROUP BY ALL),
sides AS (SELECT labelling, customer_id, MAX(IF(c = other, IF(n > 1, d * n / (n - 1), NULL), NULL)) AS a, MIN(IF(c = other, NULL, d)) AS b
  FROM far GROUP BY ALL),
silhouettes AS (SELECT labelling, IF(COUNT(b) = 0, NULL, AVG(IF(a IS NULL, 0, (b - a) / GREATEST(a, b)))) AS sil FROM sides GROUP BY labelling),
reach AS (SELECT labelling, c, AVG(SQRT(d2)) AS s FROM own GROUP BY ALL),
apart AS (SELECT x.labelling, x.c, y.c AS o, SQRT(SUM(POWER(x.m - y.m, 2))) AS d FROM centre x
  JOIN centre y ON x.labelling = y.labelling AND x.f = y.f AND x.c <> y.c GROUP BY ALL),
bouldin AS (SELECT labelling, AVG(worst) AS db FROM (SELECT labelling, a.c, MAX((p.s + q.s) / a.d) AS worst FROM apart a
  JOIN reach p USING (labelling, c) JOIN (SELECT labelling, c AS o, s FROM reach) q USING (labelling, o) GROUP BY ALL) w GROUP BY labelling)""",
    )


RULE_CLUSTERS = """labeled AS (SELECT *, 2 * CAST(monthly_revenue > 100 AS INTEGER) + CAST(IFNULL(churn_risk_score > 0.5, FALSE) AS INTEGER) AS cluster
  FROM features)"""


def cluster_profiles_sql() -> str:
    means = ", ".join(
        f"{r(f'AVG({c})', 2)} AS avg_{c}"
        for c in ("company_size", "feature_usage_score", "churn_risk_score", "customer_satisfaction_score", "total_sessions",
                  "annual_contract_value", "engagement_score")
    )
    return with_base(
        f"""SELECT cluster, {r("AVG(monthly_revenue)", 2)} AS revenue_mean, {r("MEDIAN(monthly_revenue)", 2)} AS revenue_median,
  {r("STDDEV_SAMP(monthly_revenue)", 2)} AS revenue_std, CAST(COUNT(monthly_revenue) AS BIGINT) AS revenue_count, {means}
FROM labeled GROUP BY cluster""",
        FEATURES_CTE,
        RULE_CLUSTERS,
    )


NAMES_CTE = """named AS (SELECT *, IF(rev > g75, IF(risk < 0.3, 'High-Value Champions', 'High-Value At-Risk'),
    IF(rev > g50, IF(eng > 0.6, 'Growing Advocates', 'Moderate Users'), IF(risk > 0.6, 'At-Risk Low-Value', 'New/Small Customers'))) AS name
  FROM (SELECT cluster, COUNT(*) AS size, AVG(monthly_revenue) AS rev, SUM(monthly_revenue) AS money, AVG(churn_risk_score) AS risk,
      AVG(customer_satisfaction_score) AS sat, AVG(engagement_score) AS eng FROM labeled GROUP BY cluster) c,
    (SELECT quantile_cont(monthly_revenue, 0.75) AS g75, MEDIAN(monthly_revenue) AS g50, SUM(monthly_revenue) AS all_money,
      COUNT(*) AS everyone FROM labeled) g),
report AS (SELECT cluster, name, CAST(size AS BIGINT) AS size, """ + f"""{r("size / everyone * 100", 4)} AS customer_share_pct,
  {r("rev", 4)} AS avg_revenue, {r("money / all_money * 100", 4)} AS revenue_share_pct, {r("risk", 4)} AS avg_churn_risk,
  {r("sat", 4)} AS avg_satisfaction, {r("eng", 4)} AS avg_engagement,
  (CONTAINS(name, 'High-Value') OR CONTAINS(name, 'Champions')) AS high_value FROM named)"""


def cluster_names_sql() -> str:
    return with_base("SELECT * FROM report", FEATURES_CTE, RULE_CLUSTERS, NAMES_CTE)


def named_customers_sql() -> str:
    return with_base(
        "SELECT customer_id, cluster, name AS cluster_name, high_value FROM labeled JOIN report USING (cluster)",
        FEATURES_CTE, RULE_CLUSTERS, NAMES_CTE,
    )


def high_value_sql() -> str:
    return with_base(
        f"""SELECT CAST(COUNT(*) FILTER (high_value) AS BIGINT) AS clusters, CAST(IFNULL(SUM(size) FILTER (high_value), 0) AS BIGINT) AS customers,
  {r("IFNULL(SUM(customer_share_pct) FILTER (high_value), 0)", 4)} AS customer_share_pct,
  {r("IFNULL(SUM(revenue_share_pct) FILTER (high_value), 0)", 4)} AS revenue_share_pct FROM report""",
        FEATURES_CTE, RULE_CLUSTERS, NAMES_CTE,
    )


def radar_sql() -> str:
    return with_base(
        f"""SELECT name, {r("(AVG(monthly_revenue) - ANY_VALUE(lo)) / (ANY_VALUE(hi) - ANY_VALUE(lo))", 6)} AS revenue,
  {r("AVG(customer_satisfaction_score) / 5", 6)} AS satisfaction, {r("1 - AVG(churn_risk_score)", 6)} AS retention,
  {r("AVG(feature_usage_score)", 6)} AS feature_usage, {r("AVG(engagement_score)", 6)} AS engagement
FROM labeled JOIN report USING (cluster), (SELECT MIN(monthly_revenue) AS lo, MAX(monthly_revenue) AS hi FROM labeled) g GROUP BY name""",
        FEATURES_CTE, RULE_CLUSTERS, NAMES_CTE,
    )


CHURN_FEATURES = [
    "monthly_revenue", "transaction_volume", "feature_usage_score", "support_tickets", "days_since_last_login",
    "total_sessions", "avg_session_duration", "api_calls_per_month", "integration_count", "team_size",
    "annual_contract_value", "customer_satisfaction_score", "company_size", "age", "onboarding_completion_rate",
    "feature_adoption_score", "revenue_per_session", "api_efficiency", "support_intensity", "low_engagement",
    "high_session_duration", "frequent_user", "new_customer", "veteran_customer", "high_value",
    "enterprise_customer", "industry_encoded", "location_encoded", "referral_encoded", "payment_encoded",
]


def _code(c: str) -> str:
    """Place of a value among the column's values in alphabetical order; NULL after them."""
    return f"IF({c} IS NULL, (SELECT COUNT(DISTINCT {c}) FROM cust), (SELECT COUNT(DISTINCT o.{c}) FROM cust o WHERE o.{c} < cust.{c}))"


CHURN_CTE = f"""marked AS (SELECT *, CAST(IFNULL(churn_risk_score > 0.5, FALSE) AS INTEGER) AS churn_target,
  monthly_revenue / (total_sessions + 1) AS revenue_per_session, api_calls_per_month / (total_sessions + 1) AS api_efficiency,
  support_tickets / (days_since_last_login + 1) AS support_intensity,
  CAST(IFNULL(feature_usage_score < 0.3, FALSE) AS INTEGER) AS low_engagement,
  CAST(IFNULL(avg_session_duration > (SELECT MEDIAN(avg_session_duration) FROM cust), FALSE) AS INTEGER) AS high_session_duration,
  CAST(IFNULL(total_sessions > (SELECT quantile_cont(total_sessions, 0.75) FROM cust), FALSE) AS INTEGER) AS frequent_user,
  CAST(DATE '2024-01-01' - signup_date <= 30 AS INTEGER) AS new_customer,
  CAST(DATE '2024-01-01' - signup_date > 180 AS INTEGER) AS veteran_customer,
  CAST(IFNULL(monthly_revenue > (SELECT quantile_cont(monthly_revenue, 0.75) FROM cust), FALSE) AS INTEGER) AS high_value,
  CAST(IFNULL(subscription_tier = 'Enterprise', FALSE) AS INTEGER) AS enterprise_customer,
  {_code("industry")} AS industry_encoded, {_code("location")} AS location_encoded, {_code("referral_source")} AS referral_encoded,
  {_code("payment_method")} AS payment_encoded FROM cust),
churn AS (SELECT customer_id, churn_target, {_filled(CHURN_FEATURES)} FROM marked)"""


def churn_features_sql() -> str:
    return with_base("SELECT * FROM churn", CHURN_CTE)


def churn_split_sql() -> str:
    placed = f"""placed AS (SELECT churn_target, ROW_NUMBER() OVER (PARTITION BY churn_target ORDER BY {draw("customer_id", 5)}, customer_id) AS place,
  ROUND(COUNT(*) OVER (PARTITION BY churn_target) * 0.2) AS held FROM churn)"""
    return with_base(
        """SELECT churn_target, place <= held AS is_test, CAST((place - held - 1) % 5 AS INTEGER) AS fold, CAST(COUNT(*) AS BIGINT) AS n
FROM placed GROUP BY ALL""",
        CHURN_CTE,
        placed,
    )


def anova_scores_sql(k: int = 15) -> str:
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, churn_target AS g, CAST({c} AS DOUBLE) AS v FROM train" for c in CHURN_FEATURES)
    return with_base(
        f"""SELECT feature, CAST(n AS BIGINT) AS n, {r("f", 6)} AS f_value, ROW_NUMBER() OVER (ORDER BY f DESC NULLS LAST, feature) <= {k} AS by_anova
FROM (SELECT feature, COUNT(*) AS n, (SUM(POWER(own - grand, 2)) / NULLIF(COUNT(DISTINCT g) - 1, 0))
    / NULLIF(SUM(POWER(v - own, 2)) / (COUNT(*) - COUNT(DISTINCT g)), 0) AS f
  FROM (SELECT *, AVG(v) OVER (PARTITION BY feature, g) AS own, AVG(v) OVER (PARTITION BY feature) AS grand FROM ({rows}) x) y GROUP BY feature) q""",
        CHURN_CTE,
        f"""train AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY churn_target ORDER BY {draw("customer_id", 5)}, customer_id) AS place,
  ROUND(COUNT(*) OVER (PARTITION BY churn_target) * 0.2) AS held FROM churn) t WHERE place > held)""",
    )


def business_impact_sql() -> str:
    return with_base(
        f"""SELECT {r("rate", 6)} AS churn_rate, {r("lost", 2)} AS potential_lost_revenue, {r("recall", 6)} AS recall,
  0.3 AS save_rate, {r("lost * recall * 0.3", 2)} AS potential_savings FROM
  (SELECT AVG(churn_target) AS rate, 12 * SUM(monthly_revenue) FILTER (churn_target = 1) AS lost,
     COUNT(*) FILTER (churn_target = 1 AND days_since_last_login > 30) / COUNT(*) FILTER (churn_target = 1) AS recall FROM churn) q""",
        CHURN_CTE,
    )


def ab_sql() -> str:
    arms = f"""ab AS (SELECT cleaned_monthly_revenue AS v, {kept(1)} AS stay, IF({draw("customer_id", 99, 7)} < 0.5, 'treatment', 'control') AS arm
  FROM clean WHERE signup_date >= DATE '1900-01-01')"""
    return with_base(
        f"""SELECT 'treatment' AS group_a, 'control' AS group_b, {RATE_COLUMNS}, {r("m_a", 6)} AS value_mean_a,
  {r("m_b", 6)} AS value_mean_b, {r(f"(m_a - m_b) / SQRT({ERROR2})", 6)} AS t_stat, {r(WELCH_DF, 6)} AS t_df FROM rates, two""",
        arms,
        _rates("stay = 1", "arm", "treatment", "control", "ab"),
        _pair("v", "arm", "treatment", "control").format(src="ab"),
    )
