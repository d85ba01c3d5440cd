"""DuckDB oracles for transaction features."""

from __future__ import annotations

from tidemark.plans.oracle import mean, r, with_tx

METRICS_CTE = f"""m AS (SELECT customer_id, CAST(COUNT(*) AS BIGINT) AS transaction_count,
    {r(mean('transaction_amount'), 6)} AS avg_transaction,
    {r('STDDEV_SAMP(transaction_amount)', 4)} AS transaction_volatility,
    CAST(FLOOR((epoch_us(MAX(transaction_date)) - epoch_us(MIN(transaction_date))) / 86400000000) AS BIGINT) AS customer_tenure,
    CAST(COUNT(DISTINCT YEAR(transaction_date) * 12 + MONTH(transaction_date)) AS BIGINT) AS active_months
  FROM tx GROUP BY customer_id)"""


def transactions_sql() -> str:
    return with_tx("SELECT * FROM tx")


def transaction_metrics_sql() -> str:
    return with_tx("SELECT * FROM m", METRICS_CTE)


def transaction_behaviour_sql() -> str:
    """Recency by counting a customer's later transactions, the previous amount by looking up the latest earlier one."""
    pairs = """pairs AS (SELECT a.transaction_id,
    COUNT(*) FILTER ((b.transaction_date, b.transaction_id) > (a.transaction_date, a.transaction_id)) AS later,
    ARG_MAX(b.transaction_amount, (b.transaction_date, b.transaction_id))
      FILTER ((b.transaction_date, b.transaction_id) < (a.transaction_date, a.transaction_id)) AS prev_transaction,
    COUNT(*) FILTER (b.transaction_amount > 1000) AS high_value
  FROM tx a JOIN tx b USING (customer_id) GROUP BY a.transaction_id)"""
    return with_tx(
        """
SELECT tx.customer_id, transaction_id, transaction_date, transaction_amount, CAST(high_value AS BIGINT) AS high_value_transactions,
  prev_transaction, CAST(later + 1 AS BIGINT) AS recency_rank, m.* EXCLUDE (customer_id)
FROM tx JOIN pairs USING (transaction_id) JOIN m ON m.customer_id = tx.customer_id""",
        METRICS_CTE,
        pairs,
    )


def seasonality_sql() -> str:
    return with_tx(
        f"""
SELECT CAST(QUARTER(month) AS INTEGER) AS quarter, CAST(COUNT(*) AS BIGINT) AS months, {r("CAST(SUM(revenue) AS DOUBLE) / COUNT(*)", 2)} AS avg_monthly_revenue,
  {r("AVG(revenue) / (SELECT AVG(revenue) FROM mo)", 6)} AS seasonality_index
FROM mo GROUP BY 1""",
        """mo AS (SELECT DATE_TRUNC('month', transaction_date)::DATE AS month,
  SUM(CAST(transaction_amount AS DECIMAL(18,2))) AS revenue FROM tx GROUP BY 1)""",
    )


def rfm_sql() -> str:
    ctes = f"""
base AS (SELECT customer_id, CAST(DATE '2001-08-02' - CAST(MAX(transaction_date) AS DATE) AS INTEGER) AS recency,
    CAST(COUNT(*) AS BIGINT) AS frequency,
    CAST(SUM(CAST(transaction_amount AS DECIMAL(18,6))) AS DOUBLE) AS monetary,
    {r(mean('transaction_amount'), 6)} AS avg_transaction,
    {r('STDDEV_SAMP(transaction_amount)', 4)} AS transaction_volatility
  FROM tx GROUP BY customer_id),
pd AS (SELECT o.customer_id, COUNT(DISTINCT l.l_partkey) AS product_diversity
  FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) l JOIN tx o ON l.l_orderkey = o.transaction_id
  GROUP BY o.customer_id)"""
    body = """
SELECT base.*, CAST(COALESCE(pd.product_diversity, 0) AS BIGINT) AS product_diversity,
  CAST(NTILE(5) OVER (ORDER BY -recency, base.customer_id) AS INTEGER) AS r_score,
  CAST(NTILE(5) OVER (ORDER BY frequency, base.customer_id) AS INTEGER) AS f_score,
  CAST(NTILE(5) OVER (ORDER BY monetary, base.customer_id) AS INTEGER) AS m_score
FROM base LEFT JOIN pd ON base.customer_id = pd.customer_id"""
    return with_tx(body, ctes)


def revenue_trend_sql(horizon: int = 12) -> str:
    ctes = f"""
mo AS (SELECT DATE_TRUNC('month', transaction_date)::DATE AS month, SUM(CAST(transaction_amount AS DECIMAL(18,2))) AS revenue
  FROM tx GROUP BY 1),
m AS (SELECT month, CAST(DATE_DIFF('month', (SELECT MIN(month) FROM mo), month) AS DOUBLE) AS x, CAST(revenue AS DOUBLE) AS y FROM mo),
s AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, SUM(x) AS sx, CAST(SUM(CAST(y AS DECIMAL(24,2))) AS DOUBLE) AS sy, SUM(x * x) AS sxx,
  CAST(SUM(CAST(x AS DECIMAL(38,0)) * CAST(y AS DECIMAL(24,2))) AS DOUBLE) AS sxy,
  CAST(SUM(CAST(y AS DECIMAL(38,2)) * CAST(y AS DECIMAL(24,2))) AS DOUBLE) AS syy, MAX(x) AS xmax, MAX(month) AS last_month FROM m),
f AS (SELECT xmax, last_month, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope, sy, sx, sxy, syy, n FROM s),
g AS (SELECT xmax, last_month, slope, (sy - slope * sx) / n AS intercept, syy, sy, sxy, n FROM f),
h AS (SELECT xmax, last_month, slope, intercept, SQRT(GREATEST(0.0, syy - intercept * sy - slope * sxy) / (n - 2)) AS se FROM g),
st AS (SELECT range AS step FROM range(1, {horizon + 1}))"""
    yhat = "(intercept + slope * (xmax + step))"
    body = f"""
SELECT CAST(last_month + TO_MONTHS(CAST(step AS INTEGER)) AS DATE) AS month, CAST(step AS INTEGER) AS step,
  {r(yhat, 2)} AS projected_revenue, {r(f'{yhat} - 1.96 * se', 2)} AS ci_lower, {r(f'{yhat} + 1.96 * se', 2)} AS ci_upper,
  {r('slope', 4)} AS monthly_trend FROM h CROSS JOIN st"""
    return with_tx(body, ctes)
