"""Customer and transaction inputs derived from the driver tables.

The base customer table does not exist in the test data; it is built from
``customer``, ``orders``, ``events`` and ``nation`` with arithmetic that
Spark and DuckDB evaluate identically, so the same text also serves as the
CTE prefix of every DuckDB oracle. Its work grows with the tables: two
pre-aggregations (orders and events per customer, both map-side combined)
and two key joins back onto ``customer``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import read_table

# The customer-table construction (fixture definition).
CUSTOMER_FIXTURE_SQL = """
WITH o AS (SELECT o_custkey, COUNT(*) AS n_orders, SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS cents FROM {orders} GROUP BY o_custkey),
e AS (SELECT user_id, COUNT(*) AS n_ev FROM {events} GROUP BY user_id),
b AS (SELECT c.c_custkey AS k, n.n_name, COALESCE(o.n_orders, 0) AS n_orders, COALESCE(o.cents, 0) AS cents, COALESCE(e.n_ev, 0) AS n_ev
      FROM {customer} c LEFT JOIN o ON o.o_custkey = c.c_custkey LEFT JOIN e ON e.user_id = c.c_custkey LEFT JOIN {nation} n ON n.n_nationkey = c.c_nationkey)
SELECT k AS customer_id,
  CAST(DATE '2022-01-01' + CAST((k * 13) % 730 AS INT) AS DATE) AS signup_date,
  CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(10 + (k * 7) % 85 AS INT) END AS age,
  CAST(1 + (k * 37) % 1500 AS INT) AS company_size,
  CASE k % 9 WHEN 0 THEN 'FinTech' WHEN 1 THEN 'healthcare' WHEN 2 THEN 'Banking' WHEN 3 THEN 'ecommerce' WHEN 4 THEN 'MANUFACTURING' WHEN 5 THEN 'Retail' WHEN 6 THEN 'education' WHEN 7 THEN 'Technology' ELSE NULL END AS industry,
  CASE WHEN k % 19 = 0 THEN NULL WHEN k % 23 = 0 THEN CAST(-100 AS DOUBLE) WHEN k % 101 = 0 THEN CAST(2000000 AS DOUBLE) ELSE CAST(CAST(cents AS DOUBLE) / CAST(8000 AS DOUBLE) AS DOUBLE) END AS monthly_revenue,
  CASE WHEN k % 29 = 0 THEN NULL ELSE CAST((k * 31) % 120 - 10 AS DOUBLE) / CAST(100 AS DOUBLE) END AS feature_usage_score,
  CASE WHEN k % 31 = 0 THEN NULL ELSE CAST((k * 53) % 110 - 5 AS DOUBLE) / CAST(100 AS DOUBLE) END AS churn_risk_score,
  CASE WHEN k % 37 = 0 THEN NULL ELSE CAST((k * 17) % 55 AS DOUBLE) / CAST(10 AS DOUBLE) END AS customer_satisfaction_score,
  CASE WHEN k % 41 = 0 THEN NULL WHEN (k * 5) % 3 = 0 THEN 0 ELSE 1 END AS activation_completed,
  CASE k % 8 WHEN 0 THEN 'basic' WHEN 1 THEN 'Starter' WHEN 2 THEN 'PREMIUM' WHEN 3 THEN 'pro' WHEN 4 THEN 'Enterprise' WHEN 5 THEN 'business' WHEN 6 THEN 'unknown' ELSE NULL END AS subscription_tier,
  CAST(n_orders AS DOUBLE) AS transaction_volume,
  CAST((k * 3) % 12 AS INT) AS support_tickets,
  CAST((k * 11) % 60 AS INT) AS days_since_last_login,
  CAST(n_ev + CASE WHEN k % 11 = 0 THEN 0 ELSE (k * 7) % 120 END AS INT) AS total_sessions,
  CAST((k * 19) % 600 AS DOUBLE) / CAST(10 AS DOUBLE) AS avg_session_duration,
  CAST((k * 43) % 5000 AS INT) AS api_calls_per_month,
  CAST(k % 9 AS INT) AS integration_count,
  CAST(1 + (k * 3) % 50 AS INT) AS team_size,
  CAST((k * 97) % 100000 AS DOUBLE) AS annual_contract_value,
  CASE k % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'ach' WHEN 2 THEN 'wire' ELSE 'paypal' END AS payment_method,
  CASE k % 5 WHEN 0 THEN 'organic' WHEN 1 THEN 'ads' WHEN 2 THEN 'partner' WHEN 3 THEN 'referral' ELSE 'event' END AS referral_source,
  CAST((k * 61) % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS onboarding_completion_rate,
  CAST((k * 67) % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS feature_adoption_score,
  n_name AS location
FROM b
"""

# As-of dates used by the reference (fixed values).
CUSTOMER_AS_OF = "2024-01-01"
TRANSACTION_AS_OF = "2001-08-02"


def customer_sql_for_duckdb() -> str:
    return CUSTOMER_FIXTURE_SQL.format(orders="orders", events="events", customer="customer", nation="nation")


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25-column base customer table, one row per ``customer`` row."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    events = read_table(spark, sf_dir, "events").select("user_id")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return spark.sql(
        CUSTOMER_FIXTURE_SQL,
        orders=orders,
        events=events,
        customer=customer,
        nation=nation,
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction log = orders (customer, amount, timestamp)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("transaction_amount"),
        F.col("o_orderdate").alias("transaction_date"),  # timestamp without time zone
        F.col("o_orderkey").alias("transaction_id"),
    )


def transactions_sql_for_duckdb() -> str:
    return (
        "SELECT o_custkey AS customer_id, o_totalprice AS transaction_amount, "
        "o_orderdate AS transaction_date, o_orderkey AS transaction_id FROM orders"
    )
