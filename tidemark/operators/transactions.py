"""Transaction features: per-customer metrics, behaviour windows and RFM.

Per-customer aggregates use partial aggregation (a customer holding a third
of all transactions is combined map-side). Per-customer ordered windows
(recency rank, previous amount) run on range buckets over
(customer, time, id), so a hot customer is split across many tasks instead of
landing in one window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import count_when, money_avg, money_sum, rnd
from tidemark.operators import windows as W
from tidemark.sources.fixtures import TRANSACTION_AS_OF

HIGH_VALUE = 1000.0


def ntz_micros(c) -> "F.Column":
    """Microseconds since 1970-01-01 of a wall-clock timestamp (time-zone independent)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, F.col(c).cast("timestamp_ntz") if isinstance(c, str) else c.cast("timestamp_ntz"))


def _metric_aggs() -> list:
    ts = F.col("transaction_date").cast("timestamp_ntz")
    days = F.floor((ntz_micros(F.max(ts)) - ntz_micros(F.min(ts))) / F.lit(86_400_000_000))
    return [
        F.count(F.lit(1)).alias("transaction_count"),
        rnd(money_avg("transaction_amount"), 6).alias("avg_transaction"),
        rnd(F.stddev_samp("transaction_amount"), 4).alias("transaction_volatility"),
        days.cast("long").alias("customer_tenure"),
        F.count_distinct(F.trunc(ts.cast("date"), "month")).alias("active_months"),
    ]


def transaction_metrics(tx: DataFrame) -> DataFrame:
    """Count, mean, volatility, tenure days and active months per customer."""
    return tx.groupBy("customer_id").agg(*_metric_aggs())


def transaction_behaviour(tx: DataFrame, high: float = HIGH_VALUE, n_buckets: int | None = None) -> DataFrame:
    """Per-transaction behaviour joined to customer metrics.

    ``recency_rank`` orders by (date desc, id desc); ``prev_transaction`` is
    the amount of the previous transaction, the following row in that order
    (inside a bucket, or the first row of the next one). All metrics of a
    customer come from one aggregate; both sides of the one join are tables, so
    adaptive execution splits a hot customer's rows.
    """
    from tidemark.session import materialize

    t = tx.select("customer_id", "transaction_id", "transaction_date", "transaction_amount")
    order = ["transaction_date", "transaction_id"]
    ranked = materialize(
        W.global_prefix(
            t, order, (), ("customer_id",), order, "recency_rank", n_buckets, lags=("transaction_amount",)
        ).withColumnRenamed("next_transaction_amount", "prev_transaction")
    )
    per_customer = materialize(
        ranked.groupBy("customer_id").agg(
            count_when(F.col("transaction_amount") > high).alias("high_value_transactions"), *_metric_aggs()
        )
    )
    out = W.null_safe_join(ranked, per_customer, ["customer_id"])
    return out.select(
        "customer_id",
        "transaction_id",
        "transaction_date",
        "transaction_amount",
        "high_value_transactions",
        "prev_transaction",
        "recency_rank",
        "transaction_count",
        "avg_transaction",
        "transaction_volatility",
        "customer_tenure",
        "active_months",
    )


def product_diversity(tx: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Distinct products bought per customer (lineitem -> order -> customer)."""
    lines = lineitem.select(F.col("l_orderkey").alias("transaction_id"), "l_partkey")
    pairs = lines.join(tx.select("transaction_id", "customer_id"), "transaction_id").select("customer_id", "l_partkey")
    # distinct (customer, part) pairs, then a plain count: two map-side-combined aggregates
    return pairs.distinct().groupBy("customer_id").agg(F.count(F.lit(1)).alias("product_diversity"))


def rfm(tx: DataFrame, lineitem: DataFrame, as_of: str = TRANSACTION_AS_OF, n_buckets: int | None = None) -> DataFrame:
    """Recency / frequency / monetary features with quintile scores.

    Scores are NTILE(5) over the whole customer set (bucketed global windows;
    ties broken by customer_id): 5 = most recent / most frequent / highest spend.
    """
    base = tx.groupBy("customer_id").agg(
        F.datediff(F.lit(as_of).cast("date"), F.max("transaction_date").cast("date")).alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        money_sum("transaction_amount").alias("_monetary"),
        rnd(money_avg("transaction_amount"), 6).alias("avg_transaction"),
        rnd(F.stddev_samp("transaction_amount"), 4).alias("transaction_volatility"),
    )
    base = base.join(product_diversity(tx, lineitem), "customer_id", "left").select(
        "customer_id",
        "recency",
        "frequency",
        F.col("_monetary").cast("double").alias("monetary"),
        "avg_transaction",
        "transaction_volatility",
        F.coalesce("product_diversity", F.lit(0)).alias("product_diversity"),
        (-F.col("recency")).alias("_neg_recency"),
    )
    # three NTILEs, each carrying the columns before it: no join back
    for measure, out in (("_neg_recency", "r_score"), ("frequency", "f_score"), ("monetary", "m_score")):
        base = W.global_ntile(base, [measure, "customer_id"], 5, out, n_buckets=n_buckets)
    return base.drop("_neg_recency")
