"""Customer value / engagement features, trend windows and BI roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import MONEY, count_when, money_avg, money_sum, pct, rnd
from tidemark.operators import windows as W
from tidemark.session import materialize


def customer_metrics(clean: DataFrame) -> DataFrame:
    """Revenue, engagement and health metrics per customer."""
    rev = F.col("cleaned_monthly_revenue")
    sess = F.col("total_sessions")
    days = F.col("days_since_signup")
    health = (
        F.col("cleaned_feature_usage_score") * 0.25
        + (F.col("cleaned_satisfaction_score") / 5.0) * 0.25
        + (F.lit(1) - F.col("cleaned_churn_risk_score")) * 0.25
        + F.least(F.lit(1.0), sess / 100.0) * 0.25
    )
    return clean.select(
        "customer_id",
        "signup_date",
        "cleaned_monthly_revenue",
        "standardized_subscription_tier",
        "total_sessions",
        "avg_session_duration",
        "api_calls_per_month",
        "cleaned_feature_usage_score",
        "cleaned_satisfaction_score",
        "cleaned_churn_risk_score",
        "days_since_signup",
        (rev * 12).alias("estimated_annual_revenue"),
        F.when(rev == 0, F.lit(0.0)).otherwise(F.try_divide(rev, F.nullif(sess, F.lit(0)))).alias(
            "revenue_per_session"
        ),
        F.when(sess == 0, F.lit(0.0))
        .otherwise(F.try_divide(F.col("api_calls_per_month").cast("double"), F.nullif(sess, F.lit(0))))
        .alias("api_calls_per_session"),
        F.when(days == 0, sess.cast("double"))
        .otherwise(F.try_divide(sess.cast("double"), F.nullif(days, F.lit(0))))
        .alias("sessions_per_day"),
        health.alias("customer_health_score"),
    )


BENCH_PROBS = [0.25, 0.5, 0.75, 0.9]


def percentile_benchmarks(cm: DataFrame) -> DataFrame:
    """Exact PERCENTILE_CONT benchmarks of annual revenue and health (G4): one row.

    Computed on value histograms (no task holds all values), then joined as a
    single-row broadcast (J1).
    """
    rev = W.exact_quantiles(
        cm, "estimated_annual_revenue", BENCH_PROBS, ["revenue_q1", "revenue_median", "revenue_q3", "revenue_p90"]
    )
    hl = W.exact_quantiles(
        cm, "customer_health_score", BENCH_PROBS, ["health_q1", "health_median", "health_q3", "health_p90"]
    )
    return rev.crossJoin(hl)


# Tier / segment labels of the value scoring.
REVENUE_TIERS = ["Top 10%", "High Value", "Medium Value", "Low Value", "Minimal Value"]
HEALTH_TIERS = ["Excellent", "Good", "Average", "Poor", "Critical"]
ENGAGEMENT_LEVELS = [(2, "Highly Engaged"), (0.5, "Moderately Engaged"), (0.1, "Lightly Engaged")]
ENGAGEMENT_NONE = "Inactive"
SEASONS = [((12, 1, 2), "Winter"), ((3, 4, 5), "Spring"), ((6, 7, 8), "Summer")]
SEASON_ELSE = "Fall"


def _tier(x, thresholds, labels):
    expr = None
    for t, lab in zip(thresholds, labels):
        expr = F.when(x >= t, F.lit(lab)) if expr is None else expr.when(x >= t, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def value_scoring(clean: DataFrame) -> DataFrame:
    """Feature-engineered customer table with percentile tiers and segments."""
    cm = materialize(customer_metrics(clean))
    pb = percentile_benchmarks(cm)
    j = cm.crossJoin(F.broadcast(pb))  # single-row benchmark table
    c = F.col
    rev, hs = c("estimated_annual_revenue"), c("customer_health_score")
    spd = c("sessions_per_day")
    eng = None
    for t, lab in ENGAGEMENT_LEVELS:
        eng = F.when(spd >= t, F.lit(lab)) if eng is None else eng.when(spd >= t, F.lit(lab))
    eng = eng.otherwise(F.lit(ENGAGEMENT_NONE))
    segment = (
        F.when((rev >= c("revenue_q3")) & (hs >= c("health_q3")), "Champions")
        .when((rev >= c("revenue_q3")) & (hs < c("health_q3")), "High-Value At-Risk")
        .when((rev < c("revenue_q3")) & (hs >= c("health_q3")), "Potential Champions")
        .when((rev >= c("revenue_median")) & (hs >= c("health_median")), "Solid Performers")
        .when(c("cleaned_churn_risk_score") > 0.7, "At-Risk")
        .otherwise("Developing")
    )
    m = F.month("signup_date")
    season = None
    for months, lab in SEASONS:
        season = F.when(m.isin(*months), F.lit(lab)) if season is None else season.when(m.isin(*months), F.lit(lab))
    season = season.otherwise(F.lit(SEASON_ELSE))
    return j.select(
        *cm.columns,
        rnd("revenue_median", 6).alias("revenue_median"),
        rnd("health_median", 6).alias("health_median"),
        _tier(rev, [c("revenue_p90"), c("revenue_q3"), c("revenue_median"), c("revenue_q1")], REVENUE_TIERS).alias(
            "revenue_tier"
        ),
        _tier(hs, [c("health_p90"), c("health_q3"), c("health_median"), c("health_q1")], HEALTH_TIERS).alias(
            "health_tier"
        ),
        eng.alias("engagement_level"),
        segment.alias("customer_segment"),
        m.alias("signup_month"),
        F.quarter("signup_date").alias("signup_quarter"),
        F.year("signup_date").alias("signup_year"),
        season.alias("signup_season"),
    )


# LTV multipliers by risk band and percentile performance labels.
LTV_BANDS = [(0.8, 3), (0.5, 12), (0.3, 24)]
LTV_ELSE = 36
REVENUE_PERF = [(0.9, "Top 10%"), (0.75, "Top 25%"), (0.5, "Above Average")]
REVENUE_PERF_ELSE = "Below Average"
HEALTH_PERF = [(0.9, "Excellent Health"), (0.75, "Good Health"), (0.5, "Average Health")]
HEALTH_PERF_ELSE = "Poor Health"


def _ge_ladder(x, bands, other):
    expr = None
    for t, lab in bands:
        expr = F.when(x >= t, F.lit(lab)) if expr is None else expr.when(x >= t, F.lit(lab))
    return expr.otherwise(F.lit(other))


def customer_trends(clean: DataFrame, rows: int = 30, n_buckets: int | None = None) -> DataFrame:
    """Journey / trend windows over customer metrics (W1-W5, C8-C10; input per SURVEY D2).

    Global ORDER BY windows run bucketed (see ``windows``); ties are broken by
    ``customer_id`` (SURVEY D9). Running and moving revenue sums are exact.
    """
    cm = customer_metrics(clean).select(
        "customer_id",
        "signup_date",
        "cleaned_monthly_revenue",
        "total_sessions",
        "customer_health_score",
        "standardized_subscription_tier",
        "cleaned_churn_risk_score",
    )
    # A customer may have several snapshots, so every row carries its own key and the windows are chained on the
    # rows themselves. Running and moving sums share one order by (signup_date, customer_id).
    key = ["customer_id", "signup_date", "_row"]
    df = materialize(cm.withColumn("_row", F.monotonically_increasing_id()))
    rank = lambda d, c, out: W.global_rank(d, c, out, pct=True, n_buckets=n_buckets)
    df = rank(rank(df, "cleaned_monthly_revenue", "revenue_percentile"), "customer_health_score", "health_percentile")
    df = W.global_row_number(
        df,
        ["cleaned_monthly_revenue", *key],
        "revenue_rank_in_tier",
        descending=("cleaned_monthly_revenue",),
        partition_cols=("standardized_subscription_tier",),
        n_buckets=n_buckets,
    )
    numbered = materialize(
        W.global_prefix(
            df.withColumn("_rev_dec", F.col("cleaned_monthly_revenue").cast(MONEY)),
            ["signup_date", "customer_id", "_row"],
            ("_rev_dec",),
            n_buckets=n_buckets,
        ).withColumnRenamed("cum__rev_dec", "cumulative_revenue")
    )
    df = W.moving_average_rows(
        numbered, (), "cleaned_monthly_revenue", rows, "revenue_30day_avg", exact=True, numbered=numbered
    )
    rev = F.col("cleaned_monthly_revenue")
    risk = F.col("cleaned_churn_risk_score")
    ltv = None
    for t, mult in LTV_BANDS:
        ltv = F.when(risk > t, rev * mult) if ltv is None else ltv.when(risk > t, rev * mult)
    ltv = ltv.otherwise(rev * LTV_ELSE)
    # LAG: the following row of the reversed order, so a customer's snapshots may spread over several tasks
    back = ["signup_date", "_row"]
    df = W.global_prefix(df, back, (), ("customer_id",), back, "_back", n_buckets, lags=("cleaned_monthly_revenue",))
    out = df.select(
        "customer_id",
        "signup_date",
        "cleaned_monthly_revenue",
        "total_sessions",
        "customer_health_score",
        "revenue_rank_in_tier",
        "revenue_percentile",
        "health_percentile",
        "revenue_30day_avg",
        F.col("cumulative_revenue").cast("double").alias("cumulative_revenue"),
        F.col("next_cleaned_monthly_revenue").alias("previous_revenue"),
        F.trunc("signup_date", "month").alias("signup_month_cohort"),
        ltv.alias("estimated_ltv"),
    )
    p = F.col("previous_revenue")
    return out.select(
        "*",
        F.when(p.isNull() | (p == 0), F.lit(None).cast("double"))
        .otherwise(rnd(F.lit(100.0) * (rev - p) / p, 2))
        .alias("revenue_growth_pct"),
        _ge_ladder(F.col("revenue_percentile"), REVENUE_PERF, REVENUE_PERF_ELSE).alias("revenue_performance"),
        _ge_ladder(F.col("health_percentile"), HEALTH_PERF, HEALTH_PERF_ELSE).alias("health_performance"),
    ).orderBy("signup_date", "customer_id")


ROLLUP_SETS = (
    ("standardized_subscription_tier",),
    ("standardized_industry",),
    ("customer_lifecycle_stage",),
    ("standardized_subscription_tier", "standardized_industry"),
    (),
)


def business_rollup(clean: DataFrame, sets=ROLLUP_SETS) -> DataFrame:
    """GROUPING SETS business summary with subtotal labels.

    One Expand + partial aggregate: the shuffle carries one row per
    (map task, grouping-set group). ``grouping_id`` tells a real NULL key from
    a subtotal row (SURVEY D12).
    """
    keys = ["standardized_subscription_tier", "standardized_industry", "customer_lifecycle_stage"]
    rev = F.col("cleaned_monthly_revenue")
    risk = F.col("cleaned_churn_risk_score")
    # medians of all groupings from one value histogram: no task holds the values of a group
    spread = clean.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        *[(F.col(k) if k in s else F.lit(None).cast("string")).alias(k) for k in keys],
                        F.lit(sum((k not in s) << (len(keys) - 1 - i) for i, k in enumerate(keys))).cast("long").alias(
                            "grouping_id"
                        ),
                        rev.alias("_rev"),
                    )
                    for s in sets
                ]
            )
        ).alias("g")
    ).select("g.*")
    medians = W.group_quantiles(spread, [*keys, "grouping_id"], "_rev", [0.5], ["median_monthly_revenue"])
    agg = clean.groupingSets([list(s) for s in sets], *keys).agg(
        F.grouping_id(*keys).cast("long").alias("grouping_id"),
        F.count(F.lit(1)).alias("customer_count"),
        count_when(F.col("activation_completed") == 1).alias("activated_customers"),
        money_sum(rev).alias("total_monthly_revenue"),
        money_avg(rev).alias("avg_monthly_revenue"),
        F.avg("total_sessions").alias("avg_sessions"),
        F.avg("avg_session_duration").alias("avg_session_duration"),
        money_avg("cleaned_feature_usage_score").alias("avg_feature_usage"),
        money_avg("cleaned_satisfaction_score").alias("avg_satisfaction"),
        money_avg(risk).alias("avg_churn_risk"),
        count_when(risk > 0.7).alias("high_risk_customers"),
    )
    agg = W.null_safe_join(agg, medians, [*keys, "grouping_id"], "left")
    n = F.col("customer_count")
    return agg.select(
        F.coalesce("standardized_subscription_tier", F.lit("ALL TIERS")).alias("subscription_tier"),
        F.coalesce("standardized_industry", F.lit("ALL INDUSTRIES")).alias("industry"),
        F.coalesce("customer_lifecycle_stage", F.lit("ALL STAGES")).alias("lifecycle_stage"),
        F.col("grouping_id").cast("long").alias("grouping_id"),
        "customer_count",
        "activated_customers",
        F.round("total_monthly_revenue", 2).cast("double").alias("total_monthly_revenue"),
        rnd("avg_monthly_revenue", 2).alias("avg_monthly_revenue"),
        rnd("median_monthly_revenue", 2).alias("median_monthly_revenue"),
        rnd("avg_sessions", 1).alias("avg_sessions"),
        rnd("avg_session_duration", 1).alias("avg_session_duration"),
        rnd("avg_feature_usage", 3).alias("avg_feature_usage"),
        rnd("avg_satisfaction", 2).alias("avg_satisfaction"),
        rnd("avg_churn_risk", 3).alias("avg_churn_risk"),
        rnd(pct("activated_customers", n), 2).alias("activation_rate"),
        "high_risk_customers",
        rnd(pct("high_risk_customers", n), 2).alias("high_risk_rate"),
        F.col("standardized_subscription_tier").alias("_t"),
        F.col("standardized_industry").alias("_i"),
    ).orderBy(
        F.col("_t").asc_nulls_last(), F.col("_i").asc_nulls_last(), F.col("customer_count").desc()
    ).drop("_t", "_i")
