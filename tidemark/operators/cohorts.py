"""Cohort, retention and lifecycle reports over the cleaned customer table.

All reports are one ``groupBy`` with partial (map-side) aggregation: the
shuffle carries one row per (map task, group), never the customer rows, so
a cohort holding a third of all customers costs the same as any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import MONEY, count_when, money_avg, money_sum, pct, rnd, uniform_draw

COHORT_START = "2023-01-01"

# Retention bands (risk upper bound, keep-probability threshold on the draw).
RETENTION_M1 = [(0.4, 0.1), (0.6, 0.3), (0.8, 0.6)]  # risk <= 0.2 always retained
RETENTION_M1_ELSE = 0.8
RETENTION_M3 = [(0.3, 0.05), (0.6, 0.2)]
RETENTION_M3_ELSE = 0.4
RETENTION_M6 = [(0.4, 0.1)]
RETENTION_M6_ELSE = 0.3


def monthly_cohorts(clean: DataFrame, start: str = COHORT_START) -> DataFrame:
    """Recent signups with their month cohort (filter pushes to the scan)."""
    return clean.filter(F.col("signup_date") >= F.lit(start).cast("date")).select(
        "customer_id",
        F.trunc("signup_date", "month").alias("cohort_month"),
        "signup_date",
        "cleaned_monthly_revenue",
        "standardized_subscription_tier",
        "activation_completed",
        "cleaned_churn_risk_score",
        "total_sessions",
        "days_since_signup",
    )


def _band(risk, draw, bands, otherwise):
    expr = None
    for upper, thr in bands:
        v = (draw > thr).cast("int")
        expr = F.when(risk <= upper, v) if expr is None else expr.when(risk <= upper, v)
    return expr.otherwise((draw > otherwise).cast("int"))


def simulate_retention(cohorts: DataFrame, seed: int = 42, conditional: bool = False) -> DataFrame:
    """Risk-banded Bernoulli retention at months 1, 3 and 6.

    Draws are a pure function of (customer_id, month, seed), so a retried task
    or another partitioning gives identical flags. ``conditional=True`` makes
    month 3 / 6 require survival of the previous period (the commented intent).
    """
    risk = F.col("cleaned_churn_risk_score")
    u1 = uniform_draw("customer_id", 1, seed)
    u3 = uniform_draw("customer_id", 3, seed)
    u6 = uniform_draw("customer_id", 6, seed)
    m1 = F.when(risk <= 0.2, F.lit(1)).otherwise(_band(risk, u1, RETENTION_M1, RETENTION_M1_ELSE))
    m3 = _band(risk, u3, RETENTION_M3, RETENTION_M3_ELSE)
    m6 = _band(risk, u6, RETENTION_M6, RETENTION_M6_ELSE)
    out = cohorts.select(
        "cohort_month",
        "customer_id",
        "cleaned_monthly_revenue",
        "cleaned_churn_risk_score",
        "activation_completed",
        m1.cast("int").alias("retained_month_1"),
        m3.cast("int").alias("retained_month_3"),
        m6.cast("int").alias("retained_month_6"),
    )
    if conditional:
        out = out.withColumn("retained_month_3", F.col("retained_month_3") * F.col("retained_month_1")).withColumn(
            "retained_month_6", F.col("retained_month_6") * F.col("retained_month_3")
        )
    return out


def cohort_summary_by_month(cohorts: DataFrame) -> DataFrame:
    """Cohort size / activation / revenue per signup month."""
    return cohorts.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        count_when(F.col("activation_completed") == 1).alias("activated_count"),
        money_sum("cleaned_monthly_revenue").alias("cohort_revenue"),
        money_avg("cleaned_monthly_revenue").alias("avg_revenue_per_customer"),
        F.avg("cleaned_churn_risk_score").alias("avg_initial_churn_risk"),
    )


def cohort_retention(
    clean: DataFrame, start: str = COHORT_START, seed: int = 42, conditional: bool = False, via_join: bool = False
) -> DataFrame:
    """Monthly cohort retention table.

    Default plan: a single aggregate over the simulated flags — the summary
    and the retention sums come from the same rows, so the reference's
    summary-to-members join is redundant. ``via_join=True`` keeps the join
    form (J2); the summary side has one row per month and AQE turns the join
    into a broadcast from its measured size.
    """
    sim = simulate_retention(monthly_cohorts(clean, start), seed, conditional)
    rev = F.col("cleaned_monthly_revenue")
    retained_aggs = [
        F.sum("retained_month_1").cast("long").alias("r1"),
        F.sum("retained_month_3").cast("long").alias("r3"),
        F.sum("retained_month_6").cast("long").alias("r6"),
        money_sum(F.when(F.col("retained_month_1") == 1, rev).otherwise(F.lit(0.0))).alias("rev1"),
        money_sum(F.when(F.col("retained_month_3") == 1, rev).otherwise(F.lit(0.0))).alias("rev3"),
        money_sum(F.when(F.col("retained_month_6") == 1, rev).otherwise(F.lit(0.0))).alias("rev6"),
    ]
    if via_join:
        summary = cohort_summary_by_month(sim)
        agg = summary.join(sim.groupBy("cohort_month").agg(*retained_aggs), "cohort_month")
    else:
        agg = sim.groupBy("cohort_month").agg(
            F.count(F.lit(1)).alias("cohort_size"),
            count_when(F.col("activation_completed") == 1).alias("activated_count"),
            money_sum("cleaned_monthly_revenue").alias("cohort_revenue"),
            money_avg("cleaned_monthly_revenue").alias("avg_revenue_per_customer"),
            *retained_aggs,
        )
    size = F.col("cohort_size")
    crev = F.col("cohort_revenue").cast("double")
    out = agg.select(
        "cohort_month",
        "cohort_size",
        "activated_count",
        rnd(pct("activated_count", "cohort_size"), 2).alias("activation_rate"),
        F.round("cohort_revenue", 2).cast("double").alias("initial_cohort_revenue"),
        rnd("avg_revenue_per_customer", 2).alias("avg_revenue_per_customer"),
        F.col("r1").alias("retained_month_1"),
        F.col("r3").alias("retained_month_3"),
        F.col("r6").alias("retained_month_6"),
        rnd(pct("r1", size), 2).alias("retention_rate_month_1"),
        rnd(pct("r3", size), 2).alias("retention_rate_month_3"),
        rnd(pct("r6", size), 2).alias("retention_rate_month_6"),
        F.round("rev1", 2).cast("double").alias("revenue_month_1"),
        F.round("rev3", 2).cast("double").alias("revenue_month_3"),
        F.round("rev6", 2).cast("double").alias("revenue_month_6"),
        rnd(pct(F.col("rev1").cast("double"), crev), 2).alias("revenue_retention_month_1"),
        rnd(pct(F.col("rev3").cast("double"), crev), 2).alias("revenue_retention_month_3"),
        rnd(pct(F.col("rev6").cast("double"), crev), 2).alias("revenue_retention_month_6"),
    )
    return out.orderBy("cohort_month")


# Expected retention by tier (month 1, month 6, risk weight).
TIER_EXPECTATIONS = {
    "Enterprise": (0.95, 0.90, 0.3),
    "Premium": (0.85, 0.75, 0.4),
}
TIER_EXPECTATION_ELSE = (0.70, 0.55, 0.5)


def _tier_case(tier, idx):
    expr = None
    for name, vals in TIER_EXPECTATIONS.items():
        expr = F.when(tier == name, F.lit(vals[idx])) if expr is None else expr.when(tier == name, F.lit(vals[idx]))
    return expr.otherwise(F.lit(TIER_EXPECTATION_ELSE[idx]))


def tier_cohorts(clean: DataFrame, start: str = COHORT_START) -> DataFrame:
    """Tier x signup-month cohorts with expected and risk-adjusted retention."""
    tier = F.col("standardized_subscription_tier")
    agg = (
        clean.filter(F.col("signup_date") >= F.lit(start).cast("date"))
        .groupBy(tier, F.trunc("signup_date", "month").alias("cohort_month"))
        .agg(
            F.count(F.lit(1)).alias("cohort_size"),
            money_avg("cleaned_monthly_revenue").alias("avg_initial_revenue"),
            money_avg("cleaned_churn_risk_score").alias("avg_churn_risk"),
            count_when(F.col("activation_completed") == 1).alias("activated_customers"),
        )
    )
    m1 = _tier_case(tier, 0)
    m6 = _tier_case(tier, 1)
    adj = m1 * (F.lit(1.0) - F.col("avg_churn_risk") * _tier_case(tier, 2))
    return agg.select(
        "standardized_subscription_tier",
        "cohort_month",
        "cohort_size",
        "activated_customers",
        rnd(pct("activated_customers", "cohort_size"), 2).alias("activation_rate"),
        rnd("avg_initial_revenue", 2).alias("avg_initial_revenue"),
        rnd("avg_churn_risk", 3).alias("avg_churn_risk"),
        rnd(m1 * 100, 1).alias("expected_month_1_retention_pct"),
        rnd(m6 * 100, 1).alias("expected_month_6_retention_pct"),
        rnd(adj * 100, 1).alias("risk_adjusted_retention_pct"),
        rnd(F.col("avg_initial_revenue") * 12 * adj * 2, 2).alias("estimated_24_month_ltv"),
    ).orderBy("standardized_subscription_tier", "cohort_month")


# Lifecycle (days since signup), usage (sessions) and risk bands.
LIFECYCLE_WEEKS = [(7, "Week 1"), (30, "Month 1"), (90, "Month 2-3"), (180, "Month 4-6"), (365, "Month 7-12")]
LIFECYCLE_WEEKS_TOP = "Year 2+"
USAGE_LEVELS = [(0, "No Usage"), (5, "Low Usage"), (20, "Medium Usage"), (50, "High Usage")]
USAGE_TOP = "Power User"
RISK_CATEGORIES = [(0.3, "Low Risk"), (0.6, "Medium Risk"), (0.8, "High Risk")]
RISK_TOP = "Critical Risk"


def _ladder(x, bands, top, first_eq=False):
    expr = None
    for i, (upper, label) in enumerate(bands):
        cond = (x == upper) if (first_eq and i == 0) else (x <= upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(top))


def lifecycle_metrics(clean: DataFrame, with_quartile: bool = True) -> DataFrame:
    """Per-customer lifecycle / usage / risk labels (C11, C12, C13) and revenue quartile."""
    out = clean.select(
        "customer_id",
        "signup_date",
        "standardized_subscription_tier",
        "standardized_industry",
        "days_since_signup",
        "cleaned_monthly_revenue",
        "total_sessions",
        "cleaned_churn_risk_score",
        "cleaned_satisfaction_score",
        "activation_completed",
        _ladder(F.col("days_since_signup"), LIFECYCLE_WEEKS, LIFECYCLE_WEEKS_TOP).alias("lifecycle_stage"),
        _ladder(F.col("total_sessions"), USAGE_LEVELS, USAGE_TOP, first_eq=True).alias("usage_level"),
        _ladder(F.col("cleaned_churn_risk_score"), RISK_CATEGORIES, RISK_TOP).alias("churn_risk_category"),
    )
    if with_quartile:
        from tidemark.operators.windows import global_ntile

        out = global_ntile(out, ["cleaned_monthly_revenue", "customer_id"], 4, "revenue_quartile")
    return out


def risk_matrix(clean: DataFrame, min_size: int = 5) -> DataFrame:
    """Lifecycle x risk x tier matrix with share inside the lifecycle stage."""
    lm = lifecycle_metrics(clean, with_quartile=False)
    agg = lm.groupBy("lifecycle_stage", "churn_risk_category", "standardized_subscription_tier").agg(
        F.count(F.lit(1)).alias("customer_count"),
        money_sum("cleaned_monthly_revenue").alias("sum_revenue"),
        F.avg("total_sessions").alias("avg_sessions"),
        money_avg("cleaned_satisfaction_score").alias("avg_satisfaction"),
        count_when(F.col("activation_completed") == 1).alias("activated_count"),
        money_sum(F.lit(1.0) - F.col("cleaned_churn_risk_score")).alias("sum_retention"),
    )
    # Window over the aggregated rows (one per group): small by construction.
    stage_total = F.sum("customer_count").over(Window.partitionBy("lifecycle_stage"))
    n = F.col("customer_count")
    avg_rev = F.col("sum_revenue").cast("double") / n
    avg_ret = F.col("sum_retention").cast("double") / n
    return (
        agg.select(
            "lifecycle_stage",
            "churn_risk_category",
            "standardized_subscription_tier",
            "customer_count",
            rnd(avg_rev, 2).alias("avg_monthly_revenue"),
            rnd("avg_sessions", 1).alias("avg_sessions"),
            rnd("avg_satisfaction", 2).alias("avg_satisfaction"),
            "activated_count",
            rnd(pct("activated_count", n), 2).alias("activation_rate"),
            rnd(pct(n, stage_total), 2).alias("pct_of_lifecycle_stage"),
            rnd(avg_ret * 100, 1).alias("estimated_retention_rate"),
            rnd(n * avg_rev, 2).alias("segment_monthly_revenue"),
            rnd(n * avg_rev * avg_ret * 12, 2).alias("estimated_annual_retained_revenue"),
        )
        .filter(F.col("customer_count") >= min_size)
        .orderBy("lifecycle_stage", "churn_risk_category", "standardized_subscription_tier")
    )


def cohort_summary(clean: DataFrame, start: str = COHORT_START) -> DataFrame:
    """Quarter x tier executive summary with QoQ growth."""
    tier = "standardized_subscription_tier"
    rev = F.col("cleaned_monthly_revenue")
    risk = F.col("cleaned_churn_risk_score")
    agg = (
        clean.filter(F.col("signup_date") >= F.lit(start).cast("date"))
        .groupBy(F.trunc("signup_date", "quarter").alias("signup_quarter"), tier)
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            money_sum(rev).alias("total_revenue"),
            count_when(F.col("activation_completed") == 1).alias("activated_customers"),
            money_avg(risk).alias("avg_churn_risk"),
            count_when(risk > 0.7).alias("high_risk_customers"),
            money_avg("cleaned_satisfaction_score").alias("avg_satisfaction"),
            # AVG(rev * 12 * (1 - risk) * 2) from an exact decimal sum of rev * (1 - risk)
            F.sum(rev.cast(MONEY) * (F.lit(1.0) - risk).cast("decimal(10,6)")).alias("ltv_sum"),
        )
    )
    w = Window.partitionBy(tier).orderBy("signup_quarter")
    n = F.col("total_customers")
    trev = F.col("total_revenue").cast("double")
    prev_n = F.lag("total_customers").over(w)
    prev_rev = F.lag("total_revenue").over(w).cast("double")
    return agg.select(
        "signup_quarter",
        tier,
        "total_customers",
        F.round("total_revenue", 2).cast("double").alias("total_monthly_revenue"),
        rnd(trev / n, 2).alias("avg_revenue_per_customer"),
        "activated_customers",
        rnd(pct("activated_customers", n), 2).alias("activation_rate"),
        rnd("avg_churn_risk", 3).alias("avg_churn_risk"),
        "high_risk_customers",
        rnd(pct("high_risk_customers", n), 2).alias("high_risk_rate"),
        rnd("avg_satisfaction", 2).alias("avg_satisfaction"),
        rnd((F.col("ltv_sum") * 24).cast("double") / n, 2).alias("estimated_24_month_ltv"),
        rnd(F.try_divide(F.lit(100.0) * (n - prev_n), prev_n.cast("double")), 2).alias("customer_growth_qoq"),
        rnd(F.try_divide(F.lit(100.0) * (trev - prev_rev), F.nullif(prev_rev, F.lit(0.0))), 2).alias(
            "revenue_growth_qoq"
        ),
    ).orderBy("signup_quarter", tier)
