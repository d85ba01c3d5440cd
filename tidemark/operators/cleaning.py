"""Cleaning and standardisation of the base customer table (one projection).

The whole pipeline is a single ``select``: no shuffle, one codegen stage,
and Catalyst prunes every column a downstream query does not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.fixtures import CUSTOMER_AS_OF

# Category labels and thresholds of the cleaning rules.
COMPANY_SIZE_BANDS = [
    (10, "Micro (1-10)"),
    (50, "Small (11-50)"),
    (200, "Medium (51-200)"),
    (1000, "Large (201-1000)"),
]
COMPANY_SIZE_TOP = "Enterprise (1000+)"
# Ordered substring rules on the lower-cased industry; first match wins.
INDUSTRY_RULES = [
    (("tech",), "Technology"),
    (("health",), "Healthcare"),
    (("financ", "bank"), "Finance"),
    (("retail", "ecommerce"), "Retail"),
    (("manufact",), "Manufacturing"),
]
TIER_RULES = [
    (("BASIC", "STARTER", "FREE"), "Basic"),
    (("PREMIUM", "PRO", "PROFESSIONAL"), "Premium"),
    (("ENTERPRISE", "BUSINESS", "CORPORATE"), "Enterprise"),
]
TIER_DEFAULT = "Basic"
LIFECYCLE_STAGES = [
    (30, "New (0-30 days)"),
    (90, "Growing (31-90 days)"),
    (180, "Mature (91-180 days)"),
    (365, "Established (181-365 days)"),
]
LIFECYCLE_TOP = "Veteran (365+ days)"


def clean_age(age: Column) -> Column:
    return (
        F.when(age.between(18, 80), age)
        .when(age < 18, F.lit(25))
        .when(age > 80, F.lit(65))
        .otherwise(F.lit(35))
        .cast("int")
    )


def company_size_band(size: Column) -> Column:
    expr = None
    for upper, label in COMPANY_SIZE_BANDS:
        expr = F.when(size <= upper, F.lit(label)) if expr is None else expr.when(size <= upper, F.lit(label))
    return expr.otherwise(F.lit(COMPANY_SIZE_TOP))


def standardize_industry(industry: Column) -> Column:
    low = F.lower(industry)
    expr = None
    for needles, label in INDUSTRY_RULES:
        cond = None
        for n in needles:
            c = low.contains(n)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.initcap(industry))


def clamp_revenue(rev: Column, cap: float = 1_000_000.0) -> Column:
    return (
        F.when(rev.isNull(), F.lit(0.0))
        .when(rev < 0, F.lit(0.0))
        .when(rev > cap, F.lit(cap))
        .otherwise(rev)
        .cast("double")
    )


def clamp_score(x: Column, lo: float, hi: float, default: float) -> Column:
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), F.coalesce(x, F.lit(float(default)))))


def standardize_tier(tier: Column) -> Column:
    up = F.upper(tier)
    expr = None
    for values, label in TIER_RULES:
        cond = up.isin(*values)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(TIER_DEFAULT))


def lifecycle_stage(days: Column) -> Column:
    expr = None
    for upper, label in LIFECYCLE_STAGES:
        expr = F.when(days <= upper, F.lit(label)) if expr is None else expr.when(days <= upper, F.lit(label))
    return expr.otherwise(F.lit(LIFECYCLE_TOP))


def _changed(new: Column, old: Column, null_safe: bool) -> Column:
    # Reference semantics: ``new != old`` is NULL when old is NULL -> not counted.
    cond = ~new.eqNullSafe(old) if null_safe else (new != old)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def clean_customers(df: DataFrame, as_of: str = CUSTOMER_AS_OF, null_safe: bool = False) -> DataFrame:
    """The cleaned customer view (raw ``age`` carried through, see SURVEY D1)."""
    c = F.col
    cleaned = df.select(
        c("customer_id"),
        c("signup_date"),
        clean_age(c("age")).alias("cleaned_age"),
        company_size_band(c("company_size")).alias("company_size_category"),
        standardize_industry(c("industry")).alias("standardized_industry"),
        clamp_revenue(c("monthly_revenue")).alias("cleaned_monthly_revenue"),
        clamp_score(c("feature_usage_score"), 0, 1, 0.5).alias("cleaned_feature_usage_score"),
        clamp_score(c("churn_risk_score"), 0, 1, 0.5).alias("cleaned_churn_risk_score"),
        clamp_score(c("customer_satisfaction_score"), 1, 5, 3).alias("cleaned_satisfaction_score"),
        F.coalesce(c("activation_completed"), F.lit(0)).cast("int").alias("activation_completed"),
        standardize_tier(c("subscription_tier")).alias("standardized_subscription_tier"),
        c("age"),
        c("company_size"),
        c("industry"),
        c("monthly_revenue"),
        c("feature_usage_score"),
        c("churn_risk_score"),
        c("customer_satisfaction_score"),
        c("subscription_tier"),
        c("transaction_volume"),
        c("support_tickets"),
        c("days_since_last_login"),
        c("total_sessions"),
        c("avg_session_duration"),
        c("api_calls_per_month"),
        c("integration_count"),
        c("team_size"),
        c("annual_contract_value"),
        c("payment_method"),
        c("referral_source"),
        c("onboarding_completion_rate"),
        c("feature_adoption_score"),
        c("location"),
    )
    days = F.datediff(F.lit(as_of).cast("date"), c("signup_date"))
    return cleaned.select(
        "*",
        _changed(c("cleaned_age"), c("age"), null_safe).alias("age_was_cleaned"),
        _changed(c("cleaned_monthly_revenue"), c("monthly_revenue"), null_safe).alias("revenue_was_cleaned"),
        _changed(c("standardized_industry"), c("industry"), null_safe).alias("industry_was_standardized"),
        days.alias("days_since_signup"),
        lifecycle_stage(days).alias("customer_lifecycle_stage"),
    )
