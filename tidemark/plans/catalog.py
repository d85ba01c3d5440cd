"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL or None).

Every plan reads the driver tables under ``sf_dir`` (or data Spark derives
from them) in full; none runs on made-up input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import oracle as O
from tidemark.sources.fixtures import customer_profile, transactions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def register(name: str, oracle: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.cleaning import clean_customers

    return clean_customers(customer_profile(spark, sf_dir))


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir)


# --- sources / cleaning ---------------------------------------------------


@register("customer_profile", lambda: O.with_base("SELECT * FROM cust"))
def q_customer_profile(spark, sf_dir):
    return customer_profile(spark, sf_dir)


@register("cleaned_customers", lambda: O.with_base("SELECT * FROM clean"))
def q_cleaned_customers(spark, sf_dir):
    return clean(spark, sf_dir)


@register("customer_file", lambda: O.with_base("SELECT *, TRUE AS whole FROM cust"))
def q_customer_file(spark, sf_dir):
    """The customer table written as a CSV report and read back by the file reader."""
    import uuid

    from pyspark.sql import functions as F

    from tidemark.session import tables_dir
    from tidemark.sources.tables import read_customers, write_report

    path = f"{tables_dir(spark)}/customers-{uuid.uuid4().hex}"
    write_report(customer_profile(spark, sf_dir), path, fmt="csv")
    read = read_customers(spark, path)
    return read.withColumn("whole", F.col("_corrupt_record").isNull()).drop("_corrupt_record")


@register("view_refresh", lambda: O.with_base("SELECT * FROM clean"))
def q_view_refresh(spark, sf_dir):
    """The published view by signup month, first as it was before late corrections (three months with other revenues,
    one year missing, one month too many), then refreshed: only those months are written again."""
    import uuid

    from pyspark.sql import functions as F

    from tidemark.session import tables_dir
    from tidemark.sources.tables import refresh_table

    path = f"{tables_dir(spark)}/view-{uuid.uuid4().hex}"
    now = clean(spark, sf_dir).withColumn("published_month", F.date_format("signup_date", "yyyy-MM"))
    late = F.month("signup_date").isin(2, 5, 8)
    before = now.withColumn("monthly_revenue", F.when(late, F.col("monthly_revenue") * 2).otherwise(F.col("monthly_revenue")))
    before = before.where("year(signup_date) <> 2023").unionByName(now.where("month(signup_date) = 3").withColumn("published_month", F.lit("1899-12")))
    refresh_table(before, path, "published_month")
    refresh_table(now, path, "published_month")
    return spark.read.schema(now.schema).parquet(path).drop("published_month")


# --- cohorts ---------------------------------------------------------------


@register("cohort_retention", O.cohort_retention_sql)
def q_cohort_retention(spark, sf_dir):
    from tidemark.operators.cohorts import cohort_retention

    return cohort_retention(clean(spark, sf_dir))


@register("cohort_retention_join", O.cohort_retention_sql)
def q_cohort_retention_join(spark, sf_dir):
    from tidemark.operators.cohorts import cohort_retention

    return cohort_retention(clean(spark, sf_dir), via_join=True)


@register("tier_cohorts", O.tier_cohorts_sql)
def q_tier_cohorts(spark, sf_dir):
    from tidemark.operators.cohorts import tier_cohorts

    return tier_cohorts(clean(spark, sf_dir))


@register("risk_matrix", O.risk_matrix_sql)
def q_risk_matrix(spark, sf_dir):
    from tidemark.operators.cohorts import risk_matrix

    return risk_matrix(clean(spark, sf_dir))


@register("cohort_summary", O.cohort_summary_sql)
def q_cohort_summary(spark, sf_dir):
    from tidemark.operators.cohorts import cohort_summary

    return cohort_summary(clean(spark, sf_dir))


# --- features --------------------------------------------------------------


@register("value_scoring", O.value_scoring_sql)
def q_value_scoring(spark, sf_dir):
    from tidemark.operators.features import value_scoring

    return value_scoring(clean(spark, sf_dir))


@register("customer_trends", O.customer_trends_sql)
def q_customer_trends(spark, sf_dir):
    from tidemark.operators.features import customer_trends

    return customer_trends(clean(spark, sf_dir))


@register("customer_trends_snapshots", O.snapshots_trends_sql)
def q_customer_trends_snapshots(spark, sf_dir):
    """The trend report where every customer has two snapshots, 31 days apart."""
    from pyspark.sql import functions as F

    from tidemark.operators.features import customer_trends

    now = clean(spark, sf_dir)
    later = now.withColumns(
        {
            "signup_date": F.date_add("signup_date", 31),
            "cleaned_monthly_revenue": F.col("cleaned_monthly_revenue") * 2,
        }
    )
    return customer_trends(now.unionByName(later))


@register("revenue_last_30_days", O.last_days_sql)
def q_revenue_last_30_days(spark, sf_dir):
    from tidemark.operators.windows import moving_average_days

    c = clean(spark, sf_dir).select("customer_id", "signup_date", "cleaned_monthly_revenue")
    return moving_average_days(c, "signup_date", "cleaned_monthly_revenue", 30, "revenue_30_days_avg")


@register("lifecycle_metrics", O.lifecycle_metrics_sql)
def q_lifecycle_metrics(spark, sf_dir):
    from tidemark.operators.cohorts import lifecycle_metrics

    return lifecycle_metrics(clean(spark, sf_dir)).select(
        "customer_id", "lifecycle_stage", "churn_risk_category", "usage_level", "revenue_quartile"
    )


@register("business_rollup", O.business_rollup_sql)
def q_business_rollup(spark, sf_dir):
    from tidemark.operators.features import business_rollup

    return business_rollup(clean(spark, sf_dir))


# --- quality / profiling ----------------------------------------------------
from tidemark.plans import oracle_quality as OQ  # noqa: E402


def _raw_op(fn_name):
    def run(spark, sf_dir):
        from tidemark.operators import quality

        return getattr(quality, fn_name)(customer_profile(spark, sf_dir))

    return run


def _clean_op(fn_name):
    def run(spark, sf_dir):
        from tidemark.operators import quality

        return getattr(quality, fn_name)(clean(spark, sf_dir))

    return run


for _name, _fn, _src, _oracle in [
    ("quality_report", "quality_report", "raw", OQ.quality_report_sql),
    ("outlier_report", "outlier_report", "raw", OQ.outlier_report_sql),
    ("cleaning_summary", "cleaning_summary", "clean", OQ.cleaning_summary_sql),
    ("lifecycle_distribution", "lifecycle_distribution", "clean", OQ.lifecycle_distribution_sql),
    ("cardinality_report", "cardinality_report", "raw", OQ.cardinality_report_sql),
    ("missing_report", "missing_report", "raw", OQ.missing_report_sql),
    ("missing_summary", "missing_summary", "raw", OQ.missing_summary_sql),
    ("iqr_outliers", "iqr_outliers", "raw", OQ.iqr_outliers_sql),
    ("describe_exact", "describe_exact", "raw", OQ.describe_sql),
    ("univariate_stats", "univariate_stats", "raw", OQ.univariate_sql),
    ("categorical_report", "categorical_report", "raw", OQ.categorical_report_sql),
    ("duplicate_count", "duplicate_count", "raw", OQ.duplicate_count_sql),
    ("value_counts", "value_counts", "raw", OQ.value_counts_sql),
    ("crosstab", "crosstab", "raw", OQ.crosstab_sql),
    ("overview", "overview", "raw", OQ.overview_sql),
]:
    register(_name, _oracle)(_raw_op(_fn) if _src == "raw" else _clean_op(_fn))


# --- transactions ----------------------------------------------------------
from tidemark.plans import oracle_tx as OT  # noqa: E402


@register("transactions", OT.transactions_sql)
def q_transactions(spark, sf_dir):
    return tx(spark, sf_dir)


@register("transaction_metrics", OT.transaction_metrics_sql)
def q_transaction_metrics(spark, sf_dir):
    from tidemark.operators.transactions import transaction_metrics

    return transaction_metrics(tx(spark, sf_dir))


@register("transaction_behaviour", OT.transaction_behaviour_sql)
def q_transaction_behaviour(spark, sf_dir):
    from tidemark.operators.transactions import transaction_behaviour

    return transaction_behaviour(tx(spark, sf_dir))


@register("rfm", OT.rfm_sql)
def q_rfm(spark, sf_dir):
    from tidemark.operators.transactions import rfm
    from tidemark.sources.tables import read_table

    return rfm(tx(spark, sf_dir), read_table(spark, sf_dir, "lineitem"))


# --- statistics --------------------------------------------------------------
from tidemark.plans import oracle_stats as OS  # noqa: E402

TIER = "standardized_subscription_tier"
CORR_VARS = [
    "monthly_revenue", "transaction_volume", "feature_usage_score", "churn_risk_score",
    "total_sessions", "avg_session_duration", "api_calls_per_month", "customer_satisfaction_score",
]
CORR_VARS_11 = CORR_VARS + ["age", "company_size", "annual_contract_value"]


def _stats(fn_name, *args, **kwargs):
    def run(spark, sf_dir):
        from tidemark.operators import stats

        return getattr(stats, fn_name)(clean(spark, sf_dir), *args, **kwargs)

    return run


register("ttest_premium_basic", lambda: OS.ttest_sql("monthly_revenue", TIER, "Premium", "Basic"))(
    _stats("ttest", "monthly_revenue", TIER, "Premium", "Basic")
)
register("ttest_premium_basic_report", lambda: OS.ttest_sql("monthly_revenue", TIER, "Premium", "Basic", with_p=True))(_stats("ttest", "monthly_revenue", TIER, "Premium", "Basic", with_p=True))
register("welch_premium_basic", lambda: OS.ttest_sql("monthly_revenue", TIER, "Premium", "Basic", False))(
    _stats("ttest", "monthly_revenue", TIER, "Premium", "Basic", equal_var=False)
)
register("welch_premium_basic_report", lambda: OS.ttest_sql("monthly_revenue", TIER, "Premium", "Basic", False, with_p=True))(
    _stats("ttest", "monthly_revenue", TIER, "Premium", "Basic", equal_var=False, with_p=True)
)
register("anova_churn_by_industry", lambda: OS.anova_sql("churn_risk_score", "industry"))(
    _stats("anova", "churn_risk_score", "industry")
)
register("anova_churn_by_industry_report", lambda: OS.anova_sql("churn_risk_score", "industry", with_p=True))(_stats("anova", "churn_risk_score", "industry", with_p=True))
register(
    "anova_revenue_by_tier", lambda: OS.anova_sql("monthly_revenue", TIER, ["Basic", "Premium", "Enterprise"])
)(_stats("anova", "monthly_revenue", TIER, ["Basic", "Premium", "Enterprise"]))
def _raw_stats(fn_name, *args, **kwargs):
    def run(spark, sf_dir):
        from tidemark.operators import stats

        return getattr(stats, fn_name)(customer_profile(spark, sf_dir), *args, **kwargs)

    return run


register("chi2_referral_activation", lambda: OS.chi2_sql("referral_source", "activation_completed"))(
    _raw_stats("chi2_independence", "referral_source", "activation_completed")
)
register("chi2_referral_activation_report", lambda: OS.chi2_sql("referral_source", "activation_completed", with_p=True))(
    _raw_stats("chi2_independence", "referral_source", "activation_completed", with_p=True)
)


def _ztest(with_p):
    def run(spark, sf_dir):
        from pyspark.sql import functions as F

        from tidemark.operators.stats import proportion_ztest

        return proportion_ztest(clean(spark, sf_dir), F.col("activation_completed") == 1, TIER, "Premium", "Basic", with_p)

    return run


register("ztest_activation_premium_basic", lambda: OS.ztest_sql(TIER, "Premium", "Basic"))(_ztest(False))
register("ztest_activation_premium_basic_report", lambda: OS.ztest_sql(TIER, "Premium", "Basic", with_p=True))(_ztest(True))
register(
    "cohens_d_satisfaction", lambda: OS.cohens_d_sql("customer_satisfaction_score", TIER, "Enterprise", "Basic")
)(_stats("cohens_d", "customer_satisfaction_score", TIER, "Enterprise", "Basic"))
register(
    "cohens_d_revenue_avgvar", lambda: OS.cohens_d_sql("monthly_revenue", TIER, "Premium", "Basic", True)
)(_stats("cohens_d", "monthly_revenue", TIER, "Premium", "Basic", average_variance=True))
KEY_METRICS = ["monthly_revenue", "churn_risk_score", "customer_satisfaction_score"]
register("mean_ci_key_metrics", lambda: OS.mean_ci_sql(KEY_METRICS))(_stats("mean_ci", KEY_METRICS))
register("pearson_pairs", lambda: OS.pearson_sql(CORR_VARS))(_stats("pearson_pairs", CORR_VARS))
register("pearson_pairs_report", lambda: OS.pearson_sql(CORR_VARS, with_p=True))(_stats("pearson_pairs", CORR_VARS, with_p=True))


@register("pearson_strong_pairs", lambda: OS.pearson_sql(CORR_VARS_11, with_p=True, strong=True))
def q_pearson_strong(spark, sf_dir):
    from tidemark.operators import stats

    return stats.strong_pairs(stats.pearson_pairs(clean(spark, sf_dir), CORR_VARS_11, with_p=True))


def _top(kind, cols, k):
    def run(spark, sf_dir):
        from tidemark.operators import stats

        if kind == "pearson":
            return stats.top_pairs(stats.pearson_pairs(clean(spark, sf_dir), cols), k)
        return stats.top_pairs(stats.spearman_pairs(clean(spark, sf_dir), cols), k, "spearman_rho")

    return run


register("pearson_top10", lambda: OS.pearson_sql(CORR_VARS_11, 10))(_top("pearson", CORR_VARS_11, 10))
register("spearman_top5", lambda: OS.spearman_sql(CORR_VARS, 5))(_top("spearman", CORR_VARS, 5))


def _seg(fn_name, *args):
    def run(spark, sf_dir):
        from tidemark.operators import stats

        seg = stats.value_segments(customer_profile(spark, sf_dir))
        if fn_name == "value_segments":
            return seg.select("customer_id", "customer_value_score", "value_segment")
        return getattr(stats, fn_name)(seg, *args)

    return run


register("value_segments", OS.value_segments_sql)(_seg("value_segments"))
register("segment_report", OS.segment_report_sql)(_seg("segment_report"))
register("segment_ttest", OS.segment_ttest_sql)(_seg("ttest", "monthly_revenue", "value_segment", "High Value", "At Risk"))
register("revenue_concentration", OS.revenue_concentration_sql)(_seg("revenue_concentration"))
register("prob_premium_greater", lambda: OS.prob_greater_sql("monthly_revenue", TIER, "Premium", "Basic"))(_stats("prob_greater", "monthly_revenue", TIER, "Premium", "Basic"))


# --- chart data --------------------------------------------------------------
HIST_COLS = OQ.NUM_COLS


@register("histogram", lambda: OQ.histogram_sql(HIST_COLS))
def q_histogram(spark, sf_dir):
    from tidemark.operators.chartdata import histogram

    return histogram(customer_profile(spark, sf_dir), HIST_COLS)


@register("box_stats_revenue_by_tier", lambda: OQ.box_stats_sql("monthly_revenue", "standardized_subscription_tier"))
def q_box_stats(spark, sf_dir):
    from tidemark.operators.chartdata import box_stats

    return box_stats(clean(spark, sf_dir), "monthly_revenue", "standardized_subscription_tier")


@register("sample_points", lambda: OQ.sample_points_sql(0.2))
def q_sample_points(spark, sf_dir):
    from tidemark.operators.chartdata import sample_points

    return sample_points(clean(spark, sf_dir), 0.2, strata="standardized_subscription_tier").select(
        "customer_id", "monthly_revenue", "feature_usage_score", "customer_satisfaction_score",
        "standardized_subscription_tier", "company_size",
    )


@register("journey_funnel", OQ.journey_funnel_sql)
def q_journey_funnel(spark, sf_dir):
    from tidemark.operators.chartdata import journey_funnel

    return journey_funnel(customer_profile(spark, sf_dir))


@register("revenue_hierarchy", OQ.revenue_hierarchy_sql)
def q_revenue_hierarchy(spark, sf_dir):
    from tidemark.operators.chartdata import revenue_hierarchy

    return revenue_hierarchy(customer_profile(spark, sf_dir))


# --- segmentation (ML) -------------------------------------------------------


def _seg_scaled(spark, sf_dir):
    from tidemark.operators import segmentation as S
    from tidemark.session import materialize

    feat = materialize(S.segmentation_features(customer_profile(spark, sf_dir)))
    return feat, materialize(S.standardize(feat))


@register("segmentation_features", OS.segmentation_features_sql)
def q_segmentation_features(spark, sf_dir):
    from tidemark.operators.segmentation import segmentation_features

    return segmentation_features(customer_profile(spark, sf_dir))


@register("target_correlation", OS.target_correlation_sql)
def q_target_correlation(spark, sf_dir):
    from tidemark.operators.segmentation import segmentation_features, target_correlation

    return target_correlation(segmentation_features(customer_profile(spark, sf_dir)))


@register("z_scores", OS.z_scores_sql)
def q_z_scores(spark, sf_dir):
    from tidemark.operators.segmentation import segmentation_features, z_scores
    from tidemark.session import materialize

    return z_scores(materialize(segmentation_features(customer_profile(spark, sf_dir))))


@register("cluster_quality_rule", OS.cluster_quality_sql)
def q_cluster_quality_rule(spark, sf_dir):
    """The clustering metrics of three rule-based labellings; the fitted clusterings' are in kmeans_sweep."""
    from pyspark.sql import functions as F

    from tidemark.operators.segmentation import compare_labels
    from tidemark.session import materialize

    rich, risky = F.col("monthly_revenue") > 100, F.coalesce(F.col("churn_risk_score") > 0.5, F.lit(False))
    rules = {"by_revenue": rich.cast("int"), "by_risk": risky.cast("int"), "by_both": 2 * rich.cast("int") + risky.cast("int")}
    return compare_labels(materialize(_seg_scaled(spark, sf_dir)[1].withColumns(rules)), list(rules))


_SWEEPS: dict = {}


def _sweep(spark, sf_dir):
    """The k sweep of a table, fitted once per application (ten seeds for each of nine k): a row per k."""
    from tidemark.operators.segmentation import sweep_k

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SWEEPS:
        _SWEEPS[key] = sweep_k(_seg_scaled(spark, sf_dir)[1])
    return _SWEEPS[key]


@register("kmeans_sweep")
def q_kmeans_sweep(spark, sf_dir):
    return _sweep(spark, sf_dir)


@register("segmentation_job")
def q_segmentation_job(spark, sf_dir):
    """The whole job: k from the sweep, the best algorithm, names on the customers (a row per named cluster)."""
    from pyspark.sql import functions as F

    from tidemark.operators.segmentation import segment_customers

    job = segment_customers(customer_profile(spark, sf_dir), sweep=_sweep(spark, sf_dir))
    per = job["customers"].groupBy("cluster", "cluster_name").agg(F.count(F.lit(1)).alias("customers"))
    hv = job["high_value"].select(
        F.col("customers").alias("high_value_customers"), F.col("revenue_share_pct").alias("high_value_revenue_pct")
    )
    return per.crossJoin(F.broadcast(hv)).withColumn("k", F.lit(job["k"]))


@register("clustering_comparison")
def q_clustering_comparison(spark, sf_dir):
    from tidemark.operators.segmentation import best_k, compare_clusterings

    return compare_clusterings(_seg_scaled(spark, sf_dir)[1], best_k(_sweep(spark, sf_dir)))


@register("dbscan_clusters")
def q_dbscan_clusters(spark, sf_dir):
    """Density clusters of the standardised customers (eps 0.5, 5 samples); noise is -1."""
    from pyspark.ml.functions import vector_to_array

    from tidemark.operators.density import dbscan

    scaled = _seg_scaled(spark, sf_dir)[1]
    return dbscan(scaled.select("customer_id", vector_to_array("features").alias("x")), "customer_id", "x")


@register("ward_merges")
def q_ward_merges(spark, sf_dir):
    """The merge table of Ward's clustering of the standardised customers."""
    from tidemark.operators.ward import ward

    return ward(_seg_scaled(spark, sf_dir)[1], 4)[1]


def _by_rule(spark, sf_dir):
    """Clusters by a rule on usage and risk, which SQL can state too (the fitted ones are in segmentation_job)."""
    from pyspark.sql import functions as F

    from tidemark.operators.segmentation import segmentation_features

    f = segmentation_features(customer_profile(spark, sf_dir))
    rich = (F.col("monthly_revenue") > 100).cast("int")
    risky = F.coalesce(F.col("churn_risk_score") > 0.5, F.lit(False)).cast("int")
    return f.withColumn("cluster", 2 * rich + risky)


@register("cluster_profiles", OS.cluster_profiles_sql)
def q_cluster_profiles(spark, sf_dir):
    from tidemark.operators.segmentation import profile_clusters

    return profile_clusters(_by_rule(spark, sf_dir))


@register("cluster_names", OS.cluster_names_sql)
def q_cluster_names(spark, sf_dir):
    from tidemark.operators.segmentation import name_clusters

    return name_clusters(_by_rule(spark, sf_dir))


@register("named_customers", OS.named_customers_sql)
def q_named_customers(spark, sf_dir):
    from tidemark.operators.segmentation import name_clusters, name_customers

    labeled = _by_rule(spark, sf_dir)
    return name_customers(labeled, name_clusters(labeled)).select("customer_id", "cluster", "cluster_name", "high_value")


@register("high_value_clusters", OS.high_value_sql)
def q_high_value_clusters(spark, sf_dir):
    from tidemark.operators.segmentation import high_value_summary, name_clusters

    return high_value_summary(name_clusters(_by_rule(spark, sf_dir)))


@register("cluster_radar", OS.radar_sql)
def q_cluster_radar(spark, sf_dir):
    from tidemark.operators.chartdata import radar_metrics
    from tidemark.operators.segmentation import name_clusters

    labeled = _by_rule(spark, sf_dir)
    return radar_metrics(labeled, name_clusters(labeled))


@register("pca_projection")
def q_pca_projection(spark, sf_dir):
    from pyspark.sql import functions as F

    from tidemark.operators.segmentation import pca_project

    points, explained = pca_project(_seg_scaled(spark, sf_dir)[1])
    return points.select("*", *[F.lit(v).alias(f"explained_{i + 1}") for i, v in enumerate(explained)])


@register("pca_kmeans")
def q_pca_kmeans(spark, sf_dir):
    """k sweep on the principal components of the RFM features and product diversity."""
    from tidemark.operators.segmentation import pca_kmeans, standardize
    from tidemark.operators.transactions import rfm
    from tidemark.session import materialize
    from tidemark.sources.tables import read_table

    table = rfm(tx(spark, sf_dir), read_table(spark, sf_dir, "lineitem")).fillna(0.0, ["transaction_volatility"])
    cols = ["recency", "frequency", "monetary", "avg_transaction", "transaction_volatility", "product_diversity"]
    return pca_kmeans(materialize(standardize(materialize(table), cols)))  # the scaler reads the table three times


# --- churn (ML) ----------------------------------------------------------------


def _churn_split(spark, sf_dir):
    from tidemark.operators.churn import churn_features, stratified_split
    from tidemark.session import materialize

    feat = materialize(churn_features(customer_profile(spark, sf_dir)))
    return feat, materialize(stratified_split(feat))


@register("churn_features", OS.churn_features_sql)
def q_churn_features(spark, sf_dir):
    from tidemark.operators.churn import CHURN_FEATURES, churn_features

    return churn_features(customer_profile(spark, sf_dir)).select("customer_id", "churn_target", *CHURN_FEATURES)


@register("churn_split", OS.churn_split_sql)
def q_churn_split(spark, sf_dir):
    from pyspark.sql import functions as F

    split = _churn_split(spark, sf_dir)[1]
    return split.groupBy("churn_target", "is_test", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("churn_anova_scores", OS.anova_scores_sql)
def q_churn_anova_scores(spark, sf_dir):
    """ANOVA F of every churn feature on the training split and the 15 that it selects."""
    from pyspark.sql import functions as F

    from tidemark.functions.exprs import rnd
    from tidemark.operators.churn import anova_scores

    split = _churn_split(spark, sf_dir)[1]
    return anova_scores(split.filter(~F.col("is_test"))).withColumn("f_value", rnd("f_value", 6))


@register("churn_feature_selection")
def q_churn_feature_selection(spark, sf_dir):
    from pyspark.sql import functions as F

    from tidemark.operators.churn import select_features

    split = _churn_split(spark, sf_dir)[1]
    return select_features(split.filter(~F.col("is_test")))


@register("churn_model_comparison")
def q_churn_model_comparison(spark, sf_dir):
    from tidemark.operators.churn import CHURN_FEATURES, train_models

    return train_models(_churn_split(spark, sf_dir)[1], CHURN_FEATURES)[0]


def _rf_model(spark, sf_dir):
    from tidemark.operators.churn import CHURN_FEATURES, train_models

    feat, split = _churn_split(spark, sf_dir)
    return feat, split, train_models(split, CHURN_FEATURES, models=["Random Forest"])[1]["Random Forest"]


@register("churn_scores")
def q_churn_scores(spark, sf_dir):
    from tidemark.operators.churn import score_customers

    feat, _, model = _rf_model(spark, sf_dir)
    return score_customers(model, feat)


@register("churn_importance")
def q_churn_importance(spark, sf_dir):
    """Impurity and permutation importance of the forest's features on the test split."""
    from pyspark.sql import functions as F

    from tidemark.operators.churn import CHURN_FEATURES, feature_importance, permutation_importance

    _, split, model = _rf_model(spark, sf_dir)
    test = split.filter(F.col("is_test"))
    return feature_importance(model, CHURN_FEATURES).join(permutation_importance(model, test, CHURN_FEATURES), "feature")


@register("churn_explanations")
def q_churn_explanations(spark, sf_dir):
    """Shapley values of every customer and feature under the forest."""
    from tidemark.operators.churn import CHURN_FEATURES
    from tidemark.operators.explain import explain

    feat, _, model = _rf_model(spark, sf_dir)
    return explain(model.estimator, feat, CHURN_FEATURES)


@register("churn_job")
def q_churn_job(spark, sf_dir):
    """The whole job on the selected features: the best model tuned over its grid on the training split, its test
    metrics and impact (a row per class). A forest's grid is 15 fits, boosting's 45."""
    from pyspark.sql import functions as F

    from tidemark.operators.churn import predict_churn

    job = predict_churn(customer_profile(spark, sf_dir), tuned=True)
    return job["report"].crossJoin(F.broadcast(job["auc"])).crossJoin(F.broadcast(job["impact"])).withColumns(
        {"best_model": F.lit(job["best"]), "n_features": F.lit(len(job["selected"]))}
    )


@register("churn_tuning")
def q_churn_tuning(spark, sf_dir):
    """The logistic regression's whole grid with 5-fold CV on the training split."""
    from tidemark.operators.churn import CHURN_FEATURES, tune

    return tune(_churn_split(spark, sf_dir)[1], CHURN_FEATURES, "Logistic Regression")[0]


@register("churn_business_impact", OS.business_impact_sql)
def q_churn_business_impact(spark, sf_dir):
    """Impact with a rule's predictions (no login for 30 days); the fitted model's is in churn_job."""
    from pyspark.sql import functions as F

    from tidemark.operators.churn import business_impact, churn_features
    from tidemark.session import materialize

    rule = (F.col("days_since_last_login") > 30).cast("int").alias("prediction")
    feat = materialize(churn_features(customer_profile(spark, sf_dir)).select("churn_target", "monthly_revenue", rule))
    return business_impact(feat, feat)


# Metric operators on a rule-based scorer over the data (SQL-checkable):
# label = churn target, score = days since last login / 60, prediction = score > 0.5.
def _rule_pred(spark, sf_dir):
    from pyspark.sql import functions as F

    c = customer_profile(spark, sf_dir)
    return c.select(
        F.coalesce(F.col("churn_risk_score") > 0.5, F.lit(False)).cast("int").alias("label"),
        (F.col("days_since_last_login") / 60.0).alias("score"),
        ((F.col("days_since_last_login") / 60.0) > 0.5).cast("int").alias("prediction"),
    )


@register("confusion_rule", OQ.confusion_rule_sql)
def q_confusion_rule(spark, sf_dir):
    from tidemark.operators.metrics import confusion

    return confusion(_rule_pred(spark, sf_dir))


@register("summary_metrics_rule", OQ.summary_metrics_rule_sql)
def q_summary_metrics_rule(spark, sf_dir):
    from tidemark.operators.metrics import summary_metrics

    return summary_metrics(_rule_pred(spark, sf_dir))


@register("classification_report_rule", OQ.classification_report_rule_sql)
def q_classification_report_rule(spark, sf_dir):
    from tidemark.operators.metrics import classification_report

    return classification_report(_rule_pred(spark, sf_dir))


@register("roc_points_rule", OQ.roc_points_rule_sql)
def q_roc_points_rule(spark, sf_dir):
    from tidemark.operators.metrics import roc_points

    return roc_points(_rule_pred(spark, sf_dir))


@register("roc_auc_rule", OQ.roc_auc_rule_sql)
def q_roc_auc_rule(spark, sf_dir):
    from tidemark.operators.metrics import roc_auc

    return roc_auc(_rule_pred(spark, sf_dir))


# --- streaming -----------------------------------------------------------------


@register("event_features", OQ.event_features_sql)
def q_event_features(spark, sf_dir):
    from tidemark.sources.tables import read_table
    from tidemark.streaming.features import event_features

    return event_features(read_table(spark, sf_dir, "events"))


@register("event_features_stream", OQ.event_scores_sql)
def q_event_features_stream(spark, sf_dir):
    from tidemark.streaming.features import run_event_features_stream

    return run_event_features_stream(spark, sf_dir)


@register("event_alerts_stream", OQ.event_alerts_sql)
def q_event_alerts_stream(spark, sf_dir):
    from tidemark.streaming.features import alerts, run_event_features_stream

    return alerts(run_event_features_stream(spark, sf_dir))


@register("daily_alerts_stream", OQ.daily_alerts_sql)
def q_daily_alerts_stream(spark, sf_dir):
    """Events of customers whose churn risk exceeds 0.7 as a stream: one alert per customer and day."""
    from pyspark.sql import functions as F

    from tidemark.streaming.features import run_alert_stream

    risk = F.col("churn_risk_score").alias("churn_probability")
    return run_alert_stream(spark, sf_dir, customer_profile(spark, sf_dir).select(F.col("customer_id").alias("user_id"), risk))


@register("user_scores_stream", OQ.user_scores_sql)
def q_user_scores_stream(spark, sf_dir):
    """Running features and score of every user from the state of a stream, quiet users by timer."""
    from tidemark.streaming.stateful import run_user_scores_stream

    return run_user_scores_stream(spark, sf_dir)


@register("session_features", OQ.session_features_sql)
def q_session_features(spark, sf_dir):
    from tidemark.sources.tables import read_table
    from tidemark.streaming.features import session_features

    return session_features(read_table(spark, sf_dir, "events"))


# --- monitoring ------------------------------------------------------------------
PSI_COLS = ["monthly_revenue", "total_sessions", "feature_usage_score", "annual_contract_value"]


@register("psi_signup_cohorts", lambda: OQ.psi_sql(PSI_COLS))
def q_psi(spark, sf_dir):
    from pyspark.sql import functions as F

    from tidemark.operators.monitoring import psi

    c = customer_profile(spark, sf_dir)
    cut = F.col("signup_date") < F.lit("2023-01-01").cast("date")
    return psi(c.filter(cut), c.filter(~cut), PSI_COLS)


@register("seasonality", OT.seasonality_sql)
def q_seasonality(spark, sf_dir):
    from tidemark.operators.monitoring import seasonality_index

    return seasonality_index(tx(spark, sf_dir))


@register("revenue_trend", OT.revenue_trend_sql)
def q_revenue_trend(spark, sf_dir):
    from tidemark.operators.monitoring import revenue_trend

    return revenue_trend(tx(spark, sf_dir))
register("bootstrap_premium_basic")(_stats("bootstrap_mean_diff", "monthly_revenue", TIER, "Premium", "Basic"))

register("bootstrap_subsets_premium_basic")(_stats("bootstrap_subsets", "monthly_revenue", TIER, "Premium", "Basic", "customer_id"))


def _ab_frame(spark, sf_dir):
    from pyspark.sql import functions as F

    from tidemark.functions.exprs import uniform_draw
    from tidemark.operators.cohorts import monthly_cohorts, simulate_retention

    sim = simulate_retention(monthly_cohorts(clean(spark, sf_dir), "1900-01-01"))
    arm = F.when(uniform_draw("customer_id", 99, 7) < 0.5, F.lit("treatment")).otherwise(F.lit("control"))
    return sim.withColumn("variant", arm)


@register("ab_retention_offer", lambda: OS.ab_sql())
def q_ab_retention_offer(spark, sf_dir):
    from pyspark.sql import functions as F

    from tidemark.operators.stats import ab_evaluation

    return ab_evaluation(_ab_frame(spark, sf_dir), "variant", "treatment", "control",
                         F.col("retained_month_1") == 1, "cleaned_monthly_revenue")


@register("density_revenue", lambda: OQ.density_sql("monthly_revenue"))
def q_density_revenue(spark, sf_dir):
    from tidemark.operators.chartdata import density

    return density(customer_profile(spark, sf_dir), "monthly_revenue")
