"""Customer segmentation: k-means, GMM and PCA of Spark ML, Ward and DBSCAN of this package.

Features are built with column expressions, missing values get exact
column medians (one aggregate), vectors are standardised with
population-SD semantics, and every clustering metric is an aggregate over
the prediction table (silhouette via ``ClusteringEvaluator``).
"""

from __future__ import annotations

import math

from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import rnd
from tidemark.operators import windows as W
from tidemark.operators.density import dbscan
from tidemark.operators.stats import number
from tidemark.operators.ward import ward
from tidemark.session import at_once, materialize, spread
from tidemark.sources.fixtures import CUSTOMER_AS_OF

# Clustering feature list and lifecycle thresholds.
SEG_FEATURES = [
    "monthly_revenue", "transaction_volume", "feature_usage_score", "total_sessions", "avg_session_duration",
    "api_calls_per_month", "customer_satisfaction_score", "company_size", "annual_contract_value",
    "revenue_per_session", "api_efficiency", "engagement_score", "days_since_signup",
]
LIFECYCLE_4 = [(30, "New"), (90, "Growing"), (180, "Mature")]
LIFECYCLE_4_TOP = "Veteran"
N_INIT = 10
#: fits that share the executors
PARALLEL = 8
#: rows of a partition in the fits of a sweep: several share the cores, and a pass over fewer rows costs less than its task
FIT_ROWS = 100_000


def impute_medians(df: DataFrame, cols) -> DataFrame:
    """Fill NULLs (and NaN) with each column's exact median (B20): one histogram of all columns, a one-row broadcast."""
    med = W.quantile_row(df, list(cols), [0.5], ["median"])
    return df.crossJoin(F.broadcast(med)).select(
        *[F.coalesce(number(c), F.col(f"{c}__median")).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def segmentation_features(raw: DataFrame, as_of: str = CUSTOMER_AS_OF) -> DataFrame:
    """Composite features, lifecycle stage and median imputation."""
    sess1 = F.col("total_sessions") + 1
    days = F.datediff(F.lit(as_of).cast("date"), F.col("signup_date"))
    stage = F.when(days <= LIFECYCLE_4[0][0], LIFECYCLE_4[0][1])
    for t, lab in LIFECYCLE_4[1:]:
        stage = stage.when(days <= t, lab)
    stage = stage.otherwise(LIFECYCLE_4_TOP)
    f = raw.select(
        "customer_id",
        *[c for c in raw.columns if c != "customer_id"],
        (F.col("monthly_revenue") / sess1).alias("revenue_per_session"),
        (F.col("api_calls_per_month") / sess1).alias("api_efficiency"),
        (F.col("feature_usage_score") * 0.3 + F.col("avg_session_duration") / 30 * 0.3
         + (1 - F.col("churn_risk_score")) * 0.4).alias("engagement_score"),
        days.alias("days_since_signup"),
        stage.alias("lifecycle_stage"),
    )
    return impute_medians(f, SEG_FEATURES)


def target_correlation(feat: DataFrame, target: str = "monthly_revenue", cols=SEG_FEATURES, top: int = 5) -> DataFrame:
    """|corr| of each feature with the target, self excluded, top-k."""
    from tidemark.operators.stats import pearson_pairs

    others = [c for c in cols if c != target]
    pairs = pearson_pairs(feat.select(target, *others), [target] + others, pairs=[(0, j) for j in range(1, len(others) + 1)])
    p = pairs.filter(F.col("var1") == target).select(F.col("var2").alias("feature"), F.abs("pearson_r").alias("abs_corr"))
    return p.orderBy(F.col("abs_corr").desc(), "feature").limit(top)


def standardize(feat: DataFrame, cols=SEG_FEATURES, out: str = "features") -> DataFrame:
    """z-scores with population SD (S13): Spark's sample-SD scaler times sqrt(n / (n - 1))."""
    vec = VectorAssembler(inputCols=list(cols), outputCol="_raw", handleInvalid="keep").transform(feat)
    scaled = StandardScaler(inputCol="_raw", outputCol="_z", withMean=True, withStd=True).fit(vec).transform(vec)
    n = scaled.count()
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    ep = ElementwiseProduct(scalingVec=Vectors.dense([factor] * len(cols)), inputCol="_z", outputCol=out)
    return ep.transform(scaled).drop("_raw", "_z")


def z_scores(feat: DataFrame, cols=SEG_FEATURES, key: str = "customer_id") -> DataFrame:
    """``key`` and the z-scores of ``cols`` as plain columns (S13); a constant column's are 0."""
    z = vector_to_array("features")
    return standardize(feat, cols).select(key, *[rnd(z[i], 6).alias(f"z_{c}") for i, c in enumerate(cols)])


def _cluster_stats(pred: DataFrame, k_col: str = "cluster", features: str = "features"):
    """Sizes, centroids, within-SS and mean distance per cluster (aggregates)."""
    arr = pred.select(k_col, vector_to_array(features).alias("_x"))
    dim = len(arr.first()["_x"])
    cents = arr.groupBy(k_col).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col("_x")[i]).alias(f"c{i}") for i in range(dim)]
    )
    j = arr.join(F.broadcast(cents), k_col)  # one row per cluster
    sq = sum(((F.col("_x")[i] - F.col(f"c{i}")) ** 2 for i in range(dim)), F.lit(0.0))
    within = j.groupBy(k_col).agg(F.sum(sq).alias("ss"), F.avg(F.sqrt(sq)).alias("s"))
    rows = cents.join(within, k_col).collect()  # k rows
    return rows, dim


def cluster_metrics(pred: DataFrame, k_col: str = "cluster", features: str = "features") -> dict:
    """Silhouette (squared Euclidean, Spark's evaluator), Calinski-Harabasz and Davies-Bouldin (M2-M4)."""
    rows, dim = _cluster_stats(pred, k_col, features)
    k = len(rows)
    n = sum(r["n"] for r in rows)
    grand = [sum(r["n"] * r[f"c{i}"] for r in rows) / n for i in range(dim)]
    between = sum(r["n"] * sum((r[f"c{i}"] - grand[i]) ** 2 for i in range(dim)) for r in rows)
    within = sum(r["ss"] for r in rows)
    ch = (between / (k - 1)) / (within / (n - k)) if k > 1 and within > 0 else float("nan")
    db_terms = []
    for a in rows:
        worst = 0.0
        for b in rows:
            if a[k_col] == b[k_col]:
                continue
            d = math.sqrt(sum((a[f"c{i}"] - b[f"c{i}"]) ** 2 for i in range(dim)))
            worst = max(worst, (a["s"] + b["s"]) / d if d > 0 else float("inf"))
        db_terms.append(worst)
    db = sum(db_terms) / k if k > 1 else float("nan")
    sil = (
        ClusteringEvaluator(featuresCol=features, predictionCol=k_col, metricName="silhouette").evaluate(pred)
        if k > 1 else float("nan")
    )
    return {"n_clusters": k, "inertia": within, "silhouette": sil, "calinski_harabasz": ch, "davies_bouldin": db}


def compare_labels(scaled: DataFrame, labels) -> DataFrame:
    """Metrics of given labellings of one table (M2-M4), a row each, and the one of the largest silhouette (T5, M5);
    of equal ones the first name. ``labels``: integer columns of ``scaled``. A labelling of one cluster has only an inertia."""
    rows = []
    for name in labels:
        met = cluster_metrics(scaled.where(F.col(name).isNotNull()).withColumn(name, F.col(name).cast("int")), name)
        known = {m: None if isinstance(v, float) and not math.isfinite(v) else v for m, v in met.items()}
        rows.append((name, *(known[m] for m in ("n_clusters", "inertia", "silhouette", "calinski_harabasz", "davies_bouldin"))))
    table = scaled.sparkSession.createDataFrame(
        rows, "labelling string, n_clusters int, inertia double, silhouette double, calinski_harabasz double, davies_bouldin double"
    )
    known = [r for r in rows if r[3] is not None]
    best = min(known, key=lambda r: (-r[3], r[0]))[0] if known else None
    metrics = ("inertia", "silhouette", "calinski_harabasz", "davies_bouldin")
    return table.withColumns({m: rnd(m, 6) for m in metrics}).withColumn("is_best", F.lit(best).eqNullSafe(F.col("labelling")))


def best_kmeans(data: DataFrame, k: int, seed: int = 42, n_init: int = N_INIT):
    """The k-means model of least cost among ``n_init`` seeds (M6)."""
    return _best_per_k(data, [k], seed, n_init)[0]


def _best_per_k(data: DataFrame, ks, seed: int, n_init: int, parallelism: int = PARALLEL) -> list:
    """The k-means model of least cost among ``n_init`` seeds for each k; all fits share the executors, ``parallelism`` at
    a time, the largest k first."""

    def fit(k, s):
        model = KMeans(k=k, seed=seed + s, featuresCol="features", predictionCol="cluster").fit(data)
        return model, model.summary.trainingCost

    tries = [(k, s) for k in sorted(ks, reverse=True) for s in range(n_init)]
    found = dict(zip(tries, at_once([lambda k=k, s=s: fit(k, s) for k, s in tries], parallelism), strict=True))
    return [min((found[k, s] for s in range(n_init)), key=lambda m: m[1])[0] for k in ks]


def sweep_k(scaled: DataFrame, ks=range(2, 11), seed: int = 42, n_init: int = N_INIT) -> DataFrame:
    """k-means for each k (best of ``n_init`` seeds by cost) with its metrics (M1-M5); flags the k that each metric picks."""
    ks = list(ks)
    # not persisted: a fit then keeps its own points, else it decodes the cached rows on each of its passes
    scaled = materialize(spread(scaled.select("features"), FIT_ROWS))
    best = _best_per_k(scaled, ks, seed, n_init)
    metrics = at_once([lambda m=m: cluster_metrics(m.transform(scaled)) for m in best], PARALLEL)
    out = [
        (k, float(m.summary.trainingCost), float(met["silhouette"]), float(met["calinski_harabasz"]), float(met["davies_bouldin"]))
        for k, m, met in zip(ks, best, metrics, strict=True)
    ]
    picks = {
        "silhouette": max(out, key=lambda r: r[2])[0],
        "calinski_harabasz": max(out, key=lambda r: r[3])[0],
        "davies_bouldin": min(out, key=lambda r: r[4])[0],
    }
    rows = [(*r, *(r[0] == k for k in picks.values())) for r in out]
    return scaled.sparkSession.createDataFrame(
        rows,
        "k int, inertia double, silhouette double, calinski_harabasz double, davies_bouldin double, "
        + ", ".join(f"best_by_{m} boolean" for m in picks),
    )


def best_k(sweep: DataFrame) -> int:
    """Arg-max silhouette (T5, M5)."""
    return int(sweep.agg(F.max_by("k", "silhouette")).first()[0])


def fit_cluster(scaled: DataFrame, algo: str, k: int, seed: int = 42, key: str = "customer_id") -> DataFrame:
    """Cluster labels from k-means, Ward, GMM, DBSCAN (noise is -1) or bisecting k-means (M6-M9)."""
    if algo == "kmeans":
        return best_kmeans(scaled, k, seed).transform(scaled)
    if algo == "ward":
        return ward(scaled, k, seed=seed)[0]
    if algo == "dbscan":
        labels = dbscan(scaled.select(key, vector_to_array("features").alias("_x")), key, "_x")
        return scaled.join(labels.select(key, "cluster"), key)
    if algo == "bisecting":
        est = BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster")
    elif algo == "gmm":
        est = GaussianMixture(k=k, seed=seed, featuresCol="features", predictionCol="cluster", probabilityCol="_prob")
    else:
        raise ValueError(algo)
    out = est.fit(scaled).transform(scaled)
    return out.drop("_prob") if "_prob" in out.columns else out


def compare_clusterings(scaled: DataFrame, k: int, seed: int = 42, algos=("kmeans", "ward", "gmm", "dbscan")) -> DataFrame:
    """Run the algorithms, keep those with > 1 cluster and < 50 % noise, rank by silhouette."""
    spark = scaled.sparkSession
    rows = []
    for a in algos:
        pred = materialize(fit_cluster(scaled, a, k, seed))
        noise = pred.filter(F.col("cluster") < 0).count()
        n = pred.count()
        met = cluster_metrics(pred.filter(F.col("cluster") >= 0)) if noise < n else dict.fromkeys(
            ("silhouette", "calinski_harabasz", "davies_bouldin"), math.nan) | {"n_clusters": 0}
        ok = met["n_clusters"] > 1 and noise < 0.5 * n
        rows.append((a, int(met["n_clusters"]), int(noise), float(met["silhouette"]), float(met["calinski_harabasz"]),
                     float(met["davies_bouldin"]), bool(ok)))
    df = spark.createDataFrame(rows, "algorithm string, n_clusters int, n_noise int, silhouette double, "
                                     "calinski_harabasz double, davies_bouldin double, eligible boolean")
    return df.withColumn("is_best", F.col("algorithm") == F.first(F.when(F.col("eligible"), F.col("algorithm")), True).over(
        Window.orderBy(F.col("eligible").desc(), F.col("silhouette").desc())
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))


def profile_clusters(labeled: DataFrame) -> DataFrame:
    """Cluster profile: revenue mean / median / std / count and seven means."""
    median = W.group_quantiles(labeled.select("cluster", "monthly_revenue"), ["cluster"], "monthly_revenue", [0.5], ["_median"])
    per = labeled.groupBy("cluster").agg(
        rnd(F.avg("monthly_revenue"), 2).alias("revenue_mean"),
        rnd(F.stddev_samp("monthly_revenue"), 2).alias("revenue_std"),
        F.count("monthly_revenue").alias("revenue_count"),
        *[rnd(F.avg(c), 2).alias(f"avg_{c}") for c in (
            "company_size", "feature_usage_score", "churn_risk_score", "customer_satisfaction_score", "total_sessions",
            "annual_contract_value", "engagement_score")],
    )
    return W.null_safe_join(per, median, ["cluster"], "left").withColumn("revenue_median", rnd("_median", 2)).drop("_median")


# Cluster naming rules.
CLUSTER_NAMES = ("High-Value Champions", "High-Value At-Risk", "Growing Advocates", "Moderate Users",
                 "At-Risk Low-Value", "New/Small Customers")


def name_clusters(labeled: DataFrame) -> DataFrame:
    """Cluster names from mean revenue vs global q75 / median, churn and engagement; shares."""
    glob = labeled.agg(F.sum("monthly_revenue").alias("_gsum"), F.count(F.lit(1)).alias("_gn")).crossJoin(
        W.exact_quantiles(labeled, "monthly_revenue", [0.5, 0.75], ["_g50", "_g75"])
    )  # one row each
    agg = labeled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("monthly_revenue").alias("avg_revenue"),
        F.sum("monthly_revenue").alias("_rev"),
        F.avg("churn_risk_score").alias("avg_churn_risk"),
        F.avg("customer_satisfaction_score").alias("avg_satisfaction"),
        F.avg("engagement_score").alias("avg_engagement"),
    ).crossJoin(F.broadcast(glob))
    r, c, e = F.col("avg_revenue"), F.col("avg_churn_risk"), F.col("avg_engagement")
    name = (
        F.when(r > F.col("_g75"), F.when(c < 0.3, CLUSTER_NAMES[0]).otherwise(CLUSTER_NAMES[1]))
        .when(r > F.col("_g50"), F.when(e > 0.6, CLUSTER_NAMES[2]).otherwise(CLUSTER_NAMES[3]))
        .otherwise(F.when(c > 0.6, CLUSTER_NAMES[4]).otherwise(CLUSTER_NAMES[5]))
    )
    return agg.select(
        "cluster", name.alias("name"), "size",
        rnd(F.col("size") / F.col("_gn") * 100, 4).alias("customer_share_pct"),
        rnd("avg_revenue", 4).alias("avg_revenue"),
        rnd(F.col("_rev") / F.col("_gsum") * 100, 4).alias("revenue_share_pct"),
        rnd("avg_churn_risk", 4).alias("avg_churn_risk"),
        rnd("avg_satisfaction", 4).alias("avg_satisfaction"),
        rnd("avg_engagement", 4).alias("avg_engagement"),
        (name.contains("High-Value") | name.contains("Champions")).alias("high_value"),
    )


def name_customers(labeled: DataFrame, names: DataFrame) -> DataFrame:
    """Every customer with the name of its cluster (B21); ``names`` has a row per cluster."""
    return labeled.join(names.select("cluster", F.col("name").alias("cluster_name"), "high_value"), "cluster")


def high_value_summary(names: DataFrame) -> DataFrame:
    """Customers and revenue of the high-value clusters together."""
    hv = F.col("high_value")
    return names.agg(
        F.count_if(hv).alias("clusters"),
        F.sum(F.when(hv, F.col("size")).otherwise(0)).alias("customers"),
        rnd(F.sum(F.when(hv, F.col("customer_share_pct")).otherwise(0.0)), 4).alias("customer_share_pct"),
        rnd(F.sum(F.when(hv, F.col("revenue_share_pct")).otherwise(0.0)), 4).alias("revenue_share_pct"),
    )


def pca_project(scaled: DataFrame, k: int = 2) -> tuple[DataFrame, list]:
    """2-D projection and explained variance (V8); component signs fixed so the largest loading is positive."""
    model = PCA(k=k, inputCol="features", outputCol="_pc").fit(scaled)
    pcs = model.pc.toArray()
    signs = [1.0 if pcs[abs(pcs[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    arr = vector_to_array(F.col("_pc"))
    out = model.transform(scaled).select(
        "customer_id", *[(arr[j] * signs[j]).alias(f"pc{j + 1}") for j in range(k)]
    )
    return out, [float(v) for v in model.explainedVariance.toArray()]


def pca_kmeans(scaled: DataFrame, variance: float = 0.95, ks=range(2, 11), seed: int = 42, n_init: int = N_INIT) -> DataFrame:
    """PCA keeping ``variance`` of the variance, then a k sweep on the scores (M11): components, variance and the
    sweep's columns, a row per k."""
    d = len(scaled.first()["features"])
    full = PCA(k=d, inputCol="features", outputCol="_pc").fit(scaled)
    cum, keep = 0.0, d
    for i, v in enumerate(full.explainedVariance.toArray()):
        cum += v
        if cum >= variance:
            keep = i + 1
            break
    proj = PCA(k=keep, inputCol="features", outputCol="_pcs").fit(scaled).transform(scaled)
    proj = materialize(proj.select(F.col("_pcs").alias("features")))
    return sweep_k(proj, ks, seed, n_init).select(
        F.lit(keep).alias("components"), F.lit(float(cum)).alias("variance_explained"), "*"
    )


def segment_customers(raw: DataFrame, as_of: str = CUSTOMER_AS_OF, ks=range(2, 11), seed: int = 42, sweep=None):
    """End-to-end segmentation (M12): features -> z-scores -> k sweep -> best algorithm -> names.

    ``sweep`` takes the result of an earlier ``sweep_k`` on the same customers."""
    feat = materialize(segmentation_features(raw, as_of))
    scaled = materialize(standardize(feat))
    sweep = sweep_k(scaled, ks, seed) if sweep is None else sweep
    k = best_k(sweep)
    comp = compare_clusterings(scaled, k, seed)
    best = comp.filter("is_best").first()["algorithm"]
    labeled = materialize(fit_cluster(scaled, best, k, seed))
    names = materialize(name_clusters(labeled))
    return {"features": feat, "scaled": scaled, "sweep": sweep, "k": k, "comparison": comp, "labeled": labeled,
            "profile": profile_clusters(labeled), "names": names, "customers": name_customers(labeled, names),
            "high_value": high_value_summary(names)}
