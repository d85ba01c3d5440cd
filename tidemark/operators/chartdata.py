"""The DataFrames behind the reference's charts (figures themselves are not drawn)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import money_avg, rnd, uniform_draw


def histogram(df: DataFrame, cols, bins: int = 20) -> DataFrame:
    """Equal-width bins per numeric column (V1): min/max in one agg, then one groupBy."""
    rng = df.agg(*[F.min(c).cast("double").alias(f"_mn{i}") for i, c in enumerate(cols)],
                 *[F.max(c).cast("double").alias(f"_mx{i}") for i, c in enumerate(cols)])
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(cols)])).alias("r")
    ).select("r.*").filter(F.col("_v").isNotNull())
    bounds = rng.select(
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(c).alias("column_name"), F.col(f"_mn{i}").alias("_mn"),
                               F.col(f"_mx{i}").alias("_mx")) for i, c in enumerate(cols)])
        ).alias("b")
    ).select("b.*")
    j = long.join(F.broadcast(bounds), "_i")  # one row per column
    width = F.col("_mx") - F.col("_mn")
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.lit(bins), F.floor((F.col("_v") - F.col("_mn")) / width * bins).cast("int") + 1)
    )
    counts = j.groupBy("column_name", "_mn", "_mx", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("_mx") - F.col("_mn")) / bins
    return counts.select(
        "column_name",
        "bin",
        rnd(F.col("_mn") + (F.col("bin") - 1) * w, 6).alias("bin_lower"),
        rnd(F.col("_mn") + F.col("bin") * w, 6).alias("bin_upper"),
        "count",
    )


def box_stats(df: DataFrame, value: str, group: str, k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and outlier count per group (V3): box / violin data."""
    from tidemark.operators import windows as W

    d = df.filter(F.col(value).isNotNull())
    q = W.group_quantiles(d.select(group, value), [group], value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    q = q.withColumn("lo", F.col("q1") - k * (F.col("q3") - F.col("q1"))).withColumn(
        "hi", F.col("q3") + k * (F.col("q3") - F.col("q1"))
    )
    # one row per group on the right side; AQE broadcasts it from its measured size
    j = W.null_safe_join(d, q.select(group, "lo", "hi"), [group])
    x = F.col(value)
    w = j.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(x >= F.col("lo"), x)).cast("double").alias("whisker_low"),
        F.max(F.when(x <= F.col("hi"), x)).cast("double").alias("whisker_high"),
        F.count_if((x < F.col("lo")) | (x > F.col("hi"))).alias("outliers"),
    )
    return W.null_safe_join(q, w, [group]).select(
        group, "n", rnd("q1", 6).alias("q1"), rnd("median", 6).alias("median"), rnd("q3", 6).alias("q3"),
        rnd("whisker_low", 6).alias("whisker_low"), rnd("whisker_high", 6).alias("whisker_high"),
        F.col("outliers").cast("long").alias("outliers"),
    )


def sample_points(df: DataFrame, fraction: float, key: str = "customer_id", strata: str | None = None,
                  seed: int = 42) -> DataFrame:
    """Deterministic scatter sample (V4): keep a row when its draw (key, seed) falls below ``fraction`` — the same
    rows on any partitioning; ``strata`` adds the stratum to the draw's key."""
    name = F.concat_ws("/", F.col(key), F.col(strata)) if strata else F.col(key)
    return df.filter(uniform_draw(name, 0, seed) < fraction)


def journey_funnel(df: DataFrame, tier: str = "subscription_tier") -> DataFrame:
    """Activation / adoption / satisfaction/5 per tier, long form."""
    agg = df.groupBy(tier).agg(
        F.avg("activation_completed").alias("Activation"),
        money_avg("feature_adoption_score").alias("Feature Adoption"),
        (money_avg("customer_satisfaction_score") / 5).alias("Satisfaction"),
    )
    long = agg.unpivot(tier, ["Activation", "Feature Adoption", "Satisfaction"], "stage", "score")
    return long.select(tier, "stage", rnd("score", 6).alias("score"))


def revenue_hierarchy(df: DataFrame, dims=("industry", "subscription_tier", "referral_source"),
                      value: str = "monthly_revenue") -> DataFrame:
    """Revenue roll-up industry -> tier -> source (G35) with the level of each row."""
    agg = df.rollup(*dims).agg(
        F.sum(F.col(value).cast("decimal(24,6)")).alias("_s"), F.grouping_id(*dims).alias("level_id")
    )
    return agg.select(*dims, F.col("level_id").cast("long").alias("level_id"),
                      F.round("_s", 2).cast("double").alias("revenue"))


def radar_metrics(labeled: DataFrame, names: DataFrame) -> DataFrame:
    """Radar values per cluster name (G34): mean revenue on the range of all customers, satisfaction / 5,
    1 - churn risk, feature usage and engagement; clusters of one name are one row."""
    span = labeled.agg(F.min("monthly_revenue").alias("_lo"), F.max("monthly_revenue").alias("_hi"))  # one row
    per = labeled.join(names.select("cluster", "name"), "cluster").groupBy("name").agg(
        F.avg("monthly_revenue").alias("_rev"),
        F.avg("customer_satisfaction_score").alias("_sat"),
        F.avg("churn_risk_score").alias("_risk"),
        F.avg("feature_usage_score").alias("_use"),
        F.avg("engagement_score").alias("_eng"),
    )
    return per.crossJoin(F.broadcast(span)).select(
        "name",
        rnd(F.try_divide(F.col("_rev") - F.col("_lo"), F.col("_hi") - F.col("_lo")), 6).alias("revenue"),
        rnd(F.col("_sat") / 5, 6).alias("satisfaction"),
        rnd(1 - F.col("_risk"), 6).alias("retention"),
        rnd("_use", 6).alias("feature_usage"),
        rnd("_eng", 6).alias("engagement"),
    )


def density(df: DataFrame, col: str, grid: int = 200, bins: int = 512) -> DataFrame:
    """Binned Gaussian KDE on a grid (V2).

    One scan bins the column into ``bins`` equal-width cells (plus n and SD);
    the kernel is then evaluated from the bounded histogram (``bins`` rows,
    never the data) on ``grid`` points with Scott's bandwidth SD * n^(-1/5).
    """
    import numpy as np
    import pandas as pd

    x = F.col(col).cast("double")
    st = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx"), F.count(x).alias("n"), F.stddev_samp(x).alias("sd"))
    j = df.select(x.alias("v")).filter(F.col("v").isNotNull()).crossJoin(F.broadcast(st))  # one-row stats
    width = (F.col("mx") - F.col("mn")) / bins
    b = F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("mn")) / F.when(width > 0, width).otherwise(1.0)).cast("int"))
    hist = j.groupBy(b.alias("bin"), "mn", "mx", "n", "sd").agg(F.count(F.lit(1)).alias("c"))
    packed = hist.groupBy("mn", "mx", "n", "sd").agg(F.collect_list(F.struct("bin", "c")).alias("h"))  # <= bins

    def kde(it):
        for pdf in it:
            for _, r in pdf.iterrows():
                mn, mx, n, sd = float(r["mn"]), float(r["mx"]), float(r["n"]), float(r["sd"] or 0.0)
                w = (mx - mn) / bins if mx > mn else 1.0
                centers = np.array([mn + (e["bin"] + 0.5) * w for e in r["h"]])
                counts = np.array([e["c"] for e in r["h"]], dtype=float)
                bw = sd * n ** (-0.2) if sd > 0 else 1.0
                gx = np.linspace(mn, mx, grid)
                z = (gx[:, None] - centers[None, :]) / bw
                dens = (np.exp(-0.5 * z * z) * counts[None, :]).sum(1) / (n * bw * np.sqrt(2 * np.pi))
                yield pd.DataFrame({"x": gx, "density": dens})

    out = packed.mapInPandas(kde, "x double, density double")
    return out.select(F.lit(col).alias("column_name"), rnd("x", 6).alias("x"), F.round("density", 9).alias("density"))
