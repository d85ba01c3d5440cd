"""Hypothesis tests, effect sizes, intervals and correlations.

Every test is one distributed aggregate of counts, means and centred second
moments (``var_samp`` / ``covar_pop``, whose partial results merge without
cancellation) followed by a closed form on the aggregated row. NaN counts as
NULL. A statistic that is not defined (an empty group, no variance) is NULL;
tail probabilities (pandas UDFs in ``special``) only see the result rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import special as SP
from tidemark.functions.exprs import col, money_sum, rnd
from tidemark.operators import windows as W


def number(x) -> Column:
    """The value as DOUBLE, NaN as NULL."""
    return F.nanvl(col(x).cast("double"), F.lit(None).cast("double"))


def moment_aggs(x: Column, tag: str) -> list[Column]:
    """Count, mean and sample variance of ``x`` (NULLs skipped)."""
    v = number(x)
    return [
        F.count(v).cast("double").alias(f"n_{tag}"),
        F.avg(v).alias(f"m_{tag}"),
        F.var_samp(v).alias(f"v_{tag}"),
    ]


def mean_of(tag: str) -> Column:
    return F.col(f"m_{tag}")


def var_of(tag: str) -> Column:
    return F.col(f"v_{tag}")


def _two_group_row(df: DataFrame, value: str, group: str, a: str, b: str) -> DataFrame:
    v, g = F.col(value), F.col(group)
    return df.agg(*moment_aggs(F.when(g == a, v), "a"), *moment_aggs(F.when(g == b, v), "b"))


def _per(x: Column, n: Column) -> Column:
    return F.try_divide(x, n)


def _pooled_variance() -> Column:
    na, nb = F.col("n_a"), F.col("n_b")
    return _per((na - 1) * var_of("a") + (nb - 1) * var_of("b"), na + nb - 2)


def _welch_parts() -> tuple[Column, Column]:
    """Squared standard error of the mean difference and Welch's degrees of freedom."""
    na, nb = F.col("n_a"), F.col("n_b")
    ea, eb = _per(var_of("a"), na), _per(var_of("b"), nb)
    return ea + eb, _per((ea + eb) * (ea + eb), _per(ea * ea, na - 1) + _per(eb * eb, nb - 1))


def ttest(df: DataFrame, value: str, group: str, a: str, b: str, equal_var: bool = True, z: float = 1.96,
          with_p: bool = False) -> DataFrame:
    """Two-sample t-test (pooled or Welch) with the z-interval of the mean difference."""
    row = _two_group_row(df, value, group, a, b)
    na, nb = F.col("n_a"), F.col("n_b")
    diff = mean_of("a") - mean_of("b")
    error2, welch_df = _welch_parts()
    if equal_var:
        t = _per(diff, F.sqrt(_pooled_variance() * (_per(F.lit(1.0), na) + _per(F.lit(1.0), nb))))
        dof = na + nb - 2
    else:
        t, dof = _per(diff, F.sqrt(error2)), welch_df
    out = row.select(
        F.lit(a).alias("group_a"),
        F.lit(b).alias("group_b"),
        na.cast("long").alias("n_a"),
        nb.cast("long").alias("n_b"),
        rnd(mean_of("a"), 6).alias("mean_a"),
        rnd(mean_of("b"), 6).alias("mean_b"),
        rnd(t, 6).alias("t_stat"),
        rnd(dof, 6).alias("df"),
        rnd(diff, 6).alias("mean_diff"),
        rnd(diff - z * F.sqrt(error2), 6).alias("ci_lower"),
        rnd(diff + z * F.sqrt(error2), 6).alias("ci_upper"),
        t.alias("_t"),
        dof.alias("_df"),
    )
    if with_p:
        out = out.withColumn("p_value", rnd(SP.t_pvalue("_t", "_df"), 6)).withColumn(
            "significant", F.col("p_value") < 0.05
        )
    return out.drop("_t", "_df")


def cohens_d(df: DataFrame, value: str, group: str, a: str, b: str, average_variance: bool = False) -> DataFrame:
    """Cohen's d with the pooled SD (or sqrt of the mean variance) and its size label."""
    row = _two_group_row(df, value, group, a, b)
    sd = F.sqrt((var_of("a") + var_of("b")) / 2 if average_variance else _pooled_variance())
    d = _per(mean_of("a") - mean_of("b"), sd)
    return row.select(
        F.lit(a).alias("group_a"),
        F.lit(b).alias("group_b"),
        rnd(d, 6).alias("cohens_d"),
        F.when(F.abs(d) < 0.5, "Small").when(F.abs(d) < 0.8, "Medium").when(d.isNotNull(), "Large").alias("effect_size"),
    )


def proportion_ztest(df: DataFrame, success: Column, group: str, a: str, b: str, with_p: bool = False) -> DataFrame:
    """Pooled two-proportion z-test (S7): counts of ``success`` per group."""
    g = F.col(group)
    row = df.agg(*_proportion_aggs(success, g, a, b))
    out = row.select(F.lit(a).alias("group_a"), F.lit(b).alias("group_b"), *_proportion_columns())
    if with_p:
        out = out.withColumn("p_value", rnd(SP.z_pvalue("_z"), 6))
    return out.drop("_z")


def _proportion_aggs(success: Column, g: Column, a: str, b: str) -> list[Column]:
    return [
        x.cast("double").alias(name)
        for name, x in (
            ("x_a", F.count_if((g == a) & success)),
            ("z_a", F.count_if(g == a)),
            ("x_b", F.count_if((g == b) & success)),
            ("z_b", F.count_if(g == b)),
        )
    ]


def _proportion_columns() -> list[Column]:
    xa, na, xb, nb = F.col("x_a"), F.col("z_a"), F.col("x_b"), F.col("z_b")
    p = _per(xa + xb, na + nb)
    error = F.sqrt(p * (1 - p) * (_per(F.lit(1.0), na) + _per(F.lit(1.0), nb)))
    z = _per(_per(xa, na) - _per(xb, nb), error)
    return [
        xa.cast("long").alias("successes_a"),
        na.cast("long").alias("n_a"),
        xb.cast("long").alias("successes_b"),
        nb.cast("long").alias("n_b"),
        rnd(_per(xa, na), 6).alias("rate_a"),
        rnd(_per(xb, nb), 6).alias("rate_b"),
        rnd(z, 6).alias("z_stat"),
        z.alias("_z"),
    ]


def anova(df: DataFrame, value: str, group: str, groups=None, with_p: bool = False) -> DataFrame:
    """One-way ANOVA F test (S5): per-group moments, then the sums of squares around the grand mean."""
    d = df.select(number(value).alias("_v"), F.col(group)).where(F.col("_v").isNotNull() & F.col(group).isNotNull())
    if groups is not None:
        d = d.filter(F.col(group).isin(*groups))
    per = d.groupBy(group).agg(*moment_aggs(F.col("_v"), "g"))
    grand = per.agg(_per(F.sum(F.col("n_g") * F.col("m_g")), F.sum("n_g")).alias("_grand"))
    off = F.col("m_g") - F.col("_grand")
    tot = per.crossJoin(F.broadcast(grand)).agg(  # one row
        F.count(F.lit(1)).cast("double").alias("k"),
        F.sum("n_g").alias("n"),
        F.sum(F.col("n_g") * off * off).alias("ssb"),
        F.sum((F.col("n_g") - 1) * F.coalesce("v_g", F.lit(0.0))).alias("ssw"),
    )
    k, n = F.col("k"), F.col("n")
    fstat = _per(_per(F.col("ssb"), k - 1), _per(F.col("ssw"), n - k))
    out = tot.select(
        F.lit(value).alias("value"),
        F.lit(group).alias("factor"),
        k.cast("long").alias("n_groups"),
        n.cast("long").alias("n"),
        rnd(fstat, 6).alias("f_stat"),
        fstat.alias("_f"),
        (k - 1).alias("_d1"),
        (n - k).alias("_d2"),
    )
    if with_p:
        out = out.withColumn("p_value", rnd(SP.f_pvalue("_f", "_d1", "_d2"), 6))
    return out.drop("_f", "_d1", "_d2")


def chi2_independence(df: DataFrame, a: str, b: str, yates: str = "auto", with_p: bool = False) -> DataFrame:
    """Chi-square test of independence on the a x b contingency table.

    ``yates='auto'`` applies the continuity correction for 1 degree of freedom
    (as the common library default does).
    """
    cells = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(
        F.count(F.lit(1)).cast("double").alias("o")
    )
    # Marginals by windows over the (small) cell table.
    row_t = F.sum("o").over(Window.partitionBy(a))
    col_t = F.sum("o").over(Window.partitionBy(b))
    tot = cells.agg(F.sum("o").alias("_tot"))
    e = cells.crossJoin(F.broadcast(tot)).select(a, b, "o", (row_t * col_t / F.col("_tot")).alias("e"))  # one row
    stats = e.agg(
        F.countDistinct(a).alias("r"),
        F.countDistinct(b).alias("c"),
        F.sum((F.col("o") - F.col("e")) ** 2 / F.col("e")).alias("chi2_plain"),
        F.sum(
            (F.abs(F.col("o") - F.col("e")) - F.least(F.lit(0.5), F.abs(F.col("o") - F.col("e")))) ** 2 / F.col("e")
        ).alias("chi2_yates"),
    )
    dof = (F.col("r") - 1) * (F.col("c") - 1)
    use_y = (dof == 1) if yates == "auto" else F.lit(bool(yates))
    chi2 = F.when(use_y, F.col("chi2_yates")).otherwise(F.col("chi2_plain"))
    out = stats.select(
        F.lit(a).alias("row_var"),
        F.lit(b).alias("col_var"),
        rnd(chi2, 6).alias("chi2"),
        dof.cast("long").alias("dof"),
        chi2.alias("_x"),
        dof.cast("double").alias("_k"),
    )
    if with_p:
        out = out.withColumn("p_value", rnd(SP.chi2_pvalue("_x", "_k"), 6))
    return out.drop("_x", "_k")


def mean_ci(df: DataFrame, cols, level: float = 0.95) -> DataFrame:
    """t-based confidence interval of the mean per column (S4), one scan."""
    row = df.agg(*[a for i, c in enumerate(cols) for a in moment_aggs(F.col(c), str(i))])
    parts = F.array(
        *[
            F.struct(
                F.lit(c).alias("metric"),
                F.col(f"n_{i}").cast("long").alias("n"),
                F.col(f"m_{i}").alias("mean"),
                F.sqrt(_per(F.col(f"v_{i}"), F.col(f"n_{i}"))).alias("sem"),
            )
            for i, c in enumerate(cols)
        ]
    )
    out = row.select(F.explode(parts).alias("p")).select("p.*")
    tq = SP.t_quantile(F.lit((1 + level) / 2.0), F.when(F.col("n") > 1, (F.col("n") - 1).cast("double")))
    return out.select(
        "metric",
        "n",
        rnd("mean", 6).alias("mean"),
        rnd("sem", 6).alias("sem"),
        rnd(F.col("mean") - tq * F.col("sem"), 6).alias("ci_lower"),
        rnd(F.col("mean") + tq * F.col("sem"), 6).alias("ci_upper"),
    )


def correlation_aggs(x: Column, y: Column, tag: str) -> list[Column]:
    """Count, centred cross moment and deviations of the rows that have both values."""
    both = x.isNotNull() & y.isNotNull()
    return [
        F.count_if(both).alias(f"n_{tag}"),
        F.covar_pop(x, y).alias(f"c_{tag}"),
        F.stddev_pop(F.when(both, x)).alias(f"x_{tag}"),
        F.stddev_pop(F.when(both, y)).alias(f"y_{tag}"),
    ]


def correlation_of(tag: str) -> Column:
    """Pearson r; NULL without variance, within [-1, 1]."""
    r = _per(F.col(f"c_{tag}"), F.col(f"x_{tag}") * F.col(f"y_{tag}"))
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))  # greatest() and least() skip NULL


def pearson_pairs(df: DataFrame, cols, with_p: bool = False, pairs=None) -> DataFrame:
    """Pearson r for every pair (or the given index pairs) on pairwise-complete rows (S9, SURVEY D15), one scan."""
    pairs = list(pairs) if pairs is not None else list(combinations(range(len(cols)), 2))
    values = [number(c) for c in cols]
    row = df.agg(*[a for i, j in pairs for a in correlation_aggs(values[i], values[j], f"{i}_{j}")])
    structs = [
        F.struct(
            F.lit(cols[i]).alias("var1"),
            F.lit(cols[j]).alias("var2"),
            F.col(f"n_{i}_{j}").cast("long").alias("n"),
            correlation_of(f"{i}_{j}").alias("r"),
        )
        for i, j in pairs
    ]
    long = row.select(F.explode(F.array(*structs)).alias("p")).select("p.*")
    return _pair_report(long, with_p)


def _pair_report(long: DataFrame, with_p: bool) -> DataFrame:
    out = long.select("var1", "var2", "n", rnd("r", 6).alias("pearson_r"), F.col("r").alias("_r"))
    if with_p:
        rest = 1 - F.col("_r") * F.col("_r")
        t = F.col("_r") * F.sqrt(_per((F.col("n") - 2).cast("double"), F.when(rest > 0, rest)))
        p = F.when(rest <= 0, F.lit(0.0)).otherwise(SP.t_pvalue(t, (F.col("n") - 2).cast("double")))
        out = (
            out.withColumn("p_value", rnd(p, 6))
            .withColumn("significant", F.col("p_value") < 0.05)
            .withColumn(
                "stars",
                F.when(F.col("p_value") < 0.001, "***").when(F.col("p_value") < 0.01, "**").otherwise("*"),
            )
            .withColumn("strong", (F.abs(F.col("_r")) > 0.3) & (F.col("p_value") < 0.05))
        )
    return out.drop("_r")


def strong_pairs(pairs: DataFrame) -> DataFrame:
    """The pairs of a report with p-values that are strong: |r| > 0.3 at p < 0.05."""
    return pairs.where("strong").drop("strong")


def top_pairs(pairs: DataFrame, k: int, col: str = "pearson_r") -> DataFrame:
    """Top-k pairs by absolute correlation (T3; ties by names)."""
    return pairs.orderBy(F.abs(F.col(col)).desc(), "var1", "var2").limit(k)


def spearman_pairs(df: DataFrame, cols, n_buckets=None) -> DataFrame:
    """Spearman rho for every pair on its own complete rows: Pearson on average ranks.

    The rows of all pairs are one long table; the ranks of both sides of every
    pair come from one value histogram and one prefix over it.
    """
    from tidemark.session import materialize

    pairs = list(combinations(range(len(cols)), 2))
    base = df.select(*[number(c).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = base.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("pair"), F.col(f"c{i}").alias("x"), F.col(f"c{j}").alias("y"))
                    for k, (i, j) in enumerate(pairs)
                ]
            )
        ).alias("p")
    ).select("p.*").where("x IS NOT NULL AND y IS NOT NULL")
    rows = materialize(rows)
    sides = rows.select(
        "pair",
        F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("value")) for s in ("x", "y")])).alias("s"),
    ).select("pair", "s.side", "s.value")
    ranks = materialize(
        W.value_ranks(sides, "value", ["pair", "side"], n_buckets).select(
            "pair", "side", "value", (F.col("_below") + (F.col("_cnt") + 1) / 2.0).alias("rank")
        )
    )
    both = rows
    for side in ("x", "y"):
        of = ranks.where(F.col("side") == side).select("pair", F.col("value").alias(side), F.col("rank").alias(f"r{side}"))
        both = both.join(of, ["pair", side])
    per = both.groupBy("pair").agg(*correlation_aggs(F.col("rx"), F.col("ry"), "p"))
    names = F.array(*[F.struct(F.lit(cols[i]).alias("var1"), F.lit(cols[j]).alias("var2")) for i, j in pairs])
    named = per.select(F.get(names, F.col("pair")).alias("v"), F.col("n_p").cast("long").alias("n"), correlation_of("p").alias("r"))
    return named.select("v.var1", "v.var2", "n", rnd("r", 6).alias("spearman_rho"))


# Segment labels.
VALUE_SEGMENTS = ["High Value", "Medium Value", "Low Value", "At Risk"]


def value_segments(df: DataFrame) -> DataFrame:
    """Value score and quartile segment per customer (C17, S12; NULL score -> 'At Risk', SURVEY D17)."""
    score = (
        F.col("monthly_revenue") * 0.4
        + F.col("feature_usage_score") * 1000 * 0.3
        + F.col("customer_satisfaction_score") * 2000 * 0.3
    )
    scored = df.withColumn("customer_value_score", score)
    q = W.exact_quantiles(scored, "customer_value_score", [0.25, 0.5, 0.75], ["_q1", "_q2", "_q3"])
    s = F.col("customer_value_score")
    seg = (
        F.when(s >= F.col("_q3"), VALUE_SEGMENTS[0])
        .when(s >= F.col("_q2"), VALUE_SEGMENTS[1])
        .when(s >= F.col("_q1"), VALUE_SEGMENTS[2])
        .otherwise(VALUE_SEGMENTS[3])
    )
    return scored.crossJoin(F.broadcast(q)).withColumn("value_segment", seg).drop("_q1", "_q2", "_q3")


def segment_report(seg: DataFrame) -> DataFrame:
    """Per-segment revenue mean / std / count and means of churn, satisfaction, activation."""
    agg = seg.groupBy("value_segment").agg(
        *moment_aggs(F.col("monthly_revenue"), "rev"),
        *moment_aggs(F.col("churn_risk_score"), "churn"),
        *moment_aggs(F.col("customer_satisfaction_score"), "sat"),
        *moment_aggs(F.col("activation_completed").cast("double"), "act"),
    )
    return agg.select(
        "value_segment",
        rnd(mean_of("rev"), 2).alias("revenue_mean"),
        rnd(F.sqrt(var_of("rev")), 2).alias("revenue_std"),
        F.col("n_rev").cast("long").alias("revenue_count"),
        rnd(mean_of("churn"), 2).alias("churn_risk_mean"),
        rnd(mean_of("sat"), 2).alias("satisfaction_mean"),
        rnd(mean_of("act"), 2).alias("activation_mean"),
    )


def revenue_concentration(seg: DataFrame, segment: str = "High Value", column: str = "monthly_revenue") -> DataFrame:
    """Share of total revenue from one segment, in percent."""
    row = seg.agg(
        money_sum(F.when(F.col("value_segment") == segment, F.col(column))).cast("double").alias("seg"),
        money_sum(column).cast("double").alias("tot"),
    )
    share = _per(F.lit(100.0) * F.col("seg"), F.col("tot"))
    return row.select(F.lit(segment).alias("segment"), rnd(share, 6).alias("revenue_share_pct"))


def prob_greater(df: DataFrame, value: str, group: str, a: str, b: str) -> DataFrame:
    """P(mean_a > mean_b) under a normal approximation of the difference."""
    row = _two_group_row(df, value, group, a, b)
    z = _per(mean_of("a") - mean_of("b"), F.sqrt(_welch_parts()[0]))
    return row.select(F.lit(a).alias("group_a"), F.lit(b).alias("group_b"), rnd(SP.normal_cdf(z), 6).alias("prob_a_greater"))


def bootstrap_mean_diff(df: DataFrame, value: str, group: str, a: str, b: str,
                        resamples: int = 10000, seed: int = 42, level: float = 0.95) -> DataFrame:
    """Bootstrap percentile CI of mean(a) - mean(b).

    The data is first a value histogram per group (combined on the map side); a
    cell of c rows enters a resample Poisson(c) times, drawn by a generator
    seeded with the cell alone, so every partitioning and every retried task
    gives the same resamples. A task adds its cells' sums for all resamples and
    returns one row per resample; one ``groupBy(resample)`` combines them.
    """
    import numpy as np
    import pandas as pd

    cells = (
        df.select((F.col(group) == a).cast("int").alias("is_a"), number(value).alias("v"), F.col(group).alias("g"))
        .where(F.col("g").isin(a, b) & F.col("v").isNotNull())
        .groupBy("is_a", "v")
        .agg(F.count(F.lit(1)).alias("c"))
        .select("is_a", "v", "c", F.xxhash64("is_a", "v", F.lit(seed)).alias("h"))
    )

    def part(it):
        acc = np.zeros((4, resamples))
        for pdf in it:
            for is_a, v, c, h in pdf.itertuples(index=False):
                w = np.random.Generator(np.random.Philox(key=h % (1 << 63))).poisson(c, resamples)
                at = 0 if is_a else 2
                acc[at] += w * v
                acc[at + 1] += w
        yield pd.DataFrame({"b": np.arange(resamples, dtype=np.int64), "sa": acc[0], "wa": acc[1], "sb": acc[2], "wb": acc[3]})

    partial = cells.mapInPandas(part, "b long, sa double, wa double, sb double, wb double")
    per = partial.groupBy("b").agg(*[F.sum(c).alias(c) for c in ("sa", "wa", "sb", "wb")])
    diff = per.select((_per(F.col("sa"), F.col("wa")) - _per(F.col("sb"), F.col("wb"))).alias("d"))
    lo, hi = (1 - level) / 2, 1 - (1 - level) / 2
    return diff.agg(  # one row per resample
        F.lit(a).alias("group_a"),
        F.lit(b).alias("group_b"),
        F.lit(resamples).alias("resamples"),
        rnd(F.percentile("d", lo), 6).alias("ci_lower"),
        rnd(F.percentile("d", hi), 6).alias("ci_upper"),
    )


def bootstrap_subsets(df: DataFrame, value: str, group: str, a: str, b: str, key: str, subset_rows: int = 2000,
                      resamples: int = 10000, seed: int = 42, level: float = 0.95) -> DataFrame:
    """Bag of little bootstraps for the CI of mean(a) - mean(b) (X1 at scale).

    A hash of the unique ``key`` deals the rows into subsets of about ``subset_rows``. Within a subset every
    resample draws as many rows as the whole table has, as multinomial weights on the subset's
    rows, so its interval has the width of the whole table's; the intervals of all subsets are averaged. A
    subset takes its share of ``resamples``, 100 at least, and one row leaves it; the generator
    is seeded by the subset and rows are taken in key order, so every partitioning gives the same result.
    Up to ``subset_rows`` rows it is the plain bootstrap. Subsets without rows of both groups are left out;
    ``subsets`` counts the others. Without any the interval is NULL.
    """
    import numpy as np
    import pandas as pd

    rows = df.select(F.col(key).alias("k"), (F.col(group) == a).alias("is_a"), number(value).alias("v"), F.col(group).alias("g"))
    rows = rows.where(F.col("g").isin(a, b) & F.col("v").isNotNull()).drop("g")
    size = rows.agg(F.count_if("is_a").alias("a"), F.count_if(~F.col("is_a")).alias("b")).first()
    subsets = max(1, round((size["a"] + size["b"]) / subset_rows))
    draws = max(100, -(-resamples // subsets))
    total = {True: size["a"], False: size["b"]}

    def interval(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["k", "is_a", "v"])
        rng = np.random.Generator(np.random.Philox(key=[seed, int(part["s"].iloc[0])]))
        arms = {arm: part["v"].to_numpy(float)[part["is_a"].to_numpy() == arm] for arm in (True, False)}
        if not len(arms[True]) or not len(arms[False]):
            return pd.DataFrame({"lo": [], "hi": []}, dtype=float)
        means = {}
        for arm, v in arms.items():
            even = np.full(len(v), 1 / len(v))
            step = max(1, 1_000_000 // len(v))
            means[arm] = np.concatenate(
                [rng.multinomial(total[arm], even, min(step, draws - i)) @ v for i in range(0, draws, step)]
            ) / total[arm]
        lo, hi = np.quantile(means[True] - means[False], [(1 - level) / 2, 1 - (1 - level) / 2])
        return pd.DataFrame({"lo": [lo], "hi": [hi]})

    dealt = rows.withColumn("s", F.pmod(F.xxhash64("k", F.lit(seed)), F.lit(subsets)))
    return dealt.groupBy("s").applyInPandas(interval, "lo double, hi double").agg(
        F.lit(a).alias("group_a"),
        F.lit(b).alias("group_b"),
        F.count(F.lit(1)).alias("subsets"),
        F.lit(draws).alias("resamples_per_subset"),
        rnd(F.avg("lo"), 6).alias("ci_lower"),
        rnd(F.avg("hi"), 6).alias("ci_upper"),
    )


def ab_evaluation(df: DataFrame, variant: str, a: str, b: str, success: Column, value: str) -> DataFrame:
    """A/B evaluation (X7): pooled z-test on the success rate and Welch t-test on
    ``value`` between variants, from one aggregate."""
    g, v = F.col(variant), F.col(value)
    row = df.agg(
        *_proportion_aggs(success, g, a, b), *moment_aggs(F.when(g == a, v), "a"), *moment_aggs(F.when(g == b, v), "b")
    )
    error2, dof = _welch_parts()
    return row.select(
        F.lit(a).alias("group_a"),
        F.lit(b).alias("group_b"),
        *_proportion_columns()[:-1],
        rnd(mean_of("a"), 6).alias("value_mean_a"),
        rnd(mean_of("b"), 6).alias("value_mean_b"),
        rnd(_per(mean_of("a") - mean_of("b"), F.sqrt(error2)), 6).alias("t_stat"),
        rnd(dof, 6).alias("t_df"),
    )
