"""Drift and trend monitoring: PSI between two batches (X6), revenue trend."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import rnd
from tidemark.operators import windows as W

PSI_EPS = 1e-6


def psi(base: DataFrame, new: DataFrame, cols, bins: int = 10) -> DataFrame:
    """Population stability index per column.

    Bin edges are the base batch's interior quantiles; a value's bin is the
    number of edges below it; one value histogram of both batches gives edges
    and bin counts, so each batch is read once;
    PSI = sum over bins of (q - p) * ln((q + eps) / (p + eps)).
    """
    from tidemark.session import materialize

    probs = [i / bins for i in range(1, bins)]
    names = [f"e{k}" for k in range(bins - 1)]
    side = lambda d, tag: W.unpivot(d, cols).where("_value IS NOT NULL").withColumn("_side", F.lit(tag))
    # one histogram of both batches; the base side's cells also give the edges
    hist = materialize(
        side(base, 0).unionByName(side(new, 1)).groupBy("_column", "_value").agg(
            F.count_if(F.col("_side") == 0).alias("p"), F.count_if(F.col("_side") == 1).alias("q")
        )
    )
    edges = _weighted_quantiles(hist.where("p > 0"), "p", probs, names)
    bin_ = sum(((F.col("_value") > F.col(e)).cast("int") for e in names), F.lit(0))
    cells = hist.join(F.broadcast(edges), "_column")  # a row per column of the report
    j = cells.groupBy("_column", bin_.alias("bin")).agg(F.sum("p").alias("n_p"), F.sum("q").alias("n_q"))
    of = Window.partitionBy("_column")  # over at most ``bins`` rows
    p = F.try_divide(F.col("n_p"), F.sum("n_p").over(of))
    q = F.try_divide(F.col("n_q"), F.sum("n_q").over(of))
    term = j.select("_column", p.alias("p"), q.alias("q")).select(
        F.col("_column").alias("column_name"),
        ((F.col("q") - F.col("p")) * F.log((F.col("q") + PSI_EPS) / (F.col("p") + PSI_EPS))).alias("t"),
    )
    return term.groupBy("column_name").agg(rnd(F.sum("t"), 6).alias("psi")).withColumn(
        "drift",
        F.when(F.col("psi") < 0.1, "stable").when(F.col("psi") < 0.25, "moderate").when(F.col("psi") >= 0.25, "significant"),
    )


def _weighted_quantiles(hist: DataFrame, weight: str, probs, names) -> DataFrame:
    """Exact quantiles per ``_column`` of a value histogram with ``weight`` rows a value."""
    cum = W.global_prefix(hist.select("_column", "_value", weight), ["_value"], (weight,), ("_column",))
    total = cum.groupBy("_column").agg(F.sum(weight).alias("_n"))
    h = cum.join(total, "_column").withColumn("_below", F.col(f"cum_{weight}") - F.col(weight))
    aggs, out = [F.max("_n").alias("_n")], []
    for name, p in zip(names, probs, strict=True):
        at = F.lit(float(p)) * (F.col("_n") - 1)
        for tag, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (F.col("_below") <= place) & (place < F.col(f"cum_{weight}"))
            aggs.append(F.max(F.when(hit, F.col("_value"))).alias(f"{name}_{tag}"))
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        out.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return h.groupBy("_column").agg(*aggs).select("_column", *out)


def seasonality_index(tx: DataFrame) -> DataFrame:
    """Quarterly seasonality (X3): a quarter's mean monthly revenue over the mean of all months; one row per quarter."""
    monthly = tx.groupBy(F.trunc(F.col("transaction_date").cast("date"), "month").alias("month")).agg(
        F.sum(F.col("transaction_amount").cast("decimal(18,2)")).alias("revenue")
    )
    per = monthly.groupBy(F.quarter("month").alias("quarter")).agg(
        F.count(F.lit(1)).alias("months"), F.sum("revenue").alias("_s")
    )
    of = Window.partitionBy()  # over at most four rows
    mean = F.sum("_s").over(of).cast("double") / F.sum("months").over(of)
    own = F.col("_s").cast("double") / F.col("months")
    return per.select("quarter", "months", rnd(own, 2).alias("avg_monthly_revenue"), rnd(F.try_divide(own, mean), 6).alias("seasonality_index"))


def revenue_trend(tx: DataFrame, horizon: int = 12, z: float = 1.96) -> DataFrame:
    """Monthly revenue, least-squares trend and a ``horizon``-month projection with a band.

    One aggregate per month (exact sums), then a second aggregate over the
    month rows for the regression sums; projections for months n..n+h-1.
    Two months give a projection without a band (NULL), one month a NULL projection.
    """
    monthly = tx.groupBy(F.trunc(F.col("transaction_date").cast("date"), "month").alias("month")).agg(
        F.sum(F.col("transaction_amount").cast("decimal(18,2)")).alias("revenue")
    )
    first = monthly.agg(F.min("month").alias("_m0"))
    m = monthly.crossJoin(F.broadcast(first)).select(
        "month", F.months_between("month", "_m0").cast("long").cast("double").alias("x"),
        F.col("revenue").cast("double").alias("y"),
    )
    s = m.agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("x").alias("sx"),
        F.sum(F.col("y").cast("decimal(24,2)")).cast("double").alias("sy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"),
        F.sum((F.col("x").cast("decimal(10,0)") * F.col("y").cast("decimal(24,2)"))).cast("double").alias("sxy"),
        F.sum(F.col("y").cast("decimal(24,2)") * F.col("y").cast("decimal(24,2)")).cast("double").alias("syy"),
        F.max("x").alias("xmax"), F.max("month").alias("last_month"),
    )
    slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    icpt = F.try_divide(F.col("sy") - slope * F.col("sx"), F.col("n"))
    sse = F.col("syy") - icpt * F.col("sy") - slope * F.col("sxy")
    se = F.sqrt(F.try_divide(F.greatest(F.lit(0.0), sse), F.col("n") - 2))
    fit = s.select("xmax", "last_month", slope.alias("slope"), icpt.alias("intercept"), se.alias("se"))
    out = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    xh = F.col("xmax") + F.col("step")
    yhat = F.col("intercept") + F.col("slope") * xh
    return out.select(
        F.add_months("last_month", F.col("step").cast("int")).alias("month"),
        F.col("step").cast("int").alias("step"),
        rnd(yhat, 2).alias("projected_revenue"),
        rnd(yhat - z * F.col("se"), 2).alias("ci_lower"),
        rnd(yhat + z * F.col("se"), 2).alias("ci_upper"),
        rnd("slope", 4).alias("monthly_trend"),
    )
