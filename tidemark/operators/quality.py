"""Data-quality profiling: completeness, validity rules, outliers, summaries.

Every report is one scan: all per-column measures are computed in a single
``agg`` (partial aggregation, one tiny row out) and then unpivoted, instead
of one query per column / per UNION branch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import count_when, money_avg, pct, rnd
from tidemark.operators import windows as W
from tidemark.operators.stats import number

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _rows_from_struct_array(one_row: DataFrame, structs) -> DataFrame:
    """Turn a single aggregated row into one output row per struct (unpivot)."""
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


# Validity rules of the quality report (column, rule kind, bounds).
QUALITY_RULES = [
    ("customer_id", "unique", None, None),
    ("monthly_revenue", "range", 0, None),
    ("churn_risk_score", "range", 0, 1),
    ("customer_satisfaction_score", "range", 1, 5),
]


def quality_report(df: DataFrame, rules=QUALITY_RULES) -> DataFrame:
    """Completeness / uniqueness / range rule per column (G1, G2, U1) in one scan."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    for c, _, _, _ in rules:
        aggs += [
            F.count(c).alias(f"{c}__nn"),
            F.count_distinct(c).alias(f"{c}__nd"),
            F.min(c).alias(f"{c}__min"),
            F.max(c).alias(f"{c}__max"),
        ]
    row = df.agg(*aggs)
    structs = []
    for c, kind, lo, hi in rules:
        if kind == "unique":
            ok = F.col("_total") == F.col(f"{c}__nd")
        else:
            ok = F.lit(True)
            if lo is not None:
                ok = ok & (F.col(f"{c}__min") >= lo)
            if hi is not None:
                ok = ok & (F.col(f"{c}__max") <= hi)
        structs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("_total").cast("long").alias("total_records"),
                F.col(f"{c}__nn").cast("long").alias("non_null_count"),
                F.col(f"{c}__nd").cast("long").alias("unique_count"),
                rnd(pct(f"{c}__nn", "_total"), 2).alias("completeness_pct"),
                F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("uniqueness_check"),
            )
        )
    return _rows_from_struct_array(row, structs).orderBy(F.col("completeness_pct").desc())


def outlier_bounds(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """One-row IQR bounds (G3): exact quartiles from the value histogram."""
    q = W.exact_quantiles(df, col, [0.25, 0.75], ["q1", "q3"])
    return q.select(
        "q1",
        "q3",
        (F.col("q3") - F.col("q1")).alias("iqr"),
        (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower_bound"),
        (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper_bound"),
    )


def flag_outliers(df: DataFrame, col: str = "monthly_revenue", k: float = 1.5, out: str = "revenue_outlier_flag"):
    """Row-level OUTLIER / NORMAL flag against single-row bounds."""
    b = outlier_bounds(df, col, k)
    x = F.col(col)
    return df.crossJoin(F.broadcast(b)).withColumn(
        out,
        F.when((x < F.col("lower_bound")) | (x > F.col("upper_bound")), F.lit("OUTLIER")).otherwise(F.lit("NORMAL")),
    )


def outlier_report(df: DataFrame, col: str = "monthly_revenue", k: float = 1.5) -> DataFrame:
    """Outlier distribution with share of all rows."""
    flagged = flag_outliers(df, col, k)
    agg = flagged.groupBy("revenue_outlier_flag").agg(
        F.count(F.lit(1)).alias("customer_count"),
        money_avg(col).alias("_avg"),
        F.min(col).alias("_min"),
        F.max(col).alias("_max"),
    )
    total = F.sum("customer_count").over(Window.partitionBy())  # window over <= 2 aggregated rows
    return agg.select(
        "revenue_outlier_flag",
        "customer_count",
        rnd(pct("customer_count", total), 2).alias("percentage"),
        rnd("_avg", 2).alias("avg_revenue"),
        rnd("_min", 2).alias("min_revenue"),
        rnd("_max", 2).alias("max_revenue"),
    ).orderBy("revenue_outlier_flag")


def cleaning_summary(clean: DataFrame) -> DataFrame:
    """Validation report: corrections + lifecycle distribution (G6, G7, U1; SURVEY D4/D5 kept)."""
    n = F.col("total_records")
    head = clean.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum("age_was_cleaned").cast("long").alias("age_corrections"),
        F.sum("revenue_was_cleaned").cast("long").alias("revenue_corrections"),
        F.sum("industry_was_standardized").cast("long").alias("industry_standardizations"),
    ).select(
        F.lit("Data Cleaning Summary").alias("report_section"),
        "total_records",
        "age_corrections",
        "revenue_corrections",
        "industry_standardizations",
        rnd(pct("age_corrections", n), 2).alias("age_correction_rate"),
        rnd(pct("revenue_corrections", n), 2).alias("revenue_correction_rate"),
        rnd(pct("industry_standardizations", n), 2).alias("industry_standardization_rate"),
    )
    stages = clean.groupBy("customer_lifecycle_stage").agg(F.count(F.lit(1)).alias("total_records"))
    total = F.sum("total_records").over(Window.partitionBy())  # over <= 5 aggregated rows
    null_l = F.lit(None).cast("long")
    null_d = F.lit(None).cast("double")
    lifecycle = stages.select(
        F.col("customer_lifecycle_stage").alias("report_section"),
        "total_records",
        null_l.alias("age_corrections"),
        null_l.alias("revenue_corrections"),
        null_l.alias("industry_standardizations"),
        rnd(pct("total_records", total), 2).alias("age_correction_rate"),
        null_d.alias("revenue_correction_rate"),
        null_d.alias("industry_standardization_rate"),
    )
    section = stages.agg(F.sum("total_records").alias("total_records")).select(
        F.lit("Lifecycle Distribution").alias("report_section"),
        "total_records",
        null_l.alias("age_corrections"),
        null_l.alias("revenue_corrections"),
        null_l.alias("industry_standardizations"),
        null_d.alias("age_correction_rate"),
        null_d.alias("revenue_correction_rate"),
        null_d.alias("industry_standardization_rate"),
    )
    return head.unionByName(section).unionByName(lifecycle).orderBy("report_section", F.col("total_records").desc())


def lifecycle_distribution(clean: DataFrame) -> DataFrame:
    """Tidy lifecycle-stage counts with share."""
    stages = clean.groupBy("customer_lifecycle_stage").agg(F.count(F.lit(1)).alias("customer_count"))
    total = F.sum("customer_count").over(Window.partitionBy())
    return stages.select(
        "customer_lifecycle_stage", "customer_count", rnd(pct("customer_count", total), 2).alias("share_pct")
    )


def cardinality_report(df: DataFrame, cols=("customer_id", "industry", "subscription_tier", "location"), approx=False):
    """Distinct counts of key columns (G8); ``approx`` uses HyperLogLog++ for very large tables."""
    fn = (lambda c: F.approx_count_distinct(c, 0.01)) if approx else F.count_distinct
    names = ["unique_customer_ids", "unique_industries", "unique_tiers", "unique_locations"]
    return df.agg(
        F.lit("Index Recommendations").alias("analysis_type"),
        F.lit("High cardinality columns need indexes").alias("recommendation"),
        *[fn(c).cast("long").alias(n) for c, n in zip(cols, names)],
    )


def _missing_counts(df: DataFrame) -> list:
    """Per column the rows without a value; NaN counts as none."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return [
        F.count_if(F.col(c).isNull() | F.isnan(c) if c in floating else F.col(c).isNull()).alias(f"m{i}")
        for i, c in enumerate(df.columns)
    ]


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and % per column, sorted descending."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"), *_missing_counts(df))
    structs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"m{i}").cast("long").alias("missing_count"),
            rnd(pct(f"m{i}", "_n"), 6).alias("missing_percentage"),
        )
        for i, c in enumerate(cols)
    ]
    return _rows_from_struct_array(row, structs).orderBy(F.col("missing_percentage").desc(), "column_name")


def missing_summary(df: DataFrame) -> DataFrame:
    """Shape, total missing cells, columns with any missing, missing share."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"), *_missing_counts(df))
    total = sum((F.col(f"m{i}") for i in range(len(cols))), F.lit(0))
    with_missing = sum((F.when(F.col(f"m{i}") > 0, 1).otherwise(0) for i in range(len(cols))), F.lit(0))
    return row.select(
        F.col("_n").cast("long").alias("n_rows"),
        F.lit(len(cols)).cast("long").alias("n_columns"),
        total.cast("long").alias("total_missing"),
        with_missing.cast("long").alias("columns_with_missing"),
        rnd(F.lit(100.0) * total / (F.col("_n") * len(cols)), 6).alias("missing_cell_pct"),
    )


def _by_column(row: DataFrame, cols, fields) -> DataFrame:
    """A one-row aggregate as a row per column: ``fields(i)`` are the structs' columns."""
    return _rows_from_struct_array(row, [F.struct(F.lit(c).alias("column_name"), *fields(i)) for i, c in enumerate(cols)])


def iqr_outliers(df: DataFrame, cols=None, k: float = 1.5) -> DataFrame:
    """IQR outlier count / % for every numeric column.

    The quartiles of all columns come from one value histogram; its cells then
    also give the counts outside the bounds, weighted by their rows.
    """
    cols = cols or numeric_columns(df)
    from tidemark.session import materialize

    long = W.unpivot(df, cols).where("_value IS NOT NULL")
    hist = materialize(long.groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_rows")))
    q = W.column_quantiles(df, cols, [0.25, 0.75], ["q1", "q3"])
    lo, hi = F.col("q1") - k * (F.col("q3") - F.col("q1")), F.col("q3") + k * (F.col("q3") - F.col("q1"))
    outside = (F.col("_value") < lo) | (F.col("_value") > hi)
    per = hist.join(q, "_column").groupBy("_column").agg(F.sum(F.when(outside, F.col("_rows")).otherwise(0)).alias("_o"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    total = df.agg(F.count(F.lit(1)).alias("_n"))  # one row
    out = names.join(per.withColumnRenamed("_column", "column_name"), "column_name", "left").crossJoin(F.broadcast(total))
    count = F.coalesce(F.col("_o"), F.lit(0))
    return out.select(
        "column_name", count.cast("long").alias("outlier_count"), rnd(pct(count, "_n"), 6).alias("outlier_percentage")
    )


def describe_exact(df: DataFrame, cols=None) -> DataFrame:
    """count / mean / std / min / 25% / 50% / 75% / max per numeric column."""
    cols = cols or numeric_columns(df)
    values = [number(c) for c in cols]
    row = df.agg(
        *[
            agg.alias(f"{name}{i}")
            for i, v in enumerate(values)
            for name, agg in (
                ("_c", F.count(v)), ("_m", F.avg(v)), ("_s", F.stddev_samp(v)), ("_mn", F.min(v)), ("_mx", F.max(v))
            )
        ]
    )
    base = _by_column(
        row,
        cols,
        lambda i: [
            F.col(f"_c{i}").cast("long").alias("count"),
            rnd(f"_m{i}", 6).alias("mean"),
            rnd(f"_s{i}", 6).alias("std"),
            rnd(f"_mn{i}", 6).alias("min"),
            rnd(f"_mx{i}", 6).alias("max"),
        ],
    )
    q = W.column_quantiles(df, cols, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    q = q.select(F.col("_column").alias("column_name"), *[rnd(p, 6).alias(p) for p in ("p25", "p50", "p75")])
    return base.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def univariate_stats(df: DataFrame, cols=None) -> DataFrame:
    """Mean, median, sample std and population skewness per numeric column."""
    cols = cols or numeric_columns(df)
    values = [number(c) for c in cols]
    row = df.agg(
        *[
            agg.alias(f"{name}{i}")
            for i, v in enumerate(values)
            for name, agg in (("_m", F.avg(v)), ("_s", F.stddev_samp(v)), ("_k", F.skewness(v)))
        ]
    )
    base = _by_column(
        row,
        cols,
        lambda i: [
            rnd(f"_m{i}", 6).alias("mean"),
            rnd(f"_s{i}", 6).alias("std"),
            rnd(F.nanvl(f"_k{i}", F.lit(None).cast("double")), 6).alias("skewness"),
        ],
    )
    q = W.column_quantiles(df, cols, [0.5], ["median"])
    q = q.select(F.col("_column").alias("column_name"), rnd("median", 6).alias("median"))
    return base.join(q, "column_name", "left").select("column_name", "mean", "median", "std", "skewness")


def categorical_report(df: DataFrame, cols=None) -> DataFrame:
    """Distinct count and most common value per categorical column (G25; ties -> smallest).

    From the value counts of all columns, so no task holds a column's distinct values."""
    cols = cols or string_columns(df)
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]
    counts = (
        df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").groupBy("column_name", "value")
        .agg(F.count("value").alias("c"))
    )
    top = counts.groupBy("column_name").agg(F.count("value").alias("unique_count"), F.max("c").alias("c"))
    first = counts.where("value IS NOT NULL").join(top.select("column_name", "c"), ["column_name", "c"])
    first = first.groupBy("column_name").agg(F.min("value").alias("most_common"))
    return top.join(first, "column_name", "left").select("column_name", "unique_count", "most_common")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows identical to an earlier row (G26): groupBy all columns, sum(count - 1)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def value_counts(df: DataFrame, cols=("subscription_tier", "industry", "location", "referral_source")) -> DataFrame:
    """Value counts and share of all rows per categorical column (G27), unpivoted."""
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
        ).alias("r")
    ).select("r.*")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    # the share is of all rows: a column's counts, NULL included, add up to them
    total = counts.groupBy("column_name").agg(F.sum("count").alias("_n"))
    return counts.where("value IS NOT NULL").join(total, "column_name").select(
        "column_name", "value", "count", rnd(pct("count", "_n"), 6).alias("share_pct")
    )


def crosstab(df: DataFrame, row: str = "referral_source", col: str = "activation_completed") -> DataFrame:
    """Contingency counts with row-normalised share (G28), long form."""
    counts = (
        df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
        .groupBy(row, col)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    row_total = F.sum("count").over(Window.partitionBy(row))  # over the small count table
    return counts.select(row, col, "count", rnd(F.col("count") / row_total, 6).alias("row_share"))


def overview(df: DataFrame) -> DataFrame:
    """Headline KPIs of the raw table."""
    return df.agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.round(F.sum(F.col("monthly_revenue").cast("decimal(24,6)")), 2).cast("double").alias("total_monthly_revenue"),
        rnd(money_avg("monthly_revenue"), 2).alias("avg_monthly_revenue"),
        rnd(F.avg("activation_completed"), 6).alias("activation_rate"),
        rnd(money_avg("churn_risk_score"), 6).alias("avg_churn_risk"),
        rnd(money_avg("customer_satisfaction_score"), 6).alias("avg_satisfaction"),
    )
