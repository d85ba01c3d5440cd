"""Amounts and tables at the edge: large amounts, few months, empty batches."""

import datetime

from pyspark.sql import functions as F

from tidemark.functions.exprs import money_avg, money_sum, rnd
from tidemark.operators.monitoring import psi, revenue_trend


def test_large_amounts(spark):
    df = spark.createDataFrame([(1e13,), (1e17,), (0.5,), (None,)], "x double")
    r = df.agg(money_sum("x").cast("double").alias("s"), money_avg("x").alias("a")).first()
    assert r["s"] == 1e13 + 1e17 + 0.5 and r["a"] == r["s"] / 3


def test_rounding_of_huge_numbers(spark):
    df = spark.createDataFrame([(1e30,), (-1e300,), (0.285,), (None,)], "x double")
    assert [r[0] for r in df.select(rnd("x", 2)).collect()] == [1e30, -1e300, 0.29, None]


def trend(spark, months):
    rows = [(datetime.date(2024, m, 1), 100.0 * m) for m in months]
    return revenue_trend(spark.createDataFrame(rows, "transaction_date date, transaction_amount double"), 3).orderBy("step").collect()


def test_trend_of_few_months(spark):
    one, two, three = trend(spark, [1]), trend(spark, [1, 2]), trend(spark, [1, 2, 3])
    assert [r["projected_revenue"] for r in one] == [None] * 3
    assert [(r["projected_revenue"], r["ci_lower"]) for r in two] == [(300.0, None), (400.0, None), (500.0, None)]
    assert [(r["projected_revenue"], r["ci_lower"]) for r in three] == [(400.0, 400.0), (500.0, 500.0), (600.0, 600.0)]


def test_drift_of_an_empty_batch_is_unknown(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"))
    got = psi(df, df.limit(0), ["x"]).collect()
    assert all(r["drift"] is None for r in got if r["psi"] is None)
    assert psi(df, df, ["x"]).first()["drift"] == "stable"


def test_little_bootstraps_agree_with_the_plain_one(spark):
    from tidemark.operators.stats import bootstrap_mean_diff, bootstrap_subsets

    rows = spark.range(24000).selectExpr(
        "id", "IF(id % 3 = 0, 'a', IF(id % 17 = 0, NULL, 'b')) AS g", "IF(id % 29 = 0, NULL, log(1 + pmod(xxhash64(id), 1000)) + id % 3) AS v"
    )
    one = bootstrap_subsets(rows, "v", "g", "a", "b", "id", subset_rows=3000, resamples=2000).first()
    other = bootstrap_subsets(rows.repartition(7), "v", "g", "a", "b", "id", subset_rows=3000, resamples=2000).first()
    assert one == other and one["subsets"] == 7 and one["resamples_per_subset"] == 286
    plain = bootstrap_mean_diff(rows, "v", "g", "a", "b", resamples=2000).first()
    m = {r["g"]: r for r in rows.where("v IS NOT NULL").groupBy("g").agg(F.avg("v").alias("m"), F.variance("v").alias("s"), F.count("v").alias("n")).collect()}
    centre = m["a"]["m"] - m["b"]["m"]
    width = 2 * 1.96 * (m["a"]["s"] / m["a"]["n"] + m["b"]["s"] / m["b"]["n"]) ** 0.5
    for r in (one, plain):
        assert abs((r["ci_upper"] - r["ci_lower"]) / width - 1) < 0.06
        assert abs((r["ci_upper"] + r["ci_lower"]) / 2 - centre) < 0.05 * width
    empty = bootstrap_subsets(rows.where("g = 'a'"), "v", "g", "a", "b", "id").first()
    assert empty["subsets"] == 0 and empty["ci_lower"] is None


def test_few_files_of_many_rows_are_spread(spark):
    from tidemark.session import spread

    one = spark.range(100).coalesce(1)
    assert spread(one, 10).rdd.getNumPartitions() == 10 and spread(one, 10).count() == 100
    assert spread(one, 100).rdd.getNumPartitions() == 1 and spread(spark.range(0, 100, 1, 4), 50).rdd.getNumPartitions() == 4
