"""Statistics on hard inputs: large means, tiny and huge values, constants, empty groups, NaN."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import special as SP
from tidemark.operators import metrics as M
from tidemark.operators import quality as Q
from tidemark.operators import stats as S

NAN = float("nan")


def two(spark, a, b):
    rows = [("a", v) for v in a] + [("b", v) for v in b]
    return spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("shift, scale", [(0, 1), (1e9, 1), (0, 1e-7), (0, 1e13)])
def test_ttest_is_stable_under_shift_and_scale(spark, shift, scale):
    a, b = [1.0, 2.0, 3.0, 5.0], [2.0, 4.0, 6.0, 6.5]
    r = S.ttest(two(spark, [shift + scale * v for v in a], [shift + scale * v for v in b]), "v", "g", "a", "b").first()
    assert r["t_stat"] == pytest.approx(-1.402829, abs=1e-5) and r["df"] == 6


def test_large_mean_keeps_its_variance(spark):
    r = S.mean_ci(two(spark, [1e9, 1e9 + 1, 1e9 + 2], []), ["v"]).first()
    assert r["sem"] == pytest.approx(math.sqrt(1 / 3), abs=1e-6) and r["mean"] == 1e9 + 1


def test_undefined_statistics_are_null(spark):
    same = two(spark, [1.0, 1.0], [1.0, 1.0])
    assert S.ttest(same, "v", "g", "a", "b", with_p=True).first()["t_stat"] is None
    assert S.cohens_d(same, "v", "g", "a", "b").first()["effect_size"] is None
    assert S.ttest(same, "v", "g", "a", "none", equal_var=False, with_p=True).first()["p_value"] is None
    assert S.proportion_ztest(same, F.col("v") == 1, "g", "a", "none", with_p=True).first()["z_stat"] is None
    assert S.anova(same.where("g = 'a'"), "v", "g", with_p=True).first()["f_stat"] is None
    assert S.anova(same.limit(0), "v", "g", with_p=True).first()["f_stat"] is None
    assert S.prob_greater(same, "v", "g", "a", "b").first()["prob_a_greater"] is None
    assert S.mean_ci(same.limit(0), ["v"]).first()["mean"] is None


def test_one_constant_column_leaves_the_other_pairs(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 7.0, float(i % 3)) for i in range(9)], "x double, y double, c double, z double")
    got = {(r["var1"], r["var2"]): r for r in S.pearson_pairs(df, ["x", "y", "c", "z"], with_p=True).collect()}
    assert got["x", "y"]["pearson_r"] == 1.0 and got["x", "y"]["p_value"] == 0.0 and got["x", "y"]["strong"]
    assert got["x", "c"]["pearson_r"] is None and got["x", "z"]["pearson_r"] is not None
    assert {(r["var1"], r["var2"]) for r in S.strong_pairs(S.pearson_pairs(df, ["x", "y", "c", "z"], with_p=True)).collect()} == {("x", "y")}


def test_spearman_uses_each_pair_s_own_rows(spark):
    rows = [(float(i), float(i * i), None if i % 2 else float(-i)) for i in range(10)]
    got = {(r["var1"], r["var2"]): (r["n"], r["spearman_rho"]) for r in S.spearman_pairs(
        spark.createDataFrame(rows, "x double, y double, z double"), ["x", "y", "z"]).collect()}
    assert got == {("x", "y"): (10, 1.0), ("x", "z"): (5, -1.0), ("y", "z"): (5, -1.0)}


def test_nan_is_null(spark):
    df = two(spark, [1.0, NAN, 3.0], [2.0, 4.0, NAN])
    r = S.ttest(df, "v", "g", "a", "b").first()
    assert (r["n_a"], r["n_b"], r["mean_a"], r["mean_b"]) == (2, 2, 2.0, 3.0)
    assert Q.missing_report(df).where("column_name = 'v'").first()["missing_count"] == 2
    assert Q.describe_exact(df).first()["count"] == 4


def test_roc_with_one_class(spark):
    pred = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4)], "label int, prediction int, score double")
    assert M.roc_auc(pred).first()["roc_auc"] is None
    assert {r["fpr"] for r in M.roc_points(pred).collect()} == {None}


def test_distribution_tails():
    assert SP.t_ppf(0.99995, 1) == pytest.approx(1 / math.tan(math.pi * 5e-5), rel=1e-9)
    assert SP.chi2_sf(1e8, 1e8) == pytest.approx(0.4999811936806, abs=1e-9)
    assert SP.betainc(2, 3, 0.4) == pytest.approx(0.5248, abs=1e-12)
    assert SP.betainc(0.5, 0.5, 0.25) == pytest.approx(1 / 3, abs=1e-12)
    assert SP.chi2_sf(10, 5) == pytest.approx(0.07523524614651217, abs=1e-12)
    for v in (1, 2, 5, 30, 1000):
        assert SP.t_sf_two_sided(SP.t_ppf(0.975, v), v) == pytest.approx(0.05, abs=1e-10)
