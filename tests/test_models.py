"""Fitted models on planted structure."""

import random

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.operators import churn as C
from tidemark.operators import segmentation as S


def test_sweep_finds_planted_blobs(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(c[0], 0.2), rng.gauss(c[1], 0.2)]) for i in range(90) for c in [((0, 0), (6, 0), (0, 6))[i % 3]]]
    df = spark.createDataFrame(rows, "customer_id int, x array<double>").select("customer_id", array_to_vector("x").alias("features"))
    sweep = S.sweep_k(df.coalesce(1), range(2, 5), n_init=2)
    assert S.best_k(sweep) == 3
    row = sweep.where("k = 3").first()
    assert row["best_by_silhouette"] and row["best_by_calinski_harabasz"] and row["best_by_davies_bouldin"]


def test_codes_are_alphabetical_and_null_is_last(spark):
    df = spark.createDataFrame([("b", None), ("a", "x"), (None, "x"), ("b", "y")], "c string, d string")
    got = {(r["column_name"], r["value"]): r["code"] for r in C.label_codes(df, ["c", "d"]).collect()}
    assert got == {("c", "a"): 0, ("c", "b"): 1, ("c", None): 2, ("d", "x"): 0, ("d", "y"): 1, ("d", None): 2}


def test_margin_model_gets_probabilities(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, rng.gauss(i % 2, 0.4), rng.random(), i % 10 == 0, i % 5) for i in range(200)]
    split = spark.createDataFrame(rows, "customer_id long, churn_target int, x double, y double, is_test boolean, fold int").coalesce(1)
    table, fitted = C.train_models(split, ["x", "y"], models=["SVM"])
    assert C.best_model(table) == "SVM" and table.first()["cv_auc_mean"] > 0.9
    scored = C.score_customers(fitted["SVM"], split).join(split, "customer_id")
    means = {r["churn_target"]: r["p"] for r in scored.groupBy("churn_target").agg(F.avg("churn_probability").alias("p")).collect()}
    assert 0 <= means[0] < 0.3 and 0.7 < means[1] <= 1


def test_registered_churn_job_tunes_its_best_model(spark, monkeypatch):
    import pytest

    import __spark_entry__ as E
    from tests.conftest import SF001
    from tidemark.operators import churn

    class Seen(Exception):
        pass

    def job(raw, tuned=True, **_):
        raise Seen(tuned)

    monkeypatch.setattr(churn, "predict_churn", job)
    with pytest.raises(Seen, match="True"):
        E.queries()["churn_job"](spark, SF001)


def planted(spark, n=300):
    rng = random.Random(3)
    rows = [(i, i % 2, rng.gauss(i % 2, 0.7), rng.random(), i % 10 == 0, i // 2 % 5) for i in range(n)]
    return spark.createDataFrame(rows, "customer_id long, churn_target int, x double, y double, is_test boolean, fold int").coalesce(1)


def test_first_trees_of_boosting_are_the_shorter_fit(spark):
    from pyspark.ml import Pipeline

    data = planted(spark)
    est = C._estimators("raw", "churn_target", 42, 300)["Gradient Boosting"]
    fit = lambda m: Pipeline(stages=C._stages(["x", "y"], est)).fit(data, {est.maxIter: m})
    part = C.first_trees(fit(12), 5)
    raw = lambda m: [r["rawPrediction"] for r in m.transform(data).orderBy("customer_id").collect()]
    assert raw(part) == raw(fit(5)) != raw(fit(12))


def test_first_trees_of_a_forest(spark):
    from pyspark.ml import Pipeline

    data = planted(spark)
    est = C._estimators("raw", "churn_target", 42, 300)["Random Forest"]
    whole = Pipeline(stages=C._stages(["x", "y"], est)).fit(data, {est.numTrees: 9, est.maxDepth: 4})
    part = C.first_trees(whole, 4)
    assert [t.toDebugString for t in part.stages[-1].trees] == [t.toDebugString for t in whole.stages[-1].trees[:4]]
    votes = part.transform(data).select(F.col("rawPrediction")).first()[0]
    assert abs(sum(votes) - 4) < 1e-9


def test_grid_points_of_one_fit_have_their_own_scores(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.tuning import ParamGridBuilder

    data = planted(spark)
    grid = lambda name, est, n: ParamGridBuilder().addGrid(est.maxIter, [3, 8]).addGrid(est.maxDepth, [1, 2]).build()
    monkeypatch.setattr(C, "_grid", grid)
    table, model = C.tune(data, ["x", "y"], "Gradient Boosting")
    train = data.where("NOT is_test")
    est = C._estimators("raw", "churn_target", 42, train.count())["Gradient Boosting"]
    best = 0
    for row, point in zip(table.collect(), grid("", est, 0), strict=True):
        aucs = []
        for f in range(5):
            one = Pipeline(stages=C._stages(["x", "y"], est)).fit(train.where(F.col("fold") != f), point)
            aucs.append(C._auc("churn_target").evaluate(one.transform(train.where(F.col("fold") == f))))
        assert abs(row["cv_auc"] - sum(aucs) / 5) < 1e-9
        best = max(best, row["cv_auc"])
    chosen = table.where("is_best").first()
    assert chosen["cv_auc"] == best and f"maxIter={model.estimator.getNumTrees}" in chosen["params"]


def test_anova_of_constant_and_empty_features(spark):
    rows = [(i % 2, float(i % 2 + i % 3), 1.0, None if i else 2.0, float("nan") if i == 3 else float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "churn_target int, a double, b double, c double, d double")
    got = {r["feature"]: r for r in C.anova_scores(df, ["a", "b", "c", "d"], k=2).collect()}
    assert got["a"]["f_value"] > got["d"]["f_value"] > 0 and got["b"]["f_value"] is None and got["c"]["f_value"] is None
    assert [f for f in "abcd" if got[f]["by_anova"]] == ["a", "d"] and got["d"]["n"] == 11 and got["c"]["n"] == 1


def test_labels_of_one_cluster_are_never_the_best(spark):
    from pyspark.ml.functions import array_to_vector

    rows = [(i, [float(i // 5 * 10 + i % 5), 0.0], i // 5, 0, i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "customer_id int, x array<double>, good int, one int, mixed int")
    df = df.select("customer_id", array_to_vector("x").alias("features"), "good", "one", "mixed")
    got = {r["labelling"]: r for r in S.compare_labels(df, ["mixed", "one", "good"]).collect()}
    assert got["good"]["is_best"] and not got["one"]["is_best"] and not got["mixed"]["is_best"]
    assert got["one"]["silhouette"] is None and got["one"]["n_clusters"] == 1
    assert not any(r["is_best"] for r in S.compare_labels(df, ["one"]).collect())


def test_a_forest_keeps_node_ids_and_grows_the_same_trees(spark):
    from pyspark.ml import Pipeline

    data = planted(spark)
    est = C._estimators("raw", "churn_target", 42, 300)["Random Forest"]
    assert est.getCacheNodeIds()
    fit = lambda kept: Pipeline(stages=C._stages(["x", "y"], est)).fit(data, {est.numTrees: 5, est.cacheNodeIds: kept})
    grown = lambda kept: [t.toDebugString.split("\n", 1)[1] for t in fit(kept).stages[-1].trees]  # noqa: E731  (the first line is a name)
    assert grown(True) == grown(False)


def test_permuted_features_are_scored_together(spark, monkeypatch):
    data = planted(spark)
    _, fitted = C.train_models(data, ["x", "y"], models=["Gradient Boosting"])
    model, calls = fitted["Gradient Boosting"], []
    whole = type(model).transform
    monkeypatch.setattr(type(model), "transform", lambda self, df: calls.append(1) or whole(self, df))
    got = {r["feature"]: r["auc_drop"] for r in C.permutation_importance(model, data, ["x", "y"]).collect()}
    assert len(calls) == 2 and got["x"] > 0.1 > abs(got["y"])


def test_parts_of_a_forest_vote_like_forests_of_their_own(spark):
    from pyspark.ml import Pipeline, PipelineModel

    from tidemark.operators.forest import part_name, score_parts

    data = planted(spark)
    est = C._estimators("raw", "churn_target", 42, 300)["Random Forest"]
    fit = lambda depth: Pipeline(stages=C._stages(["x", "y"], est)).fit(
        data, {est.numTrees: 9, est.maxDepth: depth, est.leafCol: "leaf"})
    whole = fit(30)
    held = PipelineModel(whole.stages[:-1]).transform(data)
    parts = [(9, 30), (9, 3), (4, 7), (2, 0)]
    got = score_parts(whole.stages[-1], held, "churn_target", parts)
    for n, depth in parts:
        own = C.first_trees(fit(depth), n).transform(data).select("churn_target", "rawPrediction").collect()
        want = sorted((r["churn_target"], round(float(r["rawPrediction"][1]), 6)) for r in own)
        name = part_name(n, depth)
        assert sorted((r["churn_target"], round(r[name], 6)) for r in got.select("churn_target", name).collect()) == want


def test_depths_of_a_forest_share_a_fit(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.tuning import ParamGridBuilder

    data = planted(spark)
    grid = lambda name, est, n: ParamGridBuilder().addGrid(est.numTrees, [3, 6]).addGrid(est.maxDepth, [2, 5]).addGrid(
        est.minInstancesPerNode, [1, 4]).build()
    fits, whole = [], Pipeline.fit
    monkeypatch.setattr(C, "_grid", grid)
    monkeypatch.setattr(Pipeline, "fit", lambda self, *a: fits.append(1) or whole(self, *a))
    table, model = C.tune(data, ["x", "y"], "Random Forest")
    assert len(fits) == 2 * 5 + 1 and table.count() == 8  # before, 4 fits a fold
    chosen = table.where("is_best").first()
    assert chosen["params"].endswith(f"numTrees={model.estimator.getNumTrees}")
    assert chosen["params"].startswith(f"maxDepth={model.estimator.getMaxDepth()},")
    est = C._estimators("raw", "churn_target", 42, 1)["Random Forest"]
    train, total = data.where("NOT is_test"), 0.0
    for f in range(5):
        one = whole(Pipeline(stages=C._stages(["x", "y"], est)), train.where(F.col("fold") != f),
                    {est.numTrees: 6, est.maxDepth: 2, est.minInstancesPerNode: 4})
        total += C._auc("churn_target").evaluate(one.transform(train.where(F.col("fold") == f)))
    got = {r["params"]: r["cv_auc"] for r in table.collect()}
    assert abs(got["maxDepth=2, minInstancesPerNode=4, numTrees=6"] - total / 5) < 1e-6


def test_sweep_fits_keep_their_own_points(spark, monkeypatch):
    rows = [(i, [float(i % 7), float(i % 3), float(i // 90 * 50)]) for i in range(180)]
    df = spark.createDataFrame(rows, "customer_id int, x array<double>").select("customer_id", array_to_vector("x").alias("features"))
    seen, whole = [], S._best_per_k
    monkeypatch.setattr(S, "_best_per_k", lambda data, *a: seen.append(data) or whole(data, *a))
    monkeypatch.setattr(S, "FIT_ROWS", 60)
    got = S.pca_kmeans(df.coalesce(1), ks=range(2, 4), n_init=2)
    # persisted data would be decoded on every pass of every fit
    assert not seen[0].storageLevel.useMemory and seen[0].columns == ["features"]
    assert seen[0].count() == 180 and seen[0].rdd.getNumPartitions() == 3
    assert S.best_k(got) == 2 and got.count() == 2
