"""Readers, published views, partitioned writes, model round trips, stream and batch."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidemark.sources import tables as T

HEAD = ",".join(f.name for f in T.CUSTOMER_SCHEMA.fields)
GOOD = "1,2023-05-01,30,12,FinTech,NaN,0.5,0.2,4.0,1,Pro,3,1,2,10,5.5,100,3,4,1000,card,ads,0.5,0.6,FRANCE"


def test_csv_with_bad_rows_and_nan(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(f"{HEAD}\n{GOOD}\nnot a number,2023-05-01,30\n,,\n")
    rows = T.read_customers(spark, str(path)).cache().collect()
    assert len(rows) == 3
    good = next(r for r in rows if r["customer_id"] == 1)
    assert good["monthly_revenue"] is None and good["feature_usage_score"] == 0.5 and good["_corrupt_record"] is None
    assert any(r["_corrupt_record"] and "not a number" in r["_corrupt_record"] for r in rows)


def test_other_formats_turn_nan_into_null(spark, tmp_path):
    spark.createDataFrame([(1, float("nan")), (2, 2.0)], "k int, v double").write.parquet(str(tmp_path / "p"))
    got = T.read_customers(spark, str(tmp_path / "p"), "parquet").orderBy("k").collect()
    assert [r["v"] for r in got] == [None, 2.0]


def test_published_view_and_partitioned_table(spark, tmp_path):
    from tidemark.plans.catalog import clean

    path = str(tmp_path / "clean")
    T.publish_view(clean(spark, SF001), "clean_customers", path, "standardized_subscription_tier")
    per = spark.sql("SELECT standardized_subscription_tier AS t, count(*) AS n FROM clean_customers GROUP BY 1")
    assert {r["t"]: r["n"] for r in per.collect()} == {
        r["t"]: r["n"] for r in clean(spark, SF001).groupBy(F.col("standardized_subscription_tier").alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    assert (tmp_path / "clean" / "standardized_subscription_tier=Basic").is_dir()
    T.write_report(per, str(tmp_path / "r"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == per.count()


def test_model_round_trip(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    df = spark.range(20).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("y"))
    stages = [VectorAssembler(inputCols=["x", "y"], outputCol="v"), StandardScaler(inputCol="v", outputCol="z", withMean=True)]
    model = Pipeline(stages=stages).fit(df)
    T.save_model(model, str(tmp_path / "m"))
    again = T.load_model(str(tmp_path / "m"))
    assert model.transform(df).select("z").collect() == again.transform(df).select("z").collect()


def test_stream_has_every_window_of_the_batch(spark):
    from tidemark.sources.tables import read_table
    from tidemark.streaming import features as S

    batch = S.activity_risk(S.event_features(read_table(spark, SF001, "events")))
    stream = S.run_event_features_stream(spark, SF001)
    cols = sorted(batch.columns)
    assert sorted(map(str, stream.select(cols).collect())) == sorted(map(str, batch.select(cols).collect()))
    assert S.alerts(stream).count() == batch.where("churn_probability > 0.7").count() > 0


def test_stream_of_shuffled_files_is_the_batch(spark, tmp_path):
    import os

    from tidemark.sources.tables import read_table
    from tidemark.streaming import features as S

    events = read_table(spark, SF001, "events").select(*S.EVENT_SCHEMA.names)
    folder = tmp_path / "events.parquet"
    events.repartitionByRange(4, F.desc("ts")).write.parquet(str(folder))  # the latest days first
    events.limit(0).write.mode("append").parquet(str(folder))
    for k, name in enumerate(sorted(p for p in os.listdir(folder) if p.startswith("part-"))):
        os.utime(folder / name, (1_700_000_000 + 60 * k, 1_700_000_000 + 60 * k))
    batch = S.activity_risk(S.event_features(read_table(spark, SF001, "events")))
    cols = sorted(batch.columns)
    want = sorted(map(str, batch.select(cols).collect()))
    assert sorted(map(str, S.run_event_features_stream(spark, str(tmp_path)).select(cols).collect())) == want
    # a day's rows spread over all files
    events.repartition(3, "event_id").write.parquet(str(tmp_path / "b" / "events.parquet"))
    again = S.run_event_features_stream(spark, str(tmp_path / "b"))
    assert sorted(map(str, again.select(cols).collect())) == want
    assert again.dtypes == S.run_event_features_stream(spark, SF001).dtypes


def test_named_stream_resumes_and_compacts(spark, tmp_path):
    from tidemark.sources.tables import read_table
    from tidemark.streaming import features as S

    events = read_table(spark, SF001, "events").select(*S.EVENT_SCHEMA.names)
    folder, job = str(tmp_path / "events.parquet"), f"resumed-{tmp_path.name}"
    cols = ["window_start", "window_end", "user_id", "events", "logins", "event_types", "value_sum", "value_avg", "churn_probability"]
    table = S.PartsTable(spark, f"{S.shared_folder(spark)}/streams/{job}/parts")
    for k in range(3):  # a job stopped and started again; late rows of every day in every part
        events.where(F.pmod("event_id", F.lit(3)) == k).repartition(2 + k).write.mode("append").parquet(folder)
        got = S.run_event_features_stream(spark, str(tmp_path), job, compact_after=3)
        seen = S.activity_risk(S.event_features(events.where(F.pmod("event_id", F.lit(3)) <= k)))
        assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, seen.select(cols).collect()))
    assert table._finished("upto") and len(table._finished("batch")) <= 4
    again = S.run_event_features_stream(spark, str(tmp_path), job)  # nothing new
    assert sorted(map(str, again.select(cols).collect())) == sorted(map(str, seen.select(cols).collect()))
    # a compaction lost halfway: an unfinished base, and old folders that were not deleted yet
    part = S.event_parts(events.limit(5))
    part.write.parquet(f"{table.path}/batch=0")
    part.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table.path}/upto=99")
    assert sorted(map(str, S.activity_risk(S.merge_parts(table.read())).select(cols).collect())) == sorted(map(str, seen.select(cols).collect()))


def test_alerts_once_per_customer(spark, tmp_path):
    from tidemark.streaming.features import stream_alerts

    rows = [(1, 0.9, "2024-01-01 00:00:00"), (1, 0.95, "2024-01-01 01:00:00"), (2, 0.5, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "customer_id long, churn_probability double, t string")
    df.select("customer_id", "churn_probability", F.to_timestamp("t").alias("event_time")).coalesce(1).write.parquet(str(tmp_path / "in"))
    schema = "customer_id long, churn_probability double, event_time timestamp"
    q = stream_alerts(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("al")
    q = q.outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["customer_id"] for r in spark.table("al").collect()] == [1]


def test_trend_report_keeps_the_rows_of_several_snapshots(spark):
    import __spark_entry__ as E

    clean = E.queries()["cleaned_customers"](spark, SF001).count()
    assert E.queries()["customer_trends_snapshots"](spark, SF001).count() == 2 * clean


def test_radar_is_on_the_range_of_all_customers(spark):
    from tidemark.operators.chartdata import radar_metrics

    rows = [(0, 10.0), (0, 30.0), (1, 70.0), (1, 110.0), (2, 70.0)]
    labeled = spark.createDataFrame(rows, "cluster int, monthly_revenue double").withColumns(
        {c: F.lit(0.5) for c in ("customer_satisfaction_score", "churn_risk_score", "feature_usage_score", "engagement_score")}
    )
    names = spark.createDataFrame([(0, "low"), (1, "high"), (2, "high")], "cluster int, name string")
    got = {r["name"]: r["revenue"] for r in radar_metrics(labeled, names).collect()}
    assert got == {"low": pytest.approx(0.1), "high": pytest.approx(0.733333, abs=1e-6)}


def test_refresh_rewrites_only_what_changed(spark, tmp_path):
    import os

    path = str(tmp_path / "view")
    schema = "id long, v double, w string, month string"
    rows = [(1, 1.0, None, "2024-01"), (2, 2.0, "a", "2024-01"), (3, 3.0, "b", "2024-02"), (4, None, "c", "a/b =%"), (5, 5.0, "d", None)]

    def files(month):
        return sorted(os.listdir(os.path.join(path, f"month={month}")))

    def read():
        return sorted(map(str, spark.read.schema(schema).parquet(path).collect()))

    def refresh(rows):
        df = spark.createDataFrame(rows, schema)
        got = {r["month"]: r["change"] for r in T.refresh_table(df, path, "month").collect()}
        assert read() == sorted(map(str, df.collect()))
        return got

    assert refresh(rows) == {"2024-01": "new", "2024-02": "new", "a/b =%": "new", None: "new"}
    assert refresh(rows[::-1]) == {}  # the order of rows is no change
    kept = files("2024-02")
    late = [(1, 1.5, None, "2024-01"), *rows[1:]]
    assert refresh(late) == {"2024-01": "changed"} and files("2024-02") == kept
    swapped = [*late[:2], (3, None, "b", "2024-02"), *late[3:]]
    assert refresh(swapped) == {"2024-02": "changed"}
    repeated = [*swapped, swapped[0]]
    assert refresh(repeated) == {"2024-01": "changed"}
    less = [r for r in repeated if r[3] in ("2024-01", None)] + [(9, 9.0, "z", "2024-03")]
    assert refresh(less) == {"2024-02": "gone", "a/b =%": "gone", "2024-03": "new"}
    # from the table itself
    assert {r["change"] for r in T.refresh_table(spark.read.schema(schema).parquet(path), path, "month").collect()} == set()
    assert T.refresh_table(spark.createDataFrame([], schema), path, "month").count() == 3 and read() == []


def test_alerts_of_a_resumed_stream_come_once(spark, tmp_path):
    from tidemark.sources.tables import read_table
    from tidemark.streaming import features as S

    events = read_table(spark, SF001, "events").select(*S.EVENT_SCHEMA.names)
    users = events.select("user_id").distinct().where("user_id IS NOT NULL")
    risk = F.when(F.pmod("user_id", F.lit(5)) == 0, None).otherwise(F.pmod("user_id", F.lit(3)) / 2.0)
    scores = users.withColumn("churn_probability", risk)
    folder, job = str(tmp_path / "events.parquet"), f"once-{tmp_path.name}"
    for k in (2, 1, 0):  # later files hold earlier days too, and days that have had their alert
        events.where(F.pmod("event_id", F.lit(3)) == k).coalesce(1).write.mode("append").parquet(folder)
        got = S.run_alert_stream(spark, str(tmp_path), scores, job)
        seen = events.where(F.pmod("event_id", F.lit(3)) >= k).join(scores.where("churn_probability > 0.7"), "user_id")
        want = seen.select("user_id", F.to_date("ts").alias("day"), "churn_probability").distinct()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() > 0
