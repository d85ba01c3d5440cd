"""Sessions by range bucket against Spark's session windows."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.streaming import features as S


def spark_sessions(events, gap):
    agg = events.groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("events"))
    return agg.select(F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "user_id", "events")


def rows(df):
    return sorted(map(str, df.select("session_start", "session_end", "user_id", "events").collect()))


def test_sessions_of_a_hot_user_spread_over_buckets(spark):
    rng, start = random.Random(5), datetime(2024, 1, 1)
    hot = [(7, start + timedelta(minutes=rng.randrange(40_000))) for _ in range(900)]
    hot += [(7, start + timedelta(minutes=50_000 + 30 * k)) for k in range(300)]  # one session, every pause just the gap
    hot += [(7, start + timedelta(minutes=60_000, microseconds=k)) for k in range(50)] * 3  # repeated moments
    others = [(rng.choice([None, *range(60)]), start + timedelta(minutes=rng.randrange(3_000))) for _ in range(1_200)]
    events = spark.createDataFrame([*hot, *others, (7, None), (None, None)], "user_id long, ts timestamp_ntz")
    want = rows(spark_sessions(events, "30 minutes"))
    for n in (1, 2, 13, 64):
        assert rows(S.session_features(events, n_buckets=n)) == want
    assert rows(S.session_features(events)) == want
    assert rows(S.session_features(events, "2 hours", n_buckets=9)) == rows(spark_sessions(events, "2 hours"))
    moments = S.materialize(events.where("ts IS NOT NULL").groupBy("user_id", "ts").count())
    dealt = S.range_bucket(moments, ["user_id", "ts"], (), 13).where("user_id = 7").select("_bkt").distinct().count()
    assert dealt > 4


def test_sessions_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "user_id long, ts timestamp_ntz")
    assert S.session_features(empty).collect() == []
    assert S.session_features(spark.createDataFrame([(1, None)], "user_id long, ts timestamp_ntz")).collect() == []
