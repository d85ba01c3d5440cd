"""The stateful score stream, stopped and started again, against the same figures of the batch."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.streaming import features as S
from tidemark.streaming import stateful as ST

T0 = datetime(2024, 1, 1)


def expected(rows, quiet_hours, late_hours):
    newest = max(t for _, t, *_ in rows if t)
    out = []
    for user in sorted({u for u, t, *_ in rows if u is not None and t}):
        own = [r for r in rows if r[0] == user and r[1]]
        values = [Decimal(str(v)) for *_, v in own if v is not None]
        kinds = {k for _, _, k, _ in own if k is not None}
        last = max(t for _, t, *_ in own)
        quiet = last + timedelta(hours=quiet_hours) < newest - timedelta(hours=late_hours)
        logins = sum(k == "login" for _, _, k, _ in own)
        p = (0.5 if quiet or not logins else 0) + 0.3 / (1 + len(own)) + 0.2 / (1 + len(kinds))
        out.append((user, quiet, len(own), logins, len(kinds), float(sum(values)) if values else None, last, round(p, 6)))
    return out


def test_scores_of_a_stream_stopped_and_started_again(spark, tmp_path):
    def at(hours):
        return T0 + timedelta(hours=hours)

    rounds = [
        # user 1 is active, 2 falls quiet, 3 has neither type nor value; rows without a user or a time are skipped
        [(1, at(h), "login" if h % 5 == 0 else "view", h / 8) for h in range(0, 60, 2)]
        + [(2, at(3), "login", 0.1), (2, at(3), "login", 0.1), (3, at(50), None, None), (None, at(59), "view", 1.0), (4, None, "view", 1.0)],
        # 2 comes back, with a row of a day before; user 1 goes on, user 5 comes and stays away
        [(2, at(61), "buy", 2e-6), (2, at(38), "view", 5.0), (1, at(62), "view", 1.0), (5, at(45), "view", -1.0)],
        # 2 and 5 are quiet now; one row of user 3 is a day late, its other one is recent enough
        [(1, at(120), "view", None), (3, at(100), "login", 7.5), (3, at(60), "view", 0.25)],
    ]
    folder, job, seen = str(tmp_path / "events.parquet"), f"scores-{tmp_path.name}", []
    schema = "user_id long, ts timestamp_ntz, event_type string, value double"
    cols = ["user_id", "quiet", "events", "logins", "event_types", "value_sum", "last_seen", "churn_probability"]
    before = spark.conf.get(ST.STORE)
    for k, rows in enumerate(rounds):
        df = spark.createDataFrame(rows, schema).withColumn("event_id", F.lit(0).cast("long")).withColumn("props", F.lit(None).cast("string"))
        df.select(*S.EVENT_SCHEMA.names).coalesce(1).write.mode("append").parquet(folder)
        got = ST.run_user_scores_stream(spark, str(tmp_path), job, quiet_hours=6, late="1 day")
        seen += rows
        assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == expected(seen, 6, 24), k
    quiet = {r["user_id"] for r in got.where("quiet").collect()}
    assert quiet == {2, 5}
    again = ST.run_user_scores_stream(spark, str(tmp_path), job)  # nothing new
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
    assert spark.conf.get(ST.STORE) == before


def test_parts_of_a_batch_need_no_shuffle(spark):
    rows = [(7, T0 + timedelta(seconds=k), "login" if k % 2 else None, 0.5) for k in range(3_000)]
    events = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_type string, value double").coalesce(1)
    parts = ST.combine_events(events)
    got = parts.collect()
    assert len(got) == 1 and (got[0]["events"], got[0]["logins"], float(got[0]["vsum"])) == (3_000, 1_500, 1_500.0)
    assert "Exchange" not in parts._jdf.queryExecution().executedPlan().toString()
    assert ST.combine_events(events.limit(0)).collect() == []
