"""Running churn scores per user with state and timers.

Every micro-batch is combined per partition and user before the shuffle, so a user with a third of all events
costs a few rows a batch. The state of a user (counts, kinds of events, value sum, last event) lives in the state
store; a timer per user reports those who fall quiet.
"""

from __future__ import annotations

from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.exprs import rnd
from tidemark.session import shared_folder, ship_package
from tidemark.streaming.features import EVENT_SCHEMA

PART = (
    "user_id long, events long, logins long, types array<string>, vsum decimal(38,6), vn long, "
    "last_seen timestamp, last_micros long"
)
STATE = "events long, logins long, types array<string>, vsum decimal(38,6), vn long, last_micros long, version long"
UPDATE = (
    "user_id long, version long, quiet boolean, events long, logins long, event_types long, "
    "vsum decimal(38,6), vn long, last_micros long"
)
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def combine_events(events: DataFrame) -> DataFrame:
    """One row per Arrow batch and user (``PART``), without a shuffle. Rows without a user or a time are skipped."""

    def combine(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            g = pa.Table.from_batches([batch]).group_by("user_id").aggregate(
                [("one", "sum"), ("login", "sum"), ("event_type", "distinct"), ("value", "sum"), ("value", "count"),
                 ("event_time", "max"), ("micros", "max")]
            )
            out = g.select(["user_id", "one_sum", "login_sum", "event_type_distinct", "value_sum", "value_count",
                            "event_time_max", "micros_max"]).rename_columns([f.name for f in part])
            decimal = out["vsum"].cast(pa.decimal128(38, 6))
            yield from out.set_column(4, "vsum", decimal).to_batches()

    part = T.StructType.fromDDL(PART)
    timed = events.withColumn("event_time", F.col("ts").cast("timestamp")).where("user_id IS NOT NULL AND ts IS NOT NULL")
    return timed.select(
        "user_id",
        F.lit(1).cast("long").alias("one"),
        F.coalesce((F.col("event_type") == "login").cast("long"), F.lit(0).cast("long")).alias("login"),
        "event_type",
        F.col("value").cast("decimal(24,6)").alias("value"),
        "event_time",
        F.unix_micros("event_time").alias("micros"),
    ).mapInArrow(combine, part)


class RunningScore(StatefulProcessor):
    """Adds the parts of a batch to a user's state, emits the new state, and once more when the user falls quiet.

    ``version`` counts what was emitted for a user; the highest one holds.
    """

    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("running", STATE)

    def _row(self, key, state, quiet: bool):
        from pyspark.sql import Row

        events, logins, types, vsum, vn, last, version = state
        return Row(user_id=key[0], version=version, quiet=quiet, events=events, logins=logins, event_types=len(types),
                   vsum=vsum, vn=vn, last_micros=last)

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.get()
        events, logins, types, vsum, vn, last, version = held or (0, 0, [], None, 0, None, 0)
        kinds = set(types)
        for r in rows:
            events, logins, vn = events + r.events, logins + r.logins, vn + r.vn
            kinds.update(t for t in r.types if t is not None)
            if r.vsum is not None:
                vsum = r.vsum + (vsum or Decimal(0))
            last = r.last_micros if last is None else max(last, r.last_micros)
        state = (events, logins, sorted(kinds), vsum, vn, last, version + 1)
        self.state.update(state)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last // 1000 + self.quiet_ms)
        yield self._row(key, state, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = tuple(self.state.get())
        state = (*held[:-1], held[-1] + 1)
        self.state.update(state)
        yield self._row(key, state, True)

    def close(self) -> None:
        pass


def running_risk(scores: DataFrame) -> DataFrame:
    """``scores`` with a churn probability: few events, few kinds of events, and no login or a quiet user each add to it."""
    away = F.when(F.col("quiet") | (F.col("logins") == 0), 0.5).otherwise(0.0)
    return scores.withColumn(
        "churn_probability", rnd(away + 0.3 * (1 / (1 + F.col("events"))) + 0.2 * (1 / (1 + F.col("event_types"))), 6)
    )


@contextmanager
def _state_store(spark: SparkSession):
    """State with timers needs the RocksDB store; the session's own setting comes back afterwards."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def run_user_scores_stream(spark: SparkSession, events_dir: str, job: str | None = None, quiet_hours: int = 6,
                           late: str = "1 day", file_glob: str = "events.parque[t]", score=running_risk) -> DataFrame:
    """Running features and score of every user after all files available now, one row per user.

    File source -> combined per partition and user -> state per user -> file sink of versions; the highest version
    of a user is read. A user is quiet if the last event plus ``quiet_hours`` lies before the watermark, which is the
    newest event less ``late``; a later event ends it. An event at most ``late`` behind the newest one of the earlier
    batches always counts; an older one may be dropped (the state store's rule), so ``late`` must cover the disorder
    of the source. A named ``job`` keeps checkpoint and versions in the shared folder: a later call reads new files
    only and goes on from the state.
    """
    import uuid

    ship_package(spark)
    base = f"{shared_folder(spark)}/streams/{job or uuid.uuid4().hex}-scores"
    events = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{events_dir}/{file_glob}")
    update = T.StructType.fromDDL(UPDATE)
    with _state_store(spark):
        found = (
            combine_events(events).withWatermark("last_seen", late).groupBy("user_id")
            .transformWithState(RunningScore(quiet_hours * 3_600_000), update, "Append", "EventTime")
        )
        q = (
            found.writeStream.format("parquet")
            .option("path", f"{base}/versions")
            .option("checkpointLocation", f"{base}/checkpoint")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
    versions = spark.read.schema(update).parquet(f"{base}/versions")
    rest = [c for c in versions.columns if c not in ("user_id", "version")]
    latest = versions.groupBy("user_id").agg(F.max_by(F.struct(*rest), "version").alias("v")).select("user_id", "v.*")
    total = F.col("vsum").cast("double")
    return score(latest).select(
        "user_id", "quiet", "events", "logins", "event_types", total.alias("value_sum"),
        rnd(F.try_divide(total, F.col("vn")), 6).alias("value_avg"),
        F.timestamp_micros("last_micros").cast("timestamp_ntz").alias("last_seen"), "churn_probability",
    )
