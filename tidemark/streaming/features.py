"""Structured Streaming: per-customer event features and churn alerts.

The reference has no streaming code; these are the streaming forms of the
batch features, written so the same aggregation runs in batch and in a
stream (event-time windows; the job keeps mergeable parts per micro-batch, so
no order of the files loses a row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import rnd
from tidemark.operators.windows import range_bucket
from tidemark.session import materialize, shared_folder

ALERT_THRESHOLD = 0.7

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _with_event_time(events: DataFrame, for_watermark: bool = False) -> DataFrame:
    # Batch windows run on the wall-clock TIMESTAMP_NTZ (time-zone independent);
    # watermarks need TIMESTAMP, so streams cast (sessions run in UTC).
    return events.withColumn("event_time", F.col("ts").cast("timestamp") if for_watermark else F.col("ts"))


def event_features(events: DataFrame, window: str = "1 day", watermark: str | None = None) -> DataFrame:
    """Tumbling-window activity per user: events, logins, distinct event types, value sum/avg.

    Works on a batch or a streaming DataFrame; with ``watermark`` the state of
    closed windows is dropped and results are emitted once (append mode).
    """
    e = _with_event_time(events, bool(watermark))
    if watermark:
        e = e.withWatermark("event_time", watermark)
    agg = e.groupBy(F.window("event_time", window).alias("w"), "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "login").alias("logins"),
        F.size(F.collect_set("event_type")).cast("long").alias("event_types"),  # a few fixed types
        F.sum(F.col("value").cast("decimal(24,6)")).alias("_vsum"),
        F.count("value").alias("_vn"),
    )
    return agg.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "user_id",
        "events",
        "logins",
        "event_types",
        F.col("_vsum").cast("double").alias("value_sum"),
        rnd(F.try_divide(F.col("_vsum").cast("double"), F.col("_vn")), 6).alias("value_avg"),
    )


def session_features(events: DataFrame, gap: str = "30 minutes", watermark: str | None = None,
                     n_buckets: int | None = None) -> DataFrame:
    """Session windows per user (activity bursts separated by more than ``gap``); rows without a time are skipped.

    A stream runs on Spark's session windows. A batch is cut into range buckets of (user, time), so the rows of one
    user may spread over any number of tasks (``_bucket_sessions``); rows without a user are one user.
    """
    if not events.isStreaming:
        return _bucket_sessions(events, gap, n_buckets)
    e = _with_event_time(events, bool(watermark))
    if watermark:
        e = e.withWatermark("event_time", watermark)
    agg = e.groupBy(F.session_window("event_time", gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("events"))
    return agg.select(
        F.col("s.start").cast("timestamp_ntz").alias("session_start"),
        F.col("s.end").cast("timestamp_ntz").alias("session_end"),
        "user_id",
        "events",
    )


def _bucket_sessions(events: DataFrame, gap: str, n_buckets: int | None) -> DataFrame:
    """Sessions inside every range bucket, stitched at the bucket borders.

    Rows are first counted per user and time, which also makes the range key unique. Inside a bucket only the first
    and the last session of a user can go on elsewhere, and only of the users at the bucket's two ends; these few
    pieces (at most four a bucket) are joined by the same gap rule, all others are final.
    """
    pause = F.expr(f"INTERVAL {gap}")
    moments = events.where("ts IS NOT NULL").groupBy("user_id", "ts").agg(F.count(F.lit(1)).alias("n"))
    b = range_bucket(moments, ["user_id", "ts"], (), n_buckets)
    by_time = Window.partitionBy("_bkt", "user_id").orderBy("ts")
    opens = F.coalesce(F.col("ts") > F.lag("ts").over(by_time) + pause, F.lit(True))
    numbered = b.withColumn("_opens", opens).withColumn("_k", F.count_if("_opens").over(by_time))
    pieces = numbered.groupBy("_bkt", "user_id", "_k").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.sum("n").alias("events")
    )
    pieces = pieces.withColumn("_last", F.max("_k").over(Window.partitionBy("_bkt", "user_id")))

    # users at the ends of more than one bucket: at most two rows a bucket, so the broadcast follows their number
    who = F.struct("user_id")
    ends = b.groupBy("_bkt").agg(F.array(F.min(who), F.max(who)).alias("u")).select("_bkt", F.explode("u").alias("u"))
    spread = ends.groupBy(F.col("u.user_id").alias("_user")).agg((F.count_distinct("_bkt") > 1).alias("_many")).where("_many")
    marked = pieces.join(F.broadcast(spread), F.col("user_id").eqNullSafe(F.col("_user")), "left")
    edge = F.col("_many").isNotNull() & ((F.col("_k") == 1) | (F.col("_k") == F.col("_last")))
    marked = materialize(marked.select("user_id", "first", "last", "events", edge.alias("_edge")))

    run = Window.partitionBy("user_id").orderBy("first")
    opens = F.coalesce(F.col("first") > F.lag("last").over(run) + pause, F.lit(True))
    stitched = (
        marked.where("_edge").withColumn("_opens", opens).withColumn("_k", F.count_if("_opens").over(run))
        .groupBy("user_id", "_k").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("events").alias("events"))
    )
    whole = marked.where("NOT _edge").unionByName(stitched, allowMissingColumns=True)
    return whole.select(
        F.col("first").cast("timestamp_ntz").alias("session_start"),
        (F.col("last") + pause).cast("timestamp_ntz").alias("session_end"),
        "user_id",
        "events",
    )


def activity_risk(features: DataFrame) -> DataFrame:
    """``features`` with a churn probability from the window's activity (X4): few events, few kinds of events and no
    login each add to it. A fitted pipeline's ``transform`` takes the same place for a learned score."""
    quiet = 1 / (1 + F.col("events"))
    narrow = 1 / (1 + F.col("event_types"))
    away = F.when(F.col("logins") > 0, 0.0).otherwise(1.0)
    return features.withColumn("churn_probability", rnd(0.5 * away + 0.3 * quiet + 0.2 * narrow, 6))


def alerts(scored: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Windows whose churn probability exceeds ``threshold``."""
    return scored.filter(F.col("churn_probability") > threshold).select("window_start", "user_id", "churn_probability")


def stream_alerts(scored: DataFrame, threshold: float = ALERT_THRESHOLD, watermark: str = "1 day",
                  key: str | list[str] = "customer_id", time_col: str = "event_time") -> DataFrame:
    """Churn alerts on a scored stream: one alert per ``key`` within the watermark."""
    return (
        scored.withWatermark(time_col, watermark)
        .filter(F.col("churn_probability") > threshold)
        .dropDuplicatesWithinWatermark([key] if isinstance(key, str) else list(key))
    )


def run_alert_stream(spark: SparkSession, events_dir: str, scores: DataFrame, job: str | None = None,
                     threshold: float = ALERT_THRESHOLD, watermark: str = "31 days",
                     file_glob: str = "events.parque[t]") -> DataFrame:
    """Alert when a customer at risk is active: (user_id, day, churn_probability), one per user and day.

    Every micro-batch of events is joined with ``scores`` (user_id, churn_probability; a NULL score raises no alert).
    The state holds a user and day until the watermark has passed it, so a replayed or late event raises no second
    alert; an event later than ``watermark`` behind the newest is dropped. The file sink and the checkpoint of a named
    ``job`` give every alert once, also when the job is stopped and started again.
    """
    import uuid

    base = f"{shared_folder(spark)}/streams/{job or uuid.uuid4().hex}-alerts"
    events = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{events_dir}/{file_glob}")
    timed = _with_event_time(events, for_watermark=True).withColumn("day", F.to_date("ts"))
    scored = timed.select("user_id", "day", "event_time").join(scores.select("user_id", "churn_probability"), "user_id")
    found = stream_alerts(scored, threshold, watermark, ["user_id", "day"]).select("user_id", "day", "churn_probability")
    q = (
        found.writeStream.format("parquet")
        .option("path", f"{base}/alerts")
        .option("checkpointLocation", f"{base}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{base}/alerts")


def event_parts(events: DataFrame, window: str = "1 day") -> DataFrame:
    """Mergeable parts of ``event_features``, one row per window and user."""
    agg = _with_event_time(events).groupBy(F.window("event_time", window).alias("w"), "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "login").alias("logins"),
        F.collect_set("event_type").alias("types"),  # a few fixed types
        F.sum(F.col("value").cast("decimal(24,6)")).cast("decimal(38,6)").alias("vsum"),
        F.count("value").alias("vn"),
    )
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "user_id",
                      "events", "logins", "types", "vsum", "vn")


def add_parts(parts: DataFrame) -> DataFrame:
    """The parts of any number of batches, in any order, as one part per window and user."""
    return parts.groupBy("window_start", "window_end", "user_id").agg(
        F.sum("events").alias("events"),
        F.sum("logins").alias("logins"),
        F.array_distinct(F.flatten(F.collect_set("types"))).alias("types"),
        F.sum("vsum").cast("decimal(38,6)").alias("vsum"),
        F.sum("vn").alias("vn"),
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """``event_features`` from the parts of any number of batches, in any order."""
    total = F.col("vsum").cast("double")
    return add_parts(parts).select(
        "window_start", "window_end", "user_id", "events", "logins", F.size("types").cast("long").alias("event_types"),
        total.alias("value_sum"), rnd(F.try_divide(total, F.col("vn")), 6).alias("value_avg"),
    )


class PartsTable:
    """Parts of a named stream: a folder ``batch=N`` per micro-batch and, after compaction, one folder
    ``upto=N`` that holds the sum of all batches up to N.

    A reader takes the highest finished ``upto`` folder and the batches above it, so a compaction that is
    lost halfway changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def put(self, batch: DataFrame, batch_id: int, window: str) -> None:
        event_parts(batch, window).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def _finished(self, kind: str) -> list[int]:
        if not self._fs.exists(self._path(self.path)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        ids = [int(n.removeprefix(f"{kind}=")) for n in names if n.startswith(f"{kind}=")]
        return sorted(i for i in ids if self._fs.exists(self._path(f"{self.path}/{kind}={i}/_SUCCESS")))

    def read(self) -> DataFrame:
        base = self._finished("upto")[-1:]
        later = [i for i in self._finished("batch") if not base or i > base[0]]
        folders = [f"{self.path}/upto={i}" for i in base] + [f"{self.path}/batch={i}" for i in later]
        empty = event_parts(self.spark.createDataFrame([], EVENT_SCHEMA))
        return self.spark.read.schema(empty.schema).parquet(*folders) if folders else empty

    def compact(self, most: int) -> None:
        """Sum up the batches once more than ``most`` folders lie beside the base; the last batch stays, as it may be replayed."""
        base = self._finished("upto")[-1:]
        later = [i for i in self._finished("batch") if not base or i > base[0]]
        if len(later) <= most + 1:
            return
        folders = [f"{self.path}/upto={i}" for i in base] + [f"{self.path}/batch={i}" for i in later[:-1]]
        add_parts(self.spark.read.parquet(*folders)).write.mode("overwrite").parquet(f"{self.path}/upto={later[-2]}")
        for folder in folders:
            self._fs.delete(self._path(folder), True)


def run_event_features_stream(spark: SparkSession, events_dir: str, job: str | None = None,
                              window: str = "1 day", file_glob: str = "events.parque[t]",
                              score=activity_risk, compact_after: int = 20) -> DataFrame:
    """Run the streaming feature job over everything available; the current features and scores of every window.

    File source -> aggregate of the micro-batch -> one folder of parts per
    micro-batch, overwritten if the batch is replayed; the parts of a window
    are merged by key when the table is read, then scored. There is no
    watermark: every row counts, whatever the order of the files. ``job`` names the stream: its
    checkpoint and parts lie under that name in the shared folder, so a later call under the same
    name, in any session with that folder, reads only files it has not seen and adds to the
    same table. Without a name the job stands alone. More than ``compact_after`` folders of parts are
    summed into one. ``file_glob`` names the table, a file or a folder of files
    (a pattern, since the file source takes no plain path of a single file).
    """
    import uuid

    base = f"{shared_folder(spark)}/streams/{job or uuid.uuid4().hex}"
    table = PartsTable(spark, f"{base}/parts")
    stream = (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{events_dir}/{file_glob}")
    )
    q = (
        stream.writeStream.foreachBatch(lambda batch, batch_id: table.put(batch, batch_id, window))
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    table.compact(compact_after)
    return score(merge_parts(table.read()))
