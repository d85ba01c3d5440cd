"""Sources and sinks: table scans, customer files, reports, models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Base customer table (25 columns) — the schema every operator expects.
CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("signup_date", T.DateType(), True),
        T.StructField("age", T.IntegerType(), True),
        T.StructField("company_size", T.IntegerType(), True),
        T.StructField("industry", T.StringType(), True),
        T.StructField("monthly_revenue", T.DoubleType(), True),
        T.StructField("feature_usage_score", T.DoubleType(), True),
        T.StructField("churn_risk_score", T.DoubleType(), True),
        T.StructField("customer_satisfaction_score", T.DoubleType(), True),
        T.StructField("activation_completed", T.IntegerType(), True),
        T.StructField("subscription_tier", T.StringType(), True),
        T.StructField("transaction_volume", T.DoubleType(), True),
        T.StructField("support_tickets", T.IntegerType(), True),
        T.StructField("days_since_last_login", T.IntegerType(), True),
        T.StructField("total_sessions", T.IntegerType(), True),
        T.StructField("avg_session_duration", T.DoubleType(), True),
        T.StructField("api_calls_per_month", T.IntegerType(), True),
        T.StructField("integration_count", T.IntegerType(), True),
        T.StructField("team_size", T.IntegerType(), True),
        T.StructField("annual_contract_value", T.DoubleType(), True),
        T.StructField("payment_method", T.StringType(), True),
        T.StructField("referral_source", T.StringType(), True),
        T.StructField("onboarding_completion_rate", T.DoubleType(), True),
        T.StructField("feature_adoption_score", T.DoubleType(), True),
        T.StructField("location", T.StringType(), True),
    ]
)

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("transaction_amount", T.DoubleType(), True),
        T.StructField("transaction_date", T.TimestampType(), True),
    ]
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; Parquet gives column pruning and filter push-down."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_customers(spark: SparkSession, path: str, fmt: str = "csv", **options) -> DataFrame:
    """Read a customer table with the fixed schema (no inference pass).

    ``fmt='csv'`` keeps malformed lines in ``_corrupt_record`` instead of
    failing the job; NaN becomes NULL in every format; ``fmt='jdbc'`` forwards ``options`` (url, dbtable,
    partitionColumn, lowerBound, upperBound, numPartitions) so a database
    table is read by parallel range scans; anything else goes through
    ``spark.read.format(fmt)``.
    """
    if fmt == "csv":
        schema = T.StructType(CUSTOMER_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType(), True)])
        reader = (
            spark.read.schema(schema)
            .option("header", options.pop("header", "true"))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("dateFormat", options.pop("dateFormat", "yyyy-MM-dd"))
        )
        for k, v in options.items():
            reader = reader.option(k, v)
        return nan_to_null(reader.csv(path))
    if fmt == "jdbc":
        reader = spark.read.format("jdbc")
        for k, v in options.items():
            reader = reader.option(k, v)
        return nan_to_null(reader.load())
    reader = spark.read.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return nan_to_null(reader.load(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Treat NaN as missing at ingest (Spark's least/greatest would hide NaN)."""
    from pyspark.sql import functions as F

    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.when(F.isnan(f.name), F.lit(None).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def publish_view(df: DataFrame, name: str, path: str | None = None, partition_by=None) -> None:
    """Publish a derived table under ``name`` (A5): a temporary view, over a partitioned table at ``path`` if given."""
    if path:
        write_report(df, path, partition_by=partition_by)
        df = df.sparkSession.read.parquet(path)
    df.createOrReplaceTempView(name)


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=None) -> None:
    """Persist a report / derived table (e.g. the cleaned view partitioned by signup month)."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.save(path)


def _partition_states(df: DataFrame, partition_by: str, *more) -> DataFrame:
    """(partition_by, state): rows and the sum of their digests per partition, whatever the order of rows and columns."""
    from pyspark.sql import functions as F

    cols = sorted(c for c in df.columns if c != partition_by)
    digest = F.xxhash64(*cols, *[F.col(c).isNull() for c in cols])  # a NULL alone adds nothing to a hash
    state = F.struct(F.count(F.lit(1)).alias("rows"), F.sum(digest.cast("decimal(38,0)")).alias("digest")).alias("state")
    return df.groupBy(partition_by).agg(state, *more)


def refresh_table(df: DataFrame, path: str, partition_by: str) -> DataFrame:
    """Bring the partitioned table at ``path`` up to date with ``df`` (A5); a row per partition that changed.

    Partitions are compared by their number of rows and the sum of their rows' digests. Only those that differ are
    written, by dynamic partition overwrite; partitions that ``df`` no longer has are deleted; the files of the
    others stay. NULL is a partition of its own. A refresh lost halfway is repeated by calling it again.
    Returns (``partition_by``, change) with change 'new', 'changed' or 'gone'; all are new if there is no table yet.
    """
    from pyspark.sql import functions as F

    from tidemark.operators.windows import null_safe_join
    from tidemark.session import materialize

    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df = materialize(df)  # read twice, and it may itself come from the table
    sides = _partition_states(df, partition_by).select(partition_by, F.col("state").alias("now"), F.lit(None).alias("was"), F.lit(None).alias("folder"))
    if fs.exists(jvm.org.apache.hadoop.fs.Path(path)):
        folder = F.max(F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]+$", 1)).alias("folder")
        old = spark.read.schema(df.schema).parquet(path).select(*df.columns, "_metadata")
        cols = [c for c in df.columns if c != partition_by]
        states = _partition_states(old.select(partition_by, *cols), partition_by)
        folders = old.groupBy(partition_by).agg(folder)
        known = null_safe_join(states, folders, [partition_by])
        sides = sides.unionByName(known.select(partition_by, F.lit(None).alias("now"), F.col("state").alias("was"), "folder"))
    both = sides.groupBy(partition_by).agg(F.max("now").alias("now"), F.max("was").alias("was"), F.max("folder").alias("folder"))
    kind = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "gone").otherwise("changed")
    changes = materialize(both.where(~F.col("now").eqNullSafe(F.col("was"))).withColumn("change", kind))
    alive = changes.where("change <> 'gone'").select(partition_by)
    null_safe_join(df, alive, [partition_by], "left_semi").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(partition_by).parquet(path)
    for gone in changes.where("change = 'gone'").select("folder").toLocalIterator():  # a folder a partition
        fs.delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(gone["folder"])), True)
    return changes.select(partition_by, "change")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
