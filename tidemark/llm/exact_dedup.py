"""Exact dedup over a persistent digest index (DataFrame and SQL functions only).

The index is a Parquet table bucketed and sorted by the SHA-256 of the
normalised text, one row per distinct text ever admitted. New rows are reduced
to one row per digest (map-side combine), anti-joined with the index bucket by
bucket (sort-merge; the index side is neither shuffled nor re-sorted as a
whole) and the unseen digests are appended.

Only ids and digests are shuffled. A digest may hold a third of all rows: the
fewer than 1,000 digests that can exceed a thousandth of the rows reach the
rows by a broadcast whose size that bound proves, every other digest by the
sort-merge join (``common.join_groups``).

Defined results: null text counts as empty; a null doc_id is smaller than any
other; rows that repeat both doc_id and text are one document (all carry
``kept``; the stage keeps one row). An empty input gives an empty result. Only
``doc_id`` and ``text`` are read, so extra columns of any name pass through the
stage and cannot clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, join_groups, text_or_empty
from tidemark.session import materialize, tables_dir

#: digests per bucket of a new index, about 50 MB
BUCKET_ROWS = 500_000
MIN_BUCKETS = 6
#: version of the index's columns and of its hash
LAYOUT = 1
_DIGEST, _ID = "__dedup_digest", "__dedup_id"


def digest_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) per row."""
    return docs.select(
        F.col("doc_id").alias(_ID), F.sha2(ascii_lower(text_or_empty()).cast("binary"), 256).alias(_DIGEST)
    )


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


class DigestIndex:
    """Bucketed, sorted digest table. ``path`` names a shared folder that outlives the session;
    without one the index lives with the application's other tables in the shared checkpoint folder.

    The number of buckets and the layout's version are written beside a new index
    (``<path>_layout``) and read on opening, so ``expected_rows`` shapes new indexes only. A folder
    with data but without that table, or of another version, is refused. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str | None = None, expected_rows: int = 0):
        self.spark = spark
        self.name = f"tidemark_digests_{uuid.uuid4().hex}"
        self.path = path or f"{tables_dir(spark)}/{self.name}"
        layout = f"{self.path.rstrip('/')}_layout"
        if path and _exists(spark, layout):
            made = spark.read.parquet(layout).first()
            if made is None or made["version"] != LAYOUT:
                raise ValueError(f"{path}: not an index of layout {LAYOUT}")
            self.buckets = made["buckets"]
        elif path and _exists(spark, path):
            raise ValueError(f"{path}: data without its layout table {layout}")
        else:
            self.buckets = max(MIN_BUCKETS, -(-expected_rows // BUCKET_ROWS))
            if path:
                spark.range(1).select(F.lit(LAYOUT).alias("version"), F.lit(self.buckets).alias("buckets")).coalesce(
                    1
                ).write.parquet(layout)
        spark.sql(
            f"CREATE TABLE {self.name} (digest STRING, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def admit(self, rows: DataFrame, batch: str | None = None) -> DataFrame:
        """Admit one batch of ``digest_rows``; returns the verdict per distinct digest of the batch:
        digest, keep_id, group_size (rows of this batch), admitted (new to the index),
        copies (rows of the batch that are the kept document).

        A caller that may repeat the batch after a failure names it: digests that an earlier
        try under this name has appended count as admitted by it, so the verdict is the same."""
        batch = batch or uuid.uuid4().hex
        self.spark.catalog.refreshTable(self.name)
        groups = materialize(
            rows.groupBy(_DIGEST, _ID)
            .agg(F.count(F.lit(1)).alias("copies"))
            .groupBy(F.col(_DIGEST).alias("digest"))
            .agg(
                F.max(_ID).alias("max_id"),
                F.sum("copies").alias("group_size"),
                F.coalesce(F.max_by("copies", _ID), F.max("copies")).alias("copies"),
            )
        )
        fresh = groups.join(self.table().hint("merge"), "digest", "left_anti").select(
            "digest", F.col("max_id").alias("keep_id"), F.lit(batch).alias("batch")
        )
        (
            fresh.repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.insertInto(self.name)
        )
        self.spark.catalog.refreshTable(self.name)
        return materialize(
            groups.join(self.table().hint("merge"), "digest").select(
                "digest", "keep_id", "group_size", "copies", (F.col("batch") == batch).alias("admitted")
            )
        )


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    rows = materialize(digest_rows(docs))
    total = rows.count()
    verdict = (index or DigestIndex(spark, expected_rows=total)).admit(rows, batch)
    out = join_groups(rows, verdict.withColumnRenamed("digest", _DIGEST), _DIGEST, "group_size", total)
    return out.select(
        F.col(_ID).alias("doc_id"),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("admitted") & F.col(_ID).eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col(_DIGEST).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: of equal texts the one with the largest doc_id."""
    spark = docs.sparkSession
    index = index or DigestIndex(spark, expected_rows=docs.count())
    verdict = index.admit(digest_rows(docs), batch).where("admitted")
    keep = verdict.select(
        F.col("digest").alias(_DIGEST), F.col("keep_id").alias(_ID), F.col("copies").alias("__dedup_copies")
    )
    keyed = docs.withColumns(
        {
            _DIGEST: F.sha2(ascii_lower(text_or_empty()).cast("binary"), 256),
            _ID: F.col("doc_id"),
        }
    )
    kept = (
        keyed.alias("d")
        .join(
            keep.alias("k"),
            (F.col(f"d.{_DIGEST}") == F.col(f"k.{_DIGEST}")) & F.col(f"d.{_ID}").eqNullSafe(F.col(f"k.{_ID}")),
        )
        .select(*[F.col(f"d.`{c}`") for c in docs.columns], F.col(f"k.{_DIGEST}"), "__dedup_copies")
    )
    if not keep.where("__dedup_copies > 1").isEmpty():
        # repeated rows: a first-value aggregate combines on the map side, so a hot repeat is no hot task
        kept = kept.where("__dedup_copies = 1").unionByName(
            kept.where("__dedup_copies > 1").dropDuplicates([_DIGEST])
        )
    return kept.select(*docs.columns)


ORACLE_SQL = """
WITH n AS (
    SELECT doc_id,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM n
WINDOW same AS (PARTITION BY t)
"""
