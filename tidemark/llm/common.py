"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
ASCII_LOWER_SQL = f"translate({{}}, '{UPPER}', '{LOWER}')"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other code point stays."""
    return F.translate(col, UPPER, LOWER)


def fold(text: str | None, modulus: int) -> int:
    """crc32 of a decimal id as the contracts' folds take it."""
    import zlib

    return zlib.crc32((text or "").encode()) % modulus


def fold_col(id_col: str, modulus: int) -> Column:
    """crc32(id as text) mod ``modulus``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, its session handing Python at most 8 MB at once unless the user set a bound: long texts stay bounded too."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(key, None) is None:
        df.sparkSession.conf.set(key, str(8 << 20))
    return df


def slices(batch, max_bytes: int = 2 << 20):
    """Cut an Arrow batch into row ranges of about ``max_bytes`` (one row at least).

    Bounds what one step of an operator holds; whole texts stay whole.
    """
    n = batch.num_rows
    if not n:
        return
    step = max(1, int(n * max_bytes / max(batch.nbytes, 1)))
    for start in range(0, n, step):
        yield batch.slice(start, min(step, n - start))


def bounded_sample(df: DataFrame, key: Column, total: int, limit: int) -> DataFrame:
    """About ``limit`` of ``total`` rows by a hash draw on ``key``, 1.2 x ``limit`` at most; every row if they fit."""
    if total <= limit:
        return df
    draw = F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1_000_000))
    return df.where(draw < int(1_000_000 * limit / total)).limit(limit + limit // 5)


HOT_GROUPS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` joined with one row per ``key`` of ``groups``, whatever share of the rows one key holds.

    ``size`` is a group's number of rows of ``total``: fewer than ``HOT_GROUPS`` groups can hold more
    than ``total / HOT_GROUPS`` rows, so those go out by a broadcast of bounded size; the others meet
    their rows in a sort-merge join. Rows without a group are left out.
    """
    hot = F.col(size) > max(1000, total // HOT_GROUPS)
    few = F.broadcast(groups.where(hot))
    return rows.join(few, key).unionByName(
        rows.join(few.select(key), key, "left_anti").join(groups.where(~hot).hint("merge"), key)
    )
