"""Global ORDER BY windows without a single-partition bottleneck.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one
task. These helpers keep the window semantics (Spark's own NULL order and
NULL partitions included) but spread the work:

1. ``repartitionByRange`` on the composite key; the partition number is written
   once as the column ``_bkt`` (``materialize``), so retried tasks and later
   reads agree on it. A unique id as the last key column splits a hot value
   over many partitions. Their number follows the data (adaptive execution) or
   is given.
2. Per-bucket counts and sums (one row per bucket and partition value) ->
   prefix offsets with a window over that table.
3. Local ``row_number`` / running sums inside each bucket, plus the offset.

Ranks with ties (``rank``, ``percent_rank``, average rank) and exact quantiles
come from a value histogram: ``groupBy(value).count()`` (map-side combined, so
a value holding a third of the rows is one histogram row), a prefix over the
histogram, and for ranks a join back on the value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: rows of one block of a moving window
ROWS_PER_BLOCK = 2_000_000


def _orders(cols, descending=()) -> list[Column]:
    return [F.col(c).desc() if c in descending else F.col(c).asc() for c in cols]


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join in which NULL equals NULL; the keys appear once."""
    named = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(named, cond, how).drop(*[f"__r_{k}" for k in keys])


def range_bucket(df: DataFrame, order_cols, descending=(), n_buckets: int | None = None) -> DataFrame:
    """``df`` as a table with ``_bkt``, its range partition by the key; equal keys share one."""
    from tidemark.session import materialize

    orders = _orders(order_cols, descending)
    dealt = df.repartitionByRange(n_buckets, *orders) if n_buckets else df.repartitionByRange(*orders)
    return materialize(dealt.withColumn("_bkt", F.spark_partition_id()))


def global_prefix(
    df: DataFrame,
    order_cols,
    measures=(),
    partition_cols=(),
    descending=(),
    rn_col: str = "_rn",
    n_buckets: int | None = None,
    with_total: bool = False,
    lags=(),
) -> DataFrame:
    """Global (per ``partition_cols``) row number and running sums.

    ``order_cols`` must form a unique key within a partition (add an id as the
    last column). Adds ``rn_col`` (1-based), ``cum_<m>`` for each measure
    (ROWS UNBOUNDED PRECEDING), with ``with_total`` ``_total`` (rows in the
    partition) and ``next_<c>`` for each of ``lags`` (the value on the following
    row of the same partition; the last row of a bucket takes it from the first
    row of the next bucket that holds the partition).
    """
    part = list(partition_cols)
    b = range_bucket(df, part + list(order_cols), descending, n_buckets)
    orders = _orders(order_cols, descending)
    w = Window.partitionBy("_bkt", *part).orderBy(*orders)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    local = b.select(
        "*",
        F.row_number().over(w).alias("_lrn"),
        *[F.sum(m).over(run).alias(f"_run_{m}") for m in measures],
        *[F.lead(F.struct(F.col(c))).over(w).alias(f"_lead_{c}") for c in lags],
    )
    stats = b.groupBy("_bkt", *part).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(m).alias(f"_s_{m}") for m in measures]
    )
    before = Window.partitionBy(*part).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    following = Window.partitionBy(*part).orderBy("_bkt")
    if lags:
        firsts = local.where("_lrn = 1").select("_bkt", *part, F.struct(*lags).alias("_first"))
        stats = null_safe_join(stats, firsts, ["_bkt", *part])
    offsets = stats.select(
        "_bkt",
        *part,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        *[F.sum(f"_s_{m}").over(before).alias(f"_off_{m}") for m in measures],
        *([F.sum("_n").over(Window.partitionBy(*part)).alias("_total")] if with_total else []),
        *([F.lead("_first").over(following).alias("_next")] if lags else []),
    )
    # without partition columns there is one row per range partition of the input
    joined = null_safe_join(local, offsets if part else F.broadcast(offsets), ["_bkt", *part])
    return joined.select(
        *df.columns,
        (F.col("_off") + F.col("_lrn")).alias(rn_col),
        *[_plus(F.col(f"_off_{m}"), F.col(f"_run_{m}")).alias(f"cum_{m}") for m in measures],
        *(["_total"] if with_total else []),
        *[
            F.when(F.col(f"_lead_{c}").isNotNull(), F.col(f"_lead_{c}")[c]).otherwise(F.col("_next")[c]).alias(f"next_{c}")
            for c in lags
        ],
    )


def _plus(before: Column, here: Column) -> Column:
    """Sum of two partial sums; NULL only if both hold no value, as SUM() gives it."""
    return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here)


def global_row_number(df, order_cols, out: str, descending=(), partition_cols=(), n_buckets=None):
    return global_prefix(df, order_cols, (), partition_cols, descending, out, n_buckets)


def global_cumsum(df, order_cols, measure: str, out: str, descending=(), n_buckets=None):
    res = global_prefix(df, order_cols, (measure,), (), descending, "_rn", n_buckets)
    return res.withColumnRenamed(f"cum_{measure}", out).drop("_rn")


def ntile_of(rn: Column, n: Column, k: int) -> Column:
    """NTILE(k) of row ``rn`` of ``n``: sizes differ by at most one, larger tiles first."""
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    return (
        F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1)
        .otherwise(F.floor((rn - 1 - big) / F.greatest(q, F.lit(1))) + r + 1)
        .cast("int")
    )


def global_ntile(df, order_cols, k: int, out: str, descending=(), n_buckets=None, partition_cols=()):
    res = global_prefix(df, order_cols, (), partition_cols, descending, "_rn", n_buckets, with_total=True)
    return res.withColumn(out, ntile_of(F.col("_rn"), F.col("_total"), k)).drop("_rn", "_total")


def value_ranks(df: DataFrame, value_col: str, partition_cols=(), n_buckets=None):
    """Histogram of ``value_col`` with rank statistics per distinct value.

    Columns: partition cols, value, ``_cnt``, ``_below`` (rows ordered before
    it, NULL first), ``_total`` (rows in the partition).
    """
    part = list(partition_cols)
    hist = df.groupBy(*part, value_col).agg(F.count(F.lit(1)).alias("_cnt"))
    pref = global_prefix(hist, [value_col], ("_cnt",), part, (), "_hrn", n_buckets)
    pref = pref.select(*part, value_col, "_cnt", (F.col("cum__cnt") - F.col("_cnt")).alias("_below"))
    if part:
        totals = pref.groupBy(*part).agg(F.sum("_cnt").alias("_total"))
        return null_safe_join(pref, totals, part)
    # One row: the grand total (a provably single-row broadcast).
    return pref.crossJoin(F.broadcast(pref.agg(F.sum("_cnt").alias("_total"))))


def group_quantiles(long: DataFrame, groups, value_col: str, probs, names, n_buckets=None) -> DataFrame:
    """PERCENTILE_CONT(p) of ``value_col`` per group, exact and distributed; NULL values are skipped.

    Works on the value histogram of all groups at once, so no task ever holds
    all values of a group: the value at 0-based position q is the histogram row
    with _below <= q < _below + _cnt; then lo + (hi - lo) * frac(p * (n - 1)).
    """
    groups = list(groups)
    h = value_ranks(long.where(F.col(value_col).isNotNull()), value_col, groups, n_buckets)
    aggs = [F.max("_total").alias("_n")]
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        for tag, q in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (F.col("_below") <= q) & (q < F.col("_below") + F.col("_cnt"))
            aggs.append(F.max(F.when(hit, F.col(value_col))).alias(f"_{tag}{i}"))
    row = h.groupBy(*groups).agg(*aggs) if groups else h.agg(*aggs)
    out = []
    for i, (p, name) in enumerate(zip(probs, names, strict=True)):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        frac = pos - F.floor(pos)
        lo, hi = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double")
        out.append((lo + (hi - lo) * frac).alias(name))
    return row.select(*groups, *out)


def unpivot(df: DataFrame, cols, keys=(), name: str = "_column", value: str = "_value") -> DataFrame:
    """One row per row and column, values as DOUBLE; NaN counts as NULL."""
    pairs = [F.struct(F.lit(c).alias(name), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(value)) for c in cols]
    return df.select(*keys, F.explode(F.array(*pairs)).alias("_p")).select(*keys, f"_p.{name}", f"_p.{value}")


def column_quantiles(df: DataFrame, cols, probs, names, groups=(), n_buckets=None) -> DataFrame:
    """Exact quantiles of several columns in one histogram and one prefix: (groups, _column, names...).

    A column without a value has a row of NULLs only where the group exists."""
    return group_quantiles(unpivot(df, cols, groups), [*groups, "_column"], "_value", probs, names, n_buckets)


def quantile_row(df: DataFrame, cols, probs, tags, n_buckets=None) -> DataFrame:
    """The quantiles of ``cols`` as one row of columns ``<col>__<tag>``."""
    q = column_quantiles(df, cols, probs, tags, (), n_buckets)
    return q.agg(
        *[F.max(F.when(F.col("_column") == c, F.col(t))).alias(f"{c}__{t}") for c in cols for t in tags]
    )


def exact_quantiles(df: DataFrame, value_col: str, probs, names, n_buckets=None) -> DataFrame:
    """Exact quantiles of one column; one-row result."""
    return group_quantiles(df.select(value_col), (), value_col, probs, names, n_buckets)


def global_rank(df: DataFrame, value_col: str, out: str, partition_cols=(), pct: bool = False, n_buckets=None):
    """RANK() (or PERCENT_RANK() with ``pct``) ordered by ``value_col`` ascending, NULL first."""
    part = list(partition_cols)
    hist = value_ranks(df, value_col, part, n_buckets)
    # No hint: AQE broadcasts the histogram when its measured size is small,
    # otherwise keeps a sort-merge join whose hot key the skew-join splits.
    j = null_safe_join(df, hist, [*part, value_col])
    rank = F.col("_below") + 1
    if pct:
        val = F.when(F.col("_total") <= 1, F.lit(0.0)).otherwise(
            (rank - 1).cast("double") / (F.col("_total") - 1).cast("double")
        )
    else:
        val = rank
    return j.withColumn(out, val).drop("_cnt", "_below", "_total")


def average_rank(df: DataFrame, value_col: str, out: str, n_buckets=None, partition_cols=()):
    """Average (fractional) rank of ``value_col``: ties share the mean rank."""
    part = list(partition_cols)
    rows = df.filter(F.col(value_col).isNotNull())
    j = null_safe_join(rows, value_ranks(rows, value_col, part, n_buckets), [*part, value_col])
    return j.withColumn(out, F.col("_below") + (F.col("_cnt") + 1) / 2.0).drop("_cnt", "_below", "_total")


def moving_average_rows(
    df: DataFrame, order_cols, measure: str, rows: int, out: str, block: int | None = None, exact: bool = False,
    numbered: DataFrame | None = None, n_buckets: int | None = None,
):
    """AVG(measure) OVER (ORDER BY order_cols ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW).

    Rows are numbered globally (or come ``numbered``, as a table with ``_rn``),
    cut into blocks of ``block`` rows, and the last ``rows - 1`` rows of each
    block are copied into the next block as a halo, so every frame is computed
    inside one block. ``exact`` sums the frame as DECIMAL (money) so the result
    does not depend on summation order.
    """
    from tidemark.session import materialize

    if numbered is None:
        numbered = materialize(global_prefix(df, order_cols, (), (), (), "_rn", n_buckets))
    block = max(block or ROWS_PER_BLOCK, rows)
    blk = F.floor((F.col("_rn") - 1) / F.lit(block))
    base = numbered.withColumn("_blk", blk).withColumn("_halo", F.lit(False))
    tail = (
        numbered.filter(((F.col("_rn") - 1) % F.lit(block)) >= F.lit(block - (rows - 1)))
        .withColumn("_blk", blk + 1)
        .withColumn("_halo", F.lit(True))
    )
    both = base.unionByName(tail) if rows > 1 else base
    w = Window.partitionBy("_blk").orderBy("_rn").rowsBetween(-(rows - 1), 0)
    return (
        both.withColumn(
            out,
            F.try_divide(F.sum(F.col(measure).cast("decimal(24,6)")).over(w).cast("double"), F.count(measure).over(w))
            if exact
            else F.avg(measure).over(w),
        )
        .filter(~F.col("_halo"))
        .drop("_blk", "_halo")
    )


def moving_average_days(df: DataFrame, date_col: str, measure: str, days: int, out: str) -> DataFrame:
    """AVG(measure) over the rows of the last ``days`` calendar days, the row's own day included.

    Rows are first combined per day, so the window runs over one row per calendar day and a day holding a third of
    all rows is one of them; rows without a date get NULL.
    """
    daily = df.where(F.col(date_col).isNotNull()).groupBy(date_col).agg(
        F.sum(F.col(measure).cast("decimal(24,6)")).alias("_s"), F.count(measure).alias("_c")
    )
    w = Window.orderBy(F.unix_date(date_col)).rangeBetween(-(days - 1), 0)
    avg = F.try_divide(F.sum("_s").over(w).cast("double"), F.sum("_c").over(w))
    return null_safe_join(df, daily.select(date_col, avg.alias(out)), [date_col], "left")
