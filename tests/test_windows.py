"""Range-partitioned global windows equal Spark's single-partition windows, NULLs included."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF01
from tidemark.operators import windows as W


def _li(spark):
    # orders: unique id, a tie-heavy key (price band) and a measure
    return spark.read.parquet(f"{SF01}/orders.parquet").select(
        F.col("o_orderkey").alias("id"),
        F.floor(F.col("o_totalprice") / 20000).cast("double").alias("l_quantity"),
        F.col("o_totalprice").alias("l_extendedprice"),
    )


def _odd(spark):
    """NULL keys of several types, NULL partitions and ids that repeat in pairs."""
    return spark.range(600).select(
        F.col("id").alias("row"),
        (F.col("id") % 300).alias("id"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 40).alias("k_long"),
        F.when(F.col("id") % 5 > 0, (F.col("id") * 37 % 101).cast("double")).alias("k_double"),
        F.when(F.col("id") % 6 > 0, F.concat(F.lit("s"), F.col("id") % 23)).alias("k_string"),
        F.when(F.col("id") % 4 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int"))).alias("k_date"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("part"),
        (F.col("id") * 0.5).alias("v"),
    )


@pytest.mark.parametrize("buckets", [1, 8, 300])
@pytest.mark.parametrize("key", ["k_long", "k_double", "k_string", "k_date"])
def test_prefix_with_null_keys_and_partitions(spark, key, buckets):
    df = _odd(spark)
    down = ("k_long",) if key == "k_long" else ()
    got = W.global_prefix(df, [key, "row"], ("v",), ("part",), down, "rn", buckets, with_total=True, lags=("v",))
    w = Window.partitionBy("part").orderBy(F.col(key).desc() if down else F.col(key), "row")
    want = df.select(
        "row",
        F.row_number().over(w).alias("rn"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_v"),
        F.count(F.lit(1)).over(Window.partitionBy("part")).alias("_total"),
        F.lead("v").over(w).alias("next_v"),
    )
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("buckets", [1, 8])
@pytest.mark.parametrize("key", ["k_long", "k_double", "k_string", "k_date"])
def test_ranks_with_null_values(spark, key, buckets):
    df = _odd(spark)
    w = Window.partitionBy("part").orderBy(key)
    want = df.select("row", F.rank().over(w).alias("r"), F.percent_rank().over(w).alias("p"))
    got = W.global_rank(df, key, "r", ("part",), n_buckets=buckets).select("row", "r")
    pct = W.global_rank(df, key, "p", ("part",), True, buckets).select("row", "p")
    assert sorted(map(tuple, got.join(pct, "row").collect())) == sorted(map(tuple, want.collect()))


def test_ntile_and_moving_average_with_nulls(spark):
    df = _odd(spark)
    w = Window.orderBy("k_double", "row")
    want = df.select("row", F.ntile(7).over(w).alias("t"), F.avg("v").over(w.rowsBetween(-4, 0)).alias("m"))
    tile = W.global_ntile(df, ["k_double", "row"], 7, "t", n_buckets=5).select("row", "t")
    avg = W.moving_average_rows(df, ["k_double", "row"], "v", 5, "m", block=50, n_buckets=5).select("row", "m")
    got = {r["row"]: (r["t"], pytest.approx(r["m"])) for r in tile.join(avg, "row").collect()}
    assert {r["row"]: (r["t"], r["m"]) for r in want.collect()} == got


def test_row_number_cumsum_ntile(spark):
    df = _li(spark)
    got = W.global_prefix(df, ["l_quantity", "id"], ("l_extendedprice",), rn_col="rn", n_buckets=8)
    got = W.global_ntile(got, ["l_quantity", "id"], 4, "tile", n_buckets=8)
    w = Window.orderBy("l_quantity", "id")
    ref = df.select(
        "id",
        F.row_number().over(w).alias("rn_ref"),
        F.sum("l_extendedprice").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_ref"),
        F.ntile(4).over(w).alias("tile_ref"),
    )
    j = got.join(ref, "id")
    bad = j.filter(
        (F.col("rn") != F.col("rn_ref"))
        | (F.abs(F.col("cum_l_extendedprice") - F.col("cum_ref")) > 1e-6 * F.abs(F.col("cum_ref")))
        | (F.col("tile") != F.col("tile_ref"))
    ).count()
    assert j.count() == df.count()
    assert bad == 0


def test_percent_rank_ties(spark):
    df = _li(spark)
    got = W.global_rank(df, "l_quantity", "pr", pct=True, n_buckets=8)
    got = W.average_rank(got, "l_quantity", "ar", n_buckets=8)
    w = Window.orderBy("l_quantity")
    ref = df.select(
        "id", F.percent_rank().over(w).alias("pr_ref"), F.rank().over(w).alias("r"), F.count(F.lit(1)).over(
            Window.partitionBy("l_quantity")
        ).alias("c")
    )
    j = got.join(ref, "id")
    bad = j.filter(
        (F.abs(F.col("pr") - F.col("pr_ref")) > 1e-12) | (F.col("ar") != F.col("r") + (F.col("c") - 1) / 2.0)
    ).count()
    assert bad == 0


def test_moving_average_halo(spark):
    df = _li(spark)
    got = W.moving_average_rows(df, ["l_extendedprice", "id"], "l_quantity", 30, "ma", block=1000)
    w = Window.orderBy("l_extendedprice", "id").rowsBetween(-29, 0)
    ref = df.select("id", F.avg("l_quantity").over(w).alias("ma_ref"))
    j = got.join(ref, "id")
    assert j.count() == df.count()
    assert j.filter(F.abs(F.col("ma") - F.col("ma_ref")) > 1e-9).count() == 0


def test_quantiles_of_columns_and_groups(spark):
    df = _odd(spark).withColumn("k_double", F.when(F.col("row") == 1, float("nan")).otherwise(F.col("k_double")))
    cols = ["k_long", "k_double", "v"]
    got = {r["_column"]: (r["a"], r["b"]) for r in W.column_quantiles(df, cols, [0.25, 0.9], ["a", "b"]).collect()}
    clean = df.withColumn("k_double", F.nanvl("k_double", F.lit(None)))
    want = clean.agg(*[F.percentile(c, [0.25, 0.9]).alias(c) for c in cols]).first()
    assert got == {c: pytest.approx(tuple(want[c])) for c in cols}
    per = W.group_quantiles(clean.select("part", "v"), ["part"], "v", [0.5], ["m"]).collect()
    ref = {r["part"]: r["m"] for r in clean.groupBy("part").agg(F.median("v").alias("m")).collect()}
    assert {r["part"]: r["m"] for r in per} == ref and len(ref) == 3


def test_exact_quantiles(spark):
    df = _li(spark)
    q = W.exact_quantiles(df, "l_extendedprice", [0.25, 0.5, 0.9], ["a", "b", "c"], n_buckets=8).first()
    ref = df.agg(F.percentile("l_extendedprice", [0.25, 0.5, 0.9]).alias("p")).first()["p"]
    for got, want in zip((q["a"], q["b"], q["c"]), ref):
        assert abs(got - want) <= 1e-9 * abs(want)


def test_many_buckets(spark):
    df = _li(spark)
    got = W.global_prefix(df, ["l_quantity", "id"], ("l_extendedprice",), rn_col="rn", n_buckets=300)
    w = Window.orderBy("l_quantity", "id")
    ref = df.select("id", F.row_number().over(w).alias("rn_ref"))
    j = got.join(ref, "id")
    assert j.count() == df.count()
    assert j.filter(F.col("rn") != F.col("rn_ref")).count() == 0
    pr = W.global_rank(df, "l_extendedprice", "pr", pct=True, n_buckets=300)
    ref2 = df.select("id", F.percent_rank().over(Window.orderBy("l_extendedprice")).alias("pr_ref"))
    assert pr.join(ref2, "id").filter(F.abs(F.col("pr") - F.col("pr_ref")) > 1e-12).count() == 0
