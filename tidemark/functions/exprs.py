"""Column-expression helpers shared by all operators (all JVM-side, codegen'd).

Rounding and money arithmetic are exact so that results do not depend on
partitioning or on the order in which partial aggregates are merged:

* ``money_sum`` sums amounts as DECIMAL (exact; equal on every retry and for
  any partition count) instead of floating point.
* ``rnd`` rounds HALF_UP after removing binary noise (cast to DECIMAL with 9
  places first), so 0.285 rounds to 0.29 whatever its binary neighbour is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: amounts below 1e18 with six places; their sums keep 34 digits
MONEY = "decimal(24,6)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, n: int) -> Column:
    """ROUND(x, n) HALF_UP on the decimal value of ``x``; returns DOUBLE. From 1e29 on a DOUBLE has no places to round."""
    return F.coalesce(F.round(col(c).try_cast("decimal(38,9)"), n).cast("double"), col(c).cast("double"))


def money_sum(c) -> Column:
    """Exact SUM of an amount column (DECIMAL accumulator)."""
    return F.sum(col(c).cast(MONEY))


def money_avg(c) -> Column:
    """AVG of an amount column from the exact sum; DOUBLE result."""
    return (money_sum(c).cast("double") / F.count(col(c))).cast("double")


def pct(num, den) -> Column:
    """100 * num / den as DOUBLE, NULL when den is 0 (ANSI-safe)."""
    return F.try_divide(F.lit(100.0) * col(num).cast("double"), col(den).cast("double"))


def count_when(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END) as BIGINT."""
    return F.count(F.when(cond, F.lit(1))).cast("long")


def uniform_draw(key, period: int, seed: int = 42) -> Column:
    """Deterministic U[0,1) from (key, period, seed): the first 52 bits of an md5.

    A pure function of the row, so re-executed tasks (lost executors) and any
    partitioning produce the same draw, unlike ``rand()``; draws of different
    periods or seeds are independent, and no key repeats another's draw.
    """
    text = F.concat(col(key).cast("string"), F.lit(f"|{period}|{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rnd_sql(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST(({x}) AS DECIMAL(38,9)), {n}) AS DOUBLE)"


def money_sum_sql(x: str) -> str:
    return f"SUM(CAST(({x}) AS DECIMAL(18,6)))"


def money_avg_sql(x: str) -> str:
    return f"(CAST({money_sum_sql(x)} AS DOUBLE) / COUNT({x}))"
