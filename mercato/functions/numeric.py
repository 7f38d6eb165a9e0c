"""Numeric policy: exact decimals inside, doubles only at the edge.

* Money is ``DECIMAL(12,2)`` and rates ``DECIMAL(4,2)`` from the silver boundary
  on; sums of decimals are exact and independent of partitioning, so results do
  not change with the number of executors or the shuffle order.
* Ratios are computed in double from exact operands and rounded with
  :func:`round_half_up`, a fixed sequence of IEEE operations that the SQL oracle
  spells the same way.
* Every denominator goes through ``nullif(den, 0)`` (ANSI mode raises on /0).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def rate(c: str | Column) -> Column:
    return col(c).cast(RATE)


def dbl(c: str | Column) -> Column:
    return col(c).cast("double")


def round_half_up(x: str | Column, n: int) -> Column:
    """sign(x) * floor(|x| * 10^n + 0.5) / 10^n, all in double."""
    x = dbl(x)
    p = float(10 ** n)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(p) + F.lit(0.5)).cast("double") / F.lit(p)


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den in double, NULL when den is 0 or NULL."""
    return dbl(num) / F.nullif(dbl(den), F.lit(0.0))


def ratio_pct(num: str | Column, den: str | Column, n: int = 2) -> Column:
    """round(num / den * 100, n)."""
    return round_half_up(ratio(num, den) * F.lit(100.0), n)


def growth_pct(cur: str | Column, prev: str | Column, n: int = 2) -> Column:
    """round((cur - prev) / prev * 100, n); difference taken before the cast."""
    return round_half_up(dbl(col(cur) - col(prev)) / F.nullif(dbl(prev), F.lit(0.0)) * F.lit(100.0), n)


def exact_avg(x: str | Column, scale: int | None = None) -> Column:
    """Average with an order-independent sum.

    ``scale`` given: the values are doubles with at most ``scale`` decimals and
    are summed as decimals.  Integers and decimals are summed as they are.
    """
    c = col(x)
    if scale is not None:
        c = c.cast(f"decimal(30,{scale})")
    return dbl(F.sum(c)) / F.nullif(F.count(c).cast("double"), F.lit(0.0))


def count_if_pct(pred: Column, n: int = 2) -> Column:
    """Share of rows matching ``pred`` in percent: sum(case) / count(*) * 100."""
    return round_half_up(
        F.sum(F.when(pred, 1).otherwise(0)).cast("double")
        / F.nullif(F.count(F.lit(1)).cast("double"), F.lit(0.0)) * F.lit(100.0), n)


def to_double_money(df, *cols: str):
    """Cast the given decimal columns to double (the final projection)."""
    return df.withColumns({c: dbl(c) for c in cols})
