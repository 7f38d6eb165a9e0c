"""Clustered layout: a space-filling curve over ranks, with the table key behind it.

A range filter on any one of the clustering columns should skip most files.  Sorting
by the columns one after the other serves the first only, and a column of five values
leaves five ranges whatever the size of the table.  Here every column is turned into a
rank code of equal steps, the codes' bits are interleaved, and the table is cut into
ranges of (curve, key).  Rows that agree in all clustering columns are spread by the
key, so a hot value fills as many files as its rows need.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_STEP = 40
MAX_BITS = 8


def _steps(df: DataFrame, columns: list[str], bits: int, seed: int) -> dict[str, list]:
    """Distinct values that cut each column into up to 2**bits steps of about equal rows.

    From a sample whose size depends on ``bits`` only; the cuts are constants afterwards.
    """
    steps = 1 << bits
    draws = steps * SAMPLE_PER_STEP
    # drawn from all rows; every task hands over at most ``draws`` of its own
    rows = df.select(*columns).orderBy(F.rand(seed)).limit(draws).collect()
    out = {}
    for c in columns:
        values = sorted(r[c] for r in rows if r[c] is not None)
        out[c] = sorted({values[i * len(values) // steps] for i in range(1, steps)}) if values else []
    return out


def _at_least(column: str, cuts: list, low: int, high: int) -> Column:
    """How many cuts the value reaches, by halving."""
    if low >= high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(F.col(column) < F.lit(cuts[mid]), _at_least(column, cuts, low, mid)) \
        .otherwise(_at_least(column, cuts, mid + 1, high))


def rank_code(column: str, cuts: list, bits: int) -> Column:
    """The value's step, stretched over [0, 2**bits); null first."""
    top = (1 << bits) - 1
    step = F.when(F.col(column).isNull(), 0).otherwise(1 + _at_least(column, cuts, 0, len(cuts)))
    return F.floor(step * top / (len(cuts) + 1)).cast("long")


def interleave(codes: list[Column], bits: int) -> Column:
    """One number from the codes' bits, highest first, one column after the other."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i, code in enumerate(codes):
            place = bit * len(codes) + len(codes) - 1 - i
            out = out.bitwiseOR(F.shiftleft(F.shiftright(code, bit).bitwiseAND(F.lit(1)), place))
    return out


def curve(df: DataFrame, columns: list[str], files: int, seed: int = 42) -> Column:
    """Place of a row on the curve, fine enough for ``files`` ranges."""
    bits = min(MAX_BITS, 62 // len(columns), max(4, math.ceil(math.log2(max(2, files)) / len(columns)) + 2))
    cuts = _steps(df, columns, bits, seed)
    return interleave([rank_code(c, cuts[c], bits) for c in columns], bits)


def cluster(df: DataFrame, columns: list[str], key: list[str] | None = None, files: int | None = None) -> DataFrame:
    """Rows in ranges of (curve, key), sorted within each.

    ``key`` spreads rows of equal clustering values; by default a hash of the whole row,
    which leaves only equal rows together.
    Without ``files`` the session's shuffle partitions are the ranges, and small ones are
    put together by their measured size.
    """
    ranges = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tail = [F.col(k) for k in key] if key else [F.xxhash64(*df.columns)]
    by = [F.col("_curve"), *[F.col(f"_tail{i}") for i in range(len(tail))]]
    placed = df.withColumns({"_curve": curve(df, columns, ranges), **{f"_tail{i}": t for i, t in enumerate(tail)}})
    cut = placed.repartitionByRange(files, *by) if files else placed.repartitionByRange(*by)
    return cut.sortWithinPartitions(*by).drop("_curve", *[f"_tail{i}" for i in range(len(tail))])
