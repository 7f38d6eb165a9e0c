"""Size-checked broadcast.

``F.broadcast`` bypasses Spark's own size check, so it is only applied behind a
bound: the optimizer's row/size estimate of the side must be under the limit.
Above it the plain DataFrame is returned and the planner picks a shuffle join
(or AQE turns it into a broadcast at runtime when the measured size is small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BYTES = 64 * 1024 * 1024


def plan_stats(df: DataFrame) -> tuple[int | None, int]:
    """(row count estimate or None, size estimate in bytes) from the optimized plan."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    size = _num(stats.sizeInBytes())
    rows = stats.rowCount()
    n = _num(rows.get()) if rows.isDefined() else None
    return n, size


def _bytes(text: str) -> int:
    t = text.strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    t = t[:-1] if t.endswith("b") else t
    if t and t[-1] in units:
        return int(float(t[:-1]) * units[t[-1]])
    return int(t)


def _num(v) -> int:
    """py4j returns Scala BigInt either converted or as an object."""
    return int(v) if isinstance(v, int) else int(v.toString())


def broadcast_bounded(df: DataFrame, max_rows: int | None = None,
                      max_bytes: int | None = None, like: DataFrame | None = None,
                      width_factor: float = 2.0) -> DataFrame:
    """Broadcast ``df`` only if its estimated size is within the bounds.

    ``like``: a plan whose statistics bound ``df`` better than ``df``'s own
    (e.g. the base table of a dimension built by key lookups, which has the
    same rows; Spark's default estimate multiplies join inputs).  Its size is
    scaled by ``width_factor`` for the added columns.
    ``max_bytes`` defaults to four times the session's broadcast threshold;
    a disabled threshold (-1) disables broadcasting here too.
    """
    if max_bytes is None:
        conf = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
        thr = _bytes(conf)
        if thr < 0:
            return df
        max_bytes = min(DEFAULT_MAX_BYTES, 4 * thr)
    try:
        rows, size = plan_stats(like if like is not None else df)
        if like is not None:
            size = int(size * width_factor)
    except Exception:
        return df
    if size > max_bytes:
        return df
    if max_rows is not None and rows is not None and rows > max_rows:
        return df
    return F.broadcast(df)
