"""Distributed global ranking: ``ntile`` and exact percentiles without one task.

``ntile(n) OVER (ORDER BY x)`` with no partition makes Spark move every row into
a single partition and sort it there.  Over a per-customer table that is the
whole customer base in one task.  Two ways around it:

* ``global_rank`` numbers all rows: range partitions over the full composite key,
  sorted in place and stored, so a row's place in its range is fixed; the sizes of
  the ranges turn into offsets.  One shuffle, no window; ranges are sorted with
  spilling, and their number grows with the rows.
* ``ntiles`` needs only the first key of each tile and finds it by narrowing: a
  bounded sample of each piece, exact counts, and a smaller piece.

Keys include a unique tie-break column, so a single hot value of the order column
is split as well.  Inputs of at most ``rows_per_bucket`` rows rank in one window
(the count proves the bound).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BUCKET = 2_000_000
SAMPLE_PER_BOUNDARY = 4_000

Order = Sequence[tuple[str, bool]]  # (column, ascending); NULLS FIRST asc, NULLS LAST desc


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the cluster's shared checkpoint folder.

    Ranking reads its input several times (count, sample, bucket counts,
    final pass); materialising once cuts the lineage so those passes read
    stored rows instead of recomputing the input plan, and a lost executor
    does not re-run the upstream stages.
    """
    from mercato.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _sort(order: Order) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]


def _key_columns(df: DataFrame, order: Order, prefix: str = "_k") -> tuple[DataFrame, list[str]]:
    """Encode each order column as (null flag, ascending value) columns."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols, names = {}, []
    for i, (c, asc) in enumerate(order):
        t = types[c]
        v = F.col(c)
        if isinstance(t, (T.DateType,)):
            v = F.datediff(v, F.lit("1970-01-01").cast("date")).cast("long")
            zero = F.lit(0).cast("long")
        elif isinstance(t, (T.StringType,)):
            if not asc:
                raise ValueError("descending string order is not supported")
            zero = F.lit("")
        elif isinstance(t, T.NumericType):
            zero = F.lit(0).cast(t)
        elif isinstance(t, T.BooleanType):
            v, zero = v.cast("int"), F.lit(0)
        else:
            raise TypeError(f"cannot rank on {t}")
        flag = F.col(c).isNotNull() if asc else F.col(c).isNull()
        val = F.coalesce(v, zero)
        if not asc:
            val = -val
        cols[f"{prefix}{i}n"] = flag.cast("int")
        cols[f"{prefix}{i}v"] = val
        names += [f"{prefix}{i}n", f"{prefix}{i}v"]
    return df.withColumns(cols), names


def _less(keys: list[str], cut: tuple) -> Column:
    """Lexicographic (keys) < cut."""
    expr = None
    for k, v in reversed(list(zip(keys, cut))):
        c = F.col(k)
        lit = F.lit(v)
        here = c < lit if expr is None else (c < lit) | ((c == lit) & expr)
        expr = here
    return expr


def global_rank(df: DataFrame, order: Order, rank_col: str = "_rank",
                rows_per_bucket: int = ROWS_PER_BUCKET, min_buckets: int = 1,
                materialized: bool = False) -> tuple[DataFrame, int]:
    """Add a 1-based ``rank_col`` (row number in ``order``); returns (df, row count).

    ``order`` must end with a unique key for the result to be deterministic.
    ``min_buckets``: cut into at least that many ranges, also for few rows.
    ``materialized``: the caller already checkpointed ``df``.
    """
    if not materialized:
        df = materialize(df)
    n = df.count()
    by = _sort(order)
    buckets = max(min_buckets, math.ceil(n / max(1, rows_per_bucket)))
    if buckets == 1:
        # n <= rows_per_bucket: one bounded window.
        return df.withColumn(rank_col, F.row_number().over(Window.orderBy(*by))), n
    placed = materialize(df.repartitionByRange(buckets, *by).sortWithinPartitions(*by)
                         .withColumn("_place", F.monotonically_increasing_id()))
    # the upper 31 bits of _place are the range, the lower 33 the place in it
    in_range = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    placed = placed.withColumn("_range", F.shiftright("_place", 33))
    sizes = placed.groupBy("_range").agg(F.max(in_range).alias("_size"))
    # one row per range, so at most n / rows_per_bucket of them
    offsets = sizes.select("_range", (F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")).alias("_before"))
    ranked = placed.join(offsets, "_range").withColumn(rank_col, F.col("_before") + in_range)
    return ranked.drop("_place", "_range", "_before"), n


@dataclass
class _Boundary:
    """Search for the key at one rank: it lies in [low, high), an open end being None."""

    keys: list[str]
    rank: int
    low: tuple | None
    high: tuple | None
    before: int  # rows below ``low``
    inside: int  # rows in [low, high)

    def holds(self) -> Column:
        out = F.lit(True)
        if self.low is not None:
            out = out & ~_less(self.keys, self.low)
        if self.high is not None:
            out = out & _less(self.keys, self.high)
        return out

    def guess(self, sample: list[tuple]) -> tuple[tuple | None, tuple | None]:
        """Sampled keys that very likely lie on either side of the rank."""
        k = len(sample)
        if k == self.inside:  # the whole piece
            at = self.rank - self.before - 1
            return sample[at], sample[at + 1] if at + 1 < k else None
        p = (self.rank - self.before - 0.5) / self.inside
        slack = 4 * math.sqrt(k * p * (1 - p)) + 2
        left, right = math.floor(k * p - slack), math.ceil(k * p + slack)
        return sample[left] if left >= 0 else None, sample[right] if right < k else None

    def narrow(self, low: tuple | None, high: tuple | None, under_low: int, under_high: int) -> None:
        """Take the guessed piece, or what is left of or right of it, by exact counts."""
        end = self.before + self.inside
        cuts = [(self.low, self.before), *([(low, under_low)] if low is not None else []),
                *([(high, under_high)] if high is not None else []), (self.high, end)]
        for (a, under_a), (b, under_b) in zip(cuts, cuts[1:], strict=False):
            if under_a < self.rank <= under_b:
                if under_b - under_a == self.inside and (a, b) == (self.low, self.high):
                    raise ValueError("the order does not end with a unique key")
                self.low, self.high, self.before, self.inside = a, b, under_a, under_b - under_a
                return
        raise ValueError("the rows changed while they were ranked")


def _search(keyed: DataFrame, open_: list[_Boundary], seed: int) -> None:
    """One round for all boundaries: a bounded sample of each piece, then exact counts in one pass."""
    every = list(dict.fromkeys(k for b in open_ for k in b.keys))
    wanted = F.filter(F.array(*[F.when(b.holds() & (F.rand(seed + i) < min(1.0, SAMPLE_PER_BOUNDARY / b.inside)), i)
                                for i, b in enumerate(open_)]), lambda x: x.isNotNull())
    # about SAMPLE_PER_BOUNDARY rows a boundary, whatever the number of rows
    rows = keyed.select(*every, F.explode(wanted).alias("_boundary")).collect()
    guesses = []
    for i, b in enumerate(open_):
        guesses.append(b.guess(sorted(tuple(r[k] for k in b.keys) for r in rows if r["_boundary"] == i)))
    sums = [F.count_if(_less(b.keys, g) if g is not None else F.lit(False))
            for b, pair in zip(open_, guesses, strict=True) for g in pair]
    counts = keyed.agg(*sums).first()
    for i, (b, (low, high)) in enumerate(zip(open_, guesses, strict=True)):
        b.narrow(low, high, counts[2 * i], counts[2 * i + 1])


def _keys_at(keyed: DataFrame, boundaries: list[_Boundary], rows_per_bucket: int, seed: int) -> list[tuple]:
    """The exact key at each boundary's rank."""
    turn = 0
    while open_ := [b for b in boundaries if b.inside > rows_per_bucket]:
        _search(keyed, open_, seed + 1000 * turn)
        turn += 1
    found = []
    for keys in dict.fromkeys(tuple(b.keys) for b in boundaries):
        mine = [b for b in boundaries if tuple(b.keys) == keys]
        pieces = F.filter(F.array(*[F.when(b.holds(), F.struct(F.lit(i).alias("i"), F.lit(b.rank - b.before).alias("at")))
                                    for i, b in enumerate(mine)]), lambda x: x.isNotNull())
        # a piece has at most rows_per_bucket rows
        place = F.row_number().over(Window.partitionBy("_piece.i").orderBy(*keys))
        rows = (keyed.select(*keys, F.explode(pieces).alias("_piece")).withColumn("_at", place)
                .where(F.col("_at") == F.col("_piece.at")).collect())
        at = {r["_piece"]["i"]: tuple(r[k] for k in keys) for r in rows}
        found += [(b, at[i]) for i, b in enumerate(mine)]
    order = {id(b): i for i, b in enumerate(boundaries)}
    return [key for _, key in sorted(found, key=lambda f: order[id(f[0])])]


def ntiles(df: DataFrame, tiles: int, orders: dict[str, Order], rows_per_bucket: int = ROWS_PER_BUCKET,
           seed: int = 42, materialized: bool = False) -> DataFrame:
    """``ntile(tiles) OVER (ORDER BY ...)`` for several orders at once, a column each.

    Only the first key of every tile is searched for, so no row is sorted or moved:
    the input is stored and counted once, each round samples and counts for all orders
    together, and the tile is an expression over the row's own key.  Every round keeps
    about a sixteenth of a piece, until it has at most ``rows_per_bucket`` rows; what the
    driver sees does not depend on the number of rows.  Each order must end with a
    unique key.
    """
    if not materialized:
        df = materialize(df)
    n = df.count()
    if n <= rows_per_bucket:
        # one bounded window an order
        return df.withColumns({out: F.ntile(tiles).over(Window.orderBy(*_sort(order))) for out, order in orders.items()})
    keyed, names = df, {}
    for i, (out, order) in enumerate(orders.items()):
        keyed, names[out] = _key_columns(keyed, order, f"_k{i}_")
    q, r = divmod(n, tiles)
    starts = [t * q + min(t, r) + 1 for t in range(1, min(tiles, n))]
    boundaries = [_Boundary(names[out], rank, None, None, 0, n) for out in orders for rank in starts]
    keys = _keys_at(keyed, boundaries, rows_per_bucket, seed)
    tile = {out: F.lit(1) for out in orders}
    for j, out in enumerate(orders):
        for key in keys[j * len(starts):(j + 1) * len(starts)]:
            tile[out] = tile[out] + F.when(_less(names[out], key), 0).otherwise(1)
    return keyed.withColumns(tile).drop(*[k for ks in names.values() for k in ks])


def distributed_ntile(df: DataFrame, tiles: int, order: Order, out_col: str,
                      **kw) -> DataFrame:
    """``ntile(tiles) OVER (ORDER BY order)`` computed on all executors."""
    return ntiles(df, tiles, {out_col: order}, **kw)


def total_percentiles(df: DataFrame, probs: dict[str, tuple[str, float]], key: str,
                      rows_per_bucket: int = ROWS_PER_BUCKET, seed: int = 42) -> dict[str, float | None]:
    """Continuous percentiles over all rows, each (column, probability): exact numbers.

    Null values do not count; ``key`` is unique.  All are searched for together, as in
    ``ntiles``: the rows are stored once and counted once.
    """
    df = materialize(df.select(key, *dict.fromkeys(v for v, _ in probs.values())))
    values = list(dict.fromkeys(v for v, _ in probs.values()))
    counts = df.agg(F.count(F.lit(1)), *[F.count(v) for v in values]).first()
    keyed, names = df, {}
    for i, v in enumerate(values):
        keyed, names[v] = _key_columns(keyed, [(v, True), (key, True)], f"_k{i}_")
    boundaries, sides = [], {}
    for out, (v, p) in probs.items():
        n = counts[1 + values.index(v)]
        if n:
            pos = (n - 1) * p
            for rank in (math.floor(pos), math.ceil(pos)):  # nulls sort first
                boundaries.append(_Boundary(names[v], counts[0] - n + rank + 1, None, None, 0, counts[0]))
            sides[out] = (len(boundaries) - 2, pos - math.floor(pos))
    found = [float(k[1]) for k in _keys_at(keyed, boundaries, rows_per_bucket, seed)]
    return {out: found[sides[out][0]] + sides[out][1] * (found[sides[out][0] + 1] - found[sides[out][0]])
            if out in sides else None for out in probs}


def exact_percentiles(df: DataFrame, value: str, probs: dict[str, float],
                      group_cols: Sequence[str] = (), key: str | None = None,
                      **kw) -> DataFrame:
    """Continuous percentiles (linear interpolation) per group, exact.

    For n values sorted v[0..n-1] and p: pos = (n - 1) * p,
    result = v[floor(pos)] + (pos - floor(pos)) * (v[ceil(pos)] - v[floor(pos)]).
    Rows are ranked globally by (groups, value, key); only the <= 2 rows per
    probability and group are picked out, so no group is gathered in one task.
    """
    g = list(group_cols)
    base = df.where(F.col(value).isNotNull()).select(*g, F.col(value).cast("double").alias("_v"),
                                                     *([key] if key else []))
    order = [(c, True) for c in g] + [("_v", True)] + ([(key, True)] if key else [])
    ranked, _ = global_rank(base, order, rank_col="_r", **kw)
    stats = ranked.groupBy(*g).agg((F.min("_r") - 1).alias("_off"), F.count(F.lit(1)).alias("_n"))
    pos = {name: (F.col("_n") - 1).cast("double") * F.lit(float(p)) for name, p in probs.items()}
    stats = stats.withColumns({f"_pos_{k}": v for k, v in pos.items()})
    stats = stats.withColumns({f"_lo_{k}": F.floor(F.col(f"_pos_{k}")) for k in probs})
    stats = stats.withColumns({f"_hi_{k}": F.ceil(F.col(f"_pos_{k}")) for k in probs})
    if g:
        # one row per group; the planner broadcasts it when small, else shuffles.
        s = stats.select(*[F.col(a).alias(f"_sg{i}") for i, a in enumerate(g)],
                         *[c for c in stats.columns if c not in g])
        cond = _and([F.col(a).eqNullSafe(F.col(f"_sg{i}")) for i, a in enumerate(g)])
        joined = ranked.join(s, cond, "inner")
    else:
        joined = ranked.crossJoin(F.broadcast(stats))  # no groups: exactly one stats row
    rel = F.col("_r") - F.col("_off") - 1
    want = None
    for k in probs:
        c = (rel == F.col(f"_lo_{k}")) | (rel == F.col(f"_hi_{k}"))
        want = c if want is None else want | c
    picked = joined.where(want)
    gsel = list(g)
    aggs = []
    for k in probs:
        aggs += [F.max(F.when(rel == F.col(f"_lo_{k}"), F.col("_v"))).alias(f"_lv_{k}"),
                 F.max(F.when(rel == F.col(f"_hi_{k}"), F.col("_v"))).alias(f"_hv_{k}"),
                 F.first(F.col(f"_pos_{k}")).alias(f"_p_{k}"),
                 F.first(F.col(f"_lo_{k}")).alias(f"_l_{k}")]
    out = picked.groupBy(*gsel).agg(*aggs)
    res = out.select(*g, *[
        (F.col(f"_lv_{k}") + (F.col(f"_p_{k}") - F.col(f"_l_{k}").cast("double"))
         * (F.col(f"_hv_{k}") - F.col(f"_lv_{k}"))).alias(k) for k in probs])
    return res


def _and(cs):
    out = cs[0]
    for c in cs[1:]:
        out = out & c
    return out
