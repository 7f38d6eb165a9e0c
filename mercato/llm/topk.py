"""Exact inner-product top-k by no-random-access aggregation.

A vector's components are attributes, and the score of a candidate for a query
is the sum of ``q[d] * x[d]`` over the attributes.  For each attribute the
candidates form a list sorted by that product.  All lists are read from the top
in rounds of equal depth.  What has been read of a candidate, and the last value
read of each list it has not been met in, bound its score from above; the least
value of those lists bounds it from below.  A query stops as soon as few enough
candidates have an upper bound that reaches the k-th largest lower bound: no
outsider can qualify then.  The scores of those that remain are resolved
exactly, as integers.

For any query the list of an attribute is the attribute's sorted order, read
from one end or the other by the sign of ``q[d]``.  So a block of candidates
is sorted once for all queries, and a round's bounds for a block of queries are
a few matrix products.

Blocks of queries meet blocks of candidates, each pair of blocks in one task of
bounded size that returns its best k for each query; a window over those few
rows picks the final k.

Defined results: vectors that are null, or hold a null or non-finite component,
and rows without an id take no part; a shorter vector counts as filled up with
zeros; rows that share a query's id are not its candidates; a query row that
repeats is asked once, and rows of one id with different vectors are queries of
their own, each with its ranks; ties go to the
smaller id, then to nothing (equal rows are all listed as far as k goes); with
fewer than k candidates all are returned; scores beyond a long are held at its
bounds; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import shuffle_partitions

_MOST = 1 << 63


def to_integers(vectors, scale: int) -> np.ndarray:
    """floor(scale * x) of every component; rows filled up with zeros.

    Exact: float64 holds whole numbers below 2**53, beyond that Python integers.
    """
    width = max((len(v) for v in vectors), default=0)
    x = np.zeros((len(vectors), width))
    for row, v in zip(x, vectors, strict=True):
        row[:len(v)] = v
    x = np.floor(x * scale)
    if x.size == 0 or np.abs(x).max() < 2.0 ** 53:
        return x.astype(np.int64)
    return np.array([[int(c) for c in row] for row in x], object)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products as int64, held at its bounds."""
    if a.dtype != object and b.dtype != object:
        top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
        if top < 2.0 ** 62:
            return np.einsum("ij,ij->i", a, b)
    return np.array([min(max(sum(int(p) * int(q) for p, q in zip(x, y, strict=True)), -_MOST), _MOST - 1)
                     for x, y in zip(a, b, strict=True)], np.int64)


def block_top(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int,
              rounds: int = 12, resolve: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, candidate index, score) of the best k of a block for each query."""
    n, width = x.shape
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    own = query_ids[:, None] == ids[None, :]
    exact = x.dtype != object and q.dtype != object and \
        float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(width, 1) < 2.0 ** 53
    going = np.arange(len(q))
    if exact and n > resolve * k:
        order = np.argsort(x, axis=0, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(n)[:, None], 0)
        ranked = np.take_along_axis(x, order, 0).astype(np.float64)  # each list in ascending order
        xf, qf = x.astype(np.float64), q.astype(np.float64)
        up, down = np.maximum(qf, 0), np.minimum(qf, 0)  # lists read from the top, and from the bottom
        for step in range(1, rounds + 1):
            depth = min(n, -(-n * step // rounds))
            met_top, met_bottom = rank >= n - depth, rank < depth
            a, b = up[going].T, down[going].T
            seen = (xf * met_top) @ a + (xf * met_bottom) @ b
            not_top, not_bottom = (~met_top).astype(np.float64), (~met_bottom).astype(np.float64)
            most = seen + not_top @ (ranked[n - depth][:, None] * a) + not_bottom @ (ranked[depth - 1][:, None] * b)
            least = seen + not_top @ (ranked[0][:, None] * a) + not_bottom @ (ranked[n - 1][:, None] * b)
            hidden = own[going].T
            most[hidden] = least[hidden] = -np.inf
            bar = np.partition(least, n - k, axis=0)[n - k]
            open_ = (most >= bar) & ~hidden
            done = (open_.sum(0) <= resolve * k) | (depth == n)
            if done.any():
                at, which = np.nonzero(open_[:, done])
                out.append((going[done][which], at, _dots(x[at], q[going[done][which]])))
                going = going[~done]
            if not going.size:
                break
    for j in going:
        at = np.flatnonzero(~own[j])
        out.append((np.full(at.size, j), at, _dots(x[at], np.broadcast_to(q[j], (at.size, width)))))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    who, at, score = (np.concatenate(c) for c in zip(*out, strict=True))
    best = np.lexsort((ids[at], ~score, who))  # ~ reverses the order, also at the bounds
    who, at, score = who[best], at[best], score[best]
    place = np.arange(who.size) - np.searchsorted(who, who)
    return who[place < k], at[place < k], score[place < k]


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
                vector_col: str = "embedding", candidate_block: int = 4096, query_block: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best candidates.

    ``is_query`` marks the query rows; every row is a candidate.  Blocks never
    exceed the given sizes by more than chance, and there are enough of them for
    every task to have work.
    """
    spark = vectors.sparkSession
    fine = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    src = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine) \
        .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("is_query"))
    n, m = src.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    tasks = shuffle_partitions(spark)
    columns = max(1, -(-n // candidate_block), min(2 * tasks, -(-n // 32)))
    rows = max(1, -(-m // query_block))
    deal = F.xxhash64("id", "v")
    cells = src.withColumn("column", F.pmod(deal, F.lit(columns))) \
        .withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))) \
        .select((F.col("column") * rows + F.col("row")).alias("cell"), "id", "v")
    asks = src.filter("is_query").dropDuplicates(["id", "v"]).withColumn("asked", deal).withColumn("row", F.pmod(deal, F.lit(rows))) \
        .withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))) \
        .select((F.col("column") * rows + F.col("row")).cast("long").alias("cell"), "id", "v", "asked")

    def meet(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"asked": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        if candidates.empty or queries.empty:
            return empty
        both = to_integers([*candidates["v"], *queries["v"]], scale)
        x, q = both[:len(candidates)], both[len(candidates):]
        ids, query_ids = candidates["id"].to_numpy(), queries["id"].to_numpy()
        who, at, score = block_top(ids, x, query_ids, q, min(k, len(ids)))
        return pd.DataFrame({"asked": queries["asked"].to_numpy()[who], "query_id": query_ids[who], "vec_id": ids[at], "score": score})

    found = cells.groupBy("cell").cogroup(asks.groupBy("cell")) \
        .applyInPandas(meet, "asked long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id", "asked").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
