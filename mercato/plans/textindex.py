"""Stored postings with block maxima, and exact top-k over them (P3, P6).

``build`` cuts texts into terms and stores, for every term and *block* of
neighbouring rows, the postings (row, weight) and the largest weight by row norm.
``search`` finds each query's best rows by TF-IDF cosine without reading blocks
that cannot hold one:

1. the block maxima of a query's terms bound the score of every row in a block;
2. the ``probe`` blocks with the highest bounds are scored, and the k-th best score
   there is the bar;
3. of the other blocks only those whose bound reaches the bar are scored.

All steps run on executors, for any number of queries.  Some neighbouring blocks make
up a *piece*.  Weights need one idf for each term of a piece, not of a row, and a piece is
scored in one place, from which only each query's best rows leave: neither the (row,
term) pairs nor the (query, row) pairs are ever shuffled.  A piece has at most
``PIECE`` blocks of rows, so a frequent term is spread over as many groups as there are pieces.

Weights are whole numbers: term frequency times ``round(1000 * (ln((n + 1) / (df + 1)) + 1))``.
Sums of their products are exact whatever their order (in doubles, below 2**53), so
the scores and their ties do not depend on partitioning.

A row without a term matches nothing; a query's terms that no row has do not count;
ties go to the smaller id columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TOKEN = r"[^\p{L}\p{N}]+"  # whatever is no letter or digit cuts
_SLACK = 1 + 1e-9  # for the rounding of bounds
PIECE = 8  # blocks that are weighed and scored together


def terms_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TOKEN), lambda t: F.length(t) > 0)


def frequencies(texts: DataFrame, *by: str, text_col: str = "text") -> DataFrame:
    """How often each term occurs in each text."""
    return texts.select(*by, F.explode(terms_of(F.col(text_col))).alias("term")).groupBy(*by, "term") \
        .agg(F.count(F.lit(1)).cast("double").alias("tf"))


def norm(weight: Column) -> Column:
    return F.sqrt(F.sum(weight * weight))


@dataclass
class TextIndex:
    """Tables of a stored index: ``rows``, ``idf``, ``postings`` and, out of these, ``maxima``.

    ``postings`` has one row for each term of a block.  The one without a term holds all
    rows of the block, with their norms as weights.
    """

    spark: SparkSession
    base: str
    ids: list[str]

    def table(self, name: str) -> DataFrame:
        if name == "maxima":
            return self.table("postings").where(F.col("term").isNotNull()).select("term", "block", "most")
        return self.spark.read.parquet(f"{self.base}/{name}")


_POSTINGS = "term string, block long, most double, rows array<long>, ws array<double>"


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """How many values each list has, and the values."""
    whole = lists.combine_chunks()
    return pc.list_value_length(whole).to_numpy(zero_copy_only=False), whole.flatten()


def _weigh_piece(rows: pa.Table, vocabulary: pa.Table, block_rows: int) -> pa.Table:
    """A piece's postings, from its rows' tokens and its terms' idf."""
    rows, vocabulary = rows.sort_by("row"), vocabulary.sort_by("term")
    counts, tokens = _flat(pc.split_pattern(rows["_tokens"], " "))
    terms, row = vocabulary["term"].combine_chunks(), rows["row"].to_numpy()
    n = len(terms)
    # (row, term) pairs in order, with the number of tokens
    cell, tf = np.unique(np.repeat(np.arange(len(row)), counts) * n + pc.index_in(tokens, terms).to_numpy(), return_counts=True)
    at, term = cell // n, cell % n
    w = tf * vocabulary["idf"].to_numpy()[term]
    norms = np.sqrt(np.bincount(at, w * w, len(row)))
    block = row // block_rows
    order = np.lexsort((at, term, block[at]))
    at, term, w = at[order], term[order], w[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(term) != 0) | (np.diff(block[at]) != 0)])
    first = np.flatnonzero(np.r_[True, np.diff(block) != 0])

    def lists(begin: np.ndarray, values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.r_[begin, len(values)], pa.int32()), pa.array(values))

    names = ["term", "block", "most", "rows", "ws"]
    return pa.concat_tables([
        pa.table([terms.take(pa.array(term[starts])).cast(pa.string()), pa.array(block[at[starts]]),
                  pa.array(np.maximum.reduceat(w / norms[at], starts)), lists(starts, row[at]), lists(starts, w)], names=names),
        pa.table([pa.nulls(len(first), pa.string()), pa.array(block[first]), pa.nulls(len(first), pa.float64()),
                  lists(first, row), lists(first, norms)], names=names)])


def _score_piece(postings: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    """Of a piece, each query's best rows within its blocks, with all that tie with the k-th."""
    held = postings.filter(pc.is_valid(postings["term"]))
    plain = postings.filter(pc.is_null(postings["term"])).sort_by("block")
    sizes, row = _flat(plain["rows"])
    row, norms = row.to_numpy(), _flat(plain["ws"])[1].to_numpy()
    block, order = np.repeat(plain["block"].to_numpy(), sizes), np.argsort(row)
    row, norms, block = row[order], norms[order], block[order]
    held = held.sort_by("term")
    counts, at = _flat(held["rows"])
    at, w = np.searchsorted(row, at.to_numpy()), _flat(held["ws"])[1].to_numpy()
    ends = np.cumsum(counts)
    # all lists of a term lie together
    of_term = pc.run_end_encode(held["term"].combine_chunks()) if len(held) else None
    terms = of_term.values if of_term is not None else pa.array([], pa.string())
    last = ends[of_term.run_ends.to_numpy() - 1] if of_term is not None else np.zeros(0, np.int64)
    begin = np.r_[0, last][:-1]
    out = []
    sizes, asked_terms = _flat(asked["terms"])
    places, wqs = pc.index_in(asked_terms, terms).fill_null(-1).to_numpy(), _flat(asked["wqs"])[1].to_numpy()
    stops, blocks, qnorms = np.cumsum(sizes), asked["blocks"].to_pylist(), asked["qnorm"].to_numpy()
    for i, stop in enumerate(stops):
        mine = slice(stop - sizes[i], stop)
        known = np.flatnonzero(places[mine] >= 0)
        if not known.size:
            continue
        where, wq = places[mine][known], wqs[mine][known]
        dots = np.bincount(np.concatenate([at[begin[p]:last[p]] for p in where]),
                           np.concatenate([w[begin[p]:last[p]] * x for p, x in zip(where, wq, strict=True)]), len(row))
        ok = np.flatnonzero((dots > 0) & np.isin(block, blocks[i]))
        scores = dots[ok] / (qnorms[i] * norms[ok])
        if ok.size > k:
            best = scores >= np.partition(scores, ok.size - k)[ok.size - k]
            ok, scores = ok[best], scores[best]
        out.append((np.full(ok.size, i), row[ok], scores))
    query, found, score = (np.concatenate(c) if out else np.zeros(0, t)
                           for c, t in zip(zip(*out, strict=True) if out else ((), (), ()), (np.int64, np.int64, np.float64), strict=True))
    return pa.table([asked["query_id"].combine_chunks().take(pa.array(query)), pa.array(found, pa.int64()), pa.array(score, pa.float64())],
                    names=["query_id", "row", "score"])


def build(texts: DataFrame, ids: list[str], base: str, text_col: str = "text", order_by: list[str] | None = None,
          block_rows: int = 512) -> TextIndex:
    """Store the index of a table at ``base``.

    ``order_by``: columns whose neighbours have terms in common, which makes the bounds
    sharp; by default the rows stay in their order.
    """
    spark = texts.sparkSession
    index = TextIndex(spark, base, ids)

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{base}/{name}")
        return index.table(name)

    src = texts.select(*ids, F.col(text_col).alias("_text"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by or [])])
    if order_by:
        order = [f"_o{i}" for i in range(len(order_by))]
        src = src.repartitionByRange(*order, *ids).sortWithinPartitions(*order, *ids)
    rows = put(src.select(F.monotonically_increasing_id().alias("row"), *ids, F.array_join(terms_of(F.col("_text")), " ").alias("_tokens")),
               "rows")
    n = rows.agg(F.count(F.lit(1)).cast("double").alias("n"))
    lettered = rows.where(F.length("_tokens") > 0).select("row", "_tokens", F.floor(F.col("row") / (block_rows * PIECE)).cast("long").alias("piece"))
    distinct = lettered.select("piece", F.explode(F.array_distinct(F.split("_tokens", " "))).alias("term"))
    idf = put(distinct.groupBy("term").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(n)).select(
        "term", F.floor(F.lit(1000) * (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1) + 0.5).cast("double").alias("idf")), "idf")
    vocabulary = distinct.distinct().withColumnRenamed("piece", "_piece").join(idf, "term")
    put(lettered.groupBy("piece").cogroup(vocabulary.groupBy("_piece")).applyInArrow(
        lambda some, known: _weigh_piece(some, known, block_rows), _POSTINGS), "postings")
    return index


def weigh(index: TextIndex, queries: DataFrame) -> DataFrame:
    """query_id, term, wq and qnorm of the queries' terms that the index has."""
    weights = frequencies(queries, "query_id").join(index.table("idf"), "term") \
        .select("query_id", "term", (F.col("tf") * F.col("idf")).alias("wq"))
    return weights.join(weights.groupBy("query_id").agg(norm(F.col("wq")).alias("qnorm")), "query_id")


def _scores(index: TextIndex, cells: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """Each query's best rows within its cells, with all that tie with the k-th."""
    piece = F.floor(F.col("block") / PIECE).cast("long").alias("piece")
    texts = weights.groupBy("query_id", "qnorm").agg(F.collect_list(F.struct("term", "wq")).alias("_t")) \
        .select("query_id", "qnorm", F.col("_t.term").alias("terms"), F.col("_t.wq").alias("wqs"))
    asked = cells.groupBy("query_id", piece).agg(F.collect_list("block").alias("blocks")).join(texts, "query_id")
    # what no query asks for stays where it is
    stored = index.table("postings").select("term", "block", "rows", "ws", piece)
    postings = stored.join(weights.select("term").distinct(), "term", "left_semi").unionByName(stored.where(F.col("term").isNull()))
    kind = cells.schema["query_id"].dataType.simpleString()
    local = postings.groupBy("piece").cogroup(asked.groupBy("piece")).applyInArrow(
        lambda held, queries: _score_piece(held, queries, k), f"query_id {kind}, row long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    return local.withColumn("_rank", F.rank().over(best)).where(F.col("_rank") <= k).drop("_rank")


def search(index: TextIndex, queries: DataFrame, k: int, folder: str, probe: int = 4) -> tuple[DataFrame, DataFrame]:
    """(query_id, id columns, score, rank) of each query's k best rows, and (query_id, blocks, scored) as a report.

    ``queries``: query_id, text.  Intermediate tables go to ``folder``.
    """
    spark = index.spark

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    weights = put(weigh(index, queries), "weights")
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    bounds = put(weights.join(index.table("maxima"), "term").groupBy("query_id", "qnorm", "block")
                 .agg((F.sum(F.col("wq") * F.col("most")) / F.col("qnorm") * _SLACK).alias("bound"))
                 .withColumn("place", F.row_number().over(by_bound)), "bounds")
    first = put(_scores(index, bounds.where(F.col("place") <= probe), weights, k), "first")
    # fewer than k rows set no bar
    bar = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(0.0)).alias("bar"))
    second = bounds.where(F.col("place") > probe).join(bar, "query_id").where(F.col("bound") >= F.col("bar"))
    found = first.unionByName(_scores(index, second, weights, k))
    cut = Window.partitionBy("query_id").orderBy(F.desc("score"))
    some = found.withColumn("_rank", F.rank().over(cut)).where(F.col("_rank") <= k)
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), *index.ids)
    top = some.join(index.table("rows").drop("_tokens"), "row").withColumn("rank", F.row_number().over(last).cast("int")) \
        .where(F.col("rank") <= k).select("query_id", *index.ids, "score", "rank")
    scored = bounds.where(F.col("place") <= probe).select("query_id").unionByName(second.select("query_id")) \
        .groupBy("query_id").agg(F.count(F.lit(1)).alias("scored"))
    report = bounds.groupBy("query_id").agg(F.count(F.lit(1)).alias("blocks")).join(scored, "query_id")
    return top, report
