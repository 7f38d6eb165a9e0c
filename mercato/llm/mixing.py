"""Mixing sources to target weights by Poisson replication.

A source that holds ``n`` of all ``N`` documents and is to make up a share
``w`` of ``M`` output documents needs each of its documents ``w * M / n`` times
on average.  Each document draws its number of copies from the Poisson
distribution of that mean, by inverting the distribution at a number in [0, 1)
that is hashed from a seed and the document's id.  Documents are exploded by
their counts and shuffled globally by a second hash, which is uniform: equal
ranges of its first digits are the partitions, each sorted within.  No state is shared, so
any partition can be computed again with the same result.

A mean above ``CHUNK`` is split evenly into several draws, each with a hash of
its own: a sum of Poisson draws is one of the summed mean, and no table of
probabilities is long.  Only counts per source are gathered.

Defined results: target weights need not add up to 1 (they are scaled); a
source without a target weight, or with weight 0, gets no copies; null is a
source like any other; a target for a source that has no rows is shared among
the others in proportion; rows that share an id draw the same number; a row
without an id draws by its other columns instead, so that such rows differ unless
all their columns are equal; text plays no part otherwise; all columns are carried
through, and if one is called ``copy`` or ``shuffle_key``, the added column of that
name gets underscores in front.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import shuffle_partitions, stored

CHUNK = 16.0
#: Sources whose table (700 bytes each) is sent to every task; more are joined by a shuffle.
MOST_BROADCAST = 10_000
_DIGITS = 13  # hexadecimal, 52 bits: exact in a double


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) hashed from the parts' text."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _DIGITS), 16, 10).cast("double") / float(16 ** _DIGITS)


def tempered(docs: DataFrame, power: float, source_col: str = "source") -> DataFrame:
    """Target weights: each source's share raised to ``power``."""
    return docs.groupBy(source_col).agg(F.count(F.lit(1)).alias("_n")) \
        .select(F.col(source_col), F.pow(F.col("_n").cast("double"), F.lit(power)).alias("weight"))


def tempered_within(docs: DataFrame, power: float, within_col: str, source_col: str = "source") -> DataFrame:
    """Target weights of cells: sources as in ``tempered``, and in each source its values of ``within_col`` by the same power.

    One row for each source and value there is: ``source_col``, ``within_col``, weight.
    """
    cells = docs.groupBy(source_col, within_col).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    root = F.pow("_n", F.lit(power))
    whole = cells.groupBy(F.col(source_col).alias("_source")).agg((F.pow(F.sum("_n"), F.lit(power)) / F.sum(root)).alias("_scale"))
    return cells.join(whole, F.col(source_col).eqNullSafe(F.col("_source"))) \
        .select(source_col, within_col, (F.col("_scale") * root).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, total: Column | None = None, source_col: str = "source") -> DataFrame:
    """source, draws and cdf: how many draws a document makes, and the distribution of each.

    ``weights``: source, weight.  ``total``: documents wanted, from the column
    ``_all`` (all there are); by default as many.
    """
    n = docs.groupBy(F.col(source_col).alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    w = weights.groupBy(F.col(source_col).alias("_w_source")).agg(F.sum(F.greatest("weight", F.lit(0.0))).alias("_w"))
    both = n.join(w, F.col("_source").eqNullSafe(F.col("_w_source")), "left").fillna(0.0, ["_w"])
    sums = both.agg(F.sum("_n").alias("_all"), F.sum("_w").alias("_weights"))  # one row
    rated = both.crossJoin(F.broadcast(sums)).filter("_w > 0") \
        .withColumn("_rate", F.col("_w") / F.col("_weights") * (total if total is not None else F.col("_all")) / F.col("_n")) \
        .withColumn("_draws", F.ceil(F.col("_rate") / CHUNK).cast("long")).withColumn("_mean", F.col("_rate") / F.col("_draws"))
    # 16 + 70 copies in one draw have a probability far below 2**-52
    most = int(CHUNK) + 70
    logs = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(most)])
    terms = F.transform(F.sequence(F.lit(0), F.lit(most - 1)),
                        lambda k: F.exp(k * F.ln("_mean") - F.col("_mean") - F.element_at(logs, k + 1)))
    cdf = F.transform(F.sequence(F.lit(1), F.lit(most)),
                      lambda k: F.aggregate(F.slice("_terms", F.lit(1), k), F.lit(0.0), lambda a, b: a + b))
    return rated.withColumn("_terms", terms).select("_source", "_draws", cdf.alias("_cdf"))


def replicate(docs: DataFrame, weights: DataFrame, seed: int = 1, id_col: str = "doc_id", source_col: str = "source",
              total: Column | None = None) -> DataFrame:
    """The rows of ``docs`` as often as drawn, with ``copy`` (from 0) and ``shuffle_key``, in the order of that key."""
    table = stored(rates(docs, weights, total, source_col))
    if table.count() <= MOST_BROADCAST:
        table = F.broadcast(table)
    # the input's columns stay inside `row`, whatever their names
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{source_col}`").alias("source"),
                        F.coalesce(F.col(f"`{id_col}`").cast("string"), _content(docs)).alias("id"))
    joined = inner.join(table, F.col("source").eqNullSafe(F.col("_source")))
    drawn = joined.withColumn("draw", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_draws") - 1))) \
        .withColumn("u", uniform(F.lit(seed), F.col("id"), F.col("draw"))) \
        .withColumn("count", F.size(F.filter("_cdf", lambda p: p <= F.col("u")))).filter("count > 0")
    copies = drawn.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    # copies of one draw are numbered within it; draws leave room for the longest one
    numbered = copies.withColumn("copy", F.col("draw") * (int(CHUNK) + 70) + F.col("i")) \
        .withColumn("key", F.md5(F.concat_ws("|", F.lit("place"), F.lit(seed).cast("string"), F.col("id"), F.col("copy").cast("string")).cast("binary")))
    parts = shuffle_partitions(docs.sparkSession)
    place = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * parts / float(1 << 32)).cast("int")
    names = {}
    for name in ("copy", "shuffle_key"):
        names[name] = name
        while names[name] in docs.columns:
            names[name] = "_" + names[name]
    return numbered.select("row", "copy", "key").repartitionById(parts, place).sortWithinPartitions("key") \
        .select("row.*", F.col("copy").alias(names["copy"]), F.col("key").alias(names["shuffle_key"]))


def _content(docs: DataFrame) -> Column:
    """Hash of all columns, as the id of a row that has none."""
    return F.concat(F.lit("row "), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).cast("string"))
