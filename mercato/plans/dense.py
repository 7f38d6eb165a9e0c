"""Dense text embeddings: a randomised range finder over the stored term matrix (P2, P4).

The matrix has a row for each text and a column for each term, holding TF-IDF weights of
length 1 a row.  ``fit`` finds the ``size`` directions over terms that keep most of it, so
two texts without a common word still match when their words keep the same company:

1. every term starts with normal numbers drawn by its hash;
2. a pass multiplies with the matrix, once by rows and once by terms, and makes the
   columns of the result orthogonal; each pass sharpens the directions;
3. the last product's eigenvectors turn the columns into ordered directions.

A product is a join of the postings with a table of numbers by term or by row, and sums
grouped by the other side, combined before the shuffle; a term that many rows have is split
by the session's skew join.  Only sums of column products, at most (size + 8) squared
numbers, come to the driver.  Each product is written before the next one reads it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.plans.textindex import frequencies
from mercato.streaming.feed import CHANGE, VERSION

SPARE = 8  # columns beyond the ones asked for


def _normal(term: Column, column: int, seed: int) -> Column:
    """A standard normal number from the hash of the term."""
    def uniform(salt: str) -> Column:
        return (F.pmod(F.xxhash64(term, F.lit(f"{salt}{seed}/{column}")), F.lit(1 << 52)).cast("double") + 1) / float(1 << 52)
    return F.sqrt(F.lit(-2.0) * F.log(uniform("r"))) * F.cos(F.lit(2 * np.pi) * uniform("a"))


def _names(n: int) -> list[str]:
    return [f"c{i}" for i in range(n)]


def _turn(table: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    """The table's columns times a small matrix."""
    old = _names(matrix.shape[0])
    return table.select(key, *[sum((F.col(c) * float(matrix[i, j]) for i, c in enumerate(old)), F.lit(0.0)).alias(f"c{j}")
                               for j in range(matrix.shape[1])])


def _gram(table: DataFrame, n: int) -> np.ndarray:
    """Sums of products of every two columns."""
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    sums = table.agg(*[F.sum(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"s{i}_{j}") for i, j in pairs]).first()
    out = np.zeros((n, n))
    for (i, j), v in zip(pairs, sums, strict=True):
        out[i, j] = out[j, i] = v or 0.0
    return out


def _directions(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, without what is zero by rounding, and their vectors."""
    sizes, vectors = np.linalg.eigh(gram)
    order = np.argsort(-sizes)
    sizes, vectors = sizes[order], vectors[:, order]
    real = sizes > max(float(sizes[0]) if sizes.size else 0.0, 0.0) * 1e-11
    vectors = vectors[:, real]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]) if vectors.size else np.ones(0)
    return sizes[real], vectors * signs


def _orthogonal(table: DataFrame, key: str, n: int) -> tuple[DataFrame, int]:
    """The same column space by columns of length 1 at right angles."""
    sizes, vectors = _directions(_gram(table, n))
    return _turn(table, key, vectors / np.sqrt(sizes)), len(sizes)


def _times(postings: DataFrame, table: DataFrame, join: str, by: str, n: int) -> DataFrame:
    return postings.join(table, join).groupBy(by).agg(*[F.sum(F.col("w") * F.col(c)).alias(c) for c in _names(n)])


@dataclass
class DenseModel:
    """Stored tables ``idf`` and ``terms`` (the directions' numbers of each term)."""

    spark: SparkSession
    base: str
    size: int
    strengths: list[float]  # of each direction, squared, largest first

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{name}")


def _weights(texts: DataFrame, by: str, idf: DataFrame, text_col: str) -> DataFrame:
    """(by, term, w): TF-IDF weights, each row of length 1; terms without ``idf`` do not count."""
    raw = frequencies(texts, by, text_col=text_col).join(idf, "term").select(by, "term", (F.col("tf") * F.col("idf")).alias("w"))
    length = raw.groupBy(by).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    return raw.join(length, by).select(by, "term", (F.col("w") / F.col("length")).alias("w"))


def fit(texts: DataFrame, key: str, base: str, text_col: str = "search_text", size: int = 16, passes: int = 2,
        seed: int = 42) -> DenseModel:
    """Learn the directions of a table of texts and store them at ``base``.

    ``key`` is unique.  A table with fewer independent texts than ``size`` gives fewer directions.
    """
    spark = texts.sparkSession
    count = iter(range(1000))

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    def step(df: DataFrame) -> DataFrame:
        return put(df, f"step{next(count)}")

    n = texts.agg(F.count(F.lit(1)).cast("double").alias("n"))  # one row
    tf = frequencies(texts, key, text_col=text_col)
    idf = put(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(n))
              .select("term", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf")), "idf")
    postings = put(_weights(texts, key, idf, text_col), "postings")
    width = size + SPARE
    terms = idf.select("term", *[_normal(F.col("term"), i, seed).alias(f"c{i}") for i in range(width)])
    for _ in range(passes):
        rows = step(_times(postings, terms, "term", key, width))
        terms, width = _orthogonal(step(_times(postings, rows, key, "term", width)), "term", width)
        if width == 0:
            break
        terms = step(terms)
    strengths, vectors = _directions(_gram(step(_times(postings, terms, "term", key, width)), width)) if width else (np.zeros(0), np.zeros((0, 0)))
    kept = min(size, len(strengths))
    put(_turn(terms, "term", vectors[:, :kept]) if width else terms.select("term"), "terms")
    return DenseModel(spark, base, kept, [float(s) for s in strengths[:kept]])


def embed(model: DenseModel, texts: DataFrame, key: str, text_col: str = "search_text") -> DataFrame:
    """(key, embedding): each text along the model's directions, length 1; null without a known term."""
    names = _names(model.size)
    if not names:
        return texts.select(key, F.lit(None).cast("array<double>").alias("embedding"))
    sums = _times(_weights(texts, key, model.table("idf"), text_col), model.table("terms"), "term", key, model.size)
    length = F.sqrt(sum((F.col(c) * F.col(c) for c in names), F.lit(0.0)))
    made = sums.withColumn("_length", length).where(F.col("_length") > 1e-9) \
        .select(key, F.array(*[F.col(c) / F.col("_length") for c in names]).alias("embedding"))
    return texts.select(key).join(made, key, "left")


def embedding_changes(model: DenseModel, changes: DataFrame, key: str, text_col: str = "search_text") -> DataFrame:
    """Change rows of a text feed as change rows of its embeddings, for the same sync (P4).

    Only inserted and updated texts are embedded; a delete carries no embedding.  A key
    may occur once in each version.
    """
    rows = changes.withColumn("_cell", F.struct(key, VERSION))
    made = embed(model, rows.where(F.col(CHANGE) != "delete").select("_cell", text_col), "_cell", text_col)
    return rows.select("_cell", CHANGE).join(made, "_cell", "left") \
        .select(F.col("_cell")[key].alias(key), CHANGE, F.col("_cell")[VERSION].alias(VERSION), "embedding")
