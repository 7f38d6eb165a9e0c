"""Search and document operators: embeddings, exact top-k, field extraction,
passage retrieval.

Exact vector top-k (no pair table is ever materialised): candidates are dealt into
blocks of bounded size, each sent once; queries are sent to every block and stream
past it, scored with numpy.  A block emits its own k best for each query, and a
window keeps the best of (blocks × k) rows.  Text top-k runs on stored postings
(:mod:`mercato.plans.textindex`).  Neither bounds the number of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from mercato.functions.numeric import round_half_up
from mercato.plans import textindex
from mercato.streaming.ingest import scratch



# -- P2: text → TF-IDF vectors ----------------------------------------------------------

def tfidf_pipeline(input_col: str = "search_text", features: int = 1 << 18) -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol=input_col, outputCol="_tokens", pattern=textindex.TOKEN, toLowercase=True),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="embedding", p=2.0)])


def embed(df: DataFrame, input_col: str = "search_text", model=None):
    """(fitted model, df with an L2-normalised TF-IDF ``embedding`` column)."""
    model = model or tfidf_pipeline(input_col).fit(df)
    return model, model.transform(df).drop("_tokens", "_tf", "_tfidf")


@F.udf(IntegerType())
def nonzero_terms(embedding):
    """How many terms an embedding has a weight for, from its sparse form: as an array it has a number for each of 2**18 terms."""
    return int(embedding.numNonzeros())


def reembed_changed(model, diff: DataFrame, key: list[str], input_col: str = "search_text") -> DataFrame:
    """P4: embed only inserted/updated rows of a snapshot diff (deletes → tombstones)."""
    upserts = diff.where(F.col("change_type").isin("insert", "update"))
    _, emb = embed(upserts, input_col, model)
    return emb


# -- P3: exact cosine top-k over array<float> vectors -----------------------------------

_MATCHES = pa.schema([("query_id", pa.int64()), ("match_id", pa.int64()), ("similarity", pa.float64())])


def _vectors(table: pa.Table) -> np.ndarray:
    return np.array(table.column("vec").to_pylist(), np.float64)


def _block_matches(ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray, queries: pa.Table, k: int) -> pa.RecordBatch:
    """The block's k best candidates of each query."""
    q, asked = _vectors(queries), queries.column("id").to_numpy()
    norms = np.outer(np.linalg.norm(q, axis=1), lengths)
    sims = np.round(np.divide(q @ vectors.T, norms, out=np.full(norms.shape, np.nan), where=norms > 0), 12)
    out = []
    for query, row in zip(asked, sims, strict=True):
        ok = np.flatnonzero(np.isfinite(row) & (ids != query))
        if ok.size > 4 * k:
            ok = ok[row[ok] >= np.partition(row[ok], ok.size - k)[ok.size - k]]
        best = ok[np.lexsort((ids[ok], -row[ok]))[:k]]
        out.append((np.full(best.size, query), ids[best], row[best]))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=_MATCHES)


def _matches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Of each block the candidates come first and are held; then the queries pass by."""
    block, held, vectors = None, [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        of, asks = table.column("block").to_numpy(), table.column("is_query").to_numpy()
        turns = np.flatnonzero((np.diff(of) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
        for start, end in zip([0, *turns], [*turns, len(of)], strict=True):
            if of[start] != block:
                block, held, vectors = of[start], [], None
            run = table.slice(start, end - start)
            if not asks[start]:
                held.append(run)
                continue
            if vectors is None and held:
                rows = pa.concat_tables(held)
                ids, vectors, held = rows.column("id").to_numpy(), _vectors(rows), []
                lengths = np.linalg.norm(vectors, axis=1)
            for at in range(0, run.num_rows if vectors is not None else 0, 64):
                yield _block_matches(ids, vectors, lengths, run.slice(at, 64), k)


def exact_topk(candidates: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
               vec_col: str = "embedding", block: int = 1 << 15) -> DataFrame:
    """Top-k cosine matches of each query among all candidates (query itself excluded).

    queries: (qid bigint, qvec array<float|double>), any number of them.
    Null and zero vectors have no direction and take no part; similarities equal
    to 12 decimals rank by id.
    """
    deal, vector = F.xxhash64("id", "vec"), "array<double>"
    rows = candidates.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()) \
        .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(vector).alias("vec"))
    asks = queries.where(F.col("qid").isNotNull() & F.col("qvec").isNotNull()) \
        .select(F.col("qid").cast("long").alias("id"), F.col("qvec").cast(vector).alias("vec"))
    n = rows.count()
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    blocks = max(1, -(-n // block), min(tasks, -(-n // 512)))
    everywhere = asks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("is_query", F.lit(True))
    dealt = rows.withColumn("block", F.pmod(deal, F.lit(blocks)).cast("int")).withColumn("is_query", F.lit(False))
    local = dealt.unionByName(everywhere).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "is_query") \
        .mapInArrow(lambda batches: _matches(batches, k), "query_id long, match_id long, similarity double")
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), F.asc("match_id"))
    return local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def label_exemplars(emb: DataFrame) -> DataFrame:
    """One probe vector per label: the label's first vector (smallest id)."""
    first = emb.groupBy("label").agg(F.min("vec_id").alias("qid"))
    return first.join(emb.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec")), "qid")


def similar_vectors(emb: DataFrame, k: int = 10) -> DataFrame:
    ex = label_exemplars(emb)
    top = exact_topk(emb, ex.select("qid", "qvec"), k)
    labels = ex.select(F.col("qid").alias("query_id"), "label")
    return top.join(labels, "query_id").select(
        "label", "query_id", "match_id", round_half_up("similarity", 6).alias("similarity"),
        F.col("rank").cast("int").alias("rank"))


# -- P5: field extraction -----------------------------------------------------------------

# Patterns for the page fields (regex, group), fixed.
PAGE_FIELDS = {
    "title": (r"<title>(.*?)</title>", 1),
    "lang": (r'<html lang="([^"]*)"', 1),
    "h1": (r"<h1>(.*?)</h1>", 1),
    "host": (r"^[a-z]+://([^/:?#]+)", 1),
}


def extract_fields(df: DataFrame, fields: dict[str, tuple[str, int]], text_col: str,
                   overrides: dict[str, str] | None = None) -> DataFrame:
    """One column per field from ``regexp_extract`` (empty string when absent)."""
    overrides = overrides or {}
    return df.withColumns({name: F.regexp_extract(F.col(overrides.get(name, text_col)), pat, g)
                           for name, (pat, g) in fields.items()})


def page_fields(pages: DataFrame) -> DataFrame:
    out = extract_fields(pages, PAGE_FIELDS, "html", overrides={"host": "url"})
    return out.select("page_id", "title", "lang", "h1", "host",
                      F.length("html").cast("long").alias("html_chars"))


# -- P6: passage retrieval ----------------------------------------------------------------

def passages(docs: DataFrame) -> DataFrame:
    """One row per non-empty line of each document (whole texts, every line)."""
    p = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "passage"))
    return p.where(F.length(F.trim("passage")) > 0)


def passage_topk(docs: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """Top-k passages per query by TF-IDF cosine, over a stored index of all passages (:mod:`mercato.plans.textindex`).

    queries: (query_id bigint, text string), any number of them.
    """
    folder = scratch(docs.sparkSession, "passages")
    index = textindex.build(passages(docs), ["doc_id", "line_no"], f"{folder}/index", text_col="passage")
    top, _ = textindex.search(index, queries, k, f"{folder}/search")
    return top.withColumn("score", round_half_up("score", 6))


# -- P3: product lookup by text ---------------------------------------------------------

def product_index(catalog: DataFrame, base: str, block_rows: int = 512) -> textindex.TextIndex:
    """Stored index of a product catalog; products of a brand and type lie in neighbouring rows."""
    return textindex.build(catalog, ["product_id"], base, text_col="search_text", order_by=["brand", "part_type", "container"],
                           block_rows=block_rows)


def product_lookup(catalog: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The k products whose search text is most like each query text (query_id, text)."""
    folder = scratch(catalog.sparkSession, "products")
    top, _ = textindex.search(product_index(catalog, f"{folder}/index"), queries, k, f"{folder}/search")
    return top.withColumn("score", round_half_up("score", 6))


def type_and_brand_queries(catalog: DataFrame) -> DataFrame:
    """What a user would type to find a brand's products of a type: one query for every such pair in the catalog."""
    text = F.concat_ws(" ", "part_type", "brand", "container")
    return catalog.select(text.alias("query_id"), text.alias("text")).distinct()
