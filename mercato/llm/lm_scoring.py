"""Cross-entropy difference between a target and a background language model.

Both models are character 4-gram models of one vocabulary, order and smoothing;
they differ only in the texts counted: the target's documents, and all of them.
A document's score is the mean over its tokens of the target's loss less the
background's: the lower, the more it is like the target.

The vocabulary is all lower-cased characters of the corpus, and counts are taken
over whole texts of all documents (``score_corpus``):

1. One pass cuts the documents into blocks of about ``block_bytes`` of text, kept
   compressed.  The target is looked up by ids alone and comes back as one bit a document
   of each block, so no text is shuffled for it.  Each block's distinct 4-grams are counted.
2. 4-grams, contexts and all shorter orders are tables that grow with the corpus;
   joins of them give every 4-gram's two losses.  Probabilities are smoothed by
   interpolation with the shorter contexts: a context gives its lower order as
   much weight as it has different continuations; below that all characters of
   the corpus are alike.
3. Each block's distinct 4-grams are joined with their losses and go back to
   their block, where texts are scored.  A 4-gram has one row a block however
   often it occurs, and the driver gets four numbers.

A block is held as one row of 32-bit places among its characters and its 4-grams are
made a million at a time, so a task needs some 15 bytes a character of a block.
Blocks of 16 MB have about the distinct 4-grams of blocks of 2 MB twice over, so far
fewer rows go out and back.

Defined results: a null text counts as empty; an empty text has no tokens and
losses and score 0; without target documents the target model is uniform over the
vocabulary;
repeated rows count and are scored each on their own; target ids that are null
or not in the corpus do nothing; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import delete_folder, shuffle_partitions, slices, stored, texts_of
from mercato.session import checkpoint_dir

ORDER = 4


_CHAR = 21  # bits of a code point, which is shifted by one: 0 stands before a text's beginning


_PIECE = 1 << 20  # places of a block taken at a time
_BITS = 1 << 15  # of one bitmap of Spark's
_INSIDE = "array<struct<number: bigint, bits: binary>>"


class _Texts:
    """The 4-grams of a block's joined texts.

    ``row`` has three zeros before each text and the places of its characters among
    ``symbols``.  A 4-gram's code joins the numbers of its two halves: to the base of
    the number of symbols, or by rank among the block's pairs where there are too many.
    """

    def __init__(self, blob: bytes, lengths: np.ndarray):
        codes = np.frombuffer(blob, np.uint32)
        seen = np.zeros(0x110000, bool)
        for a in range(0, codes.size, _PIECE):
            seen[codes[a:a + _PIECE]] = True
        self.symbols = np.concatenate((np.zeros(1, np.int64), np.flatnonzero(seen) + 1))
        place = np.cumsum(seen, dtype=np.int32)
        inside = np.ones(codes.size + lengths.size * (ORDER - 1), bool)
        opens = np.cumsum(lengths) - lengths + np.arange(lengths.size) * (ORDER - 1)
        for k in range(ORDER - 1):
            inside[opens + k] = False
        places = np.empty(codes.size, np.int32)
        for a in range(0, codes.size, _PIECE):
            places[a:a + _PIECE] = place[codes[a:a + _PIECE]]
        self.row = np.zeros(inside.size, np.int32)
        self.row[inside] = places
        self.ends = np.cumsum(lengths)
        self.pairs = None if self.symbols.size < 1 << 15 else _merged([np.unique(p) for p in self._halves()])
        self.base = self.symbols.size ** 2 if self.pairs is None else self.pairs.size

    def _halves(self) -> Iterator[np.ndarray]:
        """Of each piece, the pair that ends at each place, from two places before the piece on."""
        for a in range(ORDER - 1, self.row.size, _PIECE):
            part = self.row[a - 3:a + _PIECE].astype(np.int64)
            yield part[:-1] * self.symbols.size + part[1:]

    def pieces(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Codes of the 4-grams that end at each token, and the tokens' texts, both in their order."""
        done = 0
        for a, pair in zip(range(ORDER - 1, self.row.size, _PIECE), self._halves(), strict=True):
            if self.pairs is not None:
                pair = np.searchsorted(self.pairs, pair)
            code = (pair[:-2] * self.base + pair[2:])[self.row[a:a + _PIECE] > 0]
            yield code, np.searchsorted(self.ends, np.arange(done, done + code.size), "right")
            done += code.size

    def distinct(self) -> np.ndarray:
        """All codes, ascending."""
        return _merged([np.unique(code) for code, _ in self.pieces()])

    def spelled(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context (three characters of ``_CHAR`` bits) and last character of 4-grams."""
        halves = [code // self.base, code % self.base]
        if self.pairs is not None:
            halves = [self.pairs[h] for h in halves]
        n = self.symbols.size
        a, b, c, d = (self.symbols[x] for h in halves for x in (h // n, h % n))
        return (a << 2 * _CHAR) | (b << _CHAR) | c, d


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def _blocks(src: DataFrame, id_type: str, block_bytes: int) -> DataFrame:
    """Rows of _id and _text as blocks: a number, the ids, the texts' lengths, the joined texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def emit():
            ids = pa.concat_arrays([p.column(0) for p in held])
            texts = [t.lower() for p in held for t in texts_of(p, "_text")]
            blob = "".join(texts).encode("utf-32-le", "surrogatepass")
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                 pa.array([len(blob)], pa.int64()), pa.array([pa.compress(blob, "zstd", asbytes=True)], pa.binary())],
                names=["block", "ids", "lengths", "size", "blob"])

        for part in slices(batches, "_text", block_bytes):
            held.append(part)
            size += part.nbytes
            if size >= block_bytes:
                yield emit()
                held, size, block = [], 0, block + 1
        if held:
            yield emit()

    return src.mapInArrow(run, f"block long, ids array<{id_type}>, lengths array<long>, size long, blob binary")


def _inside(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """block and inside: for each 32,768 documents of a block with any in the target, their number (from 1) and a bit for each."""
    found = blocks.select("block", F.posexplode("ids").alias("at", "_id")).join(wanted, F.col("_id") == F.col("_target")) \
        .select("block", (F.col("at") + 1).alias("at"))  # bitmaps begin at 1
    bits = found.groupBy("block", F.bitmap_bucket_number("at").alias("number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    return bits.groupBy("block").agg(F.collect_list(F.struct("number", "bits")).alias("inside"))


def _flags(inside: list[dict] | None, n: int) -> np.ndarray:
    """Whether each of a block's ``n`` documents is in the target."""
    out = np.zeros(n, bool)
    for part in inside or ():
        bits = np.flatnonzero(np.unpackbits(np.frombuffer(part["bits"], np.uint8), bitorder="little"))
        out[(part["number"] - 1) * _BITS + bits] = True
    return out


def _text_of(row: dict) -> tuple[bytes, np.ndarray]:
    return pa.decompress(row["blob"], decompressed_size=row["size"], codec="zstd", asbytes=True) if row["size"] else b"", \
        np.array(row["lengths"], np.int64)


def _block_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's distinct 4-grams, numbered in their order, with counts in all documents and in the target's."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            blob, lengths = _text_of(row)
            texts = _Texts(blob, lengths)
            wanted = _flags(row["inside"], lengths.size)
            parts, ns = [], []
            for code, owner in texts.pieces():
                some, n = np.unique(code, return_counts=True)
                among = np.sort(code[wanted[owner]])
                parts.append(some)
                ns.append((n, np.searchsorted(among, some, "right") - np.searchsorted(among, some)))
            seen = _merged(parts)
            n = np.zeros((2, seen.size), np.int64)
            for some, both in zip(parts, ns, strict=True):
                n[:, np.searchsorted(seen, some)] += both
            context, char = texts.spelled(seen)
            for a in range(0, seen.size, 50_000):
                s = slice(a, a + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(seen[s].size, row["block"])), pa.array(np.arange(a, a + seen[s].size), pa.int32()), pa.array(context[s]),
                     pa.array(char[s]), pa.array(n[0][s]), pa.array(n[1][s])],
                    names=["block", "at", "context", "char", "background", "target"])


def _grams(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", "lengths", "inside", "size", "blob") \
        .mapInArrow(_block_grams, "block long, at int, context long, char long, background long, target long")


def gram_losses(counted: DataFrame) -> DataFrame:
    """context, char and the target's and the background's loss of every 4-gram, from its counts.

    Every order is a table; each is joined with its contexts and the order below.
    """
    both = ("background", "target")
    by_order = {ORDER: counted}
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("context").bitwiseAND(F.lit((1 << _CHAR * (order - 1)) - 1))
        by_order[order] = stored(by_order[order + 1].select(shorter.alias("context"), "char", *both)
                                 .groupBy("context", "char").agg(*[F.sum(c).alias(c) for c in both]))
    whole = by_order[1].agg(F.count(F.lit(1)).alias("kinds"), *[F.sum(c).alias(c) for c in both],
                            F.count_if(F.col("target") > 0).alias("some")).first()
    uniform = F.lit(1.0 / max(whole["kinds"], 1))

    def smoothed(n, all_, kinds, low):
        return F.when(all_ > 0, (n + kinds * low) / (all_ + kinds)).otherwise(low)

    p = by_order[1].select("context", "char", *[
        smoothed(F.col(c), F.lit(whole[c] or 0), F.lit(k), uniform).alias(f"p_{c}") for c, k in zip(both, (whole["kinds"], whole["some"]), strict=True)])
    for order in range(2, ORDER + 1):
        grams_ = by_order[order]
        # `+ 0`: the joins deal these sides out anew, so that a frequent context's rows can be split
        contexts = grams_.groupBy("context").agg(*[F.sum(c).alias(f"all_{c}") for c in both],
                                                 *[F.count_if(F.col(c) > 0).alias(f"kinds_{c}") for c in both]) \
            .withColumn("context", F.col("context") + 0)
        shorter = F.col("context").bitwiseAND(F.lit((1 << _CHAR * (order - 2)) - 1))
        lower = p.select(F.col("context").alias("shorter"), (F.col("char") + 0).alias("char"), *[f"p_{c}" for c in both])
        p = stored(grams_.join(contexts, "context").withColumn("shorter", shorter).join(lower, ["shorter", "char"]).select(
            "context", "char", *[smoothed(F.col(c), F.col(f"all_{c}"), F.col(f"kinds_{c}"), F.col(f"p_{c}")).alias(f"p_{c}") for c in both]))
    return p.select("context", "char", (-F.ln("p_target")).alias("target_loss"), (-F.ln("p_background")).alias("background_loss"))


def score_corpus(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = 16 << 20) -> DataFrame:
    """The id, n_tokens, target_loss, background_loss and score of every row, by models over all characters of ``docs``."""
    wanted = target_ids.select(F.col(id_col).alias("_target")).filter("_target IS NOT NULL").distinct()
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()
    blocks = stored(_blocks(src, id_type, block_bytes))
    spark = docs.sparkSession
    # as files, whose size Spark knows: a small table of bits leaves the blocks where they are
    folder = f"{checkpoint_dir(spark)}/lm-scoring-{uuid.uuid4()}"
    _inside(blocks, wanted).write.option("compression", "zstd").parquet(folder)
    marked = blocks.join(spark.read.parquet(folder), "block", "left")
    grams_ = _grams(marked)
    counted = stored(grams_.groupBy("context", "char").agg(F.sum("background").alias("background"), F.sum("target").alias("target")))
    delete_folder(spark, folder)
    grams_ = _grams(blocks.withColumn("inside", F.lit(None).cast(_INSIDE)))  # only which there are
    table = gram_losses(counted)
    answers = grams_.select("block", "at", "context", "char").join(table.withColumn("char", F.col("char") + 0), ["context", "char"]) \
        .select("block", "at", "target_loss", "background_loss")
    out = f"_id {id_type}, n_tokens long, target_loss double, background_loss double, score double"

    def judge(texts: pa.Table, losses_: pa.Table) -> pa.Table:
        parts = []
        order = np.argsort(losses_.column("at").to_numpy())
        tables = [losses_.column(c).to_numpy()[order] for c in ("target_loss", "background_loss")]
        for row in texts.select(["lengths", "size", "blob"]).to_pylist():
            blob, lengths = _text_of(row)
            block = _Texts(blob, lengths)
            index = pd.Index(block.distinct())
            sums = np.zeros((2, lengths.size))
            for code, owner in block.pieces():
                if code.size:
                    at, first = index.get_indexer(code), owner[0]
                    for which, table_ in enumerate(tables):
                        n = np.bincount(owner - first, table_[at])
                        sums[which, first:first + n.size] += n
            means = sums / np.maximum(lengths, 1)
            parts.append((lengths, *means, means[0] - means[1]))
        ids = texts.column("ids").combine_chunks().flatten()
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        return pa.Table.from_arrays([ids, *map(pa.array, columns)], names=["_id", "n_tokens", "target_loss", "background_loss", "score"])

    tasks = shuffle_partitions(spark)
    return blocks.select("block", "ids", "lengths", "size", "blob").repartition(tasks, "block").groupBy("block") \
        .cogroup(answers.repartition(tasks, "block").groupBy("block")).applyInArrow(judge, out).withColumnRenamed("_id", id_col)
