"""Hard negatives by Four-Russians scoring.

Vectors become integers.  For an anchor and each group of eight dimensions a
table holds the sums of all 256 subsets of the anchor's components there
(``subset_sums``).  Candidates are packed into bit planes: one byte holds one
binary digit of eight neighbouring components (``bit_planes``).  A byte is the
index into the group's table; the looked-up sums of a plane are added, shifted
by the plane's weight (the sign's plane counts negative) and added up to the full
and exact inner product (``inner_products``).

An anchor's positives are its best rows of the same label.  Its negatives for a
positive are the best rows of other labels whose score lies between ``low`` and
``high`` per cent of the positive's.

Candidates are dealt at random into blocks, each sent once; anchors are sent to
every block.  A task reads its block's candidates, packs them, and lets the
anchors stream past in Arrow batches (``_meet``): it holds one block and a few
anchors' scores, however many anchors there are.  It returns its best rows for
each anchor, and a window over those picks the final ones.  The first pass scores
candidates of the anchor's label only, the second one all others, so every pair
is scored once.

Defined results: rows whose label, vector or id is null, or with a null or
non-finite component, take no part; a shorter vector counts as filled up with
zeros; rows that share an anchor's id are neither its positives nor its negatives;
an anchor row that repeats is asked once, and rows of one id that differ are
anchors of their own; repeated candidates are all listed, and so are a repeated
positive's negatives; ties go to the smaller id; fewer rows than asked for are all
returned; an anchor without positives gives no rows; scores beyond a long are
held at its bounds; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import shuffle_partitions
from mercato.llm.topk import to_integers

_GROUP = 8
_BITS = (np.arange(1 << _GROUP)[None, :] >> np.arange(_GROUP)[:, None]) & 1  # dimension x subset
_MOST = 1 << 63
_FEW = 32  # anchors scored at a time


def bit_planes(x: np.ndarray) -> np.ndarray:
    """Two's complement digits of rows of integers as bytes: plane x group x row; the last plane is the sign."""
    rows, width = x.shape
    most = max((max(int(c), ~int(c)) for c in (x.max(), x.min())), default=0) if x.size else 0
    planes = most.bit_length() + 1
    groups = -(-width // _GROUP)
    wide = np.zeros((rows, groups * _GROUP), x.dtype)
    wide[:, :width] = x
    out = np.empty((planes, groups, rows), np.uint8)
    for plane in range(planes):
        digit = ((wide >> plane) & 1).astype(np.uint8)
        out[plane] = np.packbits(digit, axis=1, bitorder="little").T
    return out


def subset_sums(anchor: np.ndarray) -> np.ndarray:
    """group x 256 sums of the anchor's components, by the byte that marks the subset."""
    groups = -(-anchor.size // _GROUP)
    wide = np.zeros(groups * _GROUP, anchor.dtype)
    wide[:anchor.size] = anchor
    return wide.reshape(groups, _GROUP) @ _BITS.astype(anchor.dtype)


def inner_products(anchors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """anchor x row exact scores by table lookup, shift and addition."""
    n_planes, groups, rows = planes.shape
    total = np.zeros((len(anchors), rows), anchors.dtype)
    for row, anchor in zip(total, anchors, strict=True):
        tables = subset_sums(anchor)
        for plane in range(n_planes):
            held = np.zeros(rows, anchors.dtype)
            for group in range(groups):
                held += tables[group][planes[plane, group]]
            if plane == n_planes - 1:
                row -= held << plane
            else:
                row += held << plane
    return total


def _fits(a: np.ndarray, b: np.ndarray) -> bool:
    if a.dtype == object or b.dtype == object:
        return False
    # a power of two above each, as the planes' weights go up to the sign's
    return 4.0 * (float(np.abs(a).max(initial=0)) + 1) * (float(np.abs(b).max(initial=0)) + 1) * max(a.shape[1], 1) < 2.0 ** 62


class Block:
    """Candidates by label, packed once."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.planes = bit_planes(self.x)

    def rows_of(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))

    def scores(self, anchors: np.ndarray, keep: np.ndarray | slice) -> np.ndarray:
        planes = self.planes[:, :, keep]
        wide = np.zeros((len(anchors), self.x.shape[1]), anchors.dtype)  # of equal width: a shorter vector ends in zeros
        width = min(wide.shape[1], anchors.shape[1])
        wide[:, :width] = anchors[:, :width]
        anchors = wide
        if _fits(anchors, self.x):
            return inner_products(anchors.astype(np.int64), planes)
        exact = inner_products(np.array([[int(c) for c in a] for a in anchors], object).reshape(anchors.shape), planes)
        return np.array([[min(max(int(s), -_MOST), _MOST - 1) for s in row] for row in exact], np.int64).reshape(exact.shape)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, ties to the smaller id."""
    if scores.size > 4 * k:
        bar = np.partition(scores, scores.size - k)[scores.size - k]
        some = np.flatnonzero(scores >= bar)
    else:
        some = np.arange(scores.size)
    return some[np.lexsort((ids[some], ~scores[some]))][:k]  # ~ reverses the order, also at the bounds


def _meet(batches: Iterator[pa.RecordBatch], scale: int, answer: Callable[[Block, dict], dict[str, np.ndarray]],
          schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks follow one another; of each the candidates come first, then the anchors pass by."""
    block_id, held, block = None, [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        blocks, is_anchor = table.column("block").to_numpy(), table.column("is_anchor").to_numpy()
        turns = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(is_anchor.astype(np.int8)) != 0)) + 1
        for a, b in zip([0, *turns], [*turns, batch.num_rows], strict=True):
            if a == b:
                continue
            if blocks[a] != block_id:
                block_id, held, block = blocks[a], [], None
            run = table.slice(a, b - a)
            if not is_anchor[a]:
                held.append(run)
                continue
            if block is None:
                if not held:
                    continue  # an anchor of a block without candidates
                rows = pa.concat_tables(held)
                block = Block(rows.column("id").to_numpy(), rows.column("label").to_numpy(), to_integers(_vectors(rows), scale))
                held = []
            for at in range(0, run.num_rows, _FEW):
                some = run.slice(at, _FEW)
                found = answer(block, {"x": to_integers(_vectors(some), scale), "rows": some})
                if found["asked"].size:
                    yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in schema], schema=schema)


def _vectors(rows: pa.Table) -> list[np.ndarray]:
    v = rows.column("v").combine_chunks()
    values, ends = v.values.to_numpy(zero_copy_only=False), v.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _columns(names: list[str], parts: list[tuple]) -> dict[str, np.ndarray]:
    if not parts:
        return {name: np.zeros(0, np.int64) for name in names}
    return {name: np.concatenate(c) for name, c in zip(names, zip(*parts, strict=True), strict=True)}


def _positives(block: Block, anchors: dict, k: int) -> dict[str, np.ndarray]:
    rows, out = anchors["rows"], []
    asked, own, labels = (rows.column(c).to_numpy() for c in ("asked", "id", "label"))
    for label in np.unique(labels):
        first, last = block.rows_of(label)
        if first == last:
            continue
        which = np.flatnonzero(labels == label)
        scores, ids = block.scores(anchors["x"][which], slice(first, last)), block.ids[first:last]
        for i, row in zip(which, scores, strict=True):
            other = np.flatnonzero(ids != own[i])
            best = other[_best(row[other], ids[other], k)]
            out.append((np.full(best.size, asked[i]), ids[best], row[best]))
    return _columns(["asked", "positive_id", "positive_score"], out)


def _negatives(block: Block, anchors: dict, k: int, low: int, high: int) -> dict[str, np.ndarray]:
    rows, out = anchors["rows"], []
    asked, own, labels = (rows.column(c).to_numpy() for c in ("asked", "id", "label"))
    bars = rows.column("positive_scores").to_pylist()
    for label in np.unique(labels):
        first, last = block.rows_of(label)
        keep = np.concatenate((np.arange(first), np.arange(last, block.ids.size)))
        if not keep.size:
            continue
        which = np.flatnonzero(labels == label)
        scores, ids = block.scores(anchors["x"][which], keep), block.ids[keep]
        for i, row in zip(which, scores, strict=True):
            other = ids != own[i]
            # whole numbers: 100 * score >= low * p is score >= ceil(low * p / 100)
            spans = [(place, -(-low * p // 100), high * p // 100) for place, p in enumerate(bars[i])]
            spans = [s for s in spans if s[1] <= s[2]]
            for place, least, most in spans:
                fit = np.flatnonzero(other & (row >= least) & (row <= most))
                best = fit[_best(row[fit], ids[fit], k)]
                out.append((np.full(best.size, asked[i]), np.full(best.size, place), ids[best], row[best]))
    return _columns(["asked", "place", "negative_id", "negative_score"], out)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   block: int = 1 << 16) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``is_anchor`` marks the anchors; every row is a candidate.  There are enough
    blocks of candidates for every task to have work, and none is larger than
    ``block`` by more than chance.
    """
    spark = vectors.sparkSession
    fine = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    src = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & fine) \
        .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                F.col(vector_col).cast("array<double>").alias("v"), is_anchor.alias("is_anchor"))
    n = src.count()
    blocks = max(1, -(-n // block), min(shuffle_partitions(spark), -(-n // 512)))
    deal = F.xxhash64("id", "label", "v")
    candidates = src.select(F.pmod(deal, F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("is_anchor"), "id", "label", "v")
    anchors = src.filter("is_anchor").dropDuplicates(["id", "label", "v"]).select(deal.alias("asked"), "id", "label", "v")

    def pass_over(asks: DataFrame, extra: dict[str, str], answer: Callable[[Block, dict], dict[str, np.ndarray]], schema: pa.Schema,
                  ddl: str) -> DataFrame:
        everywhere = asks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) \
            .select("block", F.lit(True).alias("is_anchor"), "id", "label", "v", "asked", *extra)
        rows = candidates.withColumn("asked", F.lit(None).cast("long"))
        for name, kind in extra.items():
            rows = rows.withColumn(name, F.lit(None).cast(kind))
        return rows.unionByName(everywhere).repartitionById(blocks, F.col("block")) \
            .sortWithinPartitions("block", "is_anchor").mapInArrow(lambda batches: _meet(batches, scale, answer, schema), ddl)

    near = pass_over(anchors, {}, lambda b, a: _positives(b, a, positives),
                     pa.schema([("asked", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())]),
                     "asked long, positive_id long, positive_score long")
    best = Window.partitionBy("asked").orderBy(F.col("positive_score").desc(), "positive_id")
    chosen = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives) \
        .groupBy("asked").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("chosen"))
    asks = anchors.join(chosen, "asked").withColumn("positive_scores", F.col("chosen.positive_score"))
    far = pass_over(asks, {"positive_scores": "array<long>"}, lambda b, a: _negatives(b, a, negatives, low, high),
                    pa.schema([("asked", pa.int64()), ("place", pa.int32()), ("negative_id", pa.int64()), ("negative_score", pa.int64())]),
                    "asked long, place int, negative_id long, negative_score long")
    last = Window.partitionBy("asked", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = far.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= negatives)
    about = asks.select("asked", F.col("id").alias("anchor_id"), "chosen")
    return ranked.join(about, "asked").withColumn("positive", F.col("chosen")[F.col("place")]) \
        .select("anchor_id", F.col("positive.positive_id").alias("positive_id"), "rank", "negative_id",
                F.col("positive.positive_score").alias("positive_score"), "negative_score")
