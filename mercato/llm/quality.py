"""Quality of documents by a linear-chain conditional random field over lines.

Every line of a document is good or bad.  The field scores a labelling of all
lines by weights of each line's features and those of the lines before and
after it, and by a weight for each pair of neighbouring labels.  Forward and
backward sums give each line's marginal probability of being good; a document's
score is their mean, weighted by the lengths of the lines.

The field is fitted by gradient ascent on a bounded sample of labelled
documents (``sample``, a parameter): those with the smallest hash of the id.
A document's label is that of all its lines.  Everything else runs over whole
texts of all documents.

Defined results: a null text counts as empty, and an empty text is one empty
line, so both get a score; repeated rows are scored each on their own; rows
without an id, label or document teach nothing; with no labelled row at all the
score is 0.5; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import Spans, slices, texts_of

# ------------------------------------------------------------------ features

_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _BAR, _BANG, _SIGN, _QUOTE = range(9)
_CLASSES = 9


def _class_table() -> np.ndarray:
    table = np.full(0x250, _SIGN, np.int64)
    for code in range(0x250):
        c = chr(code)
        if c.isalpha():
            table[code] = _UPPER if c.isupper() else _LOWER
        elif c.isdigit():
            table[code] = _DIGIT
        elif c.isspace():
            table[code] = _SPACE
    for kind, chars in ((_STOP, ".,;:-"), (_BAR, "|<>{}[]=\\/"), (_BANG, "!?"), (_QUOTE, "'\"()")):
        for c in chars:
            table[ord(c)] = kind
    return table


_TABLE = _class_table()
FEATURES = ("one", "length", "upper", "digit", "space", "stop", "bar", "bang", "sign", "quote", "repeats", "again",
            "word_length", "is_copy", "is_short")


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x FEATURES), lengths of the lines, first line of each text.

    A blank line has zeros throughout.
    """
    joined = "\n".join(texts) + "\n"
    x = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.flatnonzero(x == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    lengths = ends - starts
    n = ends.size
    first = np.concatenate(([0], np.cumsum([t.count("\n") + 1 for t in texts])[:-1])).astype(np.int64)
    line = np.repeat(np.arange(n), lengths + 1)
    kind = np.where(x < 0x250, _TABLE[np.minimum(x, 0x24F)], _LOWER)
    counts = np.bincount(line * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES).astype(np.float64)
    counts[:, _SPACE] -= 1  # the line's end
    hashes = Spans(x)  # words and lines are compared by these
    blank = np.concatenate(([True], kind == _SPACE))
    opens = np.flatnonzero(blank[:-1] & ~blank[1:])
    shuts = np.flatnonzero(~blank[:-1] & blank[1:])
    owner, word = line[opens], hashes(opens, shuts)
    words = np.bincount(owner, minlength=n).astype(np.float64)
    same = np.zeros(opens.size, bool)
    same[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    again = np.bincount(owner[same], minlength=n) / np.maximum(words, 1)
    low = np.uint64((1 << 24) - 1)  # a line's number; the rest is its words' hashes
    tagged = np.sort((word & ~low) | (owner.astype(np.uint64) & low))
    new = np.ones(tagged.size, bool)
    new[1:] = tagged[1:] != tagged[:-1]
    distinct = np.bincount((tagged[new] & low).astype(np.int64), minlength=n)
    # lines that stand earlier in the same text
    text_of = np.repeat(np.arange(len(texts)), np.diff(np.concatenate((first, [n]))))
    whole = hashes(starts, ends)
    order = np.lexsort((whole, text_of))
    copy = np.zeros(n)
    a, b = order[1:], order[:-1]
    copy[a] = (whole[a] == whole[b]) & (text_of[a] == text_of[b]) & (lengths[a] > 0)
    size = np.maximum(lengths, 1).astype(np.float64)
    letters = np.maximum(counts[:, _LOWER] + counts[:, _UPPER], 1)
    f = np.empty((n, len(FEATURES)))
    f[:, 0] = 1
    f[:, 1] = np.log1p(lengths) / 5
    f[:, 2] = counts[:, _UPPER] / letters
    for at, kind_ in enumerate((_DIGIT, _SPACE, _STOP, _BAR, _BANG, _SIGN, _QUOTE), 3):
        f[:, at] = np.minimum(counts[:, kind_] / size * 5, 2)
    f[:, 10] = 1 - distinct / np.maximum(words, 1)
    f[:, 11] = again
    f[:, 12] = np.minimum((lengths - counts[:, _SPACE]) / np.maximum(words, 1) / 10, 3)
    f[:, 13] = copy
    f[:, 14] = words < 4
    f[lengths == counts[:, _SPACE]] = 0
    return f, lengths, first


def with_neighbours(f: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, then those of the line before and the line after it
    (zeros where the text begins or ends)."""
    before, after = np.zeros_like(f), np.zeros_like(f)
    before[1:], after[:-1] = f[:-1], f[1:]
    before[first] = 0
    after[first[1:] - 1] = 0
    return np.hstack((f, before, after))


# --------------------------------------------------------------------- field

@dataclass(frozen=True)
class Field:
    """Weights of a fitted field.

    A line's features are first centred, scaled and held within +-10, so that
    lines unlike any in the sample don't outweigh all others; a blank line says
    nothing about itself.
    """

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray      # of being good over being bad
    pairs: np.ndarray        # 2 x 2: label of a line, label of the next

    def inputs(self, f: np.ndarray) -> np.ndarray:
        return np.where(f[:, :1] > 0, np.clip((f - self.mean) / self.scale, -10, 10), 0)


def marginals(good: np.ndarray, pairs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and the expected number of each pair of neighbours.

    ``good`` is each line's log weight of good over bad.  All texts advance
    together, one line a step; a text drops out behind its last line.
    """
    n = good.size
    size = np.diff(np.concatenate((first, [n])))
    by_size = np.argsort(-size, kind="stable")
    first, size = first[by_size], size[by_size]
    unary = np.stack((np.zeros(n), good), 1)
    fore, back = np.empty((n, 2)), np.zeros((n, 2))
    fore[first] = unary[first]
    alive = [int(np.searchsorted(-size, -t, "left")) for t in range(int(size[0]) if size.size else 0)]
    for t in range(1, len(alive)):
        at = first[:alive[t]] + t
        fore[at] = unary[at] + np.logaddexp(fore[at - 1, :1] + pairs[0], fore[at - 1, 1:] + pairs[1])
    for t in range(len(alive) - 1, 0, -1):
        at = first[:alive[t]] + t
        behind = unary[at] + back[at]
        back[at - 1] = np.logaddexp(behind[:, :1] + pairs[:, 0], behind[:, 1:] + pairs[:, 1])
    joint = fore + back
    p = 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -700, 700)))
    inner = np.ones(n, bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    edge = fore[at - 1][:, :, None] + pairs + (unary[at] + back[at])[:, None, :]
    edge = np.exp(edge - edge.max((1, 2), keepdims=True)) if at.size else edge
    return p, (edge / edge.sum((1, 2), keepdims=True)).sum(0) if at.size else np.zeros((2, 2))


def fit(f: np.ndarray, first: np.ndarray, labels: np.ndarray, steps: int = 120, ridge: float = 0.3) -> Field:
    """Weights of the largest penalised likelihood, by a limited-memory
    quasi-Newton ascent over the whole sample.

    ``f``: features with neighbours of all lines; ``labels``: 0 or 1 of each text.
    """
    mean, scale = f.mean(0), f.std(0)
    mean[0], scale[scale < 1e-9] = 0.0, 1.0
    z = Field(mean, scale, mean, mean).inputs(f)
    sizes = np.diff(np.concatenate((first, [len(f)])))
    truth = np.repeat(labels, sizes).astype(np.float64)
    stay = np.array([((labels == k) * (sizes - 1)).sum() for k in (0, 1)], np.float64)
    w = np.zeros(z.shape[1] + 4)
    moves: list[tuple[np.ndarray, np.ndarray]] = []  # of the weights and of the slope
    old_w = old_g = None
    for _ in range(steps):
        p, pairs = marginals(z @ w[:-4], w[-4:].reshape(2, 2), first)
        g = np.concatenate((z.T @ (truth - p), (np.diag(stay) - pairs).ravel())) - ridge * w
        if old_w is not None and (w - old_w) @ (old_g - g) > 1e-12:
            moves = [*moves[-9:], (w - old_w, old_g - g)]
        old_w, old_g = w.copy(), g
        q, parts = g.copy(), []
        for s, y in reversed(moves):
            parts.append(s @ q / (s @ y))
            q -= parts[-1] * y
        q *= moves[-1][0] @ moves[-1][1] / (moves[-1][1] @ moves[-1][1]) if moves else 1 / len(z)
        for (s, y), part in zip(moves, reversed(parts), strict=True):
            q += s * (part - y @ q / (s @ y))
        w = w + q * min(1.0, 2 / max(np.abs(q).max(), 1e-12))
        if np.abs(g).max() < 1e-3 * len(sizes) ** 0.5:
            break
    return Field(mean, scale, w[:-4], w[-4:].reshape(2, 2))


def document_scores(field: Field | None, texts: list[str]) -> np.ndarray:
    """0 to 1 for each text: its lines' P(good), weighted by length."""
    if field is None:
        return np.full(len(texts), 0.5)
    f, lengths, first = line_features(texts)
    p, _ = marginals(field.inputs(with_neighbours(f, first)) @ field.weights, field.pairs, first)
    weight = lengths + 1e-9
    return np.clip(np.add.reduceat(p * weight, first) / np.add.reduceat(weight, first), 0, 1)


# --------------------------------------------------------------------- Spark

def learn(docs: DataFrame, labels: DataFrame, train: Column, sample: int = 4000, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Field | None:
    """A field fitted on at most ``sample`` labelled documents for which ``train``
    (an expression on the id) holds: those with the smallest hash of the id.

    A document with several labels has the smallest.  Executors compute the
    lines' features; the driver gets those of the sample and fits.
    """
    chosen = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & train) \
        .groupBy(F.col(id_col).alias("_id")).agg((F.min(label_col) > 0).cast("int").alias("_label")) \
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")) \
        .join(F.broadcast(chosen), "_id").select("_label", "_text")  # at most `sample` ids

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            f, _, first = line_features(texts_of(part, "_text"))
            cut = np.split(with_neighbours(f, first).astype("<f4"), first[1:])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.tobytes() for c in cut], pa.binary())],
                                             names=["label", "lines"])

    rows = src.mapInArrow(features, "label int, lines binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lines"], r["label"]))  # the same sum in any order of arrival
    lines = [np.frombuffer(r["lines"], "<f4").reshape(-1, 3 * len(FEATURES)) for r in rows]
    first = np.concatenate(([0], np.cumsum([len(x) for x in lines])[:-1])).astype(np.int64)
    return fit(np.vstack(lines).astype(np.float64), first, np.array([r["label"] for r in rows]))


def score(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and score of every document."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", 1 << 20):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(document_scores(field, texts_of(part, "_text")))],
                                             names=["_id", "score"])

    return src.mapInArrow(run, f"_id {id_type}, score double").withColumnRenamed("_id", id_col)


def keep_good(docs: DataFrame, field: Field | None, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that score ``least`` or more."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col, 1 << 20):
            scores = document_scores(field, [t or "" for t in part.column(at).to_pylist()])
            yield part.filter(pa.array(scores >= least))

    return docs.mapInArrow(run, docs.schema)
