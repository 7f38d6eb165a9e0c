"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A letter trigram is *bound*
from the vectors of its letters, each permuted (rolled) by its place; a text is
the *bundle* (weighted sum) of its trigrams, and a language the bundle of its
training texts.  A document gets the language whose prototype has the largest
cosine with the document's bundle.

Letters are lower-cased; everything else is one word boundary, which takes part
as a letter of its own.  Each training text counts with the relative
frequencies of its trigrams, so a long text weighs as much as a short one.

Learning sums bundles on the executors, one row per language and batch, and
Spark adds them up by language; the model is one vector per language, which is
what the driver holds and every task gets.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is every text when nothing could be learned.  Rows with a null language or
null text teach nothing.  Equal cosines go to the language that sorts first.
Repeated rows are scored each on their own; all other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import slices, texts_of

UNKNOWN = "und"
_BOUNDARY = 0x20


class Space:
    """The vectors of letters, and bundles of texts."""

    def __init__(self, dimension: int = 1024, seed: int = 7):
        self.dimension, self.seed = dimension, seed
        self.letters: dict[int, np.ndarray] = {}
        self.grams: dict[int, np.ndarray] = {}
        self.kind: dict[int, int] = {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            draw = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimension)
            self.letters[code] = (2 * draw - 1).astype(np.int8)
        return self.letters[code]

    def gram(self, code: int) -> np.ndarray:
        """The bound vector of a trigram; its letters are 21 bits each."""
        if code not in self.grams:
            if len(self.grams) > 20_000:  # bounds a worker's memory
                self.grams.clear()
            a, b, c = code >> 42, (code >> 21) & 0x1FFFFF, code & 0x1FFFFF
            self.grams[code] = np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)
        return self.grams[code]

    def _letters_of(self, codes: np.ndarray) -> np.ndarray:
        """Code points with everything that is no letter made a boundary."""
        seen = np.flatnonzero(np.bincount(codes)) if codes.size else codes
        for c in seen.tolist():
            if c not in self.kind:
                self.kind[c] = c if chr(c).isalpha() else _BOUNDARY
        table = np.full(int(seen[-1]) + 1 if seen.size else 1, _BOUNDARY, np.int64)
        table[seen] = [self.kind[c] for c in seen.tolist()]
        return table[codes]

    def profiles(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Relative trigram frequencies (texts x trigrams seen) and the trigrams.

        A text without a letter has a row of zeros.
        """
        lower = [t.lower() for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in lower])
        joined = "".join(f" {t} " for t in lower).encode("utf-32-le", "surrogatepass")
        x = self._letters_of(np.frombuffer(joined, np.uint32))
        # a run of boundaries counts once
        keep = np.ones(x.size, bool)
        keep[1:] = (x[1:] != _BOUNDARY) | (x[:-1] != _BOUNDARY) | (owner[1:] != owner[:-1])
        x, owner = x[keep], owner[keep]
        if x.size < 3:
            return np.zeros((len(texts), 0), np.float32), np.zeros(0, np.int64)
        inside = owner[2:] == owner[:-2]
        symbols = np.flatnonzero(np.bincount(x))
        n = symbols.size
        place = np.zeros(int(symbols[-1]) + 1, np.int64)
        place[symbols] = np.arange(n)
        d = place[x]
        if n ** 3 <= 1 << 22:
            dense = (d[:-2] * n + d[1:-1]) * n + d[2:]
            dense = dense[inside]
            seen = np.flatnonzero(np.bincount(dense, minlength=1))
            rank = np.zeros(n ** 3, np.int64)
            rank[seen] = np.arange(seen.size)
            at = rank[dense]
        else:
            dense = ((d[:-2] * n + d[1:-1]) * n + d[2:])[inside]
            seen, at = np.unique(dense, return_inverse=True)
        who = owner[2:][inside]
        codes = (symbols[seen // (n * n)] << 42) | (symbols[seen // n % n] << 21) | symbols[seen % n]
        counts = np.bincount(who * seen.size + at, minlength=len(texts) * seen.size).reshape(len(texts), -1).astype(np.float32)
        return counts / np.maximum(counts.sum(1, keepdims=True), 1), codes

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([self.gram(c) for c in codes.tolist()]).astype(np.float32) if codes.size else np.zeros((0, self.dimension), np.float32)

    def bundles(self, texts: list[str]) -> np.ndarray:
        profiles, codes = self.profiles(texts)
        return profiles @ self.vectors(codes)


_spaces: dict[tuple[int, int], Space] = {}


def _space(dimension: int, seed: int) -> Space:
    return _spaces.setdefault((dimension, seed), Space(dimension, seed))


def learn(docs: DataFrame, train: Column, dimension: int = 1024, seed: int = 7,
          text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Language -> prototype, from the rows of ``docs`` for which ``train`` holds."""
    src = docs.filter(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).cast("string").alias("_text"))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = _space(dimension, seed), {}
        for part in slices(batches, "_text", 1 << 20):
            langs = np.array(part.column(0).to_pylist(), object)
            profiles, codes = space.profiles(texts_of(part, "_text"))
            names = sorted(set(langs))
            totals = np.stack([profiles[langs == name].sum(0) for name in names]) @ space.vectors(codes)
            for name, total in zip(names, totals, strict=True):
                sums[name] = sums.get(name, 0) + total.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                                             names=["lang", "bundle"])

    parts = src.mapInArrow(bundle, "lang string, bundle array<double>")
    added = parts.select("lang", F.posexplode("bundle").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x")) \
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v"))
    return {r["lang"]: np.array([e["x"] for e in r["v"]]) for r in added.collect()}


def scorer(prototypes: dict[str, np.ndarray], dimension: int = 1024, seed: int = 7
           ) -> Callable[[list[str]], tuple[list[str], np.ndarray]]:
    """A function from texts to predicted languages and cosines (0 to 1)."""
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] for n in names]).astype(np.float32) if names else np.zeros((0, dimension), np.float32)
    matrix = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-30)

    def score(texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        b = _space(dimension, seed).bundles(texts)
        norms = np.linalg.norm(b, axis=1)
        cos = (b @ matrix.T) / np.maximum(norms, 1e-30)[:, None]
        best = cos.argmax(1)
        lettered = np.array([any(map(str.isalpha, t[:64])) or any(map(str.isalpha, t)) for t in texts], bool)
        return ([names[k] if ok else UNKNOWN for k, ok in zip(best, lettered, strict=True)],
                np.where(lettered, np.clip(cos[np.arange(len(texts)), best], 0, 1), 0.0).astype(np.float64))

    return score


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dimension: int = 1024, seed: int = 7,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, lang_pred and score of every document."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(prototypes, dimension, seed)
        for part in slices(batches, "_text", 1 << 20):
            langs, scores = score(texts_of(part, "_text"))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores)],
                                             names=["_id", "lang_pred", "score"])

    return src.mapInArrow(run, f"_id {id_type}, lang_pred string, score double").withColumnRenamed("_id", id_col)


def keep_languages(docs: DataFrame, prototypes: dict[str, np.ndarray], least: float, dimension: int = 1024,
                   seed: int = 7, text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of ``least`` or more.

    ``lang_col``: a column that gets the predicted language in place of what it held; all else is unchanged.
    """
    at = docs.columns.index(text_col)
    into = None if lang_col is None else docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(prototypes, dimension, seed)
        for part in slices(batches, text_col, 1 << 20):
            langs, scores = score([t or "" for t in part.column(at).to_pylist()])
            if into is not None:
                field = part.schema.field(into)
                part = part.set_column(into, field, pa.array(langs, pa.string()).cast(field.type))
            yield part.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(langs, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
