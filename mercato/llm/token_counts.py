"""Word-piece counts by a linear longest-match automaton.

Greedy longest match cuts a word into vocabulary pieces from the left.  The
automaton is a trie of the vocabulary.  Where no edge goes on, a node's *failure
link* leads to the node that stands for what is left over after the longest
matches of its path have been popped off, and the number of *popped* pieces is
stored with the link.  Following edges and links, each byte is read once, and
the count of pieces is the sum of the popped counts: no piece is ever built.

A node that is itself a vocabulary entry pops itself and fails to the root.  Any
other node pops what its parent pops and then goes on from the parent's failure
node with its own byte, popping more until that byte can be read.

Texts are cut at white space (space and the control characters 9 to 13).  Every
word is read with a space before it, as byte-level vocabularies have it.  A word
that the vocabulary cannot spell counts as one unknown piece.

Defined results: a text that is null, empty or white space has no words and no
pieces; repeated rows are counted each on their own; a null id is carried
through; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import Spans, slices
from mercato.llm.packing import _byte_of_letter

_DEAD = -1


def vocabulary(path: str) -> list[bytes]:
    """The entries of a byte-level ``tokenizers`` file as bytes, without special tokens."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    special = {t["content"] for t in data.get("added_tokens", [])}
    as_byte = _byte_of_letter()
    return [bytes(as_byte[c] for c in token) for token in data["model"]["vocab"] if token not in special]


class Automaton:
    """Trie edges as one sorted array of (node, byte), failure links and popped counts."""

    def __init__(self, entries: list[bytes]):
        children: list[dict[int, int]] = [{}]
        parent, byte, final = [0], [0], [False]
        for entry in entries:
            node = 0
            for b in entry:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    parent.append(node)
                    byte.append(b)
                    final.append(False)
                node = children[node][b]
            final[node] = node != 0
        fail, popped = [_DEAD] * len(children), [0] * len(children)
        level = list(children[0].values())
        while level:
            for node in level:
                if final[node]:
                    fail[node], popped[node] = 0, 1
                    continue
                at, n = fail[parent[node]], popped[parent[node]]
                while at != _DEAD and byte[node] not in children[at]:
                    n += popped[at]
                    at = fail[at]
                if at != _DEAD:
                    fail[node], popped[node] = children[at][byte[node]], n
            level = [c for node in level for c in children[node].values()]
        edges = sorted((node * 256 + b, child) for node, out in enumerate(children) for b, child in out.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.to = np.array([c for _, c in edges], np.int64)
        self.fail, self.popped = np.array(fail, np.int64), np.array(popped, np.int64)

    def _step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node an edge leads to, or -1."""
        key = node * 256 + byte
        at = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
        return np.where(self.keys[at] == key, self.to[at], _DEAD) if self.keys.size else np.full(node.size, _DEAD)

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word ``data[start:end]``, read with a space before it; all words advance together."""
        n = starts.size
        node, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        by_length = np.argsort(starts - ends, kind="stable")  # longest first
        length = (ends - starts)[by_length]
        lost = np.zeros(n, bool)
        for i in range(-1, int(length[0]) if n else -1):
            active = by_length[:np.searchsorted(-length, -i, "left")] if i >= 0 else by_length
            active = active[~lost[active]]
            byte = data[starts[active] + i].astype(np.int64) if i >= 0 else np.full(active.size, 32)
            while active.size:
                to = self._step(node[active], byte)
                moved = to != _DEAD
                node[active[moved]] = to[moved]
                active, byte = active[~moved], byte[~moved]
                self._fail(active, node, total, lost)
                still = ~lost[active]
                active, byte = active[still], byte[still]
        open_ = np.flatnonzero(~lost & (node != 0))
        while open_.size:
            self._fail(open_, node, total, lost)
            open_ = open_[~lost[open_] & (node[open_] != 0)]
        total[lost] = 1
        return total

    def _fail(self, at: np.ndarray, node: np.ndarray, total: np.ndarray, lost: np.ndarray) -> None:
        dead = self.fail[node[at]] == _DEAD
        lost[at[dead]] = True
        at = at[~dead]
        total[at] += self.popped[node[at]]
        node[at] = self.fail[node[at]]


_automata: dict[str, Automaton] = {}


def _automaton(path: str) -> Automaton:
    if path not in _automata:
        _automata[path] = Automaton(vocabulary(path))
    return _automata[path]


def count_texts(automaton: Automaton, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words and pieces of each UTF-8 text; a word that repeats is read once."""
    x = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = np.concatenate(([True], (x == 32) | ((x >= 9) & (x <= 13))))
    opens = np.flatnonzero(blank[:-1] & ~blank[1:])
    shuts = np.flatnonzero(~blank[:-1] & blank[1:])
    _, one, which = np.unique(Spans(x)(opens, shuts), return_index=True, return_inverse=True)
    pieces = automaton.count(x, opens[one], shuts[one])[which] if opens.size else np.zeros(0, np.int64)
    last = np.searchsorted(opens, np.cumsum([len(t) + 1 for t in texts]))
    first = np.concatenate(([0], last[:-1]))
    sums = np.concatenate(([0], np.cumsum(pieces)))
    return last - first, sums[last] - sums[first]


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, n_words and n_pieces of every row."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").cast("binary").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(vocabulary_path)
        for part in slices(batches, "_text"):
            words, pieces = count_texts(automaton, [t or b"" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words, pa.int64()), pa.array(pieces, pa.int64())],
                                             names=["_id", "n_words", "n_pieces"])

    return src.mapInArrow(run, f"_id {id_type}, n_words long, n_pieces long").withColumnRenamed("_id", id_col)
