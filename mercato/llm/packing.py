"""Best-fit packing of tokenised documents after Martello-Toth reduction.

A document becomes one piece, or several when it is longer than a sequence.
Packing needs only the *lengths* of the pieces, and there are at most
``capacity`` different lengths.  So the instance that is solved is the
histogram of lengths: its size depends on the capacity and never on the number
of documents.  The solution is a list of patterns (lengths that share a
sequence, and how many sequences look like that); Spark ranks the pieces of
each length and deals them to the places the patterns offer.

The reduction follows Martello and Toth: taking lengths from the largest, a
small set of lengths is fixed as one sequence for good when it provably
dominates every other way to fill the sequence of that length.  Whatever the
rules leave undecided goes to best-fit decreasing.

Defined results: a null text counts as empty and yields one piece that holds
only the separator; repeated rows are packed each on their own; a null id is
carried through; an empty table yields no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import shuffle_partitions, slices, stored, texts_of

# --------------------------------------------------------------- tokenising

#: A text with other characters than these goes to the file's own tokenizer.
_OTHER = "[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ]"
#: How byte-level BPE cuts a text into words (fixed value of the vocabulary).
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The vocabulary is that of the given ``tokenizers`` file.  The merging itself
    is done by ``tiktoken`` with the file's ids as ranks, which gives equal ids
    three times as fast (tested against the file's own tokenizer).  Texts
    outside plain characters, or with the string of an added token, which the
    tokenizer reads as that token, go to the file's own tokenizer.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.slow = re.compile("|".join([_OTHER, *(re.escape(t.content) for t in special.values())]))
        as_byte = _byte_of_letter()
        ranks = {bytes(as_byte[c] for c in token): i for token, i in self.tokenizer.get_vocab().items() if i not in special}
        self.fast = tiktoken.Encoding("file", pat_str=_CUT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.slow.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def _byte_of_letter() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: the byte
    itself where it prints, else the next free letter from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[path] = Encoder(path)
    return _encoders[path]


_PIECES = pa.schema([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, separator: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the id, piece, start, length, ids_crc32.

    A document is its ids and then the separator.  One that is longer than
    ``capacity`` is cut into pieces of ``capacity``; the first holds the rest.
    """
    end = np.array([separator], "<u4").tobytes()
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for part in slices(batches, "_text"):
            rows, cols = [], ([], [], [], [])
            for i, text in enumerate(texts_of(part, "_text")):
                ids = memoryview(enc.encode(text) + end)
                total = len(ids) // 4
                n = -(-total // capacity)
                start = 0
                for k in range(n):
                    stop = total - (n - 1 - k) * capacity
                    rows.append(i)
                    for col, value in zip(cols, (k, start, stop - start, zlib.crc32(ids[4 * start:4 * stop])), strict=True):
                        col.append(value)
                    start = stop
            ids_col = part.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids_col, *(pa.array(c, f.type) for c, f in zip(cols, _PIECES, strict=True))],
                                             names=["_id", *_PIECES.names])

    return src.mapInArrow(run, f"_id {id_type}, piece int, start long, length long, ids_crc32 long") \
        .withColumnRenamed("_id", id_col)


# ------------------------------------------------------------------- solving

Pattern = tuple[tuple[int, ...], int]


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Martello-Toth reduction on a histogram of lengths.

    Returns the fixed patterns and the histogram of what is left.  For the
    length ``w`` under study and the room ``r`` beside it, with the lengths
    still there, a set is fixed when it dominates all others:

    * nothing fits beside ``w``: alone;
    * something fills ``r`` exactly: those two (any other filling of ``r`` fits
      into the place that partner takes);
    * at most one more fits: ``w`` with the largest that does;
    * at most two more fit: ``w`` with the largest single, if no pair is longer
      than it; or with the longest pair, if its first is the largest single and
      no fitting pair has two members longer than its second.

    Removing items never makes a rule untrue, so each is applied to as many
    copies at once as there are.
    """
    left = {w: n for w, n in counts.items() if n > 0}
    lengths = sorted(left)
    fixed: list[Pattern] = []

    def take(members: tuple[int, ...]) -> None:
        need = {w: members.count(w) for w in members}
        times = min(left[w] // k for w, k in need.items())
        fixed.append((members, times))
        for w, k in need.items():
            left[w] -= k * times
            if not left[w]:
                del left[w]
                lengths.remove(w)

    def smallest(w: int, n: int, above: int = 0) -> list[int]:
        """The n smallest lengths over ``above`` besides one copy of w."""
        out: list[int] = []
        for x in lengths[bisect_left(lengths, above + 1):]:
            out += [x] * min(n - len(out), left[x] - (x == w))
            if len(out) == n:
                break
        return out

    def largest(w: int, room: int, but: int = 0) -> int:
        """The largest length that fits the room besides w (and one copy of ``but``)."""
        i = bisect_left(lengths, room + 1) - 1
        while i >= 0 and left[lengths[i]] - (lengths[i] == w) - (lengths[i] == but) < 1:
            i -= 1
        return lengths[i] if i >= 0 else 0

    for w in sorted(left, reverse=True):
        while left.get(w):
            r = capacity - w
            low = smallest(w, 3)
            if not low or low[0] > r:
                take((w,))
                continue
            one = largest(w, r)
            if one == r or len(low) < 2 or low[0] + low[1] > r:
                take((w, one))
                continue
            if len(low) < 3 or sum(low) > r:
                best = (0, 0, 0)
                for a in lengths[:bisect_left(lengths, r)]:
                    if left[a] - (a == w) >= 1 and (b := largest(w, min(a, r - a), a)):
                        best = max(best, (a + b, a, b))
                total, a, b = best
                if one >= total:
                    take((w, one))
                    continue
                if a == one and (len(over := smallest(w, 2, b)) < 2 or sum(over) > r):
                    take((w, a, b))
                    continue
            break
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram of lengths.

    Sequences that look alike are one group with a count.  All pieces of a
    length go to the fullest group that has room for one, as many at a time as
    the group has sequences; only then are new sequences opened.
    """
    groups: dict[int, list[Pattern]] = {}
    rooms: list[int] = []

    def put(members: tuple[int, ...], n: int) -> None:
        room = capacity - sum(members)
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((members, n))

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            i = bisect_left(rooms, w)
            if i == len(rooms):
                each = max(1, capacity // w)
                if n >= each:
                    put((w,) * each, n // each)
                if n % each:
                    put((w,) * (n % each), 1)
                break
            room = rooms[i]
            members, m = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(i)
            k = min(n, m)
            if m > k:
                put(members, m - k)
            put((*members, w), k)
            n -= k
    return [g for room in groups.values() for g in room]


def solve(counts: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, left = reduce_instance(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For each length, runs of ranks and where they go.

    A run says: the pieces of ``length`` with ranks from ``rank`` on go to the
    sequences from ``sequence`` on, one each, at ``offset``.
    """
    rows, taken, base = [], {}, 0
    for members, n in patterns:
        offset = 0
        for w in members:
            rows.append((w, taken.get(w, 0), base, offset))
            taken[w] = taken.get(w, 0) + n
            offset += w
        base += n
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "rank", "sequence", "offset"), cols, strict=True))


# --------------------------------------------------------------------- Spark

def pack(pieces: DataFrame, capacity: int = 2048, length_col: str = "length") -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset``: as few sequences as the method finds.

    ``pieces`` is read twice, so hand in a stored table.  Pieces of one length
    are ranked in blocks of a bounded size (a length may hold most of the rows),
    and the blocks' sizes give each block its first rank.  The driver sees the
    histogram and the runs, whose number depends on the capacity alone.
    """
    spark = pieces.sparkSession
    hist = {r[0]: r[1] for r in pieces.groupBy(length_col).count().collect() if r[0] is not None}
    if any(w < 1 or w > capacity for w in hist):
        raise ValueError(f"a piece must hold 1 to {capacity} tokens")
    runs = places(solve(hist, capacity))
    total = sum(hist.values())
    fair = max(64, total // (4 * shuffle_partitions(spark)))
    parts = spark.createDataFrame([(w, -(-n // fair)) for w, n in hist.items()], "_length long, _parts long")
    names = pieces.columns
    key = F.xxhash64(*[F.col(c) for c in names])
    dealt = (pieces.join(F.broadcast(parts), F.col(length_col) == F.col("_length"))  # at most `capacity` rows
             .withColumn("_key", key)
             .withColumn("_block", F.pmod(F.xxhash64("_key", F.lit(1)), F.col("_parts"))))
    in_block = Window.partitionBy("_length", "_block").orderBy("_key")
    over_blocks = Window.partitionBy("_length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_length", "_block").agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn("_first", F.coalesce(F.sum("_n").over(over_blocks), F.lit(0))).drop("_n")
    ranked = dealt.withColumn("_in", F.row_number().over(in_block) - 1).join(sizes, ["_length", "_block"]) \
        .select(*names, (F.col("_first") + F.col("_in")).alias("_rank"))
    at_length = pieces.schema.fieldNames().index(length_col)
    # one sorted key per run: all ranks of a length lie between its first run and the next length's
    span = total + 1
    starts = runs["length"] * span + runs["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(starts, b.column(at_length).to_numpy(zero_copy_only=False) * span + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(runs["sequence"][at] + rank - runs["rank"][at], pa.int64()),
                 pa.array(runs["offset"][at], pa.int64())], names=[*names, "sequence_id", "offset"])

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, separator: int = 0,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack whole documents; one row per piece."""
    return pack(stored(token_pieces(docs, tokenizer_path, capacity, separator, id_col, text_col)), capacity)
