"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A normalised text is a row of symbols, at first its characters.  An *agenda*
holds every pair of adjacent symbols whose strings together are a piece, in the
order of the pieces' scores and then from left to right.  The best pair becomes
one symbol, its new neighbour pairs enter the agenda, and entries whose symbols
have changed are passed over.  The agenda of a long run is a heap; those
of short runs are the rows of an array, and many advance by one merge at a time.  What is left when the agenda is empty are the
pieces; a symbol that is no piece becomes its UTF-8 bytes (or the unknown id).

No merge can join two characters that are never neighbours inside a piece.
Texts are cut there first (``cut``): before every space sign that follows
another character, and longer runs at all such places.  Each run has its own
agenda, with the same result, and a run that repeats is looked up.

The rows pass through in Arrow batches.  Every encoded row, and what ``decode``
makes of its ids, is compared with the installed sentencepiece library; the
result of the comparison is the column ``agrees``.

A task holds a megabyte of texts (a text is never cut: at least one whole text),
an agenda of about 100 bytes for each character of the longest run, and at most
half a million short runs with their ids.

Defined results: a null text counts as empty; an empty text gives the begin and
end ids alone; ties between pieces of one score go to the left; repeated rows are
encoded each on their own; a null id is carried through; an empty table gives no
rows; other columns are ignored.  Vocabularies with user-defined or unused
pieces, or of another type, raise.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import slices, texts_of

_SPACE = "▁"  # stands for a space in pieces
_RUN = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6  # fixed values of the file format
_MERGE_TYPE = 2
_SHORT = 32        # longer runs are cut further and not remembered
_SPREAD = np.int64(0x1E3779B97F4A7C15)
_REMEMBERED = 1 << 19
assert array("I").itemsize == 4 and sys.byteorder == "little"  # ids are kept as such bytes
_PLACE = 40        # bits of an agenda entry that hold the position


class PieceModel:
    """A vocabulary file, its merges, and the library's own processor."""

    def __init__(self, data: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        if proto.trainer_spec.model_type != _MERGE_TYPE:
            raise ValueError("not a merge-type vocabulary")
        kinds = [p.type for p in proto.pieces]
        if not {*kinds} <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("space signs at the end of words are not supported")
        self.begin, self.end, self.unknown = self.library.bos_id(), self.library.eos_id(), self.library.unk_id()
        self.falls_back = proto.trainer_spec.byte_fallback
        self.strips = proto.normalizer_spec.add_dummy_prefix or proto.normalizer_spec.remove_extra_whitespaces
        self.strips_all = proto.normalizer_spec.remove_extra_whitespaces

        names = [p.piece for p in proto.pieces]
        self.pieces = {names[i]: i for i, k in enumerate(kinds) if k == _NORMAL}
        # a character that occurs in pieces without being one gets an id beyond them
        letters = sorted({c for p in self.pieces for c in p} - self.pieces.keys())
        self.symbol = {**self.pieces, **{c: len(names) + i for i, c in enumerate(letters)}}
        self.n_ids = len(names)
        scores = sorted({proto.pieces[i].score for i in self.pieces.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        self.pairs: dict[int, tuple[int, int]] = {}
        self.no_merge = len(scores)  # ranks after all others
        for piece, i in self.pieces.items():
            for at in range(1, len(piece)):
                left, right = self.symbol.get(piece[:at]), self.symbol.get(piece[at:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = (rank[proto.pieces[i].score], i)
        self._tabulate()
        self.neighbours = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.cuts_at_space = not any(b == _SPACE != a for a, b in self.neighbours)

        self.byte_ids = {int(names[i][3:5], 16): i for i, k in enumerate(kinds) if k == _BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        # the symbol of every character: its piece, or the byte that spells it, or -1
        self.letter = np.full(sys.maxunicode + 1, -1, np.int32)
        if self.falls_back:
            self.letter[[b for b in self.byte_ids if b < 128]] = [i for b, i in self.byte_ids.items() if b < 128]
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.letter[ord(c)] = i
        plain = "".join(re.escape(chr(c)) for c in np.flatnonzero((self.letter >= 0) & (self.letter < self.n_ids)).tolist())
        self.odd = re.compile(f"[^{plain}]")  # characters that are neither a piece nor one byte
        self.surface = {i: p for p, i in self.pieces.items()}
        self.unknown_surface = proto.trainer_spec.unk_surface
        self.known: dict[str, bytes] = {}
        # what an id reads as on its own; bytes beyond 127 and the unknown id need their neighbours
        self.plain = np.array([self.surface.get(i, "") for i in range(len(names))], object)
        self.plain[[i for i, b in self.byte_of.items() if b < 128]] = [chr(b) for b in self.byte_of.values() if b < 128]
        self.alone = np.ones(len(names), bool)
        self.alone[[self.unknown, *(i for i, b in self.byte_of.items() if b >= 128)]] = False

    # ------------------------------------------------------------ encoding

    def _tabulate(self) -> None:
        """The pairs as an open hash table of arrays, to look up many at a time."""
        size = 1 << (4 * len(self.pairs) + 16).bit_length()
        self.table_key = np.full(size, -1, np.int64)
        self.table_rank, self.table_piece = np.full(size, self.no_merge, np.int32), np.zeros(size, np.int32)
        keys = np.array(list(self.pairs), np.int64)
        for key, slot, (rank, piece) in zip(keys.tolist(), ((keys * _SPREAD >> 40) & (size - 1)).tolist(), self.pairs.values(), strict=True):
            while self.table_key[slot] != -1:
                slot = (slot + 1) & (size - 1)
            self.table_key[slot], self.table_rank[slot], self.table_piece[slot] = key, rank, piece

    def _merge_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair of symbols; ``no_merge`` where they make no piece."""
        key = left.astype(np.int64) << 32 | right
        slot = (key * _SPREAD >> 40) & (self.table_key.size - 1)
        held = self.table_key[slot]
        open_ = np.flatnonzero((held != key) & (held != -1))
        while open_.size:
            slot[open_] = (slot[open_] + 1) & (self.table_key.size - 1)
            held = self.table_key[slot[open_]]
            open_ = open_[(held != key[open_]) & (held != -1)]
        return self.table_rank[slot], self.table_piece[slot]  # an empty slot holds no_merge

    def short_agendas(self, runs: list[str]) -> Iterator[bytes]:
        """The ids of many runs of a few characters; in each round every run makes its best pair one symbol."""
        sizes = np.array([len(r) for r in runs])
        letters = self.letter[np.frombuffer("".join(runs).encode("utf-32-le"), "<u4")]
        ends = np.cumsum(sizes)
        width = int(sizes.max())
        # every run in a row of its own, with a symbol that merges with none at the end
        place = np.arange(letters.size) + np.repeat(np.arange(len(runs)) * (width + 1) - (ends - sizes), sizes)
        symbol = np.full(len(runs) * (width + 1), -1, np.int64)
        symbol[place] = letters
        to, before = np.arange(1, symbol.size + 1), np.arange(-1, symbol.size - 1)
        rank, piece = np.full(symbol.size, self.no_merge, np.int32), np.zeros(symbol.size, np.int32)
        rank[place], piece[place] = self._merge_of(symbol[place], symbol[place + 1])
        alive = np.zeros(symbol.size, bool)
        alive[place] = True
        rows = np.arange(len(runs))
        table = rank.reshape(len(runs), width + 1)
        while rows.size:
            i = table[rows].argmin(1) + rows * (width + 1)  # the leftmost of the best
            going = rank[i] < self.no_merge
            rows, i = rows[going], i[going]
            j = to[i]
            alive[j], rank[j] = False, self.no_merge
            symbol[i] = piece[i]
            to[i] = to[j]
            before[to[j]] = i
            rank[i], piece[i] = self._merge_of(symbol[i], symbol[to[i]])
            left, i = before[i], i
            inside = left >= rows * (width + 1)
            left, i = left[inside], i[inside]
            rank[left], piece[left] = self._merge_of(symbol[left], symbol[i])
        ids = symbol[alive].astype("<u4").tobytes()
        ends = np.cumsum(alive.reshape(table.shape).sum(1)) * 4
        yield from (ids[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist()))

    def _spelled(self, symbol: int, letter: str) -> list[int]:
        """The id of a piece; of a character that is none its bytes, or the unknown id."""
        if 0 <= symbol < self.n_ids:
            return [symbol]
        return [self.byte_ids[b] for b in letter.encode()] if self.falls_back else [self.unknown]

    def agenda(self, run: str) -> list[int]:
        """The ids of one run of characters."""
        n = len(run)
        pairs = self.pairs
        symbol = [self.symbol.get(c, -1) for c in run]
        to, before = list(range(1, n + 1)), list(range(-1, n - 1))
        entry, becomes = [-1] * n, [-1] * n  # of the pair that a symbol opens
        agenda = []
        for i in range(n - 1):
            found = pairs.get(symbol[i] << 32 | symbol[i + 1])
            if found is not None:
                entry[i] = found[0] << _PLACE | i
                becomes[i] = found[1]
                agenda.append(entry[i])
        heapify(agenda)
        gone = [False] * n
        while agenda:
            best = heappop(agenda)
            i = best & (1 << _PLACE) - 1
            if entry[i] != best or gone[i]:
                continue
            j = to[i]
            symbol[i] = becomes[i]
            gone[j] = True
            to[i] = to[j]
            if to[j] < n:
                before[to[j]] = i
            for left in (before[i], i):
                if left < 0:
                    continue
                right = to[left]
                found = pairs.get(symbol[left] << 32 | symbol[right]) if right < n else None
                if found is None:
                    entry[left] = -1
                else:
                    entry[left] = found[0] << _PLACE | left
                    becomes[left] = found[1]
                    heappush(agenda, entry[left])
        ids = []
        i = 0
        while i < n:
            ids += self._spelled(symbol[i], run[i])
            i = to[i]
        return ids

    def cut(self, run: str) -> list[str]:
        """The run cut wherever two characters are never neighbours inside a piece."""
        ends = [i for i in range(1, len(run)) if run[i - 1:i + 1] not in self.neighbours]
        return [run[a:b] for a, b in zip([0, *ends], [*ends, len(run)], strict=True)]

    def long_run(self, run: str) -> bytes:
        return array("I", [i for part in self.cut(run) for i in self.agenda(part)]).tobytes()

    def learn(self, runs: set[str]) -> list[str]:
        """Note the ids of runs that are not known; gives the long ones, to be forgotten after use."""
        if len(self.known) + len(runs) > _REMEMBERED:
            self.known.clear()
        long, by_size = [], {}
        for run in runs.difference(self.known):
            if len(run) > _SHORT:
                long.append(run)
                self.known[run] = self.long_run(run)
            elif self.odd.search(run):
                self.known[run] = self.long_run(run)
            else:
                by_size.setdefault((len(run) - 1).bit_length(), []).append(run)
        for same in by_size.values():
            self.known.update(zip(same, self.short_agendas(same), strict=True))
        return long

    def encode(self, texts: list[str]) -> list[bytes]:
        """Begin id, ids, end id of each text as little-endian unsigned 32-bit integers."""
        begin, end = array("I", [self.begin]).tobytes(), array("I", [self.end]).tobytes()
        cut = []
        for text in map(self.library.Normalize, texts):
            cut.append(_RUN.findall(text) if self.cuts_at_space else [text] if text else [])
        long = self.learn(set().union(*cut))
        out = []
        for runs in cut:
            ids = b"".join(map(self.known.__getitem__, runs))
            if not self.falls_back:  # unknown characters in a row are one unknown piece
                a = np.frombuffer(ids, "<u4")
                ids = a[~((a == self.unknown) & np.concatenate(([False], a[:-1] == self.unknown)))].tobytes()
            out.append(begin + ids + end)
        for run in long:
            del self.known[run]
        return out

    # ------------------------------------------------------------ decoding

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: pieces with spaces for their signs, byte pieces as UTF-8."""
        if not self.strips_all and self.alone[ids].all():
            text = "".join(self.plain[ids].tolist())
            return (text[1:] if self.strips and text.startswith(_SPACE) else text).replace(_SPACE, " ")
        out: list[str] = []
        octets = bytearray()
        at_start = self.strips
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                octets.append(byte)
                at_start = False
                continue
            if octets:
                out.append(_characters(bytes(octets)))
                octets.clear()
            piece = self.surface.get(i)
            if piece is None:
                if i == self.unknown:
                    out.append(self.unknown_surface)
                    at_start = False
                continue
            if at_start:
                if piece[0] == _SPACE:
                    piece = piece[1:]
                at_start = self.strips_all and not piece
            out.append(piece)
        if octets:
            out.append(_characters(bytes(octets)))
        return "".join(out).replace(_SPACE, " ")


def _characters(octets: bytes) -> str:
    """UTF-8 with a replacement character for every byte that is part of no character."""
    out = []
    while octets:
        try:
            out.append(octets.decode())
            break
        except UnicodeDecodeError as e:
            out.append(octets[:e.start].decode() + "�")
            octets = octets[e.start + 1:]
    return "".join(out)


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One model per worker process and file content."""
    with open(path, "rb") as f:
        data = f.read()
    key = hashlib.sha256(data).hexdigest()
    if key not in _models:
        _models[key] = PieceModel(data)
    return _models[key]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ids (binary: unsigned 32-bit integers, begin and end included), decoded, and agrees with the library."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for part in slices(batches, "_text", 1 << 20):
            texts = texts_of(part, "_text")
            ids = model.encode(texts)
            as_lists = [np.frombuffer(i, "<u4").tolist() for i in ids]
            decoded = [model.decode(i) for i in as_lists]
            theirs = model.library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
            agrees = [a == b and c == d for a, b, c, d in
                      zip(as_lists, theirs, decoded, model.library.decode(as_lists, num_threads=1), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string()), pa.array(agrees)],
                                             names=["_id", "ids", "decoded", "agrees"])

    return src.mapInArrow(run, f"_id {id_type}, ids binary, decoded string, agrees boolean").withColumnRenamed("_id", id_col)
