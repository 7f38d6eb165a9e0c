"""Phrases that keep together, mined by a multikey quicksort of suffix pointers.

Texts are lower-cased (A-Z), split at punctuation and line ends into pieces and
those at blanks into words.  Every word opens a *suffix*: the words from there
to the end of its piece, at most ``longest`` of them.  How often a phrase occurs
is the number of suffixes that it opens.

1. Each task turns a few megabytes of texts of a language into a *block*: its different
   words and the row of their codes, compressed, and stores it.
2. Routed by their one leading word, all suffixes of an infrequent word are
   abandoned at once: a word's rows of all blocks are counted where they meet, and each
   block gets back which of its words are frequent.  The others end suffixes, as no frequent phrase
   holds them.
   Then by two: a block's different pairs of neighbours are hashed to numbers of a few bits more
   than there are words, cut into parts of the numbers' range and sent as packed gaps and counts, about
   two bytes a pair. Where a part of all blocks meets, numbers are counted, and each block gets back a bit for
   each of its pairs. Pairs with one number count together, so no frequent pair is lost; the others
   end suffixes too.
3. Each block's suffixes of two words or more are written, equal ones as one row
   with a count, and routed by all their leading words: cut into ranges of about
   ``range_rows`` rows in the order of language and words.  A frequent word or phrase is
   spread over as many ranges as it needs, as a salt ends the key.
4. Each range is sorted by a three-way multikey quicksort (``frequent``): words
   are compared at one depth, the part that is equal to the pivot goes on at the
   next one down to ``longest``.  The size of an equal part is the count of its
   phrase; parts below ``least`` are abandoned.  Only phrases that the first or
   the last suffix of a range begins with may go on in a neighbouring range;
   their shares are handed on at any size and added up.
5. Ordinary joins weigh every cut of a phrase, and phrases that a longer one
   covers go.

The tables of blocks and suffixes go to the checkpoint folder and are deleted as
soon as the phrases are stored.  A task holds one slice of texts (a text is never cut,
so at least one whole text), one block or one range of suffixes.

Defined results: a null or empty text has no words; a null language counts as
``und``; repeated rows count each; words of any length and with any other control
character are words; an empty table gives no rows; ids and other columns play no
part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import Spans, delete_folder, let_go, mix, shuffle_partitions, slices, stored
from mercato.session import checkpoint_dir

#: Ends every word in a suffix or phrase; no word holds one.  So the suffixes that
#: open with a phrase are those whose string starts with the phrase's string, and
#: are neighbours in the order of bytes.
_END = "\t"
_BLANK, _BREAK = 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = _BLANK
_CLASS[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_SUFFIXES = pa.schema([("lang", pa.string()), ("suffix", pa.string()), ("n", pa.int64()), ("salt", pa.int64())])
_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64())])


def words_of(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Codes of all words of the texts, the words by code (in byte order), and each word's piece and text."""
    x = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    kind = _CLASS[x]
    letter = kind == 0
    edge = np.diff(np.concatenate(([False], letter, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not starts.size:
        return np.zeros(0, np.int64), pa.array([], pa.large_string()), starts, starts
    piece = np.cumsum(kind == _BREAK)[starts]
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, "right")
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), starts.size, [None, pa.py_buffer(offsets), pa.py_buffer(x[letter])])
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(order.size, np.int64)
    place[order] = np.arange(order.size)
    return place[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order)).cast(pa.large_string()), piece, text


def distinct_suffixes(codes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Word codes (-1 beyond the suffix) and count of each different suffix of two words or more, in ascending order.

    ``codes``: the words in a row; -1 ends a suffix.
    """
    starts = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
    grid = np.full((starts.size, longest), -1, np.int32)
    going = np.arange(starts.size)
    for k in range(longest):
        grid[going, k] = codes[starts[going] + k]
        going = going[starts[going] + k + 1 < codes.size]
        going = going[codes[starts[going] + k + 1] >= 0]
    if not starts.size:
        return grid, starts
    base = int(codes.max()) + 2
    key = np.zeros(starts.size, np.int64)
    for k in range(longest):
        key = np.unique(key * base + grid[:, k] + 1, return_inverse=True)[1]
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return grid[first], count


def _blocks(docs: DataFrame, lang: Column, slice_bytes: int, text_col: str) -> DataFrame:
    """block, lang, size (words), words (different ones), counts, and codes: the words' places in a row, -1 between pieces."""
    src = docs.select(F.coalesce(lang.cast("string"), F.lit("und")).alias("_lang"),
                      F.col(text_col).cast("string").cast("binary").alias("_text")).filter("length(_text) > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        for batch in _joined(batches, slice_bytes):
            by_lang: dict[str, list[bytes]] = {}
            for name, text in zip(batch.column("_lang").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                by_lang.setdefault(name, []).append(text)
            for name, texts in by_lang.items():
                codes, vocabulary, piece, _ = words_of(texts)
                if not codes.size:
                    continue
                ends = np.flatnonzero(np.diff(piece)) + 1
                row = np.insert(codes, ends, -1).astype("<i4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([name]), pa.array([codes.size], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(vocabulary)], pa.int32()), vocabulary.cast(pa.string())),
                     pa.array([np.bincount(codes)], pa.list_(pa.int64())), pa.array([len(row)], pa.int64()),
                     pa.array([pa.compress(row, "zstd", asbytes=True)], pa.binary())],
                    names=["block", "lang", "size", "words", "counts", "bytes", "codes"])
                block += 1

    return src.mapInArrow(run, "block long, lang string, size long, words array<string>, counts array<long>, bytes long, codes binary")


def _numbers(words: pa.Array) -> np.ndarray:
    """A number for each word, the same in every block."""
    binary = words.cast(pa.large_binary())
    at = np.frombuffer(binary.buffers()[1], "<i8")[binary.offset:binary.offset + len(binary) + 1]
    letters = np.frombuffer(binary.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    return Spans(letters)(at[:-1] - at[0], at[1:] - at[0])


def _codes(one: pa.RecordBatch) -> np.ndarray:
    """The row of a block's codes."""
    return np.frombuffer(pa.decompress(one.column("codes")[0].as_py(), decompressed_size=one.column("bytes")[0].as_py(), codec="zstd", asbytes=True), "<i4")


def _pairs(one: pa.RecordBatch, codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers below 2 ** ``bits`` of a block's pairs of neighbours, ascending; where pairs stand; and each one's place among the numbers."""
    words = one.column("words").flatten().cast(pa.large_string())
    at = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
    own, place = np.unique(codes[at].astype(np.int64) * len(words) + codes[at + 1], return_inverse=True)
    lang = _numbers(one.column("lang").cast(pa.large_string()))
    number = _numbers(words) if len(words) else np.zeros(0, np.uint64)
    left, right = own // max(len(words), 1), own % max(len(words), 1)
    hashed = mix(mix(number[left] + lang) + number[right]) >> np.uint64(64 - bits)
    numbers, of_pair = np.unique(hashed, return_inverse=True)
    return numbers, at, of_pair[place]


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers by planes of bytes, compressed: planes of zeros take no place."""
    return pa.compress(np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=8 * int(n), codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").reshape(-1)


def _cuts(numbers: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Where each part of the numbers' range starts among the ascending ``numbers``, and their end."""
    bounds = np.array([(p << bits) // parts for p in range(parts + 1)], np.uint64)
    return np.searchsorted(numbers, bounds)


def _pair_counts(blocks: DataFrame, bits: int, parts: int) -> DataFrame:
    """block, part, n (numbers), gaps and counts of each block's pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                numbers, _, place = _pairs(one, _codes(one), bits)
                counts = np.bincount(place, minlength=numbers.size)
                cuts = _cuts(numbers, bits, parts)
                some = np.flatnonzero(np.diff(cuts))
                if not some.size:
                    continue
                spans = [slice(cuts[p], cuts[p + 1]) for p in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(some.size, one.column("block")[0].as_py())), pa.array(some), pa.array(np.diff(cuts)[some]),
                     pa.array([_packed(np.diff(numbers[x], prepend=np.uint64(0))) for x in spans], pa.binary()),
                     pa.array([_packed(counts[x]) for x in spans], pa.binary())], names=["block", "part", "n", "gaps", "counts"])

    return blocks.select("block", "lang", "words", "bytes", "codes").mapInArrow(run, "block long, part long, n long, gaps binary, counts binary")


def _frequent_pairs(pairs: DataFrame, least: int, parts: int) -> DataFrame:
    """block, part and marks: a bit for each of a block's numbers of the part, whether all blocks have ``least`` of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        part = table.column("part").to_numpy()
        for p in np.unique(part):
            rows = table.filter(pa.array(part == p))
            sizes = rows.column("n").to_numpy()
            numbers = np.concatenate([np.cumsum(_unpacked(x, n), dtype=np.uint64) for x, n in zip(rows.column("gaps").to_pylist(), sizes, strict=True)])
            counts = np.concatenate([_unpacked(x, n) for x, n in zip(rows.column("counts").to_pylist(), sizes, strict=True)])
            different, place = np.unique(numbers, return_inverse=True)
            total = np.bincount(place, counts, different.size)  # in doubles, exact below 2 ** 53
            enough = np.split((total >= least)[place], np.cumsum(sizes)[:-1])
            yield pa.RecordBatch.from_arrays([rows.column("block").combine_chunks(), rows.column("part").combine_chunks(),
                                              pa.array([np.packbits(x).tobytes() for x in enough], pa.binary())], names=["block", "part", "marks"])

    return pairs.repartitionById(parts, F.col("part").cast("int")).mapInArrow(run, "block long, part long, marks binary")


def _suffixes(blocks: DataFrame, kept: DataFrame, longest: int) -> DataFrame:
    """lang, suffix, n and salt of the blocks' suffixes of two frequent words or more.

    ``kept``: block, places of its frequent words, marks of its pairs by part, and the bits and parts of their numbers.
    """
    both = blocks.select("block", "lang", "words", "bytes", "codes").join(kept, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                lang = one.column("lang")[0].as_py()
                words = one.column("words").flatten().cast(pa.large_string())
                codes = _codes(one)
                frequent_ = np.zeros(len(words) + 1, bool)  # the last place answers for -1
                frequent_[one.column("places").flatten().to_numpy()] = True
                row = np.where(frequent_[codes], codes, -1)
                bits = one.column("bits")[0].as_py()
                numbers, at, place = _pairs(one, codes, bits)
                cuts = _cuts(numbers, bits, one.column("parts")[0].as_py())
                marked = np.zeros(numbers.size, bool)
                for mark in one.column("marks")[0].as_py():
                    first, last = cuts[mark["part"]], cuts[mark["part"] + 1]
                    marked[first:last] = np.unpackbits(np.frombuffer(mark["marks"], np.uint8), count=last - first)
                row = np.insert(row, at[~marked[place]] + 1, -1)
                grid, count = distinct_suffixes(row, longest)
                salt = one.column("block")[0].as_py()
                for at in range(0, count.size, 1 << 16):
                    rows = slice(at, at + (1 << 16))
                    columns = [words.take(pa.array(np.maximum(c, 0), mask=c < 0)) for c in grid[rows].T]
                    joined = pc.binary_join_element_wise(*columns, pa.scalar("", pa.large_string()), pa.scalar(_END, pa.large_string()),
                                                         null_handling="skip")
                    n = len(joined)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), joined.cast(pa.string()),
                                                      pa.array(count[rows], pa.int64()), pa.array(np.full(n, salt), pa.int64())], schema=_SUFFIXES)

    return both.mapInArrow(run, "lang string, suffix string, n long, salt long")


def _joined(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.Table]:
    """Batches put together to about ``most_bytes`` of texts."""
    held, size = [], 0
    for part in slices(batches, "_text", most_bytes):
        n = part.column(part.schema.get_field_index("_text")).nbytes
        if held and size + n > most_bytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(part)
        size += n
    if held:
        yield pa.Table.from_batches(held)


def frequent(grid: np.ndarray, weight: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(row, depth, count): a suffix that opens with the phrase, its length, and its count if that is ``least`` or more.

    Three-way multikey quicksort of row pointers; -1 in the grid ends a suffix.
    """
    out = []
    longest = grid.shape[1]
    open_ = [(np.arange(grid.shape[0]), 0)]
    while open_:
        rows, depth = open_.pop()
        words = grid[rows, depth]
        pivot = words[words.size // 2]
        same = words == pivot
        for part in (rows[words < pivot], rows[words > pivot]):
            if part.size and weight[part].sum() >= least:
                open_.append((part, depth))
        equal = rows[same]
        count = int(weight[equal].sum())
        if count < least:
            continue
        out.append((int(equal[0]), depth + 1, count))
        if depth + 1 < longest:
            deeper = equal[grid[equal, depth + 1] >= 0]
            if deeper.size and weight[deeper].sum() >= least:
                open_.append((deeper, depth + 1))
    return out


def _range_counts(batches: Iterator[pa.RecordBatch], longest: int, least: int) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of one range of suffixes: whole ones from ``least`` on, shares of those on its edges."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    wide = pa.schema([(f.name, pa.large_string() if f.type == pa.string() else f.type) for f in held[0].schema])
    table = pa.Table.from_batches(held).cast(wide).combine_chunks()
    weight = table.column("n").combine_chunks().to_numpy()
    langs = table.column("lang").combine_chunks().dictionary_encode()
    suffixes = table.column("suffix").combine_chunks()
    parts = pc.split_pattern(suffixes, _END)  # the last part is empty
    coded = parts.values.dictionary_encode()
    first = parts.offsets.to_numpy()[:-1]
    size = np.diff(parts.offsets.to_numpy()) - 1
    codes = coded.indices.to_numpy()
    grid = np.full((size.size, longest + 1), -1, np.int32)
    grid[:, 0] = langs.indices.to_numpy()
    for k in range(longest):
        has = size > k
        grid[has, k + 1] = codes[first[has] + k]

    edges: set[tuple[int, ...]] = set()
    order = pc.sort_indices(table, sort_keys=[("lang", "ascending"), ("suffix", "ascending")])
    rows: list[tuple[int, int, int]] = []
    for at in (order[0].as_py(), order[-1].as_py()):
        inside = np.arange(size.size)
        for depth in range(longest + 1):
            if grid[at, depth] < 0:
                break
            inside = inside[grid[inside, depth] == grid[at, depth]]
            phrase = tuple(grid[at, :depth + 1].tolist())
            if depth and phrase not in edges:
                rows.append((at, depth, int(weight[inside].sum())))
            edges.add(phrase)
    for row, depth, count in frequent(grid, weight, least):
        if depth > 1 and tuple(grid[row, :depth].tolist()) not in edges:
            rows.append((row, depth - 1, count))
    for at in range(0, len(rows), 1 << 16):
        some = rows[at:at + (1 << 16)]
        words = coded.dictionary
        yield pa.RecordBatch.from_arrays([
            pa.array([langs.dictionary[int(grid[r, 0])].as_py() for r, _, _ in some], pa.string()),
            pa.array(["".join(words[int(c)].as_py() + _END for c in grid[r, 1:d + 1]) for r, d, _ in some], pa.string()),
            pa.array([d for _, d, _ in some], pa.int32()), pa.array([c for _, _, c in some], pa.int64())], schema=_COUNTS)


def phrase_counts(suffixes: DataFrame, rows: int, size: int, longest: int, least: int, range_rows: int) -> DataFrame:
    """lang, phrase (every word followed by a tab), size in words and n of all phrases with n >= ``least``."""
    parts = max(1, -(-rows // range_rows), -(-size // (64 * range_rows)))
    if parts > 1:
        parts = max(parts, min(shuffle_partitions(suffixes.sparkSession), -(-rows // 20000)))
    routed = suffixes.repartitionByRange(parts, "lang", "suffix", "salt")
    shares = routed.mapInArrow(lambda batches: _range_counts(batches, longest, least), "lang string, phrase string, size int, n long")
    return shares.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def cut_scores(phrases: DataFrame, totals: DataFrame, scale: int = 1000) -> DataFrame:
    """a, l, r, n and score of every phrase of two words or more, by its lowest-scoring cut.

    Both sides of a cut are at least as frequent as the phrase, so they are in ``phrases`` themselves.
    """
    words = F.split(F.expr(f"substr(phrase, 1, length(phrase) - {len(_END)})"), _END)
    cuts = phrases.filter("size >= 2").select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("w")) \
        .withColumn("cut", F.explode(F.expr("sequence(1, size - 1)"))) \
        .select("lang", "phrase", "size", "a", "cut",
                F.concat(F.array_join(F.expr("slice(w, 1, cut)"), _END), F.lit(_END)).alias("head"),
                F.concat(F.array_join(F.expr("slice(w, cut + 1, size - cut)"), _END), F.lit(_END)).alias("rest"))
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    whole = "decimal(38,0)"  # products pass 64 bits
    score = F.expr(f"""(cast({scale} * cast(a as decimal(19,0)) as {whole}) * cast(n as {whole}))
                       div (cast(l as {whole}) * cast(r as {whole}))""")
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(totals, "lang") \
        .withColumn("score", score)
    low = F.min(F.struct("score", "cut", "l", "r")).alias("low")
    return scored.groupBy("lang", "phrase", "size", "a", "n").agg(low) \
        .select("lang", "phrase", "size", "a", F.col("low.l").alias("l"), F.col("low.r").alias("r"), "n", F.col("low.score").alias("score"))


def covered(phrases: DataFrame, per_cent: int = 100) -> DataFrame:
    """lang and phrase of those inside a longer phrase that has ``per_cent`` of their count or more.

    A phrase inside a longer one is inside one of just one word more that is no
    rarer, so it is enough to take away the last or the first word.
    """
    longer = phrases.filter("size >= 3").select("lang", "phrase", F.col("n").alias("longer"))
    shorter = F.array(F.regexp_replace("phrase", f"[^{_END}]+{_END}$", ""), F.regexp_replace("phrase", f"^[^{_END}]+{_END}", ""))
    inner = longer.select("lang", F.explode(shorter).alias("phrase"), "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    enough = F.lit(100) * F.col("longer").cast("decimal(19,0)") >= F.lit(per_cent) * F.col("n").cast("decimal(19,0)")
    return phrases.join(inner, ["lang", "phrase"]).filter(enough).select("lang", "phrase")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, keep: int = 2000, lang_col: str = "lang",
                 text_col: str = "text", slice_bytes: int = 8 << 20, range_rows: int = 1 << 20) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``keep`` best phrases."""
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark)}/collocations-{uuid.uuid4()}"

    def put(df: DataFrame, name: str) -> DataFrame:
        let_go(df).write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    blocks = put(_blocks(docs, F.col(f"`{lang_col}`"), slice_bytes, text_col), "blocks")
    totals = stored(blocks.groupBy("lang").agg(F.sum("size").alias("n")))
    word = F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")
    of_block = blocks.select("block", "lang", word).select("block", "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    # a block has a word at most once, so a word has as many rows as there are blocks with it; one of them keeps its letters
    same = Window.partitionBy("lang", "word")
    known = put(of_block.select("block", "place", "lang", "word", F.sum("n").over(same).alias("n"), F.min("block").over(same).alias("first"))
                .filter(F.col("n") >= least)
                .select("block", "place", "lang", F.when(F.col("block") == F.col("first"), F.col("word")).alias("word"), "n"), "known")
    single = known.filter("word IS NOT NULL").select("lang", "word", "n")
    words = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bits, parts = min(max(words.bit_length() + 4, 20), 60), max(1, -(-words // range_rows))  # a part: at most about as many pairs as a range has rows
    marks = put(_frequent_pairs(_pair_counts(blocks, bits, parts), least, parts), "pairs")
    # a union: nothing is joined with the table of words. A block has as many places as words, and a bit for each pair
    kept = known.select("block", "place", F.lit(None).cast("struct<part:bigint,marks:binary>").alias("mark")) \
        .unionByName(marks.select("block", F.lit(None).cast(known.schema["place"].dataType).alias("place"), F.struct("part", "marks").alias("mark"))) \
        .groupBy("block").agg(F.collect_list("place").alias("places"), F.collect_list("mark").alias("marks")) \
        .withColumns({"bits": F.lit(bits), "parts": F.lit(parts)})
    suffixes = put(_suffixes(blocks, kept, longest), "suffixes")
    delete_folder(spark, f"{folder}/blocks")
    delete_folder(spark, f"{folder}/pairs")
    rows, size = suffixes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("suffix")), F.lit(0))).first()
    longer = phrase_counts(suffixes, rows, size, longest, least, range_rows).filter("size >= 2")
    phrases = stored(single.select("lang", F.concat("word", F.lit(_END)).alias("phrase"), F.lit(1).alias("size"), "n").unionByName(longer))
    delete_folder(spark, folder)
    scored = cut_scores(phrases, totals)
    left = scored.join(covered(phrases), ["lang", "phrase"], "left_anti") \
        .withColumn("phrase", F.expr(f"translate(substr(phrase, 1, length(phrase) - {len(_END)}), '{_END}', ' ')"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return left.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep) \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
