"""Near-duplicate documents by MinHash bands and odd sketches.

Two documents are linked when the Jaccard similarity of their sets of word
shingles reaches a threshold; the groups are the connected components.

1. One pass over the texts gives each document the size and a digest of its
   set, its MinHash samples folded into band keys, and its *odd sketch*: each
   sample flips one bit of a bitmap, so the XOR of two sketches has few ones
   exactly when the samples mostly agree.
2. Texts with equal sets form one class; only one text of a class goes on.
   Copies are never expanded into pairs.
3. Classes that share a band key are candidates.  Of each bucket, first only
   the pairs with its smallest class are tested (a star, as many pairs as rows).
   A candidate must pass the sizes, then the sketches' estimate, then the exact
   similarity of the full sets.
4. Links found so far give components.  Buckets that still hold more than one
   component are merged by their smallest component, since near copies share
   many buckets.  Members outside that component are first held against a few of
   its members, which joins most of them.  Those still outside are held against all
   members of other components, in cells of bounded size that fetch the full sets: sketches
   are compared, pairs that pass and are still apart in the cell are tested
   exactly, and only the links that join something leave the cell (fewer than it
   has rows).  So every pair that shares a bucket is tested or already connected,
   and the pairs of a group are never listed.

With 40 bands of 4 samples, two documents at similarity 0.75 share no bucket
with probability 2.5e-7.  The sketches hold 768 samples; their limit, an
estimate of 0.65, is 418 ones.  At similarity 0.75 two sketches differ in 320
ones on average with a standard deviation of 19, the noise of the samples and of
the bitmap together, so the limit lies 5.2 deviations off: a normal tail of
1.2e-7.  Sets are held as 64-bit hashes of their shingles.

Defined results: a text that is null, empty or white space has an empty set and
is linked with nothing; one of fewer words than a shingle has one shingle;
repeated rows and rows that share an id are one document of the graph, linked
with whatever one of its texts is linked with; a row without an id is in no group
(component null) and is kept; other columns are ignored.  ``keep_one`` goes by
texts: of each group of near-duplicate texts one row stays, so texts that only
share an id all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import Spans, mix, one_row, shuffle_partitions, slices, stored

BANDS, ROWS = 40, 4
SAMPLES = 768  # all go into the sketch, the first BANDS * ROWS into the bands
SKETCH_WORDS = 32
SKETCH_BITS = 64 * SKETCH_WORDS
LONG = 2000  # shingles a row that a cell makes room for on average
_SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]

_draw = np.random.default_rng(20240711)
_FACTOR = _draw.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERM = _draw.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2)
_WORD = _draw.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
_BAND = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)


# ------------------------------------------------------------- sets of a text

def shingle_sets(texts: list[bytes], words: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each UTF-8 text.

    A-Z count as a-z; words are what stands between spaces and the control
    characters 9 to 13.
    """
    x = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    x = np.where((x >= 65) & (x <= 90), x + 32, x).astype(np.uint8)
    blank = np.concatenate(([True], (x == 32) | ((x >= 9) & (x <= 13))))
    opens = np.flatnonzero(blank[:-1] & ~blank[1:])
    shuts = np.flatnonzero(~blank[:-1] & blank[1:])
    w = Spans(x)(opens, shuts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    last = np.searchsorted(opens, ends)
    first = np.concatenate(([0], last[:-1]))
    full = np.zeros(max(w.size - words + 1, 0), np.uint64)
    for k in range(words if full.size else 0):
        full += w[k:k + full.size] * _WORD[k]
    full = mix(full)
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= words:
            s = np.sort(full[a:b - words + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            out.append(mix(mix((w[a:b] * _WORD[:b - a]).sum(keepdims=True)) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def samples(s: np.ndarray) -> np.ndarray:
    """MinHash samples of a set."""
    low = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, s.size, 128):
        part = s[a:a + 128]
        np.minimum(low, (part[:, None] * _FACTOR + _TERM).min(0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """Of samples (documents x SAMPLES)."""
    grouped = low[:, :BANDS * ROWS].reshape(len(low), BANDS, ROWS)
    return mix((mix(grouped) * _WORD[:ROWS]).sum(2) + _BAND).view(np.int64)


def odd_sketches(low: np.ndarray) -> np.ndarray:
    """Of samples: bitmaps as signed 64-bit words; a bit is set if an odd number of samples fell on it."""
    at = (mix(low + _PLACE) % np.uint64(SKETCH_BITS)).astype(np.int64)
    at += np.arange(len(low))[:, None] * SKETCH_BITS
    bits = np.bincount(at.ravel(), minlength=len(low) * SKETCH_BITS).reshape(len(low), SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<i8")


def most_ones(least_estimate: float) -> int:
    """The ones in the XOR of two sketches whose estimated similarity is ``least_estimate``.

    ``2 k (1 - J)`` samples differ on either side, each flips one of the bits.
    """
    flips = 2 * SAMPLES * (1 - least_estimate)
    return int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** flips))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, th and t (the text as bytes) of every row."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("t"))


def describe(docs: DataFrame, id_col: str, text_col: str, words: int = 5) -> DataFrame:
    """id, th (a hash of the text), n, digest (d1, d2), bands and sketch words of every row."""
    src = _texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t", 1 << 20):
            sets = shingle_sets([t or b"" for t in part.column(2).to_pylist()], words)
            low = np.stack([samples(s) for s in sets])
            digest = np.array([((mix(s ^ _WORD[10]).sum(), mix(s ^ _WORD[11]).sum())) for s in sets], np.uint64).view(np.int64)
            keys = band_keys(low)
            sketch = odd_sketches(low)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([s.size for s in sets], pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(keys.ravel())),
                 *(pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH_WORDS))],
                names=["id", "th", "n", "d1", "d2", "bands", *_SKETCH])

    return src.mapInArrow(run, "id long, th long, n long, d1 long, d2 long, bands array<long>, " + ", ".join(f"{c} long" for c in _SKETCH))


# -------------------------------------------------------------------- testing

def _as(df: DataFrame, prefix: str, id_col: str = "id") -> DataFrame:
    """The columns of ``df`` under a prefix; the id becomes the prefix itself."""
    return df.select(F.col(id_col).alias(prefix), *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c != id_col])


def _ones(a: str, b: str) -> Column:
    total = F.lit(0)
    for c in _SKETCH:
        total = total + F.bit_count(F.col(f"{a}_{c}").bitwiseXOR(F.col(f"{b}_{c}")))
    return total


def plausible(pairs: DataFrame, reps: DataFrame, threshold: float, least_estimate: float) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow a link."""
    facts = reps.select("id", "n", *_SKETCH)
    joined = pairs.join(_as(facts, "a"), "a").join(_as(facts, "b"), "b")
    few, many = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    return joined.filter((few >= threshold * many) & (_ones("a", "b") <= most_ones(least_estimate))).select("a", "b")


def _fetched(nodes: DataFrame, reps: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id (of the class) and t of the classes in ``nodes``."""
    wanted = reps.select("id", F.col("doc"), "th").join(nodes, "id").select(F.col("id").alias("node"), F.col("doc").alias("id"), "th")
    return _texts(docs, id_col, text_col).join(wanted, ["id", "th"]).select(F.col("node").alias("id"), "t").dropDuplicates(["id"])


def linked(pairs: DataFrame, reps: DataFrame, docs: DataFrame, percent: int, id_col: str, text_col: str, words: int = 5) -> DataFrame:
    """The pairs (a, b) whose full sets reach ``percent``; each text is fetched once for all its pairs."""
    needed = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    texts = stored(_fetched(needed, reps, docs, id_col, text_col))
    both = pairs.join(_as(texts, "a"), "a").join(_as(texts, "b"), "b").select("a", "b", "a_t", "b_t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "b_t", 1 << 20):
            a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
            distinct = dict(zip(a, part.column(2).to_pylist(), strict=True)) | dict(zip(b, part.column(3).to_pylist(), strict=True))
            sets = dict(zip(distinct, shingle_sets([t or b"" for t in distinct.values()], words), strict=True))
            keep = []
            for x, y in zip(a, b, strict=True):
                p, q = sets[x], sets[y]
                common = np.intersect1d(p, q, assume_unique=True).size
                keep.append(100 * common >= percent * (p.size + q.size - common) and common > 0)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


# ----------------------------------------------------------------- components

def components(edges: DataFrame) -> DataFrame:
    """node -> label, the smallest node of its component, for all nodes of the edges.

    Large-star and small-star steps in turn: each node links its larger, then its
    smaller neighbours to the smallest node around it.  A step takes a minimum by
    node, joined back, so a node with very many neighbours is no single task's
    work.  Every round is written to the checkpoint folder.
    """
    def least(df: DataFrame) -> DataFrame:
        # `+ 0`: the join deals this side out anew, so that a hot node's rows can be split
        return df.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select((F.col("u") + 0).alias("u"), "m")

    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    sign = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct())
        m = least(large)
        small = large.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionAll(m.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = stored(small)
        now = one_row(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))))
        if now == sign:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label")) \
                .unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        sign = now


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """key, id, label and low of the members of buckets with several components, merged by ``low``, the smallest one.

    A bucket's center is left out: it was held against all others.
    """
    marked = buckets.join(labels.select(F.col("node").alias("id"), "label"), "id", "left") \
        .select("key", "id", F.coalesce("label", "id").alias("label"), "center")
    mixed = marked.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                      F.count(F.lit(1)).alias("copies")).filter("low <> high AND copies > 2")
    return _by_class(marked.filter("id <> center"), stored(mixed.select("key", "low", "copies")), ["key"]) \
        .select(F.col("low").alias("key"), "id", "label", "low").distinct()


def _few_each(members: DataFrame, few: int = 8) -> DataFrame:
    """Pairs (a, b) of each stray with up to ``few`` members of its bucket's main component, so that most strays join it."""
    stray = F.col("label") != F.col("low")
    main = members.filter(~stray).groupBy("key", F.pmod(F.xxhash64("id"), F.lit(few)).alias("turn")).agg(F.min("id").alias("a")) \
        .groupBy("key").agg(F.collect_list("a").alias("few"))
    strays = members.filter(stray)
    sizes = strays.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    return _by_class(strays.select("key", "id"), stored(main.join(sizes, "key")), ["key"]) \
        .select("id", F.explode("few").alias("o")).select(F.least("id", "o").alias("a"), F.greatest("id", "o").alias("b")).distinct()


def _across(members: DataFrame, reps: DataFrame, docs: DataFrame, percent: int, words: int, least_estimate: float, block: int,
            id_col: str, text_col: str) -> DataFrame:
    """Links across components within buckets, as many as join something.

    ``members``: key, id, label and low, the bucket's smallest label.  Members
    of other components than ``low`` are *strays*; what is wanted are links of a stray
    and any member of another component.  Strays and members are cut into parts
    of about ``block`` rows and ``block * LONG`` shingles, and a pair of parts is a cell,
    so no cell is larger than that however many documents share a key.  A task holds
    the sets of one cell and key at a time.
    """
    stray = F.col("label") != F.col("low")
    sized = members.join(reps.select("id", "n"), "id")

    def parts(of: Column) -> Column:
        rows, shingles = F.count_if(of), F.sum(F.when(of, F.col("n")).otherwise(0))
        return F.greatest(F.lit(1), F.ceil(rows / block), F.ceil(shingles / (block * LONG))).cast("int")

    counts = sized.groupBy("key").agg(parts(F.lit(True)).alias("parts"), parts(stray).alias("stray_parts"), F.count(F.lit(1)).alias("copies"))
    tasks = shuffle_partitions(members.sparkSession)
    sized = _by_class(sized.drop("n"), stored(counts), ["key"])
    own = F.xxhash64("id")
    as_member = sized.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("stray_parts") - 1))) \
        .withColumn("j", F.pmod(own, F.col("parts")).cast("int")).withColumn("as_stray", F.lit(False))
    as_stray = sized.filter(stray).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .withColumn("i", F.pmod(own, F.col("stray_parts")).cast("int")).withColumn("as_stray", F.lit(True))
    rows = as_member.unionByName(as_stray).select("key", "i", "j", "id", "label", "as_stray", stray.alias("is_stray"))
    texts = stored(_fetched(rows.select("id").distinct(), reps, docs, id_col, text_col))
    facts = rows.join(reps.select("id", "n", *_SKETCH), "id").join(texts, "id") \
        .repartition(8 * tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j", "as_stray", "id")
    limit = most_ones(least_estimate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            at = np.stack([batch.column(k).to_numpy() for k in ("key", "i", "j")])
            turns = np.flatnonzero((np.diff(at) != 0).any(0)) + 1
            for start, end in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
                here = tuple(at[:, start])
                if held and here != cell:
                    yield _cell_links(pa.Table.from_batches(held), percent, words, limit)
                    held = []
                cell = here
                held.append(batch.slice(start, end - start))
        if held:
            yield _cell_links(pa.Table.from_batches(held), percent, words, limit)

    return facts.mapInArrow(run, "a long, b long").distinct()


def _cell_links(rows: pa.Table, percent: int, words: int, limit: int) -> pa.RecordBatch:
    """The links of a cell that join classes not yet joined, by components or by a link found before."""
    as_stray = rows.column("as_stray").to_numpy()
    ids, label, n, is_stray = (rows.column(c).to_numpy() for c in ("id", "label", "n", "is_stray"))
    sketch = np.stack([rows.column(c).to_numpy() for c in _SKETCH], 1).view(np.uint64)  # of signed words, numpy counts the ones of the absolute value
    # labels joined so far in this cell
    _, group = np.unique(label, return_inverse=True)
    member, strays = np.flatnonzero(~as_stray), np.flatnonzero(as_stray)
    out: list[tuple[int, int]] = []
    sets: list[np.ndarray] = []
    for s in strays:
        ok = group[member] != group[s]
        ok &= ~is_stray[member] | (ids[s] < ids[member])  # two strays meet twice
        ok &= 100 * np.minimum(n[s], n[member]) >= percent * np.maximum(n[s], n[member])
        near = member[ok]
        near = near[np.bitwise_count(sketch[near] ^ sketch[s]).sum(1) <= limit]
        if not near.size:
            continue
        if not sets:
            sets = [x for at in range(0, rows.num_rows, 64)
                    for x in shingle_sets([t or b"" for t in rows.column("t").slice(at, 64).to_pylist()], words)]
        ends = np.cumsum([sets[m].size for m in near])
        together = np.concatenate([sets[m] for m in near])
        at = np.minimum(np.searchsorted(sets[s], together), sets[s].size - 1)
        common = np.add.reduceat((sets[s][at] == together).astype(np.int64), np.concatenate(([0], ends[:-1])))
        for m in near[(common > 0) & (100 * common >= percent * (n[s] + n[near] - common))]:
            if group[m] != group[s]:
                group[group == group[m]] = group[s]
                out.append((min(ids[s], ids[m]), max(ids[s], ids[m])))
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _by_class(rows: DataFrame, classes: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` joined with their class by ``key``.

    ``classes`` has ``copies``, the number of rows of each class.  Classes that hold
    more than a hundred-thousandth of all rows (and 1,000), at most 100,000 of them,
    are sent to the tasks, so the rows of a class that a third of all rows belong to
    stay where they are.
    """
    total, most = one_row(classes.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.coalesce(F.max("copies"), F.lit(0))))
    bound = max(1000, total // 100_000)
    if most <= bound:
        return rows.join(classes, key).drop("copies")
    large = F.col("copies") > bound
    heavy, light = F.broadcast(classes.filter(large)), classes.filter(~large)
    return rows.join(heavy, key).unionByName(rows.join(heavy.select(*key), key, "left_anti").join(light, key)).drop("copies")


def text_groups(docs: DataFrame, percent: int = 75, words: int = 5, id_col: str = "doc_id", text_col: str = "text",
                least_estimate: float = 0.65, block: int = 2048) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(described, nodes, groups): all rows; the class ``node`` of every row that has words and an id; the classes with
    ``label``, equal for classes whose texts are linked, directly or not, ``doc`` and ``th`` of the class's first row."""
    threshold = percent / 100
    described = stored(describe(docs, id_col, text_col, words))
    able = described.filter("n > 0 AND id IS NOT NULL")
    classes = stored(able.groupBy("d1", "d2").agg(F.min(F.struct("id", "th")).alias("first"), F.count(F.lit(1)).alias("copies"))
                     .select("d1", "d2", F.col("first.id").alias("doc"), F.col("first.th").alias("th"), "copies",
                             F.monotonically_increasing_id().alias("node")))
    nodes = stored(_by_class(able.select("id", "d1", "d2"), classes.select("d1", "d2", "node", "copies"), ["d1", "d2"])
                   .select("id", "node").distinct())
    # one row of each class: the id is part of the key, so copies do not meet in one task
    reps = stored(able.drop("th").join(classes.select((F.col("d1") + 0).alias("d1"), "d2", F.col("doc").alias("id"), "th", "node"), ["d1", "d2", "id"])
                  .dropDuplicates(["node"]).withColumnRenamed("id", "doc").withColumnRenamed("node", "id"))

    keys = reps.select("id", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("center"), F.max("id").alias("top")).filter("center <> top")
    buckets = stored(keys.join(shared.select((F.col("key") + 0).alias("key"), "center"), "key"))
    star = stored(buckets.filter("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct())
    found = stored(linked(stored(plausible(star, reps, threshold, least_estimate)), reps, docs, percent, id_col, text_col, words))
    labels = stored(components(found))

    members = stored(_mixed(buckets, labels))
    few = stored(_few_each(members).join(star, ["a", "b"], "left_anti"))
    if not few.isEmpty():
        found = stored(found.unionAll(linked(stored(plausible(few, reps, threshold, least_estimate)), reps, docs, percent, id_col, text_col, words)))
        labels = stored(components(found))
        members = stored(_mixed(buckets, labels))
        more = stored(_across(members, reps, docs, percent, words, least_estimate, block, id_col, text_col))
        if not more.isEmpty():
            labels = stored(components(stored(found.unionAll(more))))
    groups = classes.select("node", "doc", "th", "copies").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return described, nodes, stored(groups)


def near_duplicates(docs: DataFrame, percent: int = 75, words: int = 5, id_col: str = "doc_id", text_col: str = "text",
                    least_estimate: float = 0.65, block: int = 2048) -> DataFrame:
    """id, n_shingles, component_id and kept of every row of ``docs``."""
    described, nodes, groups = text_groups(docs, percent, words, id_col, text_col, least_estimate, block)
    of_id = stored(_by_class(nodes, groups.select("node", "label", "copies"), ["node"]).select("id", "label").distinct())
    # ids with texts of several groups link these
    several = of_id.groupBy("id").agg(F.min("label").alias("a"), F.max("label").alias("top")).filter("a <> top")
    shared = stored(of_id.join(several.select((F.col("id") + 0).alias("id"), "a"), "id").select("a", F.col("label").alias("b")).distinct())
    if not shared.isEmpty():
        joined = components(shared).select(F.col("node").alias("label"), F.col("label").alias("whole"))
        groups = stored(groups.join(joined, "label", "left").withColumn("label", F.coalesce("whole", "label")).drop("whole"))
        of_id = stored(_by_class(nodes, groups.select("node", "label", "copies"), ["node"]).select("id", "label").distinct())
    sizes = groups.groupBy("label").agg(F.min("doc").alias("component_id"), F.sum("copies").alias("copies"))
    of_doc = _by_class(of_id, stored(sizes), ["label"]).select("id", "component_id")
    out = described.select("id", F.col("n").alias("n_shingles")).join(of_doc, "id", "left") \
        .withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 75, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, less all but one of each group of texts.

    The row with the smallest id stays.  Rows without an id, and different ones without words, stay.
    """
    described, _, groups = text_groups(docs, percent, words, id_col, text_col)
    kept = groups.groupBy("label").agg(F.min(F.struct("doc", "th")).alias("k")).select(F.col("k.doc").alias("id"), F.col("k.th").alias("th"))
    empty = described.filter("n = 0 AND id IS NOT NULL").select("id", "th").distinct()
    # the input's columns stay inside `row`, whatever their names
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("th"))
    one = Window.partitionBy("id", "th").orderBy(F.xxhash64("row"))
    chosen = rows.join(stored(kept.unionByName(empty)), ["id", "th"]).withColumn("place", F.row_number().over(one)).filter("place = 1")
    return chosen.select("row").unionAll(rows.filter("id IS NULL").select("row")).select("row.*")
