"""Document fingerprints by consistent weighted sampling.

A text's terms are its pairs of neighbouring words, each weighted by how often
it occurs (any positive weight will do).  For each of ``SAMPLES`` samples and each
term there are five uniform numbers, hashed from the term and the sample alone:
r and c are drawn from Gamma(2, 1) as -ln(u1 u2), b is uniform.  With

    t = floor(ln(w) / r + b),   y = exp(r (t - b)),   a = c / (y e^r)

the sample is the (term, t) with the smallest a over all terms.  Two texts have the
same sample with a probability equal to the generalised Jaccard similarity of their
weights; the similarity is estimated by the share of equal samples.  A term costs the
same however often it occurs, and its weight is a count: nothing is expanded.

The five numbers are 25 bits each of three 64-bit hashes of the term's hash.  ln(a)
is compared, so nothing overflows; it depends on nothing but the term and t, so equal
values are equal samples, and a sample is a plain minimum in a grouped aggregation.

Most draws cannot be a minimum, and a bound without logarithms tells so: y <= w, and
c = -ln(u1 u2) >= 1 - u1 u2, so a is at least that over w, times e^-r, the product q of r's
two uniforms.  At a weight of 1, y e^r = (1 / q)^(1 - b) <= 1 + (1 - b) (1 / q - 1) is closer.
A draw whose bound is above ``LIMIT`` over the sum of its text's weights is
left out before its logarithms.  A smallest a below that limit is the
smallest of all draws; a document with a sample that has none (once in e^LIMIT samples) draws
again with all its terms.  So the samples are those of all draws.

Each document is also compared with an *edited* text and with the next document
by id.  Documents are dealt by range of the id into many small buckets, each
with a copy of the first document of the following one, so every document meets
its successor where it is; the text is shuffled once.

Defined results: a null text counts as empty; a text without words has a
fingerprint of zeros, as similar as 1 to another such text and 0 to any other;
a text of one word has that word as its term; equal ids are put in the order of
a hash of the text; null ids come first; with one document it is its own
successor; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import stored

SAMPLES = 64
LIMIT = 10.0
_NONE = -(1 << 15)  # the mark of no sample
_SALT = np.random.default_rng(20240902).integers(-(1 << 63), (1 << 63) - 1, SAMPLES + 2, dtype=np.int64).tolist()


# ------------------------------------------------------------ order of the ids

def _bucket(docs: DataFrame, per_bucket: int, ranges: int = 64) -> Column:
    """A number that never falls as ``id`` grows, with about ``per_bucket`` ids each.

    At most ``ranges`` cut points come from the ids' approximate quantiles; in a
    range ids are divided evenly.
    """
    total = docs.count()
    cuts = sorted(set(docs.approxQuantile("id", [i / ranges for i in range(ranges + 1)], 1 / (4 * ranges)))) if total else []
    if len(cuts) < 2:
        return F.lit(0).cast("long")
    each = max(1, total // (per_bucket * (len(cuts) - 1)))
    found = F.lit(0).cast("long")
    for i, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        inside = F.floor((F.col("id").cast("double") - low) / (high - low) * each)
        found = F.when(F.col("id") >= low, F.lit(1 + i * each) + F.least(F.greatest(inside, F.lit(0)), F.lit(each - 1))).otherwise(found)
    return F.coalesce(found, F.lit(0)).cast("long")


def _followed(docs: DataFrame, per_bucket: int) -> DataFrame:
    """id, text and bucket of every row, plus for each bucket a ``ghost`` of the row after its last.

    The buckets' first rows are a small part of the rows; who follows whom is
    worked out on their keys, in groups of buckets and then over the groups.
    """
    keyed = docs.withColumn("bucket", _bucket(docs, per_bucket)).withColumn("tie", F.xxhash64("text"))
    firsts = stored(keyed.groupBy("bucket").agg(F.min(F.struct("id", "tie")).alias("first")))
    group = F.floor(F.col("bucket") / 1024)
    heads = firsts.groupBy(group.alias("group")).agg(F.min(F.struct("bucket", "first")).alias("head"))
    # one row per 1024 buckets
    around = heads.select("group", F.coalesce(F.lead("head.first").over(Window.orderBy("group")),
                                              F.first("head.first").over(Window.orderBy("group"))).alias("after"))
    ghosts = firsts.withColumn("group", group).withColumn("next", F.lead("first").over(Window.partitionBy("group").orderBy("bucket"))) \
        .join(around, "group").select(F.coalesce("next", "after").alias("first"), F.col("bucket").alias("into"))
    ghosts = stored(ghosts.select(F.col("first.id").alias("g_id"), F.col("first.tie").alias("g_tie"), "into"))
    if ghosts.count() <= 50_000:  # 24 bytes each
        ghosts = F.broadcast(ghosts)
    copies = keyed.join(ghosts, F.col("id").eqNullSafe(F.col("g_id")) & (F.col("tie") == F.col("g_tie"))) \
        .select("id", "text", "tie", F.col("into").alias("bucket"), F.lit(True).alias("ghost"))
    return keyed.select("id", "text", "tie", "bucket", F.lit(False).alias("ghost")).unionByName(copies)


# ------------------------------------------------------------------- sampling

def _terms(text: Column) -> Column:
    """The pairs of neighbouring words; a single word pairs with nothing."""
    words = F.array_remove(F.split(text, r"\s+"), "")
    n = F.size(words)
    count = F.greatest(n - 1, F.lit(1))
    return F.slice(F.arrays_zip(words.alias("p"), F.slice(words, F.lit(2), count).alias("q")), F.lit(1), count)


def _uniform(word: str, lane: int) -> str:
    """A number in (0, 1) from 25 bits of a 64-bit word."""
    return f"((shiftrightunsigned({word}, {39 - 25 * lane}) & 33554431L) + 0.5D) * {2.0 ** -25}D"


def _weighted(rows: DataFrame, key: list[str]) -> DataFrame:
    """key, term, its weights w0 in the text and w1 in the edited text, and the sums s0 and s1 of all weights there."""
    texts = F.array(F.struct(F.lit(0).alias("v"), F.col("text").alias("t")), F.struct(F.lit(1).alias("v"), F.col("edited").alias("t")))
    terms = rows.select(*key, F.explode(texts).alias("x")) \
        .select(*key, F.col("x.v").alias("v"), _terms(F.col("x.t")).alias("all")) \
        .select(*key, "v", F.size("all").alias("s"), "all") \
        .select(*key, "v", "s", F.explode_outer("all").alias("p")) \
        .select(*key, "v", "s", F.when(F.col("p").isNotNull(), F.xxhash64(F.col("p.p"), F.col("p.q"))).alias("term"))
    # a weight of 0 has no logarithm and draws nothing; nor does a text without words, whose term is null
    weights = [F.when(F.col("term").isNotNull(), F.nullif(F.count_if(F.col("v") == v), F.lit(0))).cast("double").alias(f"w{v}") for v in range(2)]
    return terms.groupBy(*key, "term").agg(*weights, *[F.max(F.when(F.col("v") == v, F.col("s"))).cast("double").alias(f"s{v}") for v in range(2)])


def _draws(weighted: DataFrame, key: list[str], limit: float | None) -> DataFrame:
    """key, sample, and ln(a) of each draw in both texts, as ``own`` and ``other``: null above ``limit`` over the sum of weights."""
    logs = [F.ln(f"w{v}").alias(f"l{v}") for v in range(2)]
    if limit is not None:
        logs += [F.ln(F.lit(limit) / F.col(f"s{v}")).alias(f"bar{v}") for v in range(2)]
        logs.append((F.greatest(F.col("w0") / F.col("s0"), F.col("w1") / F.col("s1")) * (limit * (1 + 1e-9))).alias("most"))  # more than rounding
        logs.append((F.greatest("w0", "w1") > 1).alias("heavy"))
    r, c, b = "xxhash64(term ^ salt)", f"xxhash64(term ^ salt ^ {_SALT[SAMPLES]}L)", f"xxhash64(term ^ salt ^ {_SALT[SAMPLES + 1]}L)"
    drawn = weighted.select(*key, F.coalesce("term", F.lit(0)).alias("term"), *logs).select("*", F.posexplode(F.array(*map(F.lit, _SALT[:SAMPLES]))).alias("sample", "salt"))
    if limit is not None:
        least, q = f"(1D - {_uniform(c, 0)} * {_uniform(c, 1)})", f"({_uniform(r, 0)} * {_uniform(r, 1)})"
        drawn = drawn.filter(F.expr(f"{least} * {q} <= most")) \
            .filter(F.expr(f"heavy OR {least} * {q} <= most * (1D - {_uniform(b, 0)} * (1D - {q}))"))
    # ln a = ln c - r (t - b) - r is a function of the term and t alone, so its bits stand for the sample
    made = drawn.withColumns({"hr": F.expr(r), "hc": F.expr(c)}).withColumns({
        "r": F.expr(f"-ln({_uniform('hr', 0)} * ({_uniform('hr', 1)}))"), "c": F.expr(f"ln(-ln({_uniform('hc', 0)} * ({_uniform('hc', 1)})))"),
        "b": F.expr(_uniform(b, 0))}) \
        .withColumns({name: F.expr(f"c - r * (floor(l{v} / r + b) - b) - r") for v, name in enumerate(("own", "other"))})
    if limit is None:
        return made.select(*key, "sample", "own", "other")
    # a generator leaves out what is above both bars; a filter would be moved to where all is computed once more
    kept = F.expr("IF(own <= bar0 OR other <= bar1, array(named_struct('own', IF(own <= bar0, own, NULL), 'other', IF(other <= bar1, other, NULL))), "
                  "array())")
    return made.select(*key, "sample", F.inline(kept))


def _marks(draws: DataFrame, key: list[str]) -> DataFrame:
    """key, own and other: the marks of both texts' samples, 16 bits each, ``_NONE`` without; and how many each has."""
    names = ("own", "other")
    samples = draws.groupBy(*key, "sample").agg(*[F.min(name).alias(name) for name in names])
    marks = [F.expr(f"cast(if({name} IS NULL, {_NONE}, pmod(xxhash64({name}), 65535L) + {_NONE + 1}) AS smallint) AS {name}") for name in names]
    whole = samples.select(*key, "sample", *marks).groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("sample", *names))).alias("all"), *[F.count_if(F.col(name) > _NONE).alias(f"{name}_found") for name in names])
    return whole.select(*key, *[F.col(f"all.{name}").alias(name) for name in names], *[f"{name}_found" for name in names])


def _hex(marks: str) -> Column:
    """Marks as a string, four digits a sample."""
    return F.array_join(F.transform(marks, lambda m: F.lpad(F.lower(F.hex(m.cast("int") - _NONE)), 4, "0")), "")


def _likeness(a: str, b: str) -> Column:
    """The share of equal samples; 1 if neither text has any."""
    def total(f) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: f(p, q).cast("int")), F.lit(0), lambda s, c: s + c)

    filled = total(lambda p, q: (p > _NONE) | (q > _NONE))
    return F.when(filled == 0, F.lit(1.0)).otherwise(total(lambda p, q: (p == q) & (p > _NONE)) / F.greatest(filled, F.lit(1)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_bucket: int = 48,
                 partition_chars: int = 3 << 20, limit: float = LIMIT) -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row.

    The edited text has the last half of its code points replaced by the first as
    many (or all) of the next document.  ``partition_chars``: about how much text
    a task holds the terms of.  ``limit``: see above; any gives the same rows.
    """
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chars = src.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = max(1, -(-chars // partition_chars))
    order = Window.partitionBy("bucket").orderBy("ghost", "id", "tie")
    rows = _followed(src, per_bucket).repartition(tasks, "bucket").withColumn("at", F.row_number().over(order)) \
        .withColumn("n_chars", F.length("text").cast("long")).withColumn("after", F.lead("text").over(order))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                                              F.substring(F.coalesce("after", F.lit("")), F.lit(1), half)))
    key = ["bucket", "at"]  # rows stay where they are: each grouping below is by the bucket and more
    found = _marks(_draws(_weighted(rows, key), key, limit), key)
    settled = stored(found.filter((F.col("own_found") == SAMPLES) & (F.col("other_found") == SAMPLES)).select(*key, "own", "other"))
    left = rows.join(settled.select(*key).repartition(tasks, "bucket"), key, "left_anti")
    again = _marks(_draws(_weighted(left, key), key, None), key).select(*key, "own", "other")
    marks = settled.unionByName(again).repartition(tasks, "bucket")
    in_order = Window.partitionBy("bucket").orderBy("at")
    judged = marks.withColumn("next", F.lead("own").over(in_order)).select(
        *key, _hex("own").alias("fingerprint"), _hex("other").alias("edited_fingerprint"),
        _likeness("own", "other").alias("near_edited"), _likeness("own", "next").alias("near_next"))
    facts = rows.select(*key, "ghost", F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256")) \
        .filter(~F.col("ghost"))
    return facts.join(judged, key).select(id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                          "near_edited", "near_next")
