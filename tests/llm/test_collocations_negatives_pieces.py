import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.llm import collocations, hard_negatives, sentence_pieces

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------ collocations

def plain_collocations(rows, least, keep, longest=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        found = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        scored = []
        for p, a in found.items():
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * c >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, c in found.items())
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:keep])]
    return Counter(out)


ODD = [("en", None), ("en", ""), (None, "Ünd a\x01b a\x01b  a\tb a"), ("und", "a a\x01b a b"), ("en", ".,;:!?\n\r\x0b\x0c"), ("de", "x" * 5000)]


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_collocations_equal_brute_force(spark, block):
    rng = random.Random(block)
    words = ["The", "the", "cat", "a", "a\x01", "a\x1fb", "é", "日本", "sat", "mat"]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n"]) for _ in range(60)))
            for _ in range(80)]
    rows += [("en", "one two three four five six seven. " * 40)] * 3 + ODD
    df = spark.createDataFrame([(i, "z", lang, text) for i, (lang, text) in enumerate(rows)], "n long, phrase string, lang string, text string") \
        .repartition(7)
    for least, keep in ((5, 2000), (2, 7)):
        got = collocations.collocations(df, least, keep=keep, slice_bytes=3000, range_rows=block).collect()
        assert Counter(map(tuple, got)) == plain_collocations(rows, least, keep)


def test_words_are_counted_where_their_rows_meet(spark, monkeypatch):
    """The blocks' words are shuffled once: no table of frequent words is joined with them."""
    made, suffixes = [], collocations._suffixes
    monkeypatch.setattr(collocations, "_suffixes", lambda blocks, kept, longest: made.append(kept) or suffixes(blocks, kept, longest))
    rows = [("en", "a b a b c")] * 60 + [("de", "a b x")] * 50 + [(None, "a b")] * 40
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), 100, slice_bytes=64).collect()
    assert Counter(map(tuple, got)) == plain_collocations(rows, 100, 2000)
    assert "Join" not in made[0]._jdf.queryExecution().optimizedPlan().toString()


def test_only_suffixes_of_frequent_pairs_are_shuffled(spark, monkeypatch):
    """Frequent words that seldom meet open no suffix; those of frequent pairs are all there, in blocks and parts of any size."""
    routed, counted = [], collocations.phrase_counts
    monkeypatch.setattr(collocations, "phrase_counts", lambda suffixes, rows, *rest: routed.append(rows) or counted(suffixes, rows, *rest))
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(rng.choice(["en", "de"]), " ".join(rng.choice(words) for _ in range(30))) for _ in range(300)]
    rows += [("en", "x y z. x y é")] * 40 + [("de", "x y z")] * 30 + ODD
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for slice_bytes, range_rows in ((1 << 20, 1 << 20), (2000, 100)):
        got = collocations.collocations(df, 20, slice_bytes=slice_bytes, range_rows=range_rows).collect()
        assert Counter(map(tuple, got)) == plain_collocations(rows, 20, 2000)
    assert max(routed) < 1500  # of some 8,700 pairs of frequent words


def test_pairs_are_packed_without_loss():
    rng = np.random.default_rng(8)
    numbers = np.unique(rng.integers(0, 1 << 37, 5000).astype(np.uint64))
    for parts in (1, 7, 20000):
        cuts = collocations._cuts(numbers, 37, parts)
        assert cuts[0] == 0 and cuts[-1] == numbers.size
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                gaps = np.diff(numbers[a:b], prepend=np.uint64(0))
                assert np.array_equal(np.cumsum(collocations._unpacked(collocations._packed(gaps), b - a), dtype=np.uint64), numbers[a:b])


def test_collocations_of_nothing(spark):
    schema = "lang string, text string"
    assert collocations.collocations(spark.createDataFrame([], schema)).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None), (None, "")], schema), 1).count() == 0


def test_scores_beyond_64_bits_are_exact(spark):
    big = 3_000_000_000_000
    phrases = spark.createDataFrame([("en", "a\t", 1, 2 * big + 1), ("en", "b\t", 1, big + 7), ("en", "a\tb\t", 2, big)],
                                    "lang string, phrase string, size int, n long")
    totals = spark.createDataFrame([("en", 9 * big + 5)], "lang string, n long")
    got = collocations.cut_scores(phrases, totals).first()
    assert got["score"] == 1000 * big * (9 * big + 5) // ((2 * big + 1) * (big + 7))


def test_quicksort_counts_equal_plain_counts():
    rng = np.random.default_rng(3)
    grid = rng.integers(0, 4, (500, 5)).astype(np.int64)
    grid[np.arange(5)[None, :] >= rng.integers(1, 6, 500)[:, None]] = -1
    weight = rng.integers(1, 4, 500)
    plain = Counter()
    for row, w in zip(grid.tolist(), weight.tolist()):
        for d in range(1, 6):
            if row[d - 1] >= 0:
                plain[tuple(row[:d])] += w
    got = {tuple(grid[r, :d].tolist()): c for r, d, c in collocations.frequent(grid, weight, 9)}
    assert got == {p: c for p, c in plain.items() if c >= 9}


# ---------------------------------------------------------- hard negatives

def plain_negatives(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    fine = [(i, label, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]

    def score(a, b):
        return min(max(sum(p * q for p, q in zip(a, b)), -2 ** 63), 2 ** 63 - 1)
    out = []
    for i, label, v in {r for r in fine if is_anchor(r[0])}:
        near = sorted((-score(v, w), j) for j, other, w in fine if other == label and j != i)[:positives]
        for s, j in near:
            far = sorted((-score(v, w), k) for k, other, w in fine if other != label and k != i)
            far = [(t, k) for t, k in far if low * -s <= 100 * -t <= high * -s][:negatives]
            # a positive that repeats has equal scores, so equal lists
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(far)]
    return Counter(out)


NEGATIVE_SCHEMA = "vec_id long, embedding array<float>, label int, block string, asked string"


@pytest.mark.parametrize("block", [1 << 16, 70])
def test_hard_negatives_equal_brute_force(spark, block):
    rng = np.random.default_rng(block)
    rows = [(i, (rng.normal(size=11) * rng.choice([0.05, 1.0, 40.0])).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(700)]
    rows += [(700 + i, rows[50][1], i % 3) for i in range(150)]  # ties
    rows += [(900, None, 1), (901, [float("nan")] * 11, 1), (902, [None] + [1.0] * 10, 1), (None, [1.0] * 11, 2), (903, [1.0] * 11, None),
             (950, [0.5, 0.5], 1), (950, [0.5, 0.5], 1), (950, [2.0] * 11, 2), (1000, [], 0), (1001, [3.0] * 14, 9), (-50, [1.0] * 11, 3)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], NEGATIVE_SCHEMA)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0, block=block).collect()
    assert Counter(map(tuple, got)) == plain_negatives(rows, lambda i: i % 50 == 0)


def test_hard_negatives_edges(spark):
    none = spark.createDataFrame([], NEGATIVE_SCHEMA)
    assert hard_negatives.hard_negatives(none, F.lit(True)).count() == 0
    rows = [(0, [1e30, 1.0], 0), (1, [1e30, 2.0], 0), (2, [5e29, 0.0], 1), (3, [1.0, 1.0], 1), (4, [-1e30, 0.0], 0)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], NEGATIVE_SCHEMA)
    got = hard_negatives.hard_negatives(df, F.lit(True)).collect()
    assert Counter(map(tuple, got)) == plain_negatives(rows, lambda i: True)


def test_table_lookups_equal_products():
    rng = np.random.default_rng(0)
    x, a = rng.integers(-300, 300, (50, 19)), rng.integers(-70000, 70000, (4, 19))
    assert (hard_negatives.inner_products(a, hard_negatives.bit_planes(x)) == a @ x.T).all()
    assert (hard_negatives.bit_planes(np.zeros((3, 2), np.int64)) == 0).all()


# ---------------------------------------------------------- sentence pieces

def model_path():
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


SIGNS = ["", " ", "   ", "▁", " ▁ a", "a\tb\nc\r\n", "\x00a\x01", "<s>x</s><unk><0x0A>", "123 4567", "日本語 한국 ﬁ é é 👩‍👩‍👧 \U0010ffff",
         "aaaaaaaaaaaa" * 50, "x" * 70_000, " " * 3000 + "end", "the " * 3000, "abcdefghij" * 4000, "…—«»", "  　"]


@pytest.mark.parametrize("text", SIGNS)
def test_pieces_of_odd_texts(text):
    model = sentence_pieces.piece_model(model_path())
    ids = np.frombuffer(model.encode([text])[0], "<u4").tolist()
    assert ids == model.library.encode(text, add_bos=True, add_eos=True)
    assert model.decode(ids) == model.library.decode(ids) == text.replace("▁", " ")


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁etaoinTh.,\n0123"), st.characters(exclude_categories=["Cs"])), max_size=120))
def test_pieces_equal_the_library(text):
    model = sentence_pieces.piece_model(model_path())
    ids = np.frombuffer(model.encode([text])[0], "<u4").tolist()
    assert ids == model.library.encode(text, add_bos=True, add_eos=True)
    assert model.decode(ids) == model.library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 262), st.integers(0, 31999)), max_size=30))
def test_any_ids_decode_as_in_the_library(ids):
    model = sentence_pieces.piece_model(model_path())
    assert model.decode(ids) == model.library.decode(ids)


def test_cuts_do_not_change_the_agenda():
    model = sentence_pieces.piece_model(model_path())
    rng = random.Random(5)
    for _ in range(200):
        run = "▁" * rng.randint(0, 9) + "".join(rng.choice("abcdeéstn019-_/ß\n") for _ in range(rng.randint(1, 90)))
        whole = model.agenda(run)
        assert [i for part in model.cut(run) for i in model.agenda(part)] == whole
        assert np.frombuffer(b"".join(model.short_agendas([run, "▁a", run[:5], "x"])), "<u4").tolist() == \
            [i for r in (run, "▁a", run[:5], "x") for i in model.agenda(r)]


def test_encode_table(spark):
    rows = [(1, None), (1, ""), (None, "Two words"), (3, "Two words"), (4, "long " * 50_000)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, ids string, agrees string")
    got = sentence_pieces.encode(df, model_path()).collect()
    library = sentence_pieces.piece_model(model_path()).library
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want[(i, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), library.decode(ids), True)] += 1
    assert Counter((r["doc_id"], hashlib.sha256(r["ids"]).hexdigest(), r["decoded"], r["agrees"]) for r in got) == want
    assert sentence_pieces.encode(df.limit(0), model_path()).count() == 0
