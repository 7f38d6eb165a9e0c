import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mercato.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_files_tokenizer(tokenizer):
    rng = random.Random(1)
    letters = " \n\t\r'sabA1_.é²!ß日😀\x1c\x85\u00a0"
    texts = ["", " ", "a   b ", "don't we'll", "x <|endoftext|> y", "日本語 テスト 😀", "A" * 3000]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    enc = packing.encoder(PATH)
    for t in texts:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def _optimal(lengths, capacity):
    """The fewest bins, by exhaustive search."""
    best = [len(lengths)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for room in set(bins):
            if room >= lengths[i]:
                rest = list(bins)
                rest.remove(room)
                go(i + 1, [*rest, room - lengths[i]])
        go(i + 1, [*bins, capacity - lengths[i]])

    go(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_keeps_an_optimal_solution(lengths):
    lengths = sorted(lengths, reverse=True)
    fixed, left = packing.reduce_instance(dict(Counter(lengths)), 20)
    rest = sorted((w for w, n in left.items() for _ in range(n)), reverse=True)
    assert Counter(lengths) == Counter(w for m, n in fixed for w in m * n) + Counter(rest)
    assert all(sum(m) <= 20 for m, _ in fixed)
    assert sum(n for _, n in fixed) + (_optimal(rest, 20) if rest else 0) == _optimal(lengths, 20)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=200))
def test_patterns_hold_every_piece_once(lengths):
    patterns = packing.solve(dict(Counter(lengths)), 50)
    assert all(sum(m) <= 50 and n > 0 for m, n in patterns)
    assert Counter(w for m, n in patterns for w in m * n) == Counter(lengths)


def test_whole_table(spark, tokenizer):
    texts = [None, "", "a", "a", "word " * 5000, "Hello, world", "x y z " * 700] + [f"doc {i} " * (i % 90) for i in range(300)]
    docs = spark.createDataFrame([(i if i != 5 else None, t, "extra") for i, t in enumerate(texts)],
                                 "doc_id long, text string, length string")
    rows = packing.pack_documents(docs, PATH, capacity=512).collect()
    expected = []
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        start = 0
        for k in range(n := -(-len(ids) // 512)):
            stop = len(ids) - (n - 1 - k) * 512
            expected.append((i if i != 5 else None, k, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
            start = stop
    assert Counter(tuple(r)[:5] for r in rows) == Counter(expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequences) <= -(-sum(r["length"] for r in rows) // 512) + 1
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0
