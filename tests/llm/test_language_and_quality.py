import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import language_id, queries, quality

SF = "/root/testdata/sf0.01"


def test_trigram_vectors_bind_permuted_letters():
    space = language_id.Space(64, 3)
    a, b, c = (space.letter(ord(x)) for x in "abc")
    code = (ord("a") << 42) | (ord("b") << 21) | ord("c")
    assert (space.gram(code) == np.roll(a, 2) * np.roll(b, 1) * c).all()


def test_profiles_equal_a_plain_count():
    space = language_id.Space(64, 3)
    texts = ["Abc, abd!", "", "123", "É é", "x" * 50]
    profiles, codes = space.profiles(texts)
    for text, row in zip(texts, profiles, strict=True):
        s = " " + " ".join("".join(ch if ch.isalpha() else " " for ch in text.lower()).split()) + " "
        plain = {}
        for i in range(len(s) - 2):
            g = tuple(map(ord, s[i:i + 3]))
            plain[g] = plain.get(g, 0) + 1
        total = max(sum(plain.values()), 1)
        got = {(c >> 42, (c >> 21) & 0x1FFFFF, c & 0x1FFFFF): v for c, v in zip(codes.tolist(), row.tolist(), strict=True) if v}
        assert got == pytest.approx({g: n / total for g, n in plain.items()})


def test_language_held_out_accuracy(spark):
    out = queries.op4_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_edges(spark):
    rows = [(1, "the cat and the dog", "en", 5), (2, "le chat et le chien", "fr", 5), (3, None, "en", 5), (4, "", None, 5),
            (None, "1234 !!", "fr", 5), (6, "the dog " * 20000, None, 5), (6, "the dog", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = language_id.learn(docs, F.lit(True), 256)
    assert sorted(model) == ["en", "fr"]
    out = {(r[0], i): r for i, r in enumerate(sorted(language_id.predict(docs, model, 256).collect(), key=lambda r: (r[0] is None, r[0] or 0)))}
    langs = [r["lang_pred"] for r in out.values()]
    assert langs == ["en", "fr", "und", "und", "en", "en", "und"]
    kept = language_id.keep_languages(docs, model, 0.1, 256)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 6, 6]
    assert language_id.learn(docs.limit(0), F.lit(True), 256) == {}
    assert {r["lang_pred"] for r in language_id.predict(docs, {}, 256).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model, 256).count() == 0


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    good, pairs, first = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([0, 4, 5])
    p, expected_pairs = quality.marginals(good, pairs, first)
    plain_p, plain_pairs = [], np.zeros((2, 2))
    for a, b in ((0, 4), (4, 5), (5, 9)):
        z, ones, edges = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(good[a + i] * k for i, k in enumerate(labels)) + sum(pairs[i, j] for i, j in zip(labels, labels[1:])))
            z += w
            ones += w * np.array(labels)
            for i, j in zip(labels, labels[1:]):
                edges[i, j] += w
        plain_p += list(ones / z)
        plain_pairs += edges / z
    assert np.allclose(p, plain_p) and np.allclose(expected_pairs, plain_pairs)


def test_quality_held_out(spark):
    out = queries.op9_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in out)


def test_quality_edges(spark):
    rows = [(1, "plain words in a line", 7), (2, "%%% %%% %%%", 7), (3, None, 7), (4, "", 7), (4, "", 7), (None, "a\n\nb", 7),
            (7, "words\n" * 30000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None), (9, 1)], "doc_id long, quality int")
    field = quality.learn(docs, labels, F.lit(True))
    out = quality.score(docs, field).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert quality.learn(docs, labels.limit(0), F.lit(True)) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.keep_good(docs, None).count() == len(rows)
    assert quality.score(docs.limit(0), field).count() == 0
