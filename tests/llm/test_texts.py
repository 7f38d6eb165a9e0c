"""Token counts, language-model scores, fingerprints and near duplicates against plain versions."""

import hashlib
import inspect
import math
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from mercato.llm import fingerprint, lm_scoring, near_dedup, token_counts

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(0, None, 7), (1, "", 7), (1, "", 7), (None, "one two three four five six", 7), (4, " \n\t ", 7), (5, "word", 7),
       (6, "long text here " * 30000, 7), (7, "Ünï cödé 日本 😀 text", 7), (7, "Ünï cödé 日本 😀 text", 7)]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, n long")


# --------------------------------------------------------------- token counts

def greedy(word, entries, longest):
    w, n, i = b" " + word, 0, 0
    while i < len(w):
        for j in range(min(len(w), i + longest), i, -1):
            if w[i:j] in entries:
                n, i = n + 1, j
                break
        else:
            return 1
    return n


def test_automaton_equals_greedy_matching():
    rng = random.Random(2)
    for k in range(200):
        entries = list({bytes(rng.choice(b" abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 25))}) + [b" "] * (k % 2)
        words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 9))) for _ in range(30)]
        _, got = token_counts.count_texts(token_counts.Automaton(entries), words)
        assert list(got) == [greedy(w, set(entries), 9) for w in words]


def test_token_counts_of_a_table(spark):
    entries = set(token_counts.vocabulary(PATH))
    longest = max(map(len, entries))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).unionByName(odd(spark).drop("n"))
    rows = docs.collect()
    expected = Counter()
    for r in rows:
        words = re.findall(rb"[^\x20\x09-\x0d]+", (r["text"] or "").encode())
        counts = {w: greedy(w, entries, longest) for w in set(words)}
        expected[(r["doc_id"], len(words), sum(counts[w] for w in words))] += 1
    assert Counter(map(tuple, token_counts.token_counts(docs, PATH).collect())) == expected
    assert token_counts.token_counts(docs.limit(0), PATH).count() == 0


# ------------------------------------------------------------ language models

def plain_models_over(texts, targets, size):
    """Of all characters; ``size`` is only their number."""
    names = sorted({c for t in texts for c in t.lower()})
    number = {c: i + 1 for i, c in enumerate(names)}
    tokens = [[0, 0, 0, *[number[c] for c in t.lower()]] for t in texts]

    def model(some):
        n, whole, kinds = Counter(tuple(x[i - k:i + 1]) for x in some for i in range(3, len(x)) for k in range(4)), Counter(), Counter()
        for g, c in n.items():
            whole[g[:-1]] += c
            kinds[g[:-1]] += 1

        def p(h, c):
            low = p(h[1:], c) if h else 1 / size
            return (n[(*h, c)] + kinds[h] * low) / (whole[h] + kinds[h]) if whole[h] else low
        return lambda x: sum(-math.log(p(tuple(x[i - 3:i]), x[i])) for i in range(3, len(x))) / max(len(x) - 3, 1)

    a, b = model([x for x, t in zip(tokens, targets, strict=True) if t]), model(tokens)
    return [(len(x) - 3, a(x), b(x)) for x in tokens]


def test_losses_over_all_characters(spark):
    letters = "abcdeé A日本Ж😀" + "".join(chr(0x4E00 + k) for k in range(80))
    texts = [(i, "".join(random.Random(i).choice(letters) for _ in range(20 + 9 * i))) for i in range(12)] + [(20, ""), (21, None), (5, "日本"), (None, "ЖЖ")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for wanted in ([0, 2, 2, None, 99], []):
        ids = spark.createDataFrame([(i,) for i in wanted], "doc_id long")
        size = len({c for _, t in texts for c in (t or "").lower()})
        expected = plain_models_over([t or "" for _, t in texts], [i in wanted and i is not None for i, _ in texts], size)
        for block_bytes in (2 << 20, 500):
            got = lm_scoring.score_corpus(docs, ids, block_bytes=block_bytes).collect()
            want = sorted((str(i), n, round(a, 6), round(b, 6), round(a - b, 6)) for (i, _), (n, a, b) in zip(texts, expected, strict=True))
            have = sorted((str(r["doc_id"]), r["n_tokens"], round(r["target_loss"], 6), round(r["background_loss"], 6), round(r["score"], 6)) for r in got)
            assert [h[:2] for h in have] == [w[:2] for w in want]
            assert [x for h in have for x in h[2:]] == pytest.approx([x for w in want for x in w[2:]], abs=2e-6)
    # documents in a script of rare characters are told apart
    assert len({r["background_loss"] for r in got if r["n_tokens"]}) == sum(1 for _, t in texts if t)
    assert lm_scoring.score_corpus(docs.limit(0), ids).count() == 0


def test_the_target_is_found_without_its_texts(spark, monkeypatch):
    """However many targets there are, blocks are cut where the texts are read, and bits say who is in."""
    seen, cut = [], lm_scoring._blocks
    monkeypatch.setattr(lm_scoring, "_blocks", lambda src, *rest: seen.append(src.columns) or cut(src, *rest))
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("ab"), F.col("id") % 7).alias("text"))
    ids = spark.createDataFrame([(0,), (32766,), (32767,), (32768,), (39_999,), (39_999,), (None,), (50_000,)], "doc_id long")
    lm_scoring.score_corpus(docs.coalesce(1), ids)
    assert seen == [["_id", "_text"]]
    blocks = cut(docs.coalesce(1).toDF("_id", "_text"), "bigint", 16 << 20)
    wanted = ids.select(F.col("doc_id").alias("_target")).filter("_target IS NOT NULL").distinct()
    got = np.concatenate([lm_scoring._flags([x.asDict() for x in r.inside], len(r.ids))
                          for r in blocks.join(lm_scoring._inside(blocks, wanted), "block", "left").collect()])
    assert np.flatnonzero(got).tolist() == [0, 32766, 32767, 32768, 39_999]


def test_codes_of_4_grams(monkeypatch):
    """Whatever the pieces and however many characters, the codes spell every text's 4-grams in their order."""
    rng = random.Random(3)
    many = [chr(0x4E00 + k) for k in range(20_000)] + [chr(0x20000 + k) for k in range(20_000)]
    for texts in (["abcab", "", "b", "日本abc"], [], [""], ["".join(rng.sample(many, 39_000)), "ab", "".join(rng.choices("ab", k=50))]):
        for piece in (7, 1000, 1 << 20):
            if piece == 7 and sum(map(len, texts)) > 1000:
                continue
            monkeypatch.setattr(lm_scoring, "_PIECE", piece)
            block = lm_scoring._Texts("".join(texts).encode("utf-32-le"), np.array([len(t) for t in texts], np.int64))
            got = [(int(o), int(c), int(d)) for code, owner in block.pieces() for o, c, d in zip(owner, *block.spelled(code), strict=True)]
            want = []
            for i, t in enumerate(texts):
                x = [0, 0, 0, *[ord(c) + 1 for c in t]]
                want += [(i, (x[k - 3] << 42) | (x[k - 2] << 21) | x[k - 1], x[k]) for k in range(3, len(x))]
            assert got == want
            assert block.distinct().tolist() == sorted({int(c) for code, _ in block.pieces() for c in code})
    assert block.pairs is not None


# --------------------------------------------------------------- fingerprints

def terms(t):
    w = re.split(r"[ \t\n\x0b\f\r]+", t)
    w = [x for x in w if x]
    return Counter(zip(w, w[1:])) if len(w) > 1 else Counter([(w[0],)] if w else [])


def likeness(p, q):
    keys = set(p) | set(q)
    return sum(min(p[k], q[k]) for k in keys) / sum(max(p[k], q[k]) for k in keys) if keys else 1.0


def edited(texts):
    out = []
    for i, t in enumerate(texts):
        half = len(t) // 2
        out.append(t[:len(t) - half] + texts[(i + 1) % len(texts)][:half])
    return out


def test_fingerprints(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: r["doc_id"])
    texts = [r["text"] or "" for r in rows]
    changed = edited(texts)
    out = sorted(fingerprint.fingerprints(docs, per_bucket=7, partition_chars=50_000).collect(), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in out] == [r["doc_id"] for r in rows] and [r["n_chars"] for r in out] == [len(t) for t in texts]
    assert [r["edited_sha256"] for r in out] == [hashlib.sha256(t.encode()).hexdigest() for t in changed]
    by_text = {}
    for t, e, r in zip(texts, changed, out, strict=True):
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert by_text.setdefault(e, r["edited_fingerprint"]) == r["edited_fingerprint"]
    counted = [terms(t) for t in texts]
    near = np.array([r["near_edited"] for r in out]) - [likeness(a, terms(e)) for a, e in zip(counted, changed, strict=True)]
    following = np.array([r["near_next"] for r in out]) - [likeness(a, b) for a, b in zip(counted, counted[1:] + counted[:1], strict=True)]
    assert abs(near.mean()) < 0.03 and near.std() < 0.12 and abs(following.mean()) < 0.02


def test_fingerprint_edges(spark):
    out = fingerprint.fingerprints(odd(spark)).collect()
    assert len(out) == len(ODD)
    empty = [r for r in out if r["n_chars"] == 0]
    assert {r["fingerprint"] for r in empty} == {"0" * 256}
    twice = [r["fingerprint"] for r in out if r["doc_id"] == 7]
    assert twice[0] == twice[1] != "0" * 256
    assert fingerprint.fingerprints(odd(spark).limit(0)).count() == 0
    alone = fingerprint.fingerprints(odd(spark).filter("doc_id = 5")).first()
    assert alone["near_next"] == 1.0


def test_fingerprints_keep_the_weights(spark):
    """Texts with heavily repeated lines, against exact values: the next document's likeness, over many draws of words."""
    rng = random.Random(11)

    def own(n):
        return " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))

    line, shared = own(10), [own(200) for _ in range(40)]
    cases = [lambda k: (f"{line} " * 100 + own(200), f"{line} " * 100 + own(200)),
             lambda k: ("a b " * 1000 + own(100), "a b " * 1000 + own(100)),
             lambda k: (f"{line} " * 100 + shared[k], shared[k])]
    for case in cases:
        pairs = [case(k) for k in range(40)]
        docs = spark.createDataFrame([(2 * k + i, t) for k, p in enumerate(pairs) for i, t in enumerate(p)], "doc_id long, text string")
        got = {r["doc_id"]: r["near_next"] for r in fingerprint.fingerprints(docs).collect()}
        off = np.array([got[2 * k] - likeness(terms(a), terms(b)) for k, (a, b) in enumerate(pairs)])
        assert abs(off.mean()) < 0.04 and off.std() < 0.12


def test_left_out_draws_change_no_sample(spark):
    """Whatever the limit, also one that makes nearly all documents draw again, the samples are those of all draws."""
    rng = random.Random(5)
    long = [(10 + i, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(2, 400)))) for i in range(40)]
    docs = odd(spark).drop("n").filter("doc_id IS NULL OR doc_id <> 6").unionByName(spark.createDataFrame(long, "doc_id long, text string"))
    want, *others = (Counter(map(tuple, fingerprint.fingerprints(docs, limit=limit).collect())) for limit in (1e12, 10.0, 0.5))
    assert all(want == got for got in others)
    key = ["bucket", "at"]
    weighted = spark.range(500).selectExpr("0 AS bucket", "0 AS at", "xxhash64(id) AS term", "1D AS w0", "1D AS w1", "500D AS s0", "500D AS s1")
    few, all_ = fingerprint._draws(weighted, key, 10.0), fingerprint._draws(weighted, key, None)
    assert all_.count() == 500 * 64 and 5 * 64 < few.count() < 0.05 * all_.count()
    assert sorted(fingerprint._marks(few, key).first()["own"]) == sorted(fingerprint._marks(all_, key).first()["own"])


# ------------------------------------------------------------ near duplicates

def plain_groups(rows, percent=75):
    sets = {}
    for i, t in rows:
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall("[^\x20\x09-\x0d]+", t)
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = root(i), root(j)
                label[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    for k in range(150):  # one group of near copies, some of them strays
        words = list(base)
        for _ in range(rng.choice([1, 2, 4, 6, 9])):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 9999)}"
        rows.append((10_000 + k, " ".join(words)))
    rows += [(20_000, None), (20_001, " \n"), (20_002, "two words"), (20_003, "Two  WORDS"), (20_004, "two words more")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, label int")
    expected = plain_groups(rows)
    for block in (512, 16):
        out = near_dedup.near_duplicates(docs, block=block).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == expected
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in expected.items() if c == i)


def test_near_duplicate_edges(spark):
    out = sorted(map(tuple, near_dedup.near_duplicates(odd(spark)).collect()), key=str)
    assert len(out) == len(ODD) and (None, 2, None, True) in out
    assert sorted(str(r["doc_id"]) for r in near_dedup.keep_one(odd(spark)).collect()) == ["0", "1", "4", "5", "6", "7", "None"]
    assert near_dedup.near_duplicates(odd(spark).limit(0)).count() == 0
    assert near_dedup.keep_one(odd(spark).limit(0)).count() == 0


def test_ids_with_several_texts(spark):
    a, b, c = ("one two three four five six seven eight " * 3, "alpha beta gamma delta epsilon zeta eta " * 3, "un deux trois quatre cinq six sept " * 3)
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "x"), (9, b, "x"), (11, c, "x"), (12, c + "huit", "x"), (9, "", "x"), (3, a, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _kept string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {(3, 3, True), (5, 3, False), (9, 3, False), (11, 11, True), (12, 11, False)}
    kept = sorted((r["doc_id"], r["text"]) for r in near_dedup.keep_one(docs).collect())
    assert kept == sorted([(3, a), (5, b), (11, c), (9, "")])  # every text stays once


def test_columns_of_any_name_come_through(spark):
    names = ["_kept", "_place", "row", "id", "th", "place", "k"]
    docs = spark.createDataFrame([(i, "one two three four five six " * (1 + i % 2)) for i in range(6)], "doc_id long, text string") \
        .select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    kept = near_dedup.keep_one(docs).collect()
    assert len(kept) == 2 and all(r[n] == f"own {n}" for r in kept for n in names)
    assert near_dedup.near_duplicates(docs).count() == 6


def test_cells_test_few_links_of_large_groups(spark):
    """Copies of one text with a few words changed lie around the threshold; what leaves the cells grows with the rows."""
    def copies(n):
        rng = random.Random(n)
        base = [f"w{i}" for i in range(200)]
        out = []
        for i in range(n):
            words = list(base)
            for at in rng.sample(range(200), 4):
                words[at] = f"x{rng.random()}"
            out.append((i, " ".join(words)))
        return out
    rows = copies(300)
    sets = [{tuple(t.split()[i:i + 5]) for i in range(196)} for _, t in rows]
    label = list(range(300))
    for i in range(300):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (512, 40):
        got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, block=block).collect()}
        assert got == dict(enumerate(label))


def test_sketch_limit_leaves_room_for_both_noises():
    """Ones between the sketches of pairs at similarity 0.75: samples differ at random and their bits fall at random."""
    rng, pairs = np.random.default_rng(4), 20_000
    ones = np.empty(pairs)
    for k, differing in enumerate(rng.binomial(near_dedup.SAMPLES, 0.25, pairs)):
        ones[k] = (np.bincount(rng.integers(0, near_dedup.SKETCH_BITS, 2 * differing), minlength=near_dedup.SKETCH_BITS) & 1).sum()
    least = inspect.signature(near_dedup.near_duplicates).parameters["least_estimate"].default
    assert (near_dedup.most_ones(least) - ones.mean()) / ones.std() > 5


def test_finished_steps_leave_no_shuffle_files(spark):
    def files():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return set(re.findall(r"shuffle_\d+_\d+_0\.data", disk.getAllFiles().mkString(" ")))

    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60, 2)] + [(1, 2), (7, 8)], "a long, b long")
    before = files()
    got = near_dedup.components(edges)
    for _ in range(100):  # executors delete them on their own time
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert {r.node: r.label for r in got.collect()}[3] == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(200)] + [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)] + [(500, 500 + i) for i in range(1, 90)]
    label = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["label"] for r in got} == {x: v for x, v in label.items() if x not in alone}
