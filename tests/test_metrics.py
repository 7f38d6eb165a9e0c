"""Exact AUC and the per-class report against plain loops."""

import math
import random

import pytest

from mercato.plans.metrics import class_report, exact_auc


def plain_auc(rows):
    rows = [(s, y) for _, s, y in rows if s is not None and not math.isnan(s) and y is not None]
    p, n = [s for s, y in rows if y == 1], [s for s, y in rows if y != 1]
    return sum((a > b) + 0.5 * (a == b) for a in p for b in n) / (len(p) * len(n)), len(p), len(n)


def test_auc_with_ties_equals_all_pairs(spark):
    rng = random.Random(4)
    # a third of the rows share one score
    rows = [(i, 0.5 if i % 3 == 0 else rng.choice([0.0, 0.1, 0.7, rng.random()]), rng.choice([0, 1])) for i in range(400)]
    rows += [(900, None, 1), (901, float("nan"), 0), (902, 0.3, None)]
    df = spark.createDataFrame(rows, "k long, score double, y int")
    for kw in ({}, {"rows_per_bucket": 30}):  # in one window, and over buckets
        assert tuple(exact_auc(df, "score", "y", "k", **kw).first()) == pytest.approx(plain_auc(rows), abs=1e-15)


def test_auc_without_a_second_class(spark):
    df = spark.createDataFrame([(1, 0.2, 1), (2, 0.3, 1)], "k long, score double, y int")
    assert tuple(exact_auc(df, "score", "y", "k").first()) == (None, 2, 0)
    assert tuple(exact_auc(df.limit(0), "score", "y", "k").first()) == (None, 0, 0)


def test_report_of_several_classes(spark):
    rng = random.Random(9)
    rows = [(rng.choice([0, 0, 1, 2]), rng.choice([0, 1, 3])) for _ in range(300)] + [(None, 1), (1, None)]
    got = {(r["kind"], r["class"]): tuple(r)[2:] for r in class_report(spark.createDataFrame(rows, "y int, p int"), "y", "p").collect()}
    kept = [r for r in rows if None not in r]
    per = {}
    for c in range(4):
        hit, said, there = (sum(f(y, p) for y, p in kept) for f in (lambda y, p: y == p == c, lambda y, p: p == c, lambda y, p: y == c))
        per[c] = (hit / said if said else 0.0, hit / there if there else 0.0, 2 * hit / (said + there), there)
        assert got["class", str(c)] == pytest.approx(per[c])
    n = len(kept)
    assert got["all", "accuracy"] == (None, None, pytest.approx(sum(y == p for y, p in kept) / n), n)
    assert got["all", "macro avg"] == pytest.approx((*[sum(v[k] for v in per.values()) / 4 for k in range(3)], n))
    assert got["all", "weighted avg"] == pytest.approx((*[sum(v[k] * v[3] for v in per.values()) / n for k in range(3)], n))
    assert len(got) == 7
