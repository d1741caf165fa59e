"""Ranked lexical search against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from skewlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item_id long, rank string, `a.b` string, score string"
ITEMS = "item_id long, text string, doc_id long, `a.b` string"
TEXTS = [None, "", " \n", "Alpha beta, beta!", "alpha BETA beta", "é É naïve 東京x_y", "z" * 5000 + " alpha", "one two three four five " * 3000, "gamma", "alpha beta beta"]


def terms(t):
    return TERM.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k=10):
    w = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    w = [x for x in w if x[2]]
    n_docs, n_terms = len(w), sum(x[2] for x in w)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in w:
            m, score = 25 + 75 * n * n_docs // max(1, n_terms), 0
            for t in terms(text):
                df = sum(t in x[1] for x in w)
                if c[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0 and d is not None:
                scores.append((-score, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def made(seed=2, n=300):
    rng = np.random.default_rng(seed)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "alpha beta")]
    docs += [(100 + i, " ".join(f"v{int(x)}" for x in rng.zipf(1.3, rng.integers(1, 60)) % 200)) for i in range(n)]
    docs += [(1000 + i, docs[40][1]) for i in range(25)]
    items = [(i, " ".join(f"V{int(x)}" for x in rng.zipf(1.3, 12) % 200)) for i in range(15)]
    return docs, [*items, (20, docs[40][1]), (21, None), (22, "?!"), (23, "nowhere"), (None, "alpha alpha é"), (3, "beta"), (3, "beta")]


@pytest.mark.parametrize("setting", [{}, {"batch_bytes": 100}, {"CELLS": 600}, {"BLOCK": 4, "SHORT": 1, "SHARD": 50}])
def test_equals_brute_force(spark, monkeypatch, setting):
    options = {k: v for k, v in setting.items() if k.islower()}
    for name, value in setting.items():
        if name.isupper():
            monkeypatch.setattr(lexical, name, value)
    docs, items = made()
    d = spark.createDataFrame([(i, t, 1, "r", "x", "s") for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEMS)
    got = lexical.ranked(d, q, **options)
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=repr) == brute(docs, items)


def test_blocks_hold_their_bounds_and_are_skipped():
    docs, items = made(7, 900)
    import pyarrow as pa

    batch = lexical.Items(items)
    n, doc, term, tf = batch.hits(pa.array([t for _, t in docs], pa.string()))
    held, doc = np.unique(doc, return_inverse=True)
    (rows, seen, x), *rest = lexical._shards(doc, term, 1_000_000 * tf, len(held))
    shard = lexical.Shard(held[rows], x, np.full(len(seen), 1000))
    assert not rest and len(shard.block) and all(len(b) <= lexical.BLOCK for b in shard.block)
    for block, summary in zip(shard.block, shard.summary, strict=True):
        assert (summary == x[block].max(0)).all()
    for t, (short, a, b) in enumerate(shard.lists):
        assert sorted([*short.tolist(), *(d for k in range(a, b) for d in shard.block[k].tolist())]) == np.flatnonzero(x[:, t]).tolist()
    none, skipped = (np.zeros(0, np.int64), np.zeros(0, np.int64)), 0
    for wanted, times in zip(batch.terms, batch.times, strict=True):
        column = np.searchsorted(seen, wanted)
        ok = (column < len(seen)) & (seen[np.minimum(column, len(seen) - 1)] == wanted)
        if ok.any():
            skipped += shard.search(column[ok], times[ok], none, 10)[1]
    assert skipped > 0


def test_empty(spark):
    d, q = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert lexical.ranked(d, q).count() == 0
    assert lexical.ranked(d, spark.createDataFrame([(1, "alpha", 1, "x")], ITEMS)).count() == 0
    assert lexical.ranked(spark.createDataFrame([(1, None, 1, "r", "x", "s")], DOCS), spark.createDataFrame([(1, "alpha", 1, "x")], ITEMS)).count() == 0
