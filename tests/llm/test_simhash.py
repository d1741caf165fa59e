"""SimHash groups against brute force."""

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from skewlake.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, fingerprint string, component_id string, `a.b` string, n long"
BASE = " ".join(f"w{i % 37}x{i % 11}" for i in range(200))
TEXTS = [BASE, BASE, BASE.upper(), BASE.replace("w5x5", "zz", 2), None, "", " \n\t ", "one", "one two", "One TWO", "a b c", "a b c " * 30, "é ÉÉ ñandú 東京 🎉 \x1c x", "x" * 9000 + " y z", "p" * 40 + " " + "q" * 300 + " r s"]


def brute_print(t):
    w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_groups(prints):
    ids = [d for d, _ in prints]
    low, changed = list(ids), True
    while changed:
        changed = False
        for i, (a, x) in enumerate(prints):
            for j, (b, y) in enumerate(prints):
                if a is not None and b is not None and (x ^ y).bit_count() <= 2 and low[j] < low[i]:
                    low[i], changed = low[j], True
    return low


def test_xxh64():
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.integers(0, 256, 3000, dtype=np.uint8), np.zeros(8, np.uint8)])
    end = np.concatenate([np.arange(0, 400), np.arange(300, 3000, 7)])
    begin = np.concatenate([np.zeros(400, np.int64), np.arange(300, 3000, 7) - rng.integers(0, 300, len(end) - 400)])
    got = simhash.xxh64(data, begin, end)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a:b].tobytes(), 42) for a, b in zip(begin, end, strict=True)]


def test_fingerprints():
    got = simhash.fingerprints(pa.array(TEXTS, pa.string()))
    assert got.tolist() == [brute_print(t) for t in TEXTS]
    assert len(simhash.fingerprints(pa.array([], pa.string()))) == 0


@pytest.mark.parametrize("summands", [1, 2, 3, 4])
def test_every_link_meets_at_home(summands):
    """Each fingerprint has one home, and all that links with it comes there."""
    rng = np.random.default_rng(summands)
    x = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    y = np.concatenate([x ^ np.uint64(1 << int(a) | 1 << int(b)) for a, b in rng.integers(0, 64, (20, 2))])
    row, anchor, home = simhash.anchors(x, summands)
    assert sorted(row[home].tolist()) == list(range(30))
    at = dict(zip(row[home].tolist(), anchor[home].tolist(), strict=True))
    row, anchor, _ = simhash.anchors(y, summands)
    came = set(zip(row.tolist(), anchor.tolist(), strict=True))
    assert all((j, at[j % 30]) in came for j in range(len(y)))


@pytest.mark.parametrize("options", [{}, {"summands": 2}, {"most": 3}, {"most": 3, "summands": 3, "pack_rows": 50}])
def test_groups(spark, options):
    rng = np.random.default_rng(5)
    near = [(100 + i, " ".join(f"t{j}" if rng.random() > 0.01 else f"n{rng.integers(9)}" for j in range(150))) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (4, "another text here"), (None, BASE), (None, None)] + near
    docs = spark.createDataFrame([(d, t, "en", "f", "c", "x", 1) for d, t in rows], SCHEMA).repartition(3)
    prints = [(d, brute_print(t)) for d, t in rows]
    want = sorted(((d, f"{p:016x}", c) for (d, p), c in zip(prints, brute_groups(prints), strict=True)), key=repr)
    got = simhash.simhash_groups(docs, **options).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_dense_ball(spark):
    """Many fingerprints within a few bits of one another, by pairs and by shared words."""
    x = np.unique(np.array([sum(1 << k for k in np.random.default_rng(i).integers(0, 16, 4).tolist()) for i in range(3000)], np.uint64))
    for home in (np.ones(len(x), bool), np.arange(len(x)) < 40):
        i, j = simhash._near(x, home)
        assert (np.bitwise_count(x[i] ^ x[j]) <= 2).all()
    i, j = simhash._near(x, np.ones(len(x), bool))
    up = list(range(len(x)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        up[max(find(a), find(b))] = min(find(a), find(b))
    want = [p for p in np.argwhere(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2).tolist()]
    assert all(find(a) == find(b) for a, b in want)


def test_empty(spark):
    assert simhash.simhash_groups(spark.createDataFrame([], SCHEMA)).count() == 0
