"""Operators on documents against brute force, over a small fixture with nulls, ties, repeated rows and clashing columns."""

import hashlib
import json
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from skewlake.llm import decontaminate, langid, ngram_join, packing, substring_dedup, token_count, token_file
from skewlake.llm.tokens import Encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, block string, part string, node long, rest string, `a.b` string"
BASE = " ".join(f"w{i % 37}x{i % 11}" for i in range(400))
TEXTS = [
    BASE, BASE, BASE.upper(), BASE.replace("w5x5", "zz", 3), None, "", "  \n\t ", "one", "one two", "One TWO", "a b c",
    "a b c " * 30, "lorem " * 5000, "tail " + " ".join(BASE.split()[100:130]) + " end", "\x1c  x<|endoftext|>y  z\n\n q", "é ÉÉ ñandú 東京 🎉",
    "x" * 9000 + " y", "<|startoftext|> it's we'll 12345 !!! ...",
]
ROWS = [(i, t, "en" if i % 2 else None, "b", "p", 7, "r", "d") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "en", "b", "p", 7, "r", "d"), (None, BASE, "en", "b", "p", 7, None, "d"), (None,) * 8]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words(t):
    return WORD.findall(t or "")


def brute_dedup(docs, window):
    first, out = {}, []
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - window + 1 if d is not None else 0):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    for d, t in docs:
        w = words(t)
        gone = {j for i in range(len(w) - window + 1) if d is not None and first[tuple(w[i : i + window])] < d for j in range(i, i + window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [600, 6 << 20])
def test_substring_dedup(docs, block):
    from pyspark.sql import functions as F

    got = substring_dedup.dedup_substrings(docs, block_bytes=block).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256))
    assert rows(got) == brute_dedup([r[:2] for r in ROWS], 13)


def test_substring_factors_and_carried_columns(docs, empty):
    for r in substring_dedup.dedup_substrings(docs, block_bytes=600).collect():
        covered = {i for f in r["factors"] for i in range(f["start"], f["start"] + f["length"])}
        assert len(covered) == r["n_removed"] and all(f["length"] >= 13 for f in r["factors"])
    kept = substring_dedup.dedup_substrings(docs, carry=True)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(r[0] for r in ROWS if r[0] is not None)
    assert substring_dedup.dedup_substrings(empty).count() == 0 and substring_dedup.dedup_substrings(empty, carry=True).count() == 0


def brute_groups(docs, size, percent):
    def shingles(t):
        w = re.findall(WORD, (t or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}

    sets = [(d, shingles(t)) for d, t in docs]
    low = [d for d, _ in sets]
    changed = True
    while changed:
        changed = False
        for i, (a, x) in enumerate(sets):
            for j, (b, y) in enumerate(sets):
                if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y) and low[j] < low[i]:
                    low[i], changed = low[j], True
    return sorted(((d, len(s), c) for (d, s), c in zip(sets, low, strict=True)), key=repr)


@pytest.mark.parametrize(("block", "most"), [(6 << 20, 1500), (600, 2)])
def test_ngram_groups(spark, block, most):
    rng = np.random.default_rng(3)
    base = [f"t{i}" for i in rng.integers(0, 500, 120)]
    near = []
    for i in range(40):
        w = list(base)
        for j in rng.integers(0, 120, i % 4):
            w[j] = f"n{rng.integers(0, 50)}"
        near.append((100 + i, " ".join(w)))
    docs = [r[:2] for r in ROWS] + near
    got = ngram_join.ngram_groups(spark.createDataFrame(docs, "doc_id long, text string"), block_bytes=block, most=most)
    assert rows(got) == brute_groups(docs, 3, 90)


def test_ngram_parts_of_every_order(spark, monkeypatch):
    """Parts split by the other orders give the same groups."""
    monkeypatch.setattr(ngram_join, "PARTED", 1)
    rng = np.random.default_rng(8)
    base = [f"t{i}" for i in rng.integers(0, 500, 90)]
    near = []
    for i in range(30):
        w = list(base)
        for j in rng.integers(0, 90, i % 5):
            w[j] = f"n{rng.integers(0, 50)}"
        near.append((100 + i, " ".join(w)))
    got = ngram_join.ngram_groups(spark.createDataFrame(near, "doc_id long, text string"), most=3)
    assert rows(got) == brute_groups(near, 3, 90)


def test_ngram_groups_keep_one(docs, empty):
    kept = ngram_join.keep_one(docs, size=5, percent=80)
    assert kept.schema == docs.schema
    want = {d for d, _, c in brute_groups([r[:2] for r in ROWS], 5, 80) if d == c}
    assert sorted(x for x in (r["doc_id"] for r in kept.collect()) if x is not None) == sorted(want - {None})
    assert ngram_join.ngram_groups(empty).count() == 0


def test_encoder_equals_library():
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        e, plain = Encoder(P.path(name)), Tokenizer.from_file(P.path(name))
        texts = [t or "" for t in TEXTS] + ["á b", " ́x", "a b  c", "a \t b", "it 's", "\n a", "b\x0b\x0cc", "x\x85y \xa0z", "İI ΣΑΣ ς"]
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]


def test_letters():
    assert not any(map(langid.has_letter, [None, "", "²³ ½", "①Ⅷ", "12_3", "!?"]))
    assert all(map(langid.has_letter, ["² x", "é", "東", "1a"]))


def test_token_count(docs, empty):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    n = [len(tok.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in ROWS]
    want = sorted(((d, len((t or "").encode()), k, k > 2048) for (d, t, *_), k in zip(ROWS, n, strict=True)), key=repr)
    assert rows(token_count.op2_token_count(docs)) == want
    assert rows(token_count.count_tokens(docs, P.path("word_bpe_49k.json"), slice_bytes=64)) == want
    assert token_count.op2_token_count(empty).count() == 0


def test_token_file(docs, empty, spark, tmp_path):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    at, want = 0, []
    for d, t in sorted((r[:2] for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert rows(token_file.op9_token_file(docs)) == sorted(want, key=repr)
    token_file.write_tokens(docs, str(tmp_path / "t"), P.path("word_bpe_49k.json"), part_bytes=2000)
    back = token_file.read_tokens(spark, str(tmp_path / "t"))
    assert rows(token_file.describe_tokens(back)) == sorted(want, key=repr)
    plan = back.select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert all("ids" not in part.split("\n")[0] for part in plan.split("ReadSchema")[1:])
    assert token_file.op9_token_file(empty).count() == 0


def test_token_file_layout(docs, tmp_path):
    """Encodings, row groups and page indexes of the written files."""
    import glob

    import pyarrow.parquet as pq

    token_file.write_tokens(docs, str(tmp_path / "t"), P.path("word_bpe_49k.json"))
    seen = 0
    for f in glob.glob(str(tmp_path / "t" / "*.parquet")):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            assert group.total_byte_size <= 32 << 20
            for c in range(group.num_columns):
                column = group.column(c)
                assert column.has_offset_index and column.has_column_index
                assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(column.encodings)
                seen += 1
    assert seen


def test_packing_repeated_rows(docs):
    """Each row's pieces lie gapless in sequences of at most 1024, with nulls and repeated rows, and with little padding."""
    got = packing.op7_packing(docs).collect()
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = sorted((d, len(tok.encode(t or "", add_special_tokens=False).ids) + 1) for d, t, *_ in ROWS if d is not None)
    assert sorted((r["doc_id"], r["doc_tokens"]) for r in got if r["doc_id"] is not None and r["start"] == 0) == want
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(held) == list(range(len(held)))
    for spans in held.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False)) and sum(n for _, n in spans) <= 1024


def test_packing_padding(spark, data):
    got = packing.op7_packing(spark.read.parquet(f"{data}/documents.parquet")).selectExpr("sum(length) AS n", "max(sequence_id) + 1 AS s").first()
    assert got["n"] > 0.97 * 1024 * got["s"]


def test_packing(docs, empty):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = packing.pack(docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), P.path("byte_bpe_50k.json"), 64).collect()
    for d, t, *_ in ROWS[: len(TEXTS)]:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        mine, at = sorted((r for r in got if r["doc_id"] == d), key=lambda r: r["start"]), 0
        for r in mine:
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(held) == list(range(len(held)))
    for spans in held.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end += n
        assert end <= 64
    assert packing.op7_packing(docs).count() == packing.cut_pieces(docs, P.path("byte_bpe_50k.json"), 1024, 0).count()
    assert packing.op7_packing(empty).count() == 0


def test_shortest_pack_first():
    rng = np.random.default_rng(0)
    hist = {int(k): int(n) for k, n in zip(*np.unique(rng.integers(1, 1025, 5000), return_counts=True), strict=True)}
    packs = packing.shortest_pack_first(hist, 1024)
    placed = {}
    for p, n in packs:
        assert sum(p) <= 1024 and n > 0
        for x in p:
            placed[x] = placed.get(x, 0) + n
    assert placed == hist
    assert sum(k * n for k, n in hist.items()) > 0.97 * 1024 * sum(n for _, n in packs)
    assert packing.shortest_pack_first({300: 10}, 1024) == [((300, 300, 300), 2), ((300, 300), 2)]


def test_language_id_held_out(spark, data, docs, empty):
    d = spark.read.parquet(f"{data}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in d.collect()}
    got = langid.op10_language_id(d).collect()
    out = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    net = langid.train(docs)
    mine = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(docs, net).collect()}
    assert {(4, "und"), (5, "und"), (6, "und"), (0, "en")} <= mine
    assert langid.op10_language_id(empty).count() == 0 and langid.train(empty) is None
    assert langid.keep_known(docs).schema == docs.schema


def test_language_without_blanks(spark):
    """Languages written without blanks, with a Latin name now and then, beside languages with blanks."""
    rng = np.random.default_rng(23)
    run = lambda lo, hi: "".join(map(chr, rng.integers(lo, hi, 60)))
    plain = lambda: " ".join("".join(rng.choice(list("abcdefghiklmnoprstu"), 5)) for _ in range(30))
    docs = []
    for _ in range(60):
        docs += [("en", plain()), ("zh", f"{run(0x4E00, 0x5000)} Tom 24 {run(0x4E00, 0x5000)}"), ("ja", run(0x3041, 0x3090)), ("th", run(0xE01, 0xE2F))]
    d = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(docs)], "doc_id long, text string, lang string")
    net = langid.train(d)
    assert net.labels == ["en", "ja", "th", "zh"]
    got = [(r["lang_pred"], docs[r["doc_id"]][0]) for r in langid.identify(d, net).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert {k for _, k in got} == {"en", "ja", "th", "zh"} and np.mean([a == b for a, b in got]) > 0.95


def test_every_label_is_learned(spark):
    """70 labels, each of eight letters of its own."""
    rng = np.random.default_rng(29)
    docs = [(k, " ".join("".join(chr(0x4E00 + 8 * k + x) for x in rng.integers(0, 8, 5)) for _ in range(20))) for k in range(70) for _ in range(12)]
    d = spark.createDataFrame([(i, t, f"l{k:02}") for i, (k, t) in enumerate(docs)], "doc_id long, text string, lang string")
    net = langid.train(d)
    assert len(net.labels) == 70
    got = [(r["lang_pred"], f"l{docs[r['doc_id']][0]:02}") for r in langid.identify(d, net).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert np.mean([a == b for a, b in got]) > 0.75
    assert np.mean([a == b for a, b in got if b > "l63"]) > 0.5


def test_labels_held_out_change_nothing(spark, data):
    """Other labels on held-out documents, and other sources and ids of equal remainder, leave the network as it is."""
    from pyspark.sql import functions as F

    d = spark.read.parquet(f"{data}/documents.parquet")
    other = d.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = langid.train(d, 3), langid.train(other, 3)
    assert a.labels == b.labels and all((a.p[k] == b.p[k]).all() for k in a.p)


def test_pieces_ties_and_repeated_rows(spark):
    """A text in one piece is read as training reads it; longer ones count every byte; the first of equal labels wins."""
    import pyarrow as pa

    rng, net = np.random.default_rng(1), langid.Network(["a", "b", "c"])
    text = "".join(rng.choice(list("abc dé"), 90))
    raw = np.frombuffer(text.encode(), np.uint8)[None, :]
    f, _ = net._layer("f", raw.astype(int))
    b, _ = net._layer("b", raw[:, ::-1].astype(int))
    score = f @ net.p["v"][: net.hidden] + b[::-1] @ net.p["v"][net.hidden :] + net.p["c"]
    p = np.exp(score) / np.exp(score).sum(-1, keepdims=True)
    total, count = net.documents(pa.array([text, "", None, text * 9, text]))
    assert count.tolist() == [raw.size, 0, 0, 9 * raw.size, raw.size] and np.allclose(total.sum(1), count, rtol=1e-4)
    assert np.allclose(total[0], p.sum((0, 1)), rtol=1e-4) and np.allclose(total[4], total[0])
    net.p["v"][:] = 0
    rows = [(1, "abc", "a"), (1, "abc", "a"), (2, "123", None)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), net).collect()
    assert sorted(tuple(r)[:2] for r in got) == [(1, "a"), (1, "a"), (2, "und")]


def test_network_gradients():
    rng, net = np.random.default_rng(0), langid.Network(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    codes, label = rng.integers(97, 110, (5, 6)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    _, g = net.gradients(codes, label)
    for k, at in (("xf", (99, 3)), ("xb", (101, 40)), ("uf", (2, 20)), ("ub", (5, 37)), ("v", (3, 1)), ("c", (2,))):
        old = net.p[k][at]
        net.p[k][at] = old + 1e-4
        up, _ = net.gradients(codes, label)
        net.p[k][at] = old - 1e-4
        down, _ = net.gradients(codes, label)
        net.p[k][at] = old
        assert abs((up - down) / 2e-4 - g[k][at]) < 1e-4


def brute_leaks(docs, items, size, percent):
    from collections import Counter

    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for d, t in docs:
        w = split(t)
        for i, b in items:
            v = split(b)
            if len(v) < size or len(w) < size or d is None or i is None:
                continue
            want = Counter(tuple(v[k : k + size]) for k in range(len(v) - size + 1))
            for s in range(-len(v), len(w)):
                x = w[max(s, 0) : max(s + len(v), 0)]
                have = Counter(tuple(x[k : k + size]) for k in range(len(x) - size + 1))
                same, total = sum((have & want).values()), sum((have | want).values())
                if 100 * same >= percent * total:
                    out[d, i] = max(out.get((d, i), 0), same / total)
    return out


def test_find_leaks(spark, empty):
    rng = np.random.default_rng(5)
    item = [" ".join(f"q{x}" for x in rng.integers(0, 900, n)) for n in (14, 30, 60, 60)]
    noise = lambda n: " ".join(f"z{x}" for x in rng.integers(0, 900, n))
    w = item[2].split()
    docs = [
        (0, noise(30) + " " + item[0] + " " + noise(20)), (1, item[1].upper().replace(" ", ", ")), (2, noise(10) + " " + " ".join([*w[:30], "new", *w[31:]]) + " " + noise(5)),
        (3, noise(100)), (4, None), (5, ""), (6, " ".join(w[:20])), (7, " ".join(w[3:])), (8, item[0] + " " + item[1]), (9, "q1 q2"), (None, item[0]), (10, " ".join([*w[:30], *w[31:]])), (0, noise(9)),
    ]
    items = [*enumerate(item), (9, None), (8, "q1 q2"), (None, item[1]), (2, item[2])]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS h", "1 AS n")
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS w", "1 AS at")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.find_leaks(d, bench).collect()}
    assert got == pytest.approx(brute_leaks(docs, items, 5, 80))
    assert {(0, 0), (1, 1), (2, 2), (7, 2), (8, 0), (8, 1)} <= set(got)
    kept = decontaminate.decontaminate(d, bench)
    assert kept.schema == d.schema and {r["doc_id"] for r in kept.collect()} == {3, 4, 5, 6, 9, None}
    assert decontaminate.find_leaks(empty, bench).count() == 0 and decontaminate.find_leaks(d, bench.limit(0)).count() == 0


def test_find_leaks_far_fingerprints(spark):
    """Items cut off or with other words at their edges, similar enough: all are found, however far their fingerprints are."""
    rng = np.random.default_rng(17)
    items, docs, want = [], [], {}
    for i in range(150):
        n = int(rng.integers(9, 41))
        w = [f"i{i}w{x}" for x in rng.integers(0, 900, n)]
        items.append((i, " ".join(w)))
        for c in range(1, 9):
            other = [f"o{len(docs)}x{k}" for k in range(c)]
            for x in (w[c:], w[: n - c], other + w[c:], w[: n - c] + other):
                same = len([1 for a in range(max(0, len(x) - 4)) if x[a : a + 5] in [w[b : b + 5] for b in range(n - 4)]])
                total = n - 4 + max(0, len(x) - 4) - same
                if 100 * same >= 80 * total:
                    # a window cut off at the document's end may be nearer than the one that lies on the item
                    want[len(docs), i] = brute_leaks([(0, " ".join(x))], [(0, " ".join(w))], 5, 80)[0, 0]
                    docs.append((len(docs), " ".join(x)))
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in got.collect()} == pytest.approx(want)


def test_find_leaks_all_windows(spark):
    """Windows that lie on no diagonal of a shared shingle, ties, repeated shingles and a long item."""
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    noise = lambda k, n: [f"z{k}x{i}" for i in range(n)]
    long = [f"l{i}" for i in range(4_000)]
    docs = [(1, noise(1, 10) + b + a + noise(2, 10)), (2, noise(3, 7) + a + b + noise(4, 9) + a + b), (3, "so it goes".split() * 20), (4, long), (5, noise(5, 1_500) + long[:3_600] + noise(6, 5_000)), (6, noise(7, 5_000) + a + b)]
    items = [(1, a + b), (2, "so it goes".split() * 20), (3, long)]
    frame = lambda rows, name: spark.createDataFrame([(i, " ".join(w)) for i, w in rows], f"{name} long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["first_word"], r["n_words"], r["similarity"]) for r in decontaminate.find_leaks(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    assert got == {(1, 1): (10, 60, 52 / 60), (2, 1): (7, 60, 1.0), (3, 2): (0, 60, 1.0), (4, 3): (0, 4_000, 1.0), (5, 3): (1_100, 4_000, 3596 / 4396), (6, 1): (5_000, 60, 1.0)}


def structured(n, a="a", b="b"):
    return "".join(a if i.bit_count() % 2 == 0 else b for i in range(n))


@pytest.mark.parametrize("size", [1024, 4096, 60])
def test_structured_words_stay_apart(spark, size):
    """Words on which polynomial hashes collide."""
    a, b = structured(size), structured(size, "b", "a")
    docs = [(1, " ".join([a] * 13)), (2, " ".join([b] * 13))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = substring_dedup.op4_substring_dedup(d)
    assert rows(got.select("doc_id", "n_words", "n_removed")) == [(1, 13, 0), (2, 13, 0)]
    assert rows(ngram_join.ngram_groups(d)) == [(1, 1, 1), (2, 1, 2)]
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    assert [r["n_tokens"] for r in token_count.op2_token_count(d).orderBy("doc_id").collect()] == [len(tok.encode(t, add_special_tokens=False).ids) for _, t in docs]


def test_one_id_on_two_texts(spark):
    base = [f"t{i}" for i in range(60)]
    other = [f"u{i}" for i in range(60)]
    docs = [(5, " ".join(base)), (5, " ".join(other)), (7, " ".join([*base[:59], "x"])), (9, " ".join([*other[:59], "x"])), (3, " ".join([*base[:58], "y", "x"]))]
    got = rows(ngram_join.ngram_groups(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == sorted([(5, 58, 3), (5, 58, 5), (7, 58, 3), (9, 58, 5), (3, 58, 3)], key=repr)


def test_greedy_factors():
    f = lambda first, block, place: substring_dedup.greedy_factors(np.array(first), np.array(block), np.array(place), np.zeros(len(first), int), 3)
    assert f([], [], []) == []
    assert f([0, 1, 5], [2, 2, 2], [4, 5, 6]) == [(0, 4, 2, False), (5, 8, 2, False)]
    # a window of another block inside the first factor straddles its end; the next factor begins at the first free word
    assert f([0, 1, 2, 3, 4, 5], [0, 0, 1, 1, 1, 1], [7, 8, 2, 3, 4, 5]) == [(0, 4, 0, False), (2, 6, 1, True), (4, 8, 1, False)]
    assert f([0, 1], [0, 1], [0, 1]) == [(0, 3, 0, False), (1, 4, 1, True)]
    # two windows of one block at other places are no longer factor
    assert f([0, 1], [0, 0], [3, 9]) == [(0, 3, 0, False), (1, 4, 0, True)]


def test_factors_are_strings_of_their_blocks(spark):
    import random

    w = [f"w{i}" for i in range(14)]
    d = [(1, " ".join([*w[:13], "X"])), (2, " ".join(["Y", *w[1:]])), (3, " ".join(w))]
    d = spark.createDataFrame(d, "doc_id long, text string")
    got = {r["doc_id"]: [tuple(f) for f in r["factors"]] for r in substring_dedup.dedup_substrings(d).collect()}
    assert got == {1: [], 2: [], 3: [(0, 13, 0, False), (1, 13, 0, True)]}

    rng = random.Random(5)
    pool = [f"v{i}" for i in range(300)]
    texts = []
    for i in range(120):
        t = [rng.choice(pool) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3) if texts else 0):
            s = rng.choice(texts)
            a = rng.randrange(len(s) + 1)
            t[rng.randrange(len(t) + 1) : 0] = s[a : a + rng.randrange(50)]
        texts.append(t)
    data = [(i * i, " ".join(t)) for i, t in enumerate(texts)]
    d = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    for size in (1500, 1 << 20):
        block = {r["doc_id"]: r["block"] for r in substring_dedup._blocks(d, size)[0].collect()}
        held = {}
        for i, t in data:
            held.setdefault(block[i], []).append((i, f" {t} "))
        n = 0
        for r in substring_dedup.dedup_substrings(d, block_bytes=size).collect():
            t = dict(data)[r["doc_id"]].split()
            for f in r["factors"]:
                if not f["boundary"]:
                    part = " ".join(t[f["start"] : f["start"] + f["length"]])
                    assert any(i < r["doc_id"] and f" {part} " in x for i, x in held[f["block"]])
                    n += f["length"] > 13
        assert n > 20
        assert rows(substring_dedup.op4_substring_dedup(d)) == brute_dedup(data, 13)


def test_blocks_of_clustered_ids(spark, monkeypatch):
    """Where there are more blocks than quantiles, each range is cut by its own quantiles, so clusters of ids don't fill a block."""
    monkeypatch.setattr(substring_dedup, "QUANTILES", 8)
    d = spark.createDataFrame([(c * 10**9 + i, "t" * 10) for c in range(20) for i in range(100)], "doc_id long, text string").repartition(3)
    df, n = substring_dedup._blocks(d, 20_000 // 50)
    sizes = sorted(r["count"] for r in df.groupBy("block").count().collect())
    assert n >= 50 and len(sizes) >= 40 and sizes[-1] <= 3 * 2000 // 50
    got = {r["doc_id"]: r["block"] for r in df.collect()}
    assert [got[i] for i in sorted(got)] == sorted(got.values())


def test_sql_twins(spark, data, same):
    from skewlake.llm import registry

    q, sql = registry.queries(), registry.oracle_sql()
    assert set(sql) <= set(q) and all(re.match(rf"op{n}_", next(k for k in q if k.startswith(f"op{n}_"))) for n in range(1, 11))
    for name in sorted(sql):
        same(q[name](spark, data), sql[name])


def test_pipeline(spark, data):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{data}/documents.parquet")
    junk = spark.createDataFrame([(10_001, "!!! 123 ...", "en", "s", 11), (10_002, None, None, None, None)], docs.schema)
    docs = docs.unionByName(junk)
    kept = C.identify_language(spark, docs, data)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    assert ids(docs) == sorted([*ids(kept), 10_001, 10_002])
    one = C.join_ngrams(spark, kept, data)
    pairs = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert ids(one) == [d for d, _, c in sorted(brute_groups(pairs, 5, 80)) if d == c]
    cut = C.dedup_substrings(spark, one, data)
    assert cut.columns == docs.columns
    removed = {d: n for d, _, n, _ in brute_dedup([(r["doc_id"], r["text"]) for r in one.collect()], 13)}
    old, new = ({r["doc_id"]: r["text"] for r in df.collect()} for df in (one, cut))
    assert all(len(words(old[d])) - len(words(new[d])) == n and (n or old[d] == new[d]) for d, n in removed.items())
    clean = C.remove_benchmark(spark, cut, data)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    leaks = {d for d, i in ((d, i) for d in new for i, b in items if " ".join(re.findall(r"[^\W_]+", b.lower())) in " ".join(re.findall(r"[^\W_]+", (new[d] or "").lower())))}
    assert leaks <= set(new) - set(ids(clean)) and json.dumps(sorted(leaks))
    assert set(r["doc_id"] for r in C.pack_sequences(spark, clean, data).collect()) == set(ids(clean))
    assert C.run(spark, data).count() > 0


def test_components(spark):
    """Chains, stars, random links and no links against a plain search."""
    from skewlake.llm.components import components

    rng = np.random.default_rng(4)
    links = [(i, i + 1) for i in range(1_000, 1_090)] + [(5_000, x) for x in range(4_000, 4_040)] + [tuple(x) for x in rng.integers(0, 400, (150, 2)).tolist()] + [(7, 7)]
    low = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    want = {n: p for n, p in low.items() if any(n in link for link in links if link[0] != link[1])}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len(want) and {r["node"]: r["part"] for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
