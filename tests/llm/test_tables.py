"""Operators on conversations, embeddings and pages against brute force, with edge cases."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from skewlake.llm import knn, tool_calls, warc
from skewlake.llm.components import components

MESSAGES = "conv_id long, turn long, role string, text string, id string, depth int"
TOOLS = [("search", "query", "string", True), ("search", "limit", "integer", False), ("scale", "by", "number", True)]


def call(ident, name, arguments, after=None):
    return {"id": ident, "name": name, "arguments": arguments} | ({"after": after} if after else {})


def said(*calls):
    return json.dumps({"tool_calls": calls})


def test_tool_calls(spark):
    rows = [
        (1, 0, "assistant", said(call("a", "search", {"query": "x é\n", "limit": 3}), call("b", "search", {"limit": "3"}))),
        (1, 1, "tool", json.dumps({"tool_call_id": "a", "content": "late"})), (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "later"})),
        (1, 3, "assistant", said(call("c", "scale", {"by": 2, "zz": [1]}, ["a", "b"]), call("d", "scale", {"by": 2.5}, ["c"]))),
        (1, 4, "assistant", said(call("e", "scale", {"by": True}, ["c", "nope"]))), (2, 0, "assistant", said(call("a", "guess", {}))),
        (2, 1, "assistant", "plain text"), (2, 2, None, None), (None, 0, "assistant", said(call("a", "search", {"query": "q"}))), (3, 0, "assistant", ""),
        (3, 1, "assistant", json.dumps({"tool_calls": [{"name": "search"}, {"id": "f", "name": "scale", "arguments": "[1]"}]})), (2, 0, "assistant", said(call("a", "guess", {}))),
    ]
    messages = spark.createDataFrame([(*r, "x", 1) for r in rows], MESSAGES)
    tools = spark.createDataFrame(TOOLS, "name string, parameter string, kind string, required boolean")
    got = tool_calls.link_tool_calls(messages, tools).collect()
    by = {(r["conv_id"], r["call_id"]): r for r in got}
    assert len(got) == 9 and len(by) == 8
    assert {k: (r["depth"], r["result_turn"], r["problems"]) for k, r in by.items()} == {
        (1, "a"): (0, 1, ""), (1, "b"): (0, None, "limit is no integer; missing query"), (1, "c"): (1, None, "unexpected zz"),
        (1, "d"): (0, None, "not after c"), (1, "e"): (2, None, "by is no number; not after nope"), (2, "a"): (0, None, "unknown tool"),
        (None, "a"): (0, None, ""), (3, "f"): (0, None, "arguments are no object"),
    }
    assert by[1, "a"]["canonical"] == '{"arguments":{"limit":3,"query":"x é\\n"},"id":"a","name":"search","result":"late"}'
    assert all(r["valid"] == (not r["problems"]) for r in got)
    assert tool_calls.link_tool_calls(messages.limit(0), tools).count() == 0


def test_native_operators_run_no_python(spark, data):
    from skewlake.llm import decontaminate

    table = lambda n: spark.read.parquet(f"{data}/{n}.parquet")
    for df in (tool_calls.op3_tool_calls(table("conversations")), decontaminate.op1_decontamination(table("documents"), table("benchmark"))):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def brute_top(rows, k, every):
    """Each row is a candidate for all others, also for those of its own vec_id."""
    out = []
    q = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for a, (i, x) in enumerate(q):
        if i % every == 0:
            found = sorted((-sum(s * t for s, t in zip(x, y, strict=True)), j) for b, (j, y) in enumerate(q) if a != b and len(x) == len(y))[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("shape", ["clusters", "equal", "few", "large"])
def test_knn_join(spark, monkeypatch, shape):
    monkeypatch.setattr(knn, "DATA_ROWS", 50)
    monkeypatch.setattr(knn, "QUERY_ROWS", 4)
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 2, (5, 8))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.05, 8)).astype(np.float32).tolist()) for i in range(200)]
    if shape == "equal":
        rows = [(i, [0.5] * 8 if i % 3 else v) for i, v in rows]
    if shape == "few":
        rows = rows[:7] + [(20, [1.0, 2.0]), (21, [1.0, 3.0]), (40, []), (41, [])]
    if shape == "large":
        rows = [(i, [x * 1e7 for x in v]) for i, v in rows[:60]]
    rows += [(1000, None), (1001, [float("nan")] * 8), (1002, [None] * 8), (1003, [float("inf")] * 8), (None, [1.0] * 8), (0, rows[0][1]), (20, rows[1][1])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, rank int, cell string")
    got = knn.knn_join(df, F.col("vec_id") % 20 == 0, k=5, pivots=6)
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, 20)
    assert knn.op5_exact_topk(df.limit(0)).count() == 0


def test_knn_join_with_repeated_ids(spark, same):
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.0]), (1, [0.1, 0.5]), (2, [0.5, 0.5])]
    got = knn.op5_exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 64 * 57), (0, 2, 2, 64 * 32), (0, 3, 1, 64 * 6)]


def test_warc_round_trip(spark, tmp_path):
    big = "<p>é WARC/1.1\r\n\r\n</p>" * 20
    rows = [(1, "http://www.B.com/x?q=1#f", big), (2, "http://a.com", big), (3, None, "small"), (4, "http://a.com", "small"), (5, "x\r\ny", None), (6, "", ""), (None, "http://n.org", big), (0, "http://a.com", big + "!"), (7, "http://a.com", big), (1, "http://www.B.com/x?q=1#f", big), (8, "http://[", "z" * 300)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, turn int")
    path = str(tmp_path / "w")
    index = warc.round_trip(pages, path).collect()
    assert len(index) == len(rows)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in index), key=repr)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        low = min((j for j, _, x in rows if x == h and j is not None), default=None)
        again = len(raw) >= 100 and low is not None and i != low
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", low if again else None))
    assert got == sorted(want, key=repr)
    order = [(r["url_key"], r["captured"], -1 if r["page_id"] is None else r["page_id"]) for r in warc.merge_runs(warc.read_runs(spark, path)).collect()]
    assert order == sorted(order)
    assert warc.url_key("http://www.B.com/x?q=1#f") == "com,b)/x?q=1"
    import gzip

    whole = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "w").glob("part*")))
    assert len(list(warc.records(whole))) == len(rows)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_loser_tree():
    rng = np.random.default_rng(0)
    for k in (0, 1, 2, 3, 7, 16):
        lists = [sorted(rng.integers(0, 20, rng.integers(0, 12)).tolist()) for _ in range(k)]
        merged = [lists[w][i] for w, i in warc.LoserTree(lists)]
        assert merged == sorted(x for x in lists for x in x)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 30)] + [(100, 101), (102, 101), (200, 200)]
    got = {r["node"]: r["part"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_conversations_are_gathered_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(tool_calls, "GATHERED", 4)
    rows = [(1, t, "assistant", said(call(f"c{t}", "scale", {"by": t}, [f"c{t - 1}", "c0"] if t else None)), "x", 1) for t in range(11)]
    rows += [(2, 0, "assistant", said(call("r", "scale", {"by": 1})), "x", 1), (2, 1, "assistant", said(call("s", "scale", {"by": 1}, ["r"])), "x", 1), (2, 2, "assistant", said(call("r", "scale", {"by": 1}, ["s"])), "x", 1)]
    tools = spark.createDataFrame(TOOLS, "name string, parameter string, kind string, required boolean")
    got = {(r["conv_id"], r["turn"]): r["depth"] for r in tool_calls.link_tool_calls(spark.createDataFrame(rows, MESSAGES), tools).collect()}
    assert got == {**{(1, t): t for t in range(11)}, (2, 0): 0, (2, 1): 1, (2, 2): 0}
