"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Words, bucket_edges, pack_sorted, pack_u32, unpack_sorted, unpack_u32

NULL_ID = np.iinfo(np.int64).min
QUANTILES = 512
OUT = "doc_id long, n_words long, n_removed long, kept string, factors array<struct<start:long,length:long,block:long,boundary:boolean>>"
FACTOR = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("block", pa.int64()), ("boundary", pa.bool_())]))


def _cuts(docs: DataFrame, n: int, q: list[int]) -> list[int]:
    """Edges of about n ranges of doc_id with equally many rows: QUANTILES of them, each cut again by its own quantiles where n is larger."""
    edges = sorted(set(q[:: max(1, QUANTILES // n)]) | {q[-1]})
    per = min(QUANTILES, -(-n // max(1, len(edges) - 1)))
    if n <= QUANTILES or per < 2 or len(edges) < 3:
        return edges
    inner = np.array(edges[1:-1], np.int64)

    @F.pandas_udf("int")
    def coarse(ids):
        return ids.__class__(np.searchsorted(inner, ids.to_numpy(), side="right").astype(np.int32))

    finer = docs.filter("doc_id IS NOT NULL").groupBy(coarse("doc_id")).agg(F.percentile_approx("doc_id", F.array(*[F.lit(i / per) for i in range(1, per)]), F.lit(20_000)).alias("q"))
    return sorted(set(edges).union(*(r["q"] for r in finer.select("q").collect())))


def _blocks(docs: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Give each document the number of its reference block: blocks are ranges of doc_id of about block_bytes.

    The driver holds at most QUANTILES squared edges, by two levels of quantiles; where there are more blocks, ids are cut evenly
    between two edges. Rows without an id copy nothing and are copied by none, so they may lie in any block and are dealt by their texts.
    """
    row = docs.agg(
        F.sum(F.octet_length("text")).alias("b"),
        F.percentile_approx("doc_id", F.array(*[F.lit(i / QUANTILES) for i in range(QUANTILES + 1)]), F.lit(20_000)).alias("q"),
    ).first()
    n = max(1, -(-(row["b"] or 0) // block_bytes))
    if n == 1 or not row["q"]:
        return docs.withColumn("block", F.lit(0).cast("long")), 1
    edges = np.array(_cuts(docs, n, row["q"]), np.int64)
    if len(edges) == 1:
        return docs.withColumn("block", F.lit(0).cast("long")), 1
    per = max(1, -(-n // (len(edges) - 1)))

    @F.pandas_udf("long")
    def block(ids):
        x = ids.fillna(int(edges[0])).to_numpy().astype(np.int64)
        k = np.clip(np.searchsorted(edges, x, side="right") - 1, 0, len(edges) - 2)
        a, b = edges[k].astype(np.float64), edges[k + 1].astype(np.float64)
        return ids.__class__(k * per + np.clip((x - a) * per // np.maximum(b - a, 1), 0, per - 1).astype(np.int64))

    n = per * (len(edges) - 1)
    return docs.withColumn("block", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(n))).otherwise(block("doc_id"))), n


def _sorted_block(table: pa.Table) -> tuple[np.ndarray, pa.Array]:
    ids = table.column("doc_id").combine_chunks().fill_null(NULL_ID).to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    return ids[order], table.column("text").combine_chunks().take(pa.array(order))


def _windows(words: Words, ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, hash and place in the block of each window of a document that has an id.

    Places count words, with a gap before each document, so windows at successive places are of one document.
    """
    h, whole = words.ngrams(window)
    doc = words.text_of()
    at = np.flatnonzero(whole & (ids[doc] != NULL_ID))
    return at, h[at], at + doc[at]


def greedy_factors(first: np.ndarray, block: np.ndarray, place: np.ndarray, doc: np.ndarray, window: int) -> list[tuple[int, int, int, bool]]:
    """Parse from left to right: begin, end (in words), block and whether the span is a boundary check.

    first, block, place, doc: first word, reference block, place in that block and document of each window that some block
    holds, in order. A factor begins at the first such window that the factor before leaves free, and grows while the next window
    lies at the next place of the same block, so it is a string of a document of that block.
    Windows that begin inside a factor and run past its end straddle a boundary: no factor holds them, so their
    spans are given beside the factors.
    """
    if not len(first):
        return []
    lead = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1] + 1) | (block[1:] != block[:-1]) | (place[1:] != place[:-1] + 1) | (doc[1:] != doc[:-1])]))
    run = np.diff(np.concatenate([lead, [len(first)]]))
    out, free = [], 0
    for a, n, b in zip(first[lead].tolist(), run.tolist(), block[lead].tolist(), strict=True):
        begin, last = max(a, free), a + n - 1
        if begin > a:
            out.append((a, min(begin - 1, last) + window, b, True))
        if begin <= last:
            free = last + window
            out.append((begin, free, b, False))
    return out


def dedup_substrings(docs: DataFrame, window: int = 13, block_bytes: int = 6 << 20, carry: bool = False) -> DataFrame:
    """Parse every document against the reference blocks of all documents with a smaller doc_id, and drop what is copied.

    Blocks are ranges of doc_id. Each block is indexed by the hashes of its `window`-word windows with the place where each
    is first found; the index is dealt over buckets of the hash space, so one shuffle sets each window of a document against every
    reference block at once, and the answer names the first block that holds it and its place there. The parse (greedy_factors) goes
    from left to right: a factor grows word by word while the next window lies at the next place of the same block, so it is
    a string of a document there; what is shorter than `window` words is no factor but literal.
    Factors are the duplicate spans, and so are the windows that straddle the boundary of a factor and are in some block.
    The words that these spans cover are removed.

    Returns doc_id, n_words, n_removed, kept (the words left, joined by one blank) and factors (start, length in
    words, reference block, whether it is a boundary check). A window counts as copied when its word sequence
    starts in a document with a smaller doc_id; it is judged on the input.
    Null or empty text: no words, kept is empty. Null doc_id: neither copies nor is copied. Rows with the same doc_id
    do not copy from each other and each give a row. An empty table gives no rows. Extra columns are not read.
    Window hashes have 64 bits: over 10^10 windows about three are expected to be taken for another.

    With carry, the input's columns come back instead, with text replaced in the documents that lose words.
    """
    names, kinds = docs.columns, dict(docs.dtypes)
    rest = [c for c in names if c not in ("doc_id", "text")] if carry else []
    packed = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]).alias("rest")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([packed] if carry else []))
    docs, n = _blocks(docs, block_bytes)
    out = StructType.fromDDL(OUT)
    if carry:
        out = out.add("rest", docs.schema["rest"].dataType).add("old", "string")
    buckets = n

    def index(key: tuple, table: pa.Table) -> pa.Table:
        ids, texts = _sorted_block(table)
        _, h, place = _windows(Words(texts), ids, window)
        h, first = np.unique(h, return_index=True)
        place = place[first]
        edge = bucket_edges(h, buckets)
        full = np.flatnonzero(np.diff(edge))
        body, places = ([pack(x[edge[k] : edge[k + 1]]) for k in full] for pack, x in ((pack_sorted, h), (pack_u32, place)))
        return pa.table({"bucket": pa.array(full, pa.int64()), "block": pa.array([key[0].as_py()] * len(full), pa.int64()), "body": pa.array(body, pa.binary()), "places": pa.array(places, pa.binary())})

    def match(table: pa.Table) -> pa.Table:
        """For each block's windows in a bucket, the first block that has them and the place there, where that is another."""
        table = table.sort_by("block")
        parts = [unpack_sorted(x) for x in table.column("body").to_pylist()]
        size = np.array([len(x) for x in parts])
        h, block = np.concatenate(parts), np.repeat(table.column("block").to_numpy(), size)
        order = np.argsort(h, kind="stable")
        s = h[order]
        head = np.concatenate([[True], s[1:] != s[:-1]])
        lead = np.empty(len(h), np.int64)
        lead[order] = order[np.flatnonzero(head)][np.cumsum(head) - 1]
        del s, order, head
        source, place = block[lead], np.concatenate([unpack_u32(x) for x in table.column("places").to_pylist()])[lead]
        edge = np.concatenate([[0], np.cumsum(size)])
        out: dict[str, list] = {"bucket": [], "block": [], "hits": [], "source": [], "places": []}
        for k, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
            hit = np.flatnonzero(source[a:b] != block[a:b])
            if len(hit):
                for name, v in zip(out, (table.column("bucket")[k].as_py(), table.column("block")[k].as_py(), pack_u32(np.diff(hit, prepend=0)), pack_u32(source[a:b][hit]), pack_u32(place[a:b][hit])), strict=True):
                    out[name].append(v)
        return pa.table(out, schema=pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("hits", pa.binary()), ("source", pa.binary()), ("places", pa.binary())]))

    def parse(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = _sorted_block(table)
        order = pa.array(np.argsort(table.column("doc_id").combine_chunks().fill_null(NULL_ID).to_numpy(zero_copy_only=False), kind="stable"))
        words = Words(texts)
        at, h, place = _windows(words, ids, window)
        distinct, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        source, there = np.full(len(distinct), -1, np.int64), place[first]
        edge = bucket_edges(distinct, buckets)
        for bucket, hits, found, places in zip(*(answers.column(c).to_pylist() for c in ("bucket", "hits", "source", "places")), strict=True):
            hit = edge[bucket] + np.cumsum(unpack_u32(hits).astype(np.int64))
            source[hit], there[hit] = unpack_u32(found), unpack_u32(places)
        doc = words.text_of()
        of = source[inverse]
        # in the block itself: documents are in order, so the first place of a window has its smallest doc_id
        own = ids[doc[at]] > ids[doc[at[first]]][inverse] if len(at) else np.zeros(0, bool)
        me = int(table.column("block")[0].as_py()) if table.num_rows else 0
        of = np.where(of < 0, np.where(own, me, -1), of)
        copied = of >= 0
        spans = greedy_factors(at[copied], of[copied], there[inverse[copied]], doc[at[copied]], window)
        lo, hi, source_of, boundary = (np.array(x) for x in zip(*spans, strict=True)) if spans else (np.zeros(0, np.int64),) * 4
        drop = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(drop, lo, 1)
        np.add.at(drop, hi, -1)
        keep = np.cumsum(drop)[:-1] == 0
        # kept words and one blank after each
        byte = np.zeros(len(words.data) + 1, np.int8)
        byte[words.begin[keep]] += 1
        byte[words.end[keep] + 1] -= 1
        mask = np.cumsum(byte[:-1], dtype=np.int8).astype(bool)
        data = words.data.copy()
        data[words.end] = 0x20
        kept, size = data[mask], np.concatenate([[0], np.cumsum(mask)])[words.at]
        starts, ends = size[:-1], np.maximum(size[1:] - 1, size[:-1])
        raw = kept.tobytes()
        n_words = np.diff(words.first)
        before = np.concatenate([[0], np.cumsum(~keep)])
        removed = before[words.first[1:]] - before[words.first[:-1]]
        d = doc[lo]
        per_doc = np.concatenate([[0], np.cumsum(np.bincount(d, minlength=len(ids)))]) if len(ids) else np.zeros(1)
        items = pa.StructArray.from_arrays([pa.array(lo - words.first[d], pa.int64()), pa.array(hi - lo, pa.int64()), pa.array(source_of, pa.int64()), pa.array(boundary.astype(bool))], fields=list(FACTOR.value_type))
        factors = pa.ListArray.from_arrays(pa.array(per_doc.astype(np.int32)), items)
        more = {"rest": table.column("rest").combine_chunks().take(order), "old": texts} if carry else {}
        return pa.table({"doc_id": pa.array(ids, pa.int64(), mask=ids == NULL_ID), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array([raw[x:y] for x, y in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()).cast(pa.string()), "factors": factors.cast(FACTOR), **more})

    messages = docs.groupBy("block").applyInArrow(index, "bucket long, block long, body binary, places binary")
    answers = messages.groupBy("bucket").applyInArrow(match, "bucket long, block long, hits binary, source binary, places binary")
    found = docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(parse, out)
    if not carry:
        return found
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("old"))
    return found.select(*[F.col("doc_id").cast(kinds[c]).alias(c) if c == "doc_id" else text.cast(kinds[c]).alias(c) if c == "text" else F.col(f"rest.c{rest.index(c)}").alias(c) for c in names])


def op4_substring_dedup(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM d WHERE len(w) >= 13),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i+12], ' ')) AS k FROM g),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS low FROM h),
c AS (SELECT DISTINCT doc_id, i + j AS p FROM m, (SELECT unnest(range(0, 13)) AS j) WHERE low < doc_id),
p AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w) AS n, coalesce(len(gone), 0) AS r,
  array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ') AS t
  FROM d LEFT JOIN p ON d.doc_id = p.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM k
"""
