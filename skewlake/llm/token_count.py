"""Token counts from counts of distinct pre-tokens."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, bucket_edges, byte_slices, pack_u32, plain, text_bytes, unpack_u32
from .tokens import encoder

#: Hash ranges of pre-tokens, and slices that meet in one group: a group holds about as much as one slice, however many there are.
BUCKETS = SLICES = 256
BLOCK = "block long, bucket int, runs binary, sizes binary, at binary, times binary, doc_id array<long>, n_bytes array<long>"
SUMS = "block long, at binary, n binary, doc_id array<long>, n_bytes array<long>"
LONGS = pa.list_(pa.int64())


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, slice_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for each row of docs.

    Pre-tokens are the runs between ASCII white space, which the library encodes each on its own. Each slice of rows gives
    its distinct pre-tokens (compared as words where hashes agree) with their frequencies by document, dealt by hash of
    the pre-token; where they meet, each distinct pre-token is counted once, joined to the frequencies and summed by
    document; ids are never kept for a document. Over SLICES slices (2 GB of text) a hash range is dealt in several groups,
    so a frequent pre-token is shared out and counted once in each.

    The tokenizer file must drop white space (Encoder kind "dropped"); for any other, whole texts are encoded and counted.
    Null or empty text: 0 bytes and 0 tokens. Null doc_id: counted like any row. Repeated rows each give a row; an empty
    table gives no rows; extra columns are not read.
    """
    docs = plain(docs, doc_id="long", text="string")
    if encoder(tokenizer).kind != "dropped":
        return _whole(docs, tokenizer, limit)

    _, size = text_bytes(docs)
    slices = max(1, -(-size // slice_bytes))
    buckets = min(BUCKETS, slices)

    def spread(batches):
        turn = TaskContext.get().partitionId() << 32
        for b in byte_slices(batches, slice_bytes):
            words, turn = Words(b.column("text")), turn + 1
            first, inverse = words.distinct()
            h = words.hash[first]
            pair, times = np.unique(inverse * len(b) + words.text_of(), return_counts=True)
            run, at = pair // max(1, len(b)), pair % max(1, len(b))
            edge = bucket_edges(h, buckets)
            where = np.searchsorted(run, edge)
            begin, end = words.begin[first].tolist(), words.end[first].tolist()
            raw = words.data.tobytes()
            size = np.bincount(run, minlength=len(h))
            out: dict[str, list] = {c: [] for c in ("block", "bucket", "runs", "sizes", "at", "times", "doc_id", "n_bytes")}
            for k in np.flatnonzero(np.diff(edge)).tolist():
                i, j, x, y = edge[k], edge[k + 1], where[k], where[k + 1]
                row = (turn, k, b"\n".join([raw[p:q] for p, q in zip(begin[i:j], end[i:j], strict=True)]), pack_u32(size[i:j]), pack_u32(at[x:y]), pack_u32(times[x:y]), None, None)
                for c, v in zip(out, row, strict=True):
                    out[c].append(v)
            nbytes = [0 if t is None else len(t) for t in b.column("text").cast(pa.large_binary()).to_pylist()]
            for c, v in zip(out, (turn, turn % buckets, None, None, None, None, b.column("doc_id").to_pylist(), nbytes), strict=True):
                out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("block", pa.int64()), ("bucket", pa.int32()), *[(c, pa.binary()) for c in ("runs", "sizes", "at", "times")], ("doc_id", LONGS), ("n_bytes", LONGS)]))

    def join(table: pa.Table) -> pa.Table:
        """Count the group's distinct pre-tokens, and sum by slice and document."""
        some = [None if x is None else x.split(b"\n") for x in table.column("runs").to_pylist()]
        distinct = list(dict.fromkeys(run for runs in some if runs for run in runs))
        count = dict(zip(distinct, encoder(tokenizer).pieces(distinct), strict=True))
        at_out, n_out = [], []
        for runs, sizes, at, times in zip(some, *(table.column(c).to_pylist() for c in ("sizes", "at", "times")), strict=True):
            if runs is None:
                at_out.append(None)
                n_out.append(None)
                continue
            n = np.repeat(np.array([count[x] for x in runs], np.int64), unpack_u32(sizes)) * unpack_u32(times)
            total = np.bincount(unpack_u32(at).astype(np.int64), weights=n)
            held = np.flatnonzero(total)
            at_out.append(held.astype("<i8").tobytes())
            n_out.append(total[held].astype("<i8").tobytes())
        return pa.table({"block": table.column("block"), "at": pa.array(at_out, pa.binary()), "n": pa.array(n_out, pa.binary()), "doc_id": table.column("doc_id"), "n_bytes": table.column("n_bytes")})

    def total(table: pa.Table) -> pa.Table:
        own = next(i for i, x in enumerate(table.column("doc_id").to_pylist()) if x is not None)
        ids, size = table.column("doc_id")[own].as_py(), table.column("n_bytes")[own].as_py()
        n = np.zeros(len(ids), np.int64)
        for at, some in zip(table.column("at").to_pylist(), table.column("n").to_pylist(), strict=True):
            if at is not None:
                n[np.frombuffer(at, "<i8")] += np.frombuffer(some, "<i8")
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(size, pa.int64()), "n_tokens": pa.array(n)})

    dealt = docs.mapInArrow(spread, BLOCK).withColumn("group", F.pmod(F.xxhash64("block"), F.lit(-(-slices // SLICES))))
    joined = dealt.repartition(max(8, slices), "bucket", "group").groupBy("bucket", "group").applyInArrow(join, SUMS)
    out = joined.groupBy("block").applyInArrow(total, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def _whole(docs: DataFrame, tokenizer: str, limit: int) -> DataFrame:
    def run(batches):
        for b in byte_slices(batches, 4 << 20):
            texts = b.column("text").to_pylist()
            ids = encoder(tokenizer).encode(texts)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_count(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
