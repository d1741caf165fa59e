"""Packing of token pieces into sequences, shortest pack first over the histogram of lengths."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_slices, cut, hashed, plain
from .tokens import encoder

PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def cut_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, keep_words: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: each document's ids with end_id, cut every `size` ids.

    With keep_words a worker keeps its word tables for its next task, which saves time; without, it frees them after each.
    """

    def run(batches):
        end = np.array([end_id], "<u4").tobytes()
        for b in byte_slices(batches, 4 << 20):
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc, ids in zip(b.column("doc_id").to_pylist(), encoder(tokenizer).encode(b.column("text").to_pylist()), strict=True):
                ids += end
                for a in range(0, len(ids), 4 * size):
                    part = ids[a : a + 4 * size]
                    for c, v in zip(out, (doc, a // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=PIECE)
        if not keep_words:
            encoder(tokenizer).forget()

    return plain(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, longest first, and how many sequences have each.

    Lengths are placed longest first, all of one length at a time, each into the shortest packs that have room; packs are
    opened, as few as can hold those left of a length, where none has room. At most a few patterns arise for each length.
    """
    packs: dict[int, list[list]] = {}
    totals: list[int] = []

    def put(total: int, pattern: tuple[int, ...], n: int) -> None:
        if total not in packs:
            insort(totals, total)
        packs.setdefault(total, []).append([pattern, n])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if totals and totals[0] + length <= size:
                total = totals[0]
                pattern, n = packs[total].pop()
                if not packs[total]:
                    del packs[total]
                    totals.pop(bisect_left(totals, total))
                used = min(n, left)
                if n > used:
                    put(total, pattern, n - used)
                put(total + length, (*pattern, length), used)
                left -= used
            else:
                opened = -(-left // (size // length))
                put(length, (length,), opened)
                left -= opened
    return sorted(((tuple(p), n) for held in packs.values() for p, n in held), reverse=True)


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, keep_words: bool = True) -> DataFrame:
    """Pack every document's ids into sequences of at most `size` ids.

    Returns for each piece doc_id, start, length, ids_crc32, doc_tokens, sequence_id (from 0) and offset. The histogram of
    lengths (at most `size` numbers) is all that the driver sees; it is packed shortest pack first. Pieces are then ranked
    within their length, in salted groups so that a frequent length is shared out, and a pattern's slots take ranges of ranks.
    Null or empty text: the one id end_id. A null doc_id is kept as null. Repeated rows are packed each. An empty table gives
    no rows. Extra columns are not read.
    """
    pieces = cut(cut_pieces(docs, tokenizer, size, end_id, keep_words))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    patterns = shortest_pack_first(counts, size)
    slots, taken, base = [], dict.fromkeys(counts, 0), 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            slots.append((length, taken[length], n, base, offset))
            taken[length] += n
            offset += length
        base += n
    salts = min(4096, sum(counts.values()) // 20_000 + 8)
    dealt = pieces.withColumn("salt", hashed(salts, "doc_id", "start"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = dealt.groupBy("length", "salt").count().select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    ranked = dealt.withColumn("turn", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")))
    ranked = ranked.join(shift, ["length", "salt"]).withColumn("rank", F.col("shift") + F.col("turn") - 1)
    order = sorted(slots)
    starts = {k: np.array([s[1] for s in order if s[0] == k]) for k in counts}
    rows = {k: np.array([s[1:] for s in order if s[0] == k]) for k in counts}

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            out = np.empty((len(length), 2), np.int64)
            for k in np.unique(length).tolist():
                of = length == k
                row = rows[k][np.searchsorted(starts[k], rank[of], side="right") - 1]
                out[of] = np.stack([row[:, 2] + rank[of] - row[:, 0], row[:, 3]], 1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in PIECE.names), pa.array(out[:, 0]), pa.array(out[:, 1])], [*PIECE.names, "sequence_id", "offset"])

    return ranked.select(*PIECE.names, "rank").mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op7_packing(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
