"""SimHash near-duplicates by anchor points of a covering code, and the groups that their links form."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Spans, byte_slices, hashed, plain, stored
from .components import components, stars

#: Fingerprints link at so many differing bits or fewer.
DISTANCE = 2
#: The covering code is a direct sum of cyclic codes: bits, generator polynomial, covering radius. The first two are perfect
#: binary Golay codes, then a Hamming code, then all words of the last three bits.
CODES = [(23, 0b110001110101, 3), (23, 0b110001110101, 3), (15, 0b10011, 1), (3, 1, 0)]
#: Fingerprints at home at one anchor, on average, from which on the code gets its next summand.
HOMES = 64
#: Shingles longer than this are hashed by the library one by one.
LONG = 256
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xxh64(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many spans of one byte buffer at once. The buffer must go on for 8 bytes after the last span."""
    with np.errstate(over="ignore"):
        eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        four = np.ndarray(len(data) - 3, "<u4", data, strides=(1,))
        size, s = end - begin, np.uint64(seed)
        step = lambda acc, lane: _turn(acc + lane * P2, 31) * P1
        out = np.full(len(begin), s + P5, np.uint64)
        at = begin.astype(np.int64).copy()
        of = np.flatnonzero((size >= 32) & (size <= LONG))
        if len(of):
            lane = [np.full(len(of), x, np.uint64) for x in (s + P1 + P2, s + P2, s, s - P1)]
            live = np.arange(len(of))
            while len(live):
                for k in range(4):
                    lane[k][live] = step(lane[k][live], eight[at[of[live]] + 8 * k])
                at[of[live]] += 32
                live = live[end[of[live]] - at[of[live]] >= 32]
            h = _turn(lane[0], 1) + _turn(lane[1], 7) + _turn(lane[2], 12) + _turn(lane[3], 18)
            for x in lane:
                h = (h ^ step(np.zeros(1, np.uint64), x)) * P1 + P4
            out[of] = h
        out += size.astype(np.uint64)
        of = np.flatnonzero(size <= LONG)
        while len(of := of[end[of] - at[of] >= 8]):
            out[of] = _turn(out[of] ^ step(np.zeros(1, np.uint64), eight[at[of]]), 27) * P1 + P4
            at[of] += 8
        of = np.flatnonzero((size <= LONG) & (end - at >= 4))
        out[of] = _turn(out[of] ^ (four[at[of]].astype(np.uint64) * P1), 23) * P2 + P3
        at[of] += 4
        of = np.flatnonzero(size <= LONG)
        while len(of := of[end[of] > at[of]]):
            out[of] = _turn(out[of] ^ (data[at[of]].astype(np.uint64) * P5), 11) * P1
            at[of] += 1
        out = (out ^ (out >> np.uint64(33))) * P2
        out = (out ^ (out >> np.uint64(29))) * P3
        out ^= out >> np.uint64(32)
        for i in np.flatnonzero(size > LONG).tolist():
            out[i] = xxhash.xxh64_intdigest(data[begin[i] : end[i]].tobytes(), seed)
    return out


def fingerprints(texts: pa.Array | pa.ChunkedArray, size: int = 3) -> np.ndarray:
    """The 64-bit SimHash of each text: a bit is set if it is set in over half the hashes of the shingles, repeats included."""
    spans = Spans(texts)
    count = np.diff(spans.first)
    # words again, lower-cased, with one blank after each
    mark = np.zeros(len(spans.data) + 1, np.int8)
    mark[spans.begin] = 1
    mark[spans.end + 1] -= 1
    kept = np.cumsum(mark[:-1]).astype(bool)
    place = np.cumsum(kept) - kept
    data = LOWER[spans.data]
    data[spans.end] = 0x20
    data = np.concatenate([data[kept], np.zeros(8, np.uint8)])
    begin, end = place[spans.begin], place[spans.end]
    left = np.repeat(spans.first[1:], count) - np.arange(len(begin))
    head = np.flatnonzero(left >= size)
    few = spans.first[:-1][(count > 0) & (count < size)]
    start = np.sort(np.concatenate([head, few]))
    last = np.minimum(start + size, start + left[start]) - 1
    doc = spans.text_of()[start]
    total, n = np.zeros((len(count), 64), np.int64), np.bincount(doc, minlength=len(count))
    for a in range(0, len(start), 1 << 16):
        b = slice(a, a + (1 << 16))
        bits = np.unpackbits(xxh64(data, begin[start[b]], end[last[b]]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        d = doc[b]
        edge = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        total[d[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int32)
    return np.packbits(2 * total > n[:, None], axis=1, bitorder="little").view("<u8").ravel()


@cache
def _patterns(n: int, generator: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a cyclic code: the syndrome of each single bit; error patterns of up to radius + DISTANCE bits in the order of their
    syndromes, by how much each exceeds the radius, and where each syndrome's begin."""
    degree = generator.bit_length() - 1
    unit = []
    for i in range(n):
        r = 1 << i
        for j in range(n - 1, degree - 1, -1):
            r ^= (generator << (j - degree)) * (r >> j & 1)
        unit.append(r)
    found = []
    for w in range(min(n, radius + DISTANCE) + 1):
        for bits in combinations(range(n), w):
            syndrome = 0
            for i in bits:
                syndrome ^= unit[i]
            found.append((syndrome, sum(1 << i for i in bits), max(0, w - radius)))
    table = np.array(sorted(found), np.int64)
    return np.array(unit), table[:, 1], table[:, 2], np.searchsorted(table[:, 0], np.arange((1 << degree) + 1))


def anchors(values: np.ndarray, summands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every anchor at which a fingerprint is to be met: row of values, anchor, and whether the row is at home there.

    Anchors are the words of the direct sum of the first `summands` codes. A fingerprint's home lies within the covering radius
    of each part; whatever links with it is within that radius plus DISTANCE, counted over all parts.
    """
    row, anchor, over, shift = np.arange(len(values)), np.zeros(len(values), np.uint64), np.zeros(len(values), np.int64), 0
    for n, generator, radius in CODES[:summands]:
        unit, pattern, excess, first = _patterns(n, generator, radius)
        part = ((values >> np.uint64(shift)) & np.uint64((1 << n) - 1)).astype(np.int64)
        syndrome = np.zeros(len(values), np.int64)
        for i in range(n):
            syndrome ^= (part >> i & 1) * unit[i]
        s = syndrome[row]
        many = first[s + 1] - first[s]
        at = np.repeat(first[s] - np.cumsum(many) + many, many) + np.arange(many.sum())
        row, anchor, over = np.repeat(row, many), np.repeat(anchor, many), np.repeat(over, many) + excess[at]
        ok = over <= DISTANCE
        row, over = row[ok], over[ok]
        anchor = anchor[ok] | ((part[row] ^ pattern[at[ok]]).astype(np.uint64) << np.uint64(shift))
        shift += n
    return row, anchor, over == 0


def _replicate(summands: int):
    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 4096):
                ids = b.column("fingerprint").slice(a, 4096)
                row, anchor, home = anchors(ids.to_numpy().view(np.uint64), summands)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), ids.take(pa.array(row)), pa.array(home)], ["anchor", "fingerprint", "home"])

    return run


def _near(x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (places in x) among distinct fingerprints that meet at one anchor; enough to join all that links join."""
    homes = np.flatnonzero(home)
    if len(homes) < 2048:
        found, seen = [], 0
        for a in range(0, len(homes), 256):
            i, j = np.nonzero(np.bitwise_count(x[homes[a : a + 256], None] ^ x[None, :]) <= DISTANCE)
            i = homes[a + i]
            found.append((i[i != j], j[i != j]))
            seen += len(i)
            if seen > 16 * len(x) + 4096:
                break
        else:
            return np.concatenate([i for i, _ in found] or [homes]), np.concatenate([j for _, j in found] or [homes])
    # many homes or a dense ball: two words are at most two bits apart when some word is at most one bit from both
    word = np.concatenate([x, *(x ^ np.uint64(1 << k) for k in range(64))])
    of = np.tile(np.arange(len(x)), 65)
    order = np.argsort(word, kind="stable")
    word, of = word[order], of[order]
    same = word[1:] == word[:-1]
    pairs = np.unique(np.stack([of[:-1][same], of[1:][same]], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _compare(key: tuple, table: pa.Table) -> pa.Table:
    anchor, x, home = (table.column(c).to_numpy() for c in ("anchor", "fingerprint", "home"))
    order = np.argsort(anchor, kind="stable")
    anchor, x, home = anchor[order], x[order], home[order]
    edge = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1], [True]]))
    at_home = np.concatenate([[0], np.cumsum(home)])
    links = set()
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        if b - a > 1 and at_home[b] > at_home[a]:
            here = x[a:b]
            i, j = _near(here.view(np.uint64), home[a:b])
            links.update(zip(np.minimum(here[i], here[j]).tolist(), np.maximum(here[i], here[j]).tolist(), strict=True))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def links(distinct: DataFrame, most: int = 32768, pack_rows: int = 200_000, summands: int | None = None) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column fingerprint) of at most DISTANCE differing bits, enough to join all
    that any chain of links joins.

    Each fingerprint is replicated to every anchor within the covering radius plus DISTANCE; those at home at an anchor are
    compared there with all that came. An anchor at which more than `most` meet isn't given to one task: its
    fingerprints are dealt by the words within one bit of them instead, of which no word has more than 65.
    """
    count = distinct.count()
    if summands is None:
        summands, homes = 1, 1 << 12
        while summands < len(CODES) and count > HOMES * homes:
            homes <<= CODES[summands][0] - CODES[summands][1].bit_length() + 1
            summands += 1
    met = stored(distinct.select("fingerprint").mapInArrow(_replicate(summands), "anchor long, fingerprint long, home boolean"))
    hot = met.groupBy("anchor").count().filter(F.col("count") > most).select("anchor")
    out = None
    if not hot.isEmpty():
        hot = stored(hot)
        crowd = met.join(hot, "anchor", "left_semi").select("fingerprint").distinct()
        word = F.explode(F.array(F.col("fingerprint"), *[F.col("fingerprint").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63)).cast("long")) for k in range(64)]))
        out = stars(crowd.select(F.col("fingerprint").alias("node"), word.alias("key")))
        met = met.join(hot, "anchor", "left_anti")
    packs = max(1, -(-count * 24 // pack_rows))
    near = met.withColumn("pack", hashed(packs, "anchor")).groupBy("pack").applyInArrow(_compare, "a long, b long")
    return near if out is None else near.union(out)


def simhash_groups(docs: DataFrame, size: int = 3, **options) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id that links reach) for each row of docs.

    Equal fingerprints stand as one. Words are `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; with fewer than `size` words the whole
    sequence is one shingle. Null, empty or blank text: fingerprint zero, linked like any other. Null doc_id: no links,
    component_id null. Rows that repeat a doc_id are judged each by its own text. An empty table gives no rows. Extra columns
    are not read.
    """

    def run(batches):
        for b in byte_slices(batches, 4 << 20):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fingerprints(b.column("text"), size).view(np.int64))], ["doc_id", "fingerprint"])

    prints = stored(plain(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, fingerprint long"))
    known = prints.filter("doc_id IS NOT NULL")
    distinct = stored(known.groupBy("fingerprint").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")))
    part = stored(components(links(distinct, **options)).select(F.col("node").alias("fingerprint"), "part"))
    low = part.join(distinct, "fingerprint").groupBy("part").agg(F.min("low").alias("part_low"))
    named = distinct.join(part.join(low, "part"), "fingerprint", "left").select("fingerprint", "n", F.coalesce("part_low", "low").alias("component_id"))
    named = stored(named)
    # fingerprints of over a 500th of all rows, of which there are under 500, are joined without a shuffle
    frequent = F.broadcast(named.filter(F.col("n") * 500 > known.count()).drop("n"))
    hot = known.join(frequent, "fingerprint")
    rest = known.join(frequent, "fingerprint", "left_anti").join(named.drop("n"), "fingerprint")
    alone = prints.filter("doc_id IS NULL").withColumn("component_id", F.lit(None).cast("long"))
    out = hot.unionByName(rest).unionByName(alone)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op13_simhash_groups(docs: DataFrame) -> DataFrame:
    return simhash_groups(docs)
