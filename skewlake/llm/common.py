"""Shared helpers: checkpointing, and vectorised word and n-gram hashing on Arrow text columns."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Words longer than this many bytes are hashed one by one.
LONG_WORD = 64


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir). Where none is set a local session makes one; a cluster must name it."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not path:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="spark-ckpt-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a written table in the shared folder.

    A checkpoint hands on the size that the optimiser guessed. In rounds of joins that guess is a product with ever more
    digits, until planning takes longer than the work; a table read back has the size of its files.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast; extra columns of the input, whatever their names, are dropped."""
    return df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in columns.items()])


def hashed(n: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (xor-shift-multiply)."""
    x = x.copy()
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: Masks that keep the first k of eight bytes.
KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


#: Bytes that part words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANK = np.isin(np.arange(256), [0x20, *range(9, 14)])


class Spans:
    """Where the words of a text column lie: maximal runs of bytes that aren't in `gap` (where not given `[^\\x20\\x09-\\x0D]+`).

    data: all texts with a blank between, which must be in gap; begin, end: bytes of each word; first: for each text (and one more) the
    number of words before it.
    """

    def __init__(self, texts: pa.Array | pa.ChunkedArray, gap: np.ndarray = BLANK):
        raw = [b"" if t is None else t for t in texts.cast(pa.large_binary()).to_pylist()]
        at = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in raw], out=at[1:])
        padded = np.frombuffer(b" ".join(raw) + b" " + bytes(8), np.uint8)
        del raw
        self.data, self.padded = padded[:-8], padded
        space = gap[self.data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            edge = np.concatenate([[0], edge])
        self.begin, self.end = edge[0::2], edge[1::2]
        self.at = at
        self.first = np.searchsorted(self.begin, at)

    def text_of(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class Words(Spans):
    """The words of a text column with a 64-bit hash of each."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, lower: bool = False, gap: np.ndarray = BLANK):
        super().__init__(texts, gap)
        self.hash = self._hash(LOWER[self.padded] if lower else self.padded)

    def _eights(self, data: np.ndarray) -> np.ndarray:
        """The eight bytes from each place on, as a number."""
        return np.ndarray(len(data) - 7, "<u8", data, strides=(1,))

    def _hash(self, data: np.ndarray) -> np.ndarray:
        """Words of up to eight bytes have hashes of their own; up to LONG_WORD they are mixed eight bytes at a time; longer ones get BLAKE2."""
        load, size = self._eights(data), self.end - self.begin
        out = mix(mix(load[self.begin] & KEEP[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * GOLD))
        of = np.flatnonzero((size > 8) & (size <= LONG_WORD))
        k = 8
        while len(of):
            out[of] = mix(out[of] ^ mix((load[self.begin[of] + k] & KEEP[np.minimum(size[of] - k, 8)]) ^ GOLD))
            k += 8
            of = of[size[of] > k]
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            out[i] = int.from_bytes(hashlib.blake2b(data[self.begin[i] : self.end[i]], digest_size=8).digest(), "little")
        return out

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Place of a word for each distinct one, by hash, and which of these each word is. Words of equal hashes are compared."""
        _, first, inverse = np.unique(self.hash, return_index=True, return_inverse=True)
        size, rep = self.end - self.begin, first[inverse]
        same = bool((size == size[rep]).all())
        load, of, k = self._eights(np.concatenate([self.data, np.zeros(8, np.uint8)])), np.flatnonzero(size > 8), 0
        while same and len(of):
            keep = KEEP[np.minimum(size[of] - k, 8)]
            same = bool(((load[self.begin[of] + k] ^ load[self.begin[rep[of]] + k]) & keep == 0).all())
            k += 8
            of = of[size[of] > k]
        if not same:  # two words have one hash: tell them apart by their bytes
            raw, seen = self.data.tobytes(), {}
            words = [raw[a:b] for a, b in zip(self.begin.tolist(), self.end.tolist(), strict=True)]
            inverse = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
            first = np.unique(inverse, return_index=True)[1]
            order = np.argsort(self.hash[first], kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            first, inverse = first[order], rank[inverse]
        return first, inverse

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each word on, and whether they lie in one text."""
        total = len(self.hash)
        out = np.zeros(total, np.uint64)
        for j in range(n):
            out[: max(0, total - j)] += self.hash[j:] * np.uint64(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64))
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(total)
        return mix(out), left >= n


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as differences, stored byte plane by byte plane, which compresses well."""
    return np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_u32(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_u32(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def bucket_edges(values: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of `buckets` (fewer than 2^32) equal ranges of the 64-bit space begins in sorted values."""
    of = ((values >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64)).astype(np.int64)


def text_bytes(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes of a text column, over all rows."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(column)).alias("b")).first()
    return row["n"], row["b"] or 0


def byte_slices(batches, limit: int, column: str = "text"):
    """Arrow record batches cut into runs of rows whose texts hold at most `limit` bytes; a longer text stands alone."""
    for b in batches:
        size = np.array([0 if t is None else t for t in pc.binary_length(b.column(column).cast(pa.large_binary())).to_pylist()], np.int64)
        a, held = 0, 0
        for i, n in enumerate(size.tolist()):
            if i > a and held + n > limit:
                yield b.slice(a, i - a)
                a, held = i, 0
            held += n
        if b.num_rows > a or b.num_rows == 0:
            yield b.slice(a)
