"""Ranked lexical search with geometric blocks in every posting list."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, byte_slices, hashed, plain

#: What parts terms: ASCII without letters and digits.
GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}
#: Documents of a block, at most of a list that is one block read without a summary, and of a shard.
BLOCK, SHORT, SHARD = 32, 8, 1024
#: Numbers that a shard's matrices of documents, or of blocks, and terms hold at most (unless one document has more).
CELLS = 4 << 20
FOUND = "item int, item_id long, doc_id long, score long"


class Items:
    """A batch of items: their terms with repeats, by number, and the distinct terms by hash."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        counts = [Counter(TERM.findall((text or "").translate(SMALL))) for _, text in rows]
        terms = sorted({t for c in counts for t in c})
        h = Words(pa.array(terms, pa.string()), gap=GAP).hash
        order = np.argsort(h)
        self.hash, self.ids = h[order], [i for i, _ in rows]
        number = dict(zip((terms[i] for i in order.tolist()), range(len(terms)), strict=True))
        self.terms = [np.array(sorted(number[t] for t in c), np.int64) for c in counts]
        self.times = [np.array([n for _, n in sorted((number[t], n) for t, n in c.items())], np.int64) for c in counts]

    def hits(self, texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text, and document, term and frequency of each pair of a document and a term of some item, in this order.

        Terms are told by 64-bit hashes: in a corpus of 10^10 distinct terms one of 10^4 sought terms is mistaken with a chance of 10^-5.
        """
        words = Words(texts, lower=True, gap=GAP)
        at = np.minimum(np.searchsorted(self.hash, words.hash), len(self.hash) - 1)
        hit = np.flatnonzero(self.hash[at] == words.hash)
        pair, tf = np.unique(words.text_of()[hit] * len(self.hash) + at[hit], return_counts=True)
        return np.diff(words.first), pair // len(self.hash), pair % len(self.hash), tf


def _count(items: Items):
    """Documents with each term in this partition; as term -1 the documents with any term at all, as -2 all their terms."""

    def run(batches):
        df, docs, total = np.zeros(len(items.hash), np.int64), 0, 0
        for b in byte_slices(batches, 4 << 20):
            n, _, term, _ = items.hits(b.column("text"))
            df += np.bincount(term, minlength=len(df))
            docs, total = docs + int((n > 0).sum()), total + int(n.sum())
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *term.tolist()], pa.int64()), pa.array([docs, total, *df[term].tolist()], pa.int64())], ["term", "n"])

    return run


class Shard:
    """An inverted index of some documents (ids; x: document by term, frequency parts of scores; weight of each term).

    Each posting list of over SHORT documents is clustered: every BLOCKth document is a pivot, and each document goes to the pivot of the
    greatest inner product. Clusters are cut in blocks of BLOCK documents. A block's summary holds the greatest value in every coordinate.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, weight: np.ndarray):
        self.ids, self.x = ids, x
        scaled = (x * (weight / 1e9)).astype(np.float32)
        alike = scaled @ scaled.T
        summary, self.block, self.least, self.lists = [], [], [], []
        for t in range(x.shape[1]):
            docs = np.flatnonzero(x[:, t])
            if len(docs) <= SHORT:
                self.lists.append((docs, 0, 0))
                continue
            pivots = docs[:: BLOCK]
            cluster = alike[docs[:, None], pivots].argmax(1)
            order = np.argsort(cluster, kind="stable")
            docs, cluster = docs[order], cluster[order]
            edge = np.flatnonzero(np.concatenate([[True], cluster[1:] != cluster[:-1], [True]]))
            starts = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(edge[:-1], edge[1:], strict=True)])
            summary.append(np.maximum.reduceat(x[docs], starts, axis=0))
            self.lists.append((docs[:0], len(self.block), len(self.block) + len(starts)))
            self.block += np.split(docs, starts[1:])
            self.least += np.minimum.reduceat(ids[docs], starts).tolist()
        self.summary = np.concatenate(summary) if summary else np.zeros((0, x.shape[1]), x.dtype)
        self.least = np.array(self.least, np.int64)

    def search(self, columns: np.ndarray, factor: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
        """Scores and ids of the k best so far, with this shard's documents taken in, and how many blocks were skipped.

        A block is skipped only when its summary's score is below the k-th best, or equals it with no smaller id in the block.
        """
        seen = np.zeros(len(self.ids), bool)

        def read(docs: np.ndarray, best):
            docs = docs[~seen[docs]]
            seen[docs] = True
            score = self.x[docs[:, None], columns] @ factor
            score, ids = np.concatenate([best[0], score[score > 0]]), np.concatenate([best[1], self.ids[docs[score > 0]]])
            order = np.lexsort((ids, -score))[:k]
            return score[order], ids[order]

        short = [self.lists[c][0] for c in columns]
        best = read(np.unique(np.concatenate(short)), best)
        rows = np.concatenate([np.arange(a, b) for _, a, b in (self.lists[c] for c in columns)])
        bound = self.summary[rows[:, None], columns] @ factor
        order = np.lexsort((self.least[rows], -bound))
        rows, bound = rows[order], bound[order]
        at = 0
        while at < len(rows):
            if len(best[0]) == k:
                worst, last = best[0][-1], best[1][-1]
                ok = (bound[at:] > worst) | ((bound[at:] == worst) & (self.least[rows[at:]] < last))
                if not ok[0]:
                    # bounds only fall from here, and among equal bounds the least id only grows
                    return best, len(rows) - at
            take = rows[at : at + 2]
            best = read(np.unique(np.concatenate([self.block[r] for r in take])), best)
            at += 2
        return best, 0


def _shards(doc: np.ndarray, term: np.ndarray, x: np.ndarray, docs: int):
    """The pairs cut in runs of documents whose matrices stay within CELLS: documents, terms, matrix."""
    edge = np.searchsorted(doc, np.arange(docs + 1))
    a, step = 0, SHARD
    while a < docs:
        b = min(docs, a + step)
        p = slice(edge[a], edge[b])
        terms, column = np.unique(term[p], return_inverse=True)
        if (b - a + (edge[b] - edge[a]) // SHORT) * len(terms) > CELLS and b - a > 1:
            step = max(1, step // 2)
            continue
        matrix = np.zeros((b - a, len(terms)), np.int64)
        matrix[doc[p] - a, column] = x[p]
        yield slice(a, b), terms, matrix
        a, step = b, min(SHARD, 2 * step)


def _search(items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int):
    """The k best documents of a partition for each item, shard by shard, each beginning with what is known from the last."""

    def run(batches):
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items.ids]
        for b in byte_slices(batches, 4 << 20):
            n, doc, term, tf = items.hits(b.column("text"))
            m = 25 + (75 * n[doc] * n_docs) // n_terms if n_terms else n[doc]
            x = (1_000_000_000 * tf) // (1000 * tf + 8 * m)
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            held, doc = np.unique(doc, return_inverse=True)
            for rows, terms, matrix in _shards(doc, term, x, len(held)):
                shard = Shard(ids[held[rows]], matrix, weight[terms])
                at = np.full(len(items.hash), -1, np.int64)
                at[terms] = np.arange(len(terms))
                for i, wanted in enumerate(items.terms):
                    column = at[wanted]
                    if len(here := np.flatnonzero(column >= 0)):
                        best[i], _ = shard.search(column[here], items.times[i][here] * weight[wanted[here]], best[i], k)
        number = np.repeat(np.arange(len(best)), [len(s) for s, _ in best])
        arrays = [pa.array(number.astype(np.int32)), pa.array([items.ids[i] for i in number.tolist()], pa.int64()), pa.array(np.concatenate([d for _, d in best])), pa.array(np.concatenate([s for s, _ in best]))]
        yield pa.RecordBatch.from_arrays(arrays, ["item", "item_id", "doc_id", "score"])

    return run


def ranked(docs: DataFrame, benchmark: DataFrame, k: int = 10, batch_bytes: int = 1 << 20) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents of the greatest scores above 0 for each item.

    Items are taken in batches of about `batch_bytes` of text, by hash, each batch a broadcast of bounded size; each reads the
    documents twice, once to count and once to search. A partition's documents are indexed in shards, whose posting lists are
    clustered in blocks; the partitions' best are merged in two steps.

    Terms are runs of letters, digits and characters beyond ASCII, only A-Z lower-cased. Null or empty texts have none; they are no
    results and don't count in the statistics. Documents without a doc_id count in them and are no results. Equal scores go by
    doc_id; rows that repeat a doc_id or item_id stand each for itself. Items without terms, or without any document, have no
    rows; nor has an empty table. Extra columns are not read.
    """
    docs, benchmark = plain(docs, doc_id="long", text="string"), plain(benchmark, item_id="long", text="string")
    named = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-size // batch_bytes))
    found = None
    for batch in range(batches):
        rows = benchmark.filter(hashed(batches, "item_id", "text") == batch) if batches > 1 else benchmark
        items = Items([tuple(r) for r in rows.select("item_id", "text").collect()])
        if not len(items.hash):
            continue
        counts = dict(map(tuple, docs.select("text").mapInArrow(_count(items), "term long, n long").groupBy("term").agg(F.sum("n")).collect()))
        n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(items.hash))], np.int64)
        best = named.mapInArrow(_search(items, weight, n_docs, n_terms, k), FOUND).withColumn("batch", F.lit(batch))
        found = best if found is None else found.unionByName(best)
    spark = docs.sparkSession
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.col("score").desc(), "doc_id"]
    part = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    first = part.withColumn("rank", F.row_number().over(Window.partitionBy("batch", "item", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("batch", "item").orderBy(*order))).filter(F.col("rank") <= k)
    return last.select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return ranked(docs, benchmark)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
n AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
s AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM n),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
qt AS (SELECT item_id, t, count(*) AS times FROM q GROUP BY ALL),
p AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) SEMI JOIN qt USING (t) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY t, nd),
x AS (SELECT p.doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nd) // nt))) AS x FROM p JOIN w USING (t) JOIN n ON n.doc_id = p.doc_id, s),
r AS (SELECT item_id, doc_id, CAST(sum(times * x) AS BIGINT) AS score FROM x JOIN qt USING (t) GROUP BY ALL HAVING sum(times * x) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
