"""Exact top-k search by a Voronoi kNN join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Rows of data, and queries, that one local search takes at most.
DATA_ROWS, QUERY_ROWS = 8192, 2048
CELL = "vec_id long, row long, query boolean, dim int, cell int, dist double, norm double, vector binary"


def _unpack(blobs: list[bytes], dim: int) -> np.ndarray:
    if len({len(b) for b in blobs}) == 1 and dim:
        return np.frombuffer(b"".join(blobs), f"<i{len(blobs[0]) // dim}").reshape(len(blobs), dim).astype(np.int64)
    return np.array([np.frombuffer(b, f"<i{max(1, len(b) // dim)}" if dim else "<i2") for b in blobs], np.int64).reshape(len(blobs), dim)


def _pack(x: np.ndarray) -> list[bytes]:
    """The rows of a matrix, in two bytes a number where all of them fit."""
    x = x.astype("<i2" if not x.size or np.abs(x).max() < 32768 else "<i8")
    raw, n = x.tobytes(), x.shape[1] * x.itemsize
    return [raw[i * n : (i + 1) * n] for i in range(len(x))]


def _by_dim(sizes: np.ndarray):
    """Each dimension with the rows that have it."""
    for dim in np.unique(sizes).tolist():
        yield dim, np.flatnonzero(sizes == dim)


def _best(q: np.ndarray, x: np.ndarray, ids: np.ndarray, row_of: np.ndarray, own: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """For each query (place in q) up to k of (query, place in x, score): greatest scores, ties to smaller ids; own: the query's own row."""
    out = []
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1]) < 2**52
    xt = (x.astype(np.float64) if exact else x).T
    for i in range(0, len(q), 256):
        part = q[i : i + 256]
        score = (part.astype(np.float64) @ xt).astype(np.int64) if exact else part @ xt
        for j, row in enumerate(score):
            ok = np.flatnonzero(row_of != own[i + j])
            s = row[ok]
            if len(ok) > k:
                ok = ok[s >= np.partition(s, len(s) - k)[len(s) - k]]
                s = row[ok]
            out += [(i + j, int(ok[t]), int(s[t])) for t in np.lexsort((ids[ok], -s))[:k]]
    return out


def knn_join(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, pivots: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of greatest inner product with each query, but for the query itself.

    Components x become floor(scale * x). Rows are grouped by their nearest pivot (a sample of at most `pivots` rows, by hash
    of vec_id: where not given one for 50,000 rows, 16 at least and 512 at most; a vector whose dimension no pivot has is grouped about the origin). Summaries of each group (rows, radius, k + 1 smallest
    distances) bound every query's k-th score from below; each group of queries keeps the least such bound. A row x is
    replicated to a group of queries only if pivot * x + radius * |x| reaches it, so nothing that could be an answer is
    left out. Groups are cut in shards by hash of the ids, solved locally, and the shards' answers are merged.

    Vectors that are null, or hold null or non-finite components, take no part, nor do null ids; vectors of different length
    don't meet. Rows that repeat a vec_id stand each for itself: as candidates, also of one another, and as queries with ranks of their own. Ties go to the smaller vec_id. A query with
    fewer than k others has as many rows as there are; an empty table gives none. Extra columns are not read. Scores must
    fit a 64-bit integer.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"), is_query.alias("query"))
    v = v.filter("vec_id IS NOT NULL AND e IS NOT NULL AND forall(e, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    v = v.select("vec_id", F.monotonically_increasing_id().alias("row"), "query", F.expr(f"transform(e, x -> floor(x * {scale}))").alias("v"))
    pivots = pivots or min(512, max(16, v.count() // 50_000))
    some = v.select("v").orderBy(F.xxhash64("vec_id")).limit(4 * pivots).collect()
    by_dim: dict[int, list] = {}
    for p in list(dict.fromkeys(tuple(r["v"]) for r in some))[:pivots]:
        by_dim.setdefault(len(p), []).append(p)
    centre = {d: np.array([*p, (0,) * d], np.float64).reshape(len(p) + 1, d) for d, p in by_dim.items()}

    def centres(dim: int) -> np.ndarray:
        return centre[dim] if dim in centre else np.zeros((1, dim))

    def assign(batches):
        for b in batches:
            lists, n = b.column("v"), b.num_rows
            edge, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            sizes = np.diff(edge)
            cell, dist, norm, vector = np.zeros(n, np.int32), np.zeros(n), np.zeros(n), [b""] * n
            for dim, rows in _by_dim(sizes):
                x = values[edge[rows][:, None] + np.arange(dim)].reshape(len(rows), dim)
                near = np.full(len(rows), np.inf)
                for c, p in enumerate(centres(dim)):
                    far = np.sqrt(((x - p) ** 2).sum(1))
                    cell[rows[far < near]] = c
                    near = np.minimum(near, far)
                dist[rows], norm[rows] = near, np.sqrt((x.astype(np.float64) ** 2).sum(1))
                for i, blob in zip(rows.tolist(), _pack(x), strict=True):
                    vector[i] = blob
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("row"), b.column("query"), pa.array(sizes.astype(np.int32)), pa.array(cell), pa.array(dist), pa.array(norm), pa.array(vector, pa.binary())], ["vec_id", "row", "query", "dim", "cell", "dist", "norm", "vector"])

    def nearest(batches):
        """The k + 1 smallest distances of each group in this partition."""
        least: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            dim, cell, dist = (b.column(c).to_numpy() for c in ("dim", "cell", "dist"))
            for d, c in np.unique(np.stack([dim, cell], 1), axis=0).tolist():
                mine = dist[(dim == d) & (cell == c)]
                least[d, c] = np.sort(np.concatenate([least.get((d, c), mine[:0]), mine]))[: k + 1]
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in least], pa.int32()), pa.array([c for _, c in least], pa.int32()), pa.array([x.tolist() for x in least.values()], pa.list_(pa.float64()))], ["dim", "cell", "near"])

    cells = cut(v.mapInArrow(assign, CELL))
    near = cells.select("dim", "cell", "dist").mapInArrow(nearest, "dim int, cell int, near array<double>")
    near = near.groupBy("dim", "cell").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"))
    held = {(r["dim"], r["cell"]): r["near"] for r in near.collect()}
    rows = {r["dim"]: r["n"] for r in cells.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}

    def bound(batches):
        """The bound of each query, and how far the query is from its pivot."""
        for b in batches:
            dims, norm, blobs = b.column("dim").to_numpy(), b.column("norm").to_numpy(), b.column("vector").to_pylist()
            low = np.full(len(dims), -np.inf)
            for dim, rows in _by_dim(dims):
                held_here = [(c, np.array(n)) for (d, c), n in held.items() if d == dim]
                at = np.concatenate([np.full(len(n), c) for c, n in held_here])
                if len(at) <= k:
                    continue
                x = _unpack([blobs[i] for i in rows.tolist()], dim) @ centres(dim).T
                least = x[:, at] - norm[rows][:, None] * np.concatenate([n for _, n in held_here])
                bound = np.partition(least, least.shape[1] - k - 1, axis=1)[:, least.shape[1] - k - 1]
                low[rows] = bound - 1e-6 * (1 + np.abs(bound))
            yield pa.RecordBatch.from_arrays([b.column("dim"), b.column("cell"), b.column("dist"), pa.array(low, pa.float64())], ["dim", "cell", "dist", "low"])

    wanted = cells.filter("query").mapInArrow(bound, "dim int, cell int, dist double, low double").groupBy("dim", "cell").agg(F.max("dist").alias("radius"), F.min("low").alias("low"), F.count(F.lit(1)).alias("n")).collect()
    groups: dict[int, list] = {}
    for r in wanted:
        groups.setdefault(r["dim"], []).append((r["cell"], r["radius"], r["low"]))

    def replicate(batches):
        for b in batches:
            dims, norm, blobs = b.column("dim").to_numpy(), b.column("norm").to_numpy(), b.column("vector").to_pylist()
            row, to = [], []
            for dim, rows in _by_dim(dims):
                x = _unpack([blobs[i] for i in rows.tolist()], dim) @ centres(dim).T
                for cell, radius, low in groups.get(dim, ()):
                    most = x[:, cell] + radius * norm[rows]
                    mine = rows[most + 1e-6 * (1 + np.abs(most)) >= low]
                    row += mine.tolist()
                    to += [cell] * len(mine)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("vec_id").take(take), b.column("row").take(take), b.column("dim").take(take), pa.array(to, pa.int32()), b.column("vector").take(take)], ["vec_id", "row", "dim", "cell", "vector"])

    # shards of data for each dimension, and of queries for each group: a group with a third of all queries has more
    per = F.create_map(*[F.lit(x) for d, n in (rows or {0: 1}).items() for x in (d, -(-n // DATA_ROWS))])[F.col("dim")]
    turns = {f"{r['dim']} {r['cell']}": -(-r["n"] // QUERY_ROWS) for r in wanted} or {"": 1}
    asked = F.create_map(*[F.lit(x) for pair in turns.items() for x in pair])[F.concat_ws(" ", "dim", "cell")]
    part = lambda n: F.pmod(F.xxhash64("row"), n).cast("int")
    span = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    data = cells.mapInArrow(replicate, "vec_id long, row long, dim int, cell int, vector binary").withColumn("shard", part(per)).select("*", span(asked).alias("turn"))
    queries = cells.filter("query").select("vec_id", "row", "dim", "cell", "vector", part(asked).alias("turn")).select("*", span(per).alias("shard"))
    key = ["dim", "cell", "shard", "turn"]

    def solve(key: tuple, asked: pa.Table, data: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        name, own = asked.column("vec_id").to_numpy(), asked.column("row").to_numpy()
        ids, rows = data.column("vec_id").to_numpy(), data.column("row").to_numpy()
        found = _best(_unpack(asked.column("vector").to_pylist(), dim), _unpack(data.column("vector").to_pylist(), dim), ids, rows, own, k) if len(own) and len(ids) else []
        return pa.table({"query_id": pa.array([int(name[a]) for a, _, _ in found], pa.int64()), "query_row": pa.array([int(own[a]) for a, _, _ in found], pa.int64()), "vec_id": pa.array([int(ids[b]) for _, b, _ in found], pa.int64()), "score": pa.array([s for _, _, s in found], pa.int64())})

    some = queries.groupBy(*key).cogroup(data.groupBy(*key)).applyInArrow(solve, "query_id long, query_row long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id"))
    return some.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_exact_topk(vectors: DataFrame) -> DataFrame:
    return knn_join(vectors, F.col("vec_id") % 20 == 0)


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""
