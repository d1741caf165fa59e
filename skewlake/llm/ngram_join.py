"""N-gram Jaccard join under several global token orders, and the groups that its links form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, bucket_edges, byte_slices, hashed, mix, pack_sorted, pack_u32, plain, stored, text_bytes, unpack_sorted, unpack_u32
from .components import components, stars

ORDERS, SALTS = 3, 16
#: Parts of more chunks than this are first split by the other orders.
PARTED = 8
#: A token's rank class is taken from the upper bits of its hash only: that sets the order, never a link.
LOW_BITS = np.uint64(16)
SEEDS = [np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)]


def shingle_sets(texts: pa.Array | pa.ChunkedArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, one text after the other, and where each text's begin."""
    words = Words(texts, lower=True)
    count = np.diff(words.first)
    h, whole = words.ngrams(size)
    for k in range(1, size):
        if len(at := words.first[:-1][count == k]):
            h[at] = words.ngrams(k)[0][at]
            whole[at] = True
    h, doc = h[whole], words.text_of()[whole]
    edge = np.searchsorted(doc, np.arange(len(count) + 1))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.searchsorted(doc[new], np.arange(len(count) + 1))


def set_keys(h: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each set."""
    out = []
    for seed in SEEDS[:2]:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ seed), dtype=np.uint64)])
        out.append((total[edge[1:]] - total[edge[:-1]]).view(np.int64))
    return out[0], out[1]


def prefix_length(n: int, percent: int) -> int:
    """Tokens of which a set of n must share one, in any order, with each set it links with."""
    return n - -(-percent * n // 100) + 1


def _describe(size: int):
    def run(batches):
        for b in byte_slices(batches, 4 << 20):
            h, edge = shingle_sets(b.column("text"), size)
            k1, k2 = set_keys(h, edge)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(edge), pa.int64()), pa.array(k1), pa.array(k2)], ["doc_id", "n_shingles", "k1", "k2"])

    return run


def _chosen(table: pa.Table, chosen: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, shingles and edges of the sets for which a row of the table stands; of equal rows the first."""
    ids, k1, k2, node = (chosen.column(c).to_pylist() for c in ("doc_id", "k1", "k2", "node"))
    want = dict(zip(zip(ids, k1, k2, strict=True), node, strict=True))
    held = set(ids)
    doc = table.column("doc_id").to_pylist()
    rows = [i for i, d in enumerate(doc) if d in held]
    h, edge = shingle_sets(table.column("text").combine_chunks().take(pa.array(rows, pa.int64())), size)
    a, b = set_keys(h, edge)
    found = {r: want.pop(key) for r, i in enumerate(rows) if (key := (doc[i], int(a[r]), int(b[r]))) in want}
    keep = list(found)
    mask = np.zeros(len(rows), bool)
    mask[keep] = True
    n = np.diff(edge)
    return np.array(list(found.values()), np.int64), h[np.repeat(mask, n)], np.concatenate([[0], np.cumsum(n[mask])])


def _survivors(docs: DataFrame, reps: DataFrame, size: int, percent: int, block_bytes: int) -> DataFrame:
    """The sets of which fewer tokens than a prefix are theirs alone, with their prefixes under each order.

    A set's other tokens can't hold a prefix token in common with another set, so it links with none.
    Tokens are counted exactly, each block of sets once, by buckets of the hash space.
    """
    _, total = text_bytes(docs)
    n = max(1, -(-total // block_bytes))
    buckets = n
    # rows without an id link with nothing and need no block
    docs, reps = docs.filter("doc_id IS NOT NULL").withColumn("block", hashed(n, "doc_id")), reps.withColumn("block", hashed(n, "doc_id"))

    def index(key: tuple, table: pa.Table, chosen: pa.Table) -> pa.Table:
        _, h, _ = _chosen(table, chosen, size)
        v, count = np.unique(h >> LOW_BITS << LOW_BITS, return_counts=True)
        edge = bucket_edges(v, buckets)
        full = np.flatnonzero(np.diff(edge))
        many = np.minimum(count, 255).astype(np.uint8)
        return pa.table({"bucket": pa.array(full, pa.int64()), "block": pa.array([key[0].as_py()] * len(full), pa.int32()), "body": pa.array([pack_sorted(v[edge[k] : edge[k + 1]]) for k in full], pa.binary()), "many": pa.array([many[edge[k] : edge[k + 1]].tobytes() for k in full], pa.binary())})

    def match(table: pa.Table) -> pa.Table:
        parts = [unpack_sorted(x) for x in table.column("body").to_pylist()]
        v = np.concatenate(parts)
        many = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("many").to_pylist()])
        order = np.argsort(v, kind="stable")
        s = v[order]
        head = np.concatenate([[True], s[1:] != s[:-1]])
        run = np.cumsum(head) - 1
        rank = np.empty(len(v), np.uint8)
        rank[order] = np.minimum(255, 8 * np.log2(np.bincount(run, weights=many[order]))).astype(np.uint8)[run]
        edge = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        out: dict[str, list] = {"bucket": [], "block": [], "hits": [], "rank": []}
        for k, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
            if len(hit := np.flatnonzero(rank[a:b])):
                for name, x in zip(out, (table.column("bucket")[k].as_py(), table.column("block")[k].as_py(), pack_u32(np.diff(hit, prepend=0)), rank[a:b][hit].tobytes()), strict=True):
                    out[name].append(x)
        return pa.table(out, schema=pa.schema([("bucket", pa.int64()), ("block", pa.int32()), ("hits", pa.binary()), ("rank", pa.binary())]))

    def survive(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        told = answers.column("bucket").is_valid()
        chosen, answers = answers.filter(pc.invert(told)), answers.filter(told)
        ids, h, edge = _chosen(table, chosen, size)
        v, inverse = np.unique(h >> LOW_BITS << LOW_BITS, return_inverse=True)
        cls = np.zeros(len(v), np.uint8)
        at = bucket_edges(v, buckets)
        for bucket, hits, rank in zip(*(answers.column(c).to_pylist() for c in ("bucket", "hits", "rank")), strict=True):
            cls[at[bucket] + np.cumsum(unpack_u32(hits).astype(np.int64))] = np.frombuffer(rank, np.uint8)
        cls = cls[inverse]
        own = np.concatenate([[0], np.cumsum(cls == 0)])
        out: dict[str, list] = {"node": [], "n": [], "tokens": [], **{f"prefix{k}": [] for k in range(ORDERS)}}
        for i, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
            p = prefix_length(b - a, percent)
            if own[b] - own[a] >= p:
                continue
            tokens, c = h[a:b], cls[a:b]
            for k in range(ORDERS):
                first = np.argsort((c.astype(np.uint64) << np.uint64(56)) | (mix(tokens ^ SEEDS[k]) >> np.uint64(8)))[:p]
                out[f"prefix{k}"].append(tokens[first[c[first] > 0]].view(np.int64).tolist())
            out["node"].append(int(ids[i]))
            out["n"].append(b - a)
            out["tokens"].append(tokens.tobytes())
        longs = pa.list_(pa.int64())
        return pa.table(out, schema=pa.schema([("node", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary()), *[(f"prefix{k}", longs) for k in range(ORDERS)]]))

    grouped = docs.groupBy("block")
    messages = grouped.cogroup(reps.groupBy("block")).applyInArrow(index, "bucket long, block int, body binary, many binary")
    answers = messages.groupBy("bucket").applyInArrow(match, "bucket long, block int, hits binary, rank binary")
    told = reps.select("block", "doc_id", "k1", "k2", "node").unionByName(answers, allowMissingColumns=True)
    return grouped.cogroup(told.groupBy("block")).applyInArrow(survive, "node long, n long, tokens binary, " + ", ".join(f"prefix{k} array<long>" for k in range(ORDERS)))


class _Groups:
    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    def join(self, x: int, y: int) -> int:
        x, y = sorted((self.find(x), self.find(y)))
        self.up[y] = x
        return x


def _solve(percent: int, final: bool = False):
    """Find what links among the sets of each part (column part), given the labels already known (column label).

    Candidates share a prefix token under every order and have near sizes; then the whole sets are compared. Sets
    already in one group aren't compared again. Returns a row (a, b) for each merger of labels.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("n", "ascending"), ("node", "ascending")])
        part, n, label = (table.column(c).to_pylist() for c in ("part", "n", "label"))
        tokens = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
        prefix = [table.column(f"prefix{k}").to_pylist() for k in range(ORDERS)]
        sets = [[frozenset(x) for x in p] for p in prefix[1:]]
        groups, posting, links, last = _Groups(), {}, [], None
        for i in range(len(part)):
            if part[i] != last:
                posting, last = {}, part[i]
            seen: set[int] = set()
            me = groups.find(label[i])
            for t in prefix[0][i]:
                held = posting.setdefault(t, {})
                for r in list(held):
                    if (now := groups.find(r)) != r:
                        held.setdefault(now, []).extend(held.pop(r))
                for r in list(held):
                    if groups.find(r) == me:
                        continue
                    for j in held[r]:
                        if j in seen:
                            continue
                        seen.add(j)
                        if 100 * n[j] < percent * n[i] or any(s[i].isdisjoint(s[j]) for s in sets):
                            continue
                        same = len(np.intersect1d(tokens[i], tokens[j], assume_unique=True))
                        if 100 * same >= percent * (n[i] + n[j] - same):
                            links.append((label[i], label[j]))
                            me = groups.join(label[i], label[j])
                            break
            for t in prefix[0][i]:
                posting[t].setdefault(me, []).append(i)
        if final:
            links = [(x, groups.find(x)) for x in label]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def _parts(sets: DataFrame, most: int) -> DataFrame:
    """The sets with their part (its smallest node) and its size; no link leaves a part.

    A part holds the sets that share prefix tokens under the first order, directly or by way of others. As links share prefix
    tokens under every order, parts of more than `most` sets are split further by those of the next orders.
    This only saves work in what follows.
    """
    part = stored(components(stars(sets.select("node", F.explode("prefix0").alias("key")))))
    for k in range(1, ORDERS + 1):
        count = part.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
        # a large part's rows are dealt by salt as well
        dealt = count.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        sized = part.withColumn("salt", hashed(SALTS, "node")).join(dealt, ["part", "salt"]).drop("salt")
        if k == ORDERS or count.filter(F.col("size") > most).isEmpty():
            return sets.join(sized, "node")
        large = stored(sized.filter(F.col("size") > most).select("node", "part"))
        keys = large.join(sets, "node").select("node", "part", F.explode(f"prefix{k}").alias("token")).select("node", F.struct("part", "token").alias("key"))
        finer = large.select("node").join(components(stars(keys)), "node", "left").select("node", F.coalesce("part", "node").alias("part"))
        part = stored(sized.filter(F.col("size") <= most).select("node", "part").union(finer))
    raise AssertionError


def ngram_groups(docs: DataFrame, size: int = 3, percent: int = 90, block_bytes: int = 6 << 20, most: int = 400) -> DataFrame:
    """Group documents by links: 100 * intersection >= percent * union of their sets of `size`-word shingles.

    Equal sets stand as one. Tokens (shingles) are ordered rarest first, with ties broken in ORDERS different ways; two
    sets that link share a token in their prefixes under every order. Sets that share prefix tokens form parts; inside a
    part candidates must pass the filters of all orders, then whole sets are compared. Parts of more than `most` sets are
    solved in chunks, then by one set for each group found, then, where a part still holds several groups, by pairs of
    chunks of the sets that share a prefix token with another group, so no link is lost.

    Returns doc_id, n_shingles, component_id (the smallest doc_id that links reach) for each row of docs.
    Words are `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; with fewer than `size` words the whole sequence is one shingle.
    Null, empty or blank text: no shingles and no links. Null doc_id: no links, component_id null. Rows that repeat a
    doc_id are judged each by its own text. An empty table gives no rows. Extra columns are not read.
    """
    docs = plain(docs, doc_id="long", text="string")
    sets = docs.mapInArrow(_describe(size), "doc_id long, n_shingles long, k1 long, k2 long")
    sets = stored(sets)
    reps = sets.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"))
    reps = stored(reps.withColumn("node", F.monotonically_increasing_id()))
    live = stored(_survivors(docs, reps, size, percent, block_bytes))
    ready = stored(_parts(live, PARTED * most).withColumn("label", F.col("node")))
    total = ready.agg(F.sum("n")).first()[0] or 0
    packs = max(1, -(-8 * total // block_bytes))
    label = ready.filter(F.col("size") <= most).groupBy(hashed(packs, "part").alias("pack")).applyInArrow(_solve(percent, True), "a long, b long").toDF("node", "part")
    large = ready.filter(F.col("size") > most)
    if not large.isEmpty():
        label = label.union(components(_large(large, percent, most)))
    label = stored(label)
    low = label.join(reps, "node").groupBy("part").agg(F.min("doc_id").alias("low"))
    named = reps.join(label.join(low, "part"), "node", "left").select("k1", "k2", F.coalesce("low", "doc_id").alias("component_id"))
    out = sets.join(named, ["k1", "k2"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))).alias("component_id"))


def _solved(rows: DataFrame, percent: int, *keys: str) -> DataFrame:
    """Links in each group. Groups hold few bytes for their work, so they are dealt over all partitions, not as few as the bytes ask for."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(rows.repartition(n, *keys).groupBy(*keys).applyInArrow(_solve(percent), "a long, b long"))


def _large(rows: DataFrame, percent: int, most: int) -> DataFrame:
    """Links (a, b) among the sets of large parts, enough to join all that any chain of links joins."""
    rows = rows.withColumn("chunks", F.ceil(F.col("size") / most).cast("int")).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    spread = lambda df, links: stored(df.join(components(links).select(F.col("node").alias("label"), F.col("part").alias("low")), "label", "left").withColumn("label", F.coalesce("low", "label")).drop("low"))
    one = _solved(rows, percent, "part", "chunk")
    rows = spread(rows, one)
    lead = rows.filter("label = node")
    turns = lead.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("turns"))
    lead = lead.join(turns, "part").withColumn("turn", F.pmod(F.xxhash64("node", F.lit(1)), F.col("turns")).cast("int"))
    two = _solved(lead, percent, "part", "turn")
    rows = spread(rows, two)
    split = rows.groupBy("part").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("part")
    open_ = rows.join(split, "part")
    # only sets with a prefix token that a set of another group has too
    keys = open_.select("part", "node", "label", F.explode("prefix0").alias("token"))
    mixed = keys.groupBy("part", "token").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("part", "token")
    rest = open_.join(keys.join(mixed, ["part", "token"]).select("node").distinct(), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rest = rest.withColumn("lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other"))
    return one.union(two).union(_solved(rest, percent, "part", "lo", "hi"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, of which each group keeps that with the smallest doc_id.

    Rows without a doc_id stay. Of rows that repeat a kept doc_id and its text one stays.
    """
    groups = stored(ngram_groups(docs, **options).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("component_id").alias("low"), F.count(F.lit(1)).alias("n")))
    gone = groups.filter("low < doc_id").select("doc_id")
    out = docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    if groups.filter("n > 1 AND low = doc_id").isEmpty():
        return out
    return out.filter("doc_id IS NULL").unionByName(out.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]))


def op6_ngram_join(docs: DataFrame) -> DataFrame:
    return ngram_groups(docs)


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: md5(array_to_string(w[i:i+2], ' '))) WHEN len(w) > 0 THEN [md5(array_to_string(w, ' '))] ELSE [] END) AS s FROM d),
u AS (SELECT DISTINCT doc_id, s FROM g),
n AS (SELECT doc_id, count(*) AS n FROM u GROUP BY doc_id),
k AS (SELECT s FROM u GROUP BY s HAVING count(*) > 1),
v AS (SELECT doc_id, s FROM u SEMI JOIN k USING (s)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM v a JOIN v b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id
FROM documents d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY ALL
"""
