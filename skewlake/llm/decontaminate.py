"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted-shingle check.

Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, plain

BITS, BLOCK = 64, 16
#: Sides of at most so many rows (of a few numbers each) are broadcast; larger ones are joined by shuffling.
SMALL = 200_000
#: Words of a document that get running sums together; longer where an item is longer.
TILE = 4096
HASHES = r"transform(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+', 0), x -> xxhash64(x))"


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL else df


def _shingles(words: str, size: int) -> str:
    """Hashes of the shingles of an array of word hashes, which must be a column."""
    return f"CASE WHEN size({words}) >= {size} THEN transform(sequence(0, size({words}) - {size}), i -> xxhash64({', '.join(f'{words}[i + {k}]' for k in range(size))})) END"


def _tagged(df: DataFrame, shingles: str, tags: str) -> DataFrame:
    """Sorted tags, one for each shingle: the first of equal ones for itself, the others hashed with their numbers.

    Plain overlap of tags is weighted overlap of shingles.
    """
    df = df.withColumn("sorted", F.expr(f"sort_array({shingles})"))
    df = df.withColumn("heads", F.expr("CASE WHEN size(array_distinct(sorted)) < size(sorted) THEN filter(sequence(0, size(sorted) - 1), i -> i = 0 OR sorted[i] <> sorted[greatest(i - 1, 0)]) END"))
    runs = "transform(sequence(0, size(heads) - 1), k -> transform(sequence(0, coalesce(get(heads, k + 1), size(sorted)) - heads[k] - 1), j -> IF(j = 0, sorted[heads[k]], xxhash64(sorted[heads[k]], j))))"
    return df.withColumn(tags, F.expr(f"CASE WHEN heads IS NULL THEN sorted ELSE sort_array(flatten({runs})) END")).drop("sorted", "heads")


class _Votes:
    """Votes for the bits of fingerprints, several counters to a long, so that plain sums count all bits of many words.

    most: the most words of a fingerprint; span: the most words that are ever summed. No counter then runs into the next, and
    differences of running sums are sums of the words between.
    """

    def __init__(self, most: int, span: int):
        self.width = max(1, most.bit_length())
        self.lanes = max(1, (62 - span.bit_length()) // self.width + 1)
        self.longs = -(-BITS // self.lanes)

    def bits(self, k: int) -> list[tuple[int, int]]:
        return [(j * self.width, b) for j in range(self.lanes) if (b := k + j * self.longs) < BITS]

    def of(self, word: str) -> list[Column]:
        return [F.expr(" + ".join(f"shiftleft(shiftrightunsigned({word}, {b}) & 1L, {at})" for at, b in self.bits(k))) for k in range(self.longs)]

    def fingerprint(self, votes: list[Column], words: Column) -> Column:
        """A bit is set if more than half of the words' hashes have it."""
        out = F.lit(0).cast("long")
        for k, v in enumerate(votes):
            for at, b in self.bits(k):
                count = F.shiftrightunsigned(v, at).bitwiseAND(F.lit((1 << self.width) - 1).cast("long"))
                out = out.bitwiseOR(F.when(count * 2 > words, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
        return out


def _blocks(fingerprint: str) -> list[Column]:
    """Blocks of bits, numbered."""
    return [F.expr(f"shiftleft({i}L, 32) | (shiftrightunsigned({fingerprint}, {i * BLOCK}) & {(1 << BLOCK) - 1}L)") for i in range(BITS // BLOCK)]


def _flips(most: int) -> list[int]:
    return [m for m in range(1 << BLOCK) if m.bit_count() <= most]


def _prefix(tags: str, percent: int) -> str:
    """The first tags: two sorted sets of a similarity of `percent` or more share one of these."""
    return f"slice({tags}, 1, size({tags}) - (size({tags}) * {percent} + 99) div 100 + 1)"


def find_leaks(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80, radius: int = 15) -> DataFrame:
    """doc_id, item_id, first_word, n_words, similarity: the best window of each document for each item that it repeats.

    Words are runs of letters and digits, lower-cased. Windows of as many words as an item has (fewer at either end of a document)
    begin at every word; those that hold no shingle of any item of that size have similarity 0 with all and get no
    fingerprint. All others get a 64-bit SimHash of their words, from running sums of votes over the document. Fingerprints
    are cut in four blocks; two within the radius differ by at most radius // 4 bits in one of them, and every such variant of the
    items' blocks is indexed, so the index gives every pair within the radius. Windows that hold enough shingles of
    items but lie beyond the radius are set against the items that share one of their first shingles, as
    many as `percent` leaves open. Then, for both, the multisets of `size`-word shingles must have 100 * (sum of minima) >=
    percent * (sum of maxima); no pair that has is left out.

    Null or empty texts, and texts of fewer than `size` words on either side, repeat nothing. Rows with a null doc_id or
    item_id can't be named and give none. Rows that repeat a doc_id, or items that repeat an item_id, give the best of
    their windows; of equal ones the first, of those the longest. Empty tables give no rows. Extra columns are not read.
    """
    items = plain(benchmark, item_id="long", text="string").filter("item_id IS NOT NULL").select("item_id", F.expr(HASHES).alias("w"))
    items = items.withColumn("s", F.expr(_shingles("w", size))).filter("s IS NOT NULL").withColumn("n", F.size("w"))
    items = cut(items.dropDuplicates(["item_id", "w"]).withColumn("item", F.monotonically_increasing_id()))
    top, n_items = items.agg(F.max("n"), F.count(F.lit(1))).first()
    tile = max(TILE, top or 0)
    votes = _Votes(top or 1, 2 * tile)
    sums = items.select("item", F.explode("w").alias("x")).groupBy("item").agg(*[F.sum(v).alias(f"v{k}") for k, v in enumerate(votes.of("x"))])
    prints = items.join(sums, "item").select("item", votes.fingerprint([F.col(f"v{k}") for k in range(votes.longs)], F.col("n")).alias("f"))
    items = cut(_tagged(items, "s", "t").join(prints, "item").select("item", "item_id", "n", "s", "f", "t"))
    places = cut(items.select(F.explode("s").alias("h"), "n").groupBy("h").agg(F.collect_set("n").alias("sizes")))

    texts = plain(docs, doc_id="long", text="string").filter("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("digest", F.xxhash64("text"))
    doc = ["doc_id", "digest"]
    shingles = texts.select(*doc, F.expr(HASHES).alias("w")).select(*doc, F.size("w").alias("total"), F.posexplode_outer(F.expr(_shingles("w", size))).alias("pos", "h"))
    hits = shingles.join(_small(places, places.count()), "h").select(*doc, "total", "pos", F.explode("sizes").alias("n"))
    # how many shingles of items of n words each window of n words holds, for runs of starts
    change = hits.select(*doc, "total", "n", F.explode(F.array(F.struct((F.col("pos") - F.col("n") + size).alias("lo"), F.lit(1).alias("d"), "pos"), F.struct((F.col("pos") + 1).alias("lo"), F.lit(-1).alias("d"), "pos"))).alias("e"))
    change = change.select(*doc, "total", "n", "e.*").distinct().groupBy(*doc, "total", "n", "lo").agg(F.sum("d").alias("d"))
    along = Window.partitionBy(*doc, "n").orderBy("lo")
    spans = change.select(*doc, "total", "n", "lo", F.sum("d").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("held"), (F.lead("lo").over(along) - 1).alias("hi"))
    spans = cut(spans.filter("held > 0"))
    first, at = F.greatest("start", F.lit(0)), F.greatest("lo", F.lit(0))
    tiles = spans.select(*doc, F.explode(F.sequence((at / tile).cast("int"), (F.greatest("hi", F.lit(0)) / tile).cast("int"))).alias("tile")).groupBy(*doc).agg(F.collect_set("tile").alias("tiles"))
    tiles = cut(tiles)
    near = texts.join(_small(tiles, tiles.agg(F.sum(F.size("tiles"))).first()[0] or 0), doc).select(*doc, "tiles", F.expr(HASHES).alias("w"))
    parts = near.select(*doc, F.explode("tiles").alias("tile"), "w").select(*doc, "tile", F.expr(f"slice(w, tile * {tile} + 1, {tile + (top or 0)})").alias("w"))
    parts = cut(parts.dropDuplicates([*doc, "tile"]).withColumn("s", F.expr(_shingles("w", size))))
    # running sums of votes, and those of each window as differences
    run = Window.partitionBy(*doc, "tile").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    words = parts.select(*doc, "tile", F.posexplode("w").alias("off", "x"))
    names = [f"v{k}" for k in range(votes.longs)]
    running = cut(words.select(*doc, "tile", "off", *[v.alias(c) for c, v in zip(names, votes.of("x"), strict=True)]).select(*doc, "tile", "off", *[F.sum(c).over(run).alias(c) for c in names]))
    windows = spans.select(*doc, "total", "n", "held", F.explode(F.sequence("lo", "hi")).alias("start"))
    windows = windows.select(*doc, "n", "held", first.alias("first_word"), (F.least(F.col("start") + F.col("n"), "total") - first).alias("n_words")).filter(F.col("n_words") >= size)
    windows = windows.withColumn("tile", (F.col("first_word") / tile).cast("int")).withColumn("begin", F.col("first_word") - F.col("tile") * tile)
    ends = running.select(*doc, "tile", F.col("off").alias("last"), *[F.col(c).alias(f"e{c}") for c in names])
    starts = running.select(*doc, "tile", (F.col("off") + 1).alias("begin"), *names)
    windows = windows.withColumn("last", F.col("begin") + F.col("n_words") - 1).join(ends, [*doc, "tile", "last"]).join(starts, [*doc, "tile", "begin"], "left")
    between = [(F.col(f"e{c}") - F.coalesce(c, F.lit(0))).alias(c) for c in names]
    one = [*doc, "n", "first_word", "n_words"]
    windows = windows.select(*one, "tile", "begin", "held", *between).select(*one, "tile", "begin", "held", votes.fingerprint([F.col(c) for c in names], F.col("n_words")).alias("g"))
    # `held` bounds the shingles that a window can have in common with an item
    windows = cut(windows.withColumn("dense", F.col("held") * (100 + percent) >= (F.col("n") + F.col("n_words") - 2 * (size - 1)) * percent))

    flips = radius // (BITS // BLOCK)
    variants = F.expr(f"array({', '.join(f'{m}L' for m in _flips(flips))})")
    index = items.select("item", "n", "f", F.explode(F.array(*_blocks("f"))).alias("block")).select("item", "n", "f", F.explode(variants).alias("m"), "block").select("item", "n", "f", F.col("block").bitwiseXOR(F.col("m")).alias("block"))
    asked = windows.select(*one, "dense", "g", F.explode(F.array(*_blocks("g"))).alias("block"))
    apart = F.bit_count(F.col("f").bitwiseXOR(F.col("g")))
    close = asked.join(_small(index, n_items * (BITS // BLOCK) * len(_flips(flips))), ["n", "block"]).filter(apart <= radius)
    close = close.filter("dense").select(*one, "item").distinct()
    dense = windows.filter("dense").join(parts, [*doc, "tile"]).select(*one, "g", F.expr(f"slice(s, begin + 1, n_words - {size - 1})").alias("s"))
    dense = cut(_tagged(dense, "s", "u").drop("s"))
    left = dense.select(*one, "g", F.explode(F.expr(_prefix("u", percent))).alias("tag"))
    right = items.select("item", "n", "f", F.explode(F.expr(_prefix("t", percent))).alias("tag"))
    far = left.join(_small(right, places.count()), ["n", "tag"]).filter(apart > radius).select(*one, "item").distinct()
    pairs = close.union(far).join(dense.drop("g"), one).join(_small(items.select("item", "item_id", "t"), n_items), "item")
    pairs = pairs.withColumn("same", F.size(F.array_intersect("t", "u"))).withColumn("all", F.size("t") + F.size("u") - F.col("same")).filter(F.col("same") * 100 >= F.col("all") * percent)
    best = F.max(F.struct((F.col("same") / F.col("all")).alias("similarity"), (-F.col("first_word")).alias("first"), "n_words"))
    return pairs.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", (-F.col("b.first")).cast("long").alias("first_word"), F.col("b.n_words").cast("long").alias("n_words"), "b.similarity")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that repeat no item. Of a repeated doc_id all rows go if one repeats an item; rows with a null doc_id are kept."""
    return docs.join(find_leaks(docs, benchmark, **options).select("doc_id").distinct(), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs, benchmark)


SQL = r"""
WITH i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
si AS (SELECT item_id, len(w) AS n, unnest(range(1, len(w) - 3)) AS p, w FROM i WHERE len(w) >= 5),
hi AS (SELECT item_id, n, p, array_to_string(w[p:p+4], ' ') AS s FROM si),
sd AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS p, w FROM d WHERE len(w) >= 5),
hd AS (SELECT doc_id, p, array_to_string(w[p:p+4], ' ') AS s FROM sd),
c AS (SELECT DISTINCT hd.doc_id, unnest(range(hd.p - x.n + 4, hd.p)) AS start, x.n FROM hd JOIN (SELECT DISTINCT s, n FROM hi) x USING (s)),
win AS (SELECT c.doc_id, greatest(start, 0) AS first_word, n, w[greatest(start, 0) + 1 : start + n] AS w FROM c JOIN d USING (doc_id)),
ws AS (SELECT doc_id, first_word, n, len(w) AS n_words, unnest(range(1, len(w) - 3)) AS p, w FROM win WHERE len(w) >= 5),
hw AS (SELECT doc_id, first_word, n, n_words, array_to_string(w[p:p+4], ' ') AS s, count(*) AS k FROM ws GROUP BY ALL),
ci AS (SELECT item_id, n, s, count(*) AS k FROM hi GROUP BY ALL),
tw AS (SELECT doc_id, first_word, n, n_words, sum(k) AS total FROM hw GROUP BY ALL),
ti AS (SELECT item_id, sum(k) AS total FROM ci GROUP BY ALL),
j AS (SELECT hw.doc_id, hw.first_word, hw.n, hw.n_words, ci.item_id, sum(least(hw.k, ci.k)) AS same FROM hw JOIN ci ON hw.s = ci.s AND hw.n = ci.n GROUP BY ALL),
r AS (SELECT j.*, tw.total + ti.total - same AS u FROM j JOIN tw ON j.doc_id = tw.doc_id AND j.first_word = tw.first_word AND j.n = tw.n AND j.n_words = tw.n_words JOIN ti ON ti.item_id = j.item_id)
SELECT doc_id, item_id, CAST(first_word AS BIGINT) AS first_word, CAST(n_words AS BIGINT) AS n_words, CAST(same AS DOUBLE) / u AS similarity
FROM r WHERE 100 * same >= 80 * u
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY CAST(same AS DOUBLE) / u DESC, first_word, n_words DESC) = 1
"""
