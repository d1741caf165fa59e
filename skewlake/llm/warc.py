"""WARC archives with revisit records, and their index merged from sorted runs."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, plain, shared_dir, text_bytes

#: Payloads of at least so many bytes are written once.
LEAST = 100
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Bytes of payload that a file holds on average, and rows of the index that one task merges.
FILE_BYTES, MERGED = 32 << 20, 200_000
RUN = "run string, turn long, url_key string, captured timestamp, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
ROW = pa.schema([("run", pa.string()), ("turn", pa.int64()), ("url_key", pa.string()), ("captured", pa.timestamp("us", "UTC")), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])


def write_warc(pages: DataFrame, path: str, records_per_file: int | None = None) -> None:
    """Write a record for each row, gzipped, as many to a file as hold about FILE_BYTES, 2000 at most.

    Of rows with equal payloads (html in UTF-8; null is empty) of LEAST bytes or more, that with the smallest page_id is a response and the others
    revisit it; rows that repeat that page_id are responses too, and rows with a null page_id never stand for others.
    The record's identifier holds the page_id; its date is the start of 2024 and page_id seconds. A null url has no header.
    """
    p = plain(pages, page_id="long", url="string", html="string")
    if records_per_file is None:
        rows, size = text_bytes(p, "html")
        records_per_file = max(1, min(2000, FILE_BYTES * rows // max(1, size)))
    p = p.withColumn("html", F.coalesce("html", F.lit("")))
    p = p.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("size", F.octet_length("html"))
    first = p.filter(F.col("size") >= LEAST).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    p = p.join(first, "digest", "left").withColumn("refers", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    block = F.concat(F.lit(HTTP), F.when(F.col("refers").isNull(), F.col("html")).otherwise(F.lit("")))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    line = lambda head, c: F.coalesce(F.concat(F.lit(f"{head}: "), c, F.lit("\r\n")), F.lit(""))
    date = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 30))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind = F.when(F.col("refers").isNull(), "response").otherwise("revisit")
    record = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", name(F.coalesce(F.col("page_id").cast("string"), F.lit("none")))),
        line("WARC-Target-URI", F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))), line("WARC-Date", date), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        line("WARC-Refers-To", name(F.col("refers"))), F.when(F.col("refers").isNotNull(), "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n").otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block,
    )
    p.select(record.alias("value")).write.options(lineSep="\r\n\r\n", compression="gzip", maxRecordsPerFile=str(records_per_file)).text(path)


def records(body: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive; lengths come from Content-Length, never from the payload."""
    at = 0
    while at < len(body):
        end = body.index(b"\r\n\r\n", at)
        lines = body[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        yield head, body[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def url_key(url: str | None) -> str:
    """Sort key of a URL: host read from its end, then path and query, all in lower case; fragment and scheme dropped."""
    if url is None:
        return ""
    try:
        u = urlsplit(url.strip().lower())
        host = u.hostname or ""
    except ValueError:
        return url.strip().lower()
    return ",".join(reversed(host.removeprefix("www.").split("."))) + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives; each file is a run, sorted by URL key, time and page_id. Digests are of the payloads as read."""

    def run(batches):
        for b in batches:
            for name, body in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                rows = []
                for head, block in records(zlib.decompress(body.as_buffer(), wbits=31)):
                    ident = re.fullmatch(r"<urn:page:(-?\d+|none)>", head["WARC-Record-ID"])[1]
                    refers = re.fullmatch(r"<urn:page:(-?\d+)>", head.get("WARC-Refers-To", ""))
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    told = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    if not refers and hashlib.sha256(payload).hexdigest() != told:
                        raise ValueError(f"{name}: payload of {head['WARC-Record-ID']} differs from its digest")
                    url = head.get("WARC-Target-URI")
                    rows.append((url_key(url), head["WARC-Date"], -1 if ident == "none" else int(ident), ident == "none", url, head["WARC-Type"], None if refers else len(payload), told, int(refers[1]) if refers else None))
                rows.sort(key=lambda r: r[:3])
                c = list(zip(*rows, strict=True)) or [()] * 9
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int64()), pa.array(c[0], pa.string()), pa.array([x.replace("Z", "") for x in c[1]], pa.string()).cast(pa.timestamp("us")).cast(pa.timestamp("us", "UTC")), pa.array([None if none else x for x, none in zip(c[2], c[3], strict=True)], pa.int64()), pa.array(c[4], pa.string()), pa.array(c[5], pa.string()), pa.array(c[6], pa.int64()), pa.array(c[7], pa.string()), pa.array(c[8], pa.int64())], schema=ROW)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, RUN)


class LoserTree:
    """Merges sorted lists: inner nodes hold the losers of their matches, so each step replays one path."""

    def __init__(self, lists: list[list]):
        self.lists, self.at, self.k = lists, [0] * len(lists), len(lists)
        self.tree = [-1] * max(1, self.k)
        for i in range(self.k):
            self._replay(i)

    def _less(self, i: int, j: int) -> bool:
        if self.at[i] >= len(self.lists[i]):
            return False
        if self.at[j] >= len(self.lists[j]):
            return True
        return (self.lists[i][self.at[i]], i) < (self.lists[j][self.at[j]], j)

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            other = self.tree[node]
            if other < 0:  # the first to come waits for its match
                self.tree[node] = winner
                return
            if self._less(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """Number of the list and place in it of each item, in order."""
        if not self.k:
            return
        while True:
            w = self.tree[0]
            if self.at[w] >= len(self.lists[w]):
                return
            yield w, self.at[w]
            self.at[w] += 1
            self._replay(w)


def merge_runs(runs: DataFrame) -> DataFrame:
    """The runs as one index with part and place: by these it is ordered by URL key, time and page_id over all rows.

    The range of each part is cut from a sample of the keys (with time and page_id, so that a frequent URL is shared out), MERGED rows to a part on
    average; every run gives each range a sorted slice, and the slices are merged by a loser tree. Ties go to the run that sorts first.
    """
    runs = cut(runs.select(*ROW.names))
    schema = pa.schema([*ROW, ("part", pa.int32()), ("place", pa.int64())])

    def merge(batches):
        table = pa.Table.from_batches(list(batches)).sort_by([("run", "ascending"), ("turn", "ascending")])
        name = table.column("run").to_pylist()
        keys = list(zip(table.column("url_key").to_pylist(), table.column("captured").cast(pa.int64()).to_pylist(), [-1 if x is None else x for x in table.column("page_id").to_pylist()], strict=True))
        heads = [i for i in range(len(name)) if not i or name[i] != name[i - 1]]
        lists = [keys[a:b] for a, b in zip(heads, [*heads[1:], len(name)], strict=False)]
        order = [heads[w] + at for w, at in LoserTree(lists)]
        table = table.take(pa.array(order, pa.int64()))
        table = table.append_column("part", pa.array([TaskContext.get().partitionId()] * len(order), pa.int32())).append_column("place", pa.array(range(len(order)), pa.int64()))
        yield from table.select(schema.names).cast(schema).combine_chunks().to_batches()

    def some(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            yield from merge(held)

    parts = max(1, runs.count() // MERGED)
    return runs.repartitionByRange(parts, "url_key", "captured", "page_id").mapInArrow(some, f"{RUN}, part int, place long")


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the archives, read them back, and give the merged capture index with each record's full payload size.

    The rows keep the order of the merge in part and place. Null html: an empty payload. Null url: the empty key, first in
    order. Null page_id: a row of its own. Repeated rows each give a record. An empty table gives none. Extra columns are
    not read.
    """
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, path)
    runs = cut(read_runs(spark, path))
    full = runs.filter("record_type = 'response' AND page_id IS NOT NULL").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("full"))
    sized = runs.join(full, ["refers_to", "payload_digest"], "left").withColumn("payload_bytes", F.coalesce("payload_bytes", "full"))
    return merge_runs(sized)


def op8_warc(pages: DataFrame) -> DataFrame:
    return round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS low FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= {LEAST} AND page_id <> low THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN payload_bytes >= {LEAST} AND page_id <> low THEN low END AS refers_to FROM m
"""
