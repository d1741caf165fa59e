"""Sources, sinks, and incremental ingest."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from .. import config, schemas
from ..functions import scalars as S
from ..operators import clean, joins
from ..operators import ingest as I
from ..operators.backfill import Backfill
from ..operators.bars import BAR_KEY, CONTRACT, Bars
from ..sources import tables as T
from ..sources.store import bucket
from .base import CHAINS, CQ, attempts, bars, chains, cleaned, daily, query, text_of


@query("SELECT symbol, strike, expiry, option_type, what_to_show, bar_ts, close, volume FROM fx_option_bars WHERE is_incoming = 0 AND symbol IN ('S1', 'S3') AND what_to_show = 'TRADES' AND bar_ts >= TIMESTAMP '1996-01-01' AND bar_ts < TIMESTAMP '1997-01-01'")
def scan_bars(spark, d):
    return T.scan_bars(bars(spark, d, 0), ["S1", "S3"], "TRADES", F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'"), F.expr("TIMESTAMP_NTZ '1997-01-01 00:00:00'"))


@query("SELECT symbol, trade_date, open, high, low, close, volume FROM fx_underlying_bars WHERE symbol = 'U1' AND trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def scan_underlying_daily(spark, d):
    return T.scan_daily(daily(spark, d), "U1", F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date"))


@query(f"WITH {CHAINS} SELECT symbol, exchange, trading_class, array_to_string(strikes, ',') AS strikes, array_to_string(expirations, ',') AS expirations FROM ch WHERE exchange = 'CBOE'")
def scan_chain(spark, d):
    return T.scan_chain(chains(spark, d), "CBOE").select("symbol", "exchange", "trading_class", text_of("strikes").alias("strikes"), text_of("expirations").alias("expirations"))


NEW_BARS = """a AS (SELECT *, row_number() OVER (PARTITION BY symbol, strike, expiry, option_type, what_to_show, bar_ts ORDER BY close, volume) AS rn FROM fx_option_bars WHERE is_incoming = 1),
nb AS (SELECT symbol, strike, expiry, option_type, what_to_show, bar_ts, close, volume FROM a ANTI JOIN (SELECT * FROM fx_option_bars WHERE is_incoming = 0) s USING (symbol, strike, expiry, option_type, what_to_show, bar_ts) WHERE rn = 1)"""


@query(f"WITH {NEW_BARS} SELECT * FROM nb")
def insert_new_bars(spark, d):
    return I.insert_new(bars(spark, d, 0), bars(spark, d, 1), BAR_KEY, ["close", "volume"])


def _held(spark, d):
    """A store with the bars that aren't arriving, and the latest of each contract."""
    held = Bars(T.fresh_store(spark))
    held.store.publish(held.changes(held.store.stage("bars", bars(spark, d, 0), held.part)))
    return held


@query(f"WITH {NEW_BARS} SELECT * FROM nb")
def insert_touched_months(spark, d):
    """The insertion into a table of months: the keys of those that arriving bars touch are read, new bars join them. The rows are those that were stored."""
    held = _held(spark, d)
    return held.store.staged(held.insert(bars(spark, d, 1), ["close", "volume"]))


@query("SELECT symbol, strike, expiry, option_type, what_to_show, max(bar_ts) AS latest FROM fx_option_bars GROUP BY ALL")
def latest_bar_kept(spark, d):
    """The latest bar of each contract after the arriving bars went in, from the maxima that are kept beside the bars."""
    held = _held(spark, d)
    held.insert(bars(spark, d, 1), ["close", "volume"])
    return held.latest()


@query("SELECT * FROM fx_underlying_bars WHERE day(trade_date) % 2 = 1")
def insert_new_underlying(spark, d):
    every = daily(spark, d)
    return I.insert_new(every.filter(F.day("trade_date") % 2 == 0), every.union(every), schemas.UNDERLYING_BARS_KEY, ["close"])


@query(f"WITH {CQ} SELECT symbol, snapshot_time, count(*) AS n_written, count(bid) AS n_bids, max(underlying_price) AS price, count(*) FILTER (WHERE incomplete = 0) AS contracts_processed, CASE WHEN count(*) FILTER (WHERE incomplete = 0) > 0 THEN 'COMPLETED' ELSE 'FAILED' END AS status FROM sq GROUP BY ALL")
def write_quote_snapshot(spark, d):
    quotes, underlying, done = T.write_snapshot(T.fresh_store(spark), cleaned(spark, d), clean.complete_reading())
    by = ["symbol", "snapshot_time"]
    back = quotes.groupBy(*by).agg(F.count(F.lit(1)).alias("n_written"), F.count("bid").alias("n_bids"))
    return back.join(underlying, by).join(done.select(*by, "contracts_processed", "status"), by)


@query("SELECT batch_id, contract_id, status FROM fx_attempts")
def read_progress(spark, d):
    return attempts(spark, d).select("batch_id", "contract_id", "status")


@query("SELECT batch_id, contract_id, attempt_seq, status FROM fx_attempts WHERE batch_id <> 'B7'")
def delete_batch(spark, d):
    """The table after the deletion; only the bucket that may hold the batch is read and written anew."""
    store, part = T.fresh_store(spark), bucket(16, "batch_id")
    store.publish([store.stage("attempts", attempts(spark, d).select("batch_id", "contract_id", "attempt_seq", "status"), part)])
    where = store.touched(spark.range(1).select(F.lit("B7").alias("batch_id")), part)
    store.publish([store.without("attempts", F.col("batch_id") == "B7", part, where)])
    return store.read("attempts")


@query("SELECT batch_id, arg_max(contract_id, attempt_seq) AS contract_id, max(attempt_seq) AS attempt_seq, arg_max(status, attempt_seq) AS status FROM fx_attempts GROUP BY batch_id")
def upsert_progress(spark, d):
    """A table of batches by bucket, into which later rows are put by key; buckets without such rows keep their files."""
    store, part = T.fresh_store(spark), bucket(16, "batch_id")
    log = T.write_and_read(attempts(spark, d).select("batch_id", "contract_id", "attempt_seq", "status"), [])
    put = lambda stored, new: I.upsert(stored, new, schemas.PROGRESS_KEY, "attempt_seq")
    for turn in (0, 1):
        store.publish([store.rewrite("progress", log.filter(F.col("attempt_seq") % 2 == turn), part, put)])
    return store.read("progress")


@query("SELECT batch_id, contract_id, attempt_seq, ts, status FROM fx_attempts")
def jdbc_io(spark, d):
    """The log written to a relational store and read back in parts. Without DB_URL the store is an embedded one in this process, for local sessions."""
    url = os.environ.get("DB_URL", f"jdbc:derby:memory:market-{uuid.uuid4().hex};create=true")
    T.write_jdbc(attempts(spark, d).select("batch_id", "contract_id", "attempt_seq", "ts", "status"), "attempts", 4, url, "overwrite")
    return T.read_jdbc_split(spark, "attempts", "attempt_seq", 8, url).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""WITH w AS (SELECT DISTINCT symbol, strike, expiry, option_type, what_to_show, CAST(bar_ts AS DATE) AS trade_date FROM fx_option_bars WHERE is_incoming = 1),
h AS (SELECT DISTINCT symbol, strike, expiry, option_type, what_to_show, CAST(bar_ts AS DATE) AS trade_date FROM fx_option_bars WHERE is_incoming = 0)
SELECT w.* FROM w SEMI JOIN h USING (symbol, strike, expiry, option_type, what_to_show, trade_date)""")
def trade_day_rows_exist(spark, d):
    wanted = bars(spark, d, 1).select(*CONTRACT, F.to_date("bar_ts").alias("trade_date")).distinct()
    return I.verify_written(wanted, bars(spark, d, 0), CONTRACT, "trade_date", "bar_ts")


RESOLVED = """rq AS (SELECT symbol, strike, expiry, option_type, what_to_show, CAST(min(bar_ts) AS DATE) AS start_date, CAST(max(bar_ts) AS DATE) + 1 AS end_date FROM fx_option_bars WHERE is_incoming = 1 GROUP BY ALL),
lt AS (SELECT symbol, strike, expiry, option_type, what_to_show, max(bar_ts) AS latest FROM fx_option_bars WHERE is_incoming = 0 GROUP BY ALL),
hd AS (SELECT symbol, strike, expiry, option_type, what_to_show, min(bar_ts) AS head_ts FROM fx_option_bars WHERE volume > 25 GROUP BY ALL),
rs AS (SELECT rq.*, greatest(start_date, coalesce(CAST(latest AS DATE), CASE WHEN end_date - start_date <= 1 THEN start_date END, CAST(head_ts AS DATE), start_date)) AS resolved_start
FROM rq LEFT JOIN lt USING (symbol, strike, expiry, option_type, what_to_show) LEFT JOIN hd USING (symbol, strike, expiry, option_type, what_to_show))"""


def _resolved(spark, d, latest=None):
    asked = bars(spark, d, 1).groupBy(*CONTRACT).agg(F.to_date(F.min("bar_ts")).alias("start_date"), F.date_add(F.to_date(F.max("bar_ts")), 1).alias("end_date"))
    heads = bars(spark, d).filter("volume > 25").groupBy(*CONTRACT).agg(F.min("bar_ts").alias("head_ts"))
    latest = I.latest_bar(bars(spark, d, 0), CONTRACT, "bar_ts") if latest is None else latest(asked)
    return I.resolve_start(asked, latest, heads, CONTRACT)


def resolved(every):
    """The same from one pass over stored and arriving bars, told apart by is_incoming."""
    new, ts = F.col("is_incoming") == 1, F.col("bar_ts")
    facts = every.groupBy(*CONTRACT).agg(
        F.to_date(F.min(F.when(new, ts))).alias("start_date"), F.date_add(F.to_date(F.max(F.when(new, ts))), 1).alias("end_date"),
        F.max(F.when(~new, ts)).alias("latest"), F.min(F.when(F.col("volume") > 25, ts)).alias("head_ts"),
    )
    return facts.filter("start_date IS NOT NULL").withColumn("resolved_start", I.start_of(F.col("start_date"), F.col("end_date"), F.col("latest"), F.col("head_ts")))


@query(f"WITH {RESOLVED} SELECT * FROM rs")
def resolve_start_date(spark, d):
    return _resolved(spark, d)


@query(f"WITH {RESOLVED} SELECT * FROM rs")
def resolve_start_kept(spark, d):
    """The same from the latest bars that are kept, of the contracts that are asked for; no stored bar is read."""
    return _resolved(spark, d, _held(spark, d).latest)


@query(f"WITH {RESOLVED} SELECT * FROM rs WHERE resolved_start <= end_date")
def eligible_requests(spark, d):
    return I.eligible_requests(_resolved(spark, d))


GAPS = """dd AS (SELECT symbol, trade_date, lag(trade_date) OVER w AS b, lead(trade_date) OVER w AS a FROM fx_underlying_bars WHERE trade_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28' WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)),
gp AS (SELECT symbol, coalesce(b + 1, DATE '2024-01-03') AS range_start, trade_date - 1 AS range_end FROM dd UNION ALL SELECT symbol, trade_date + 1, DATE '2024-01-28' FROM dd WHERE a IS NULL),
mr AS (SELECT * FROM gp WHERE range_start <= range_end UNION ALL SELECT 'U9', DATE '2024-01-03', DATE '2024-01-28')"""


def _gaps(spark, d):
    stored = daily(spark, d)
    span = lambda df: df.select("symbol", F.lit("2024-01-03").cast("date").alias("start_date"), F.lit("2024-01-28").cast("date").alias("end_date"))
    asked = span(stored.select("symbol").distinct()).union(span(spark.range(1).select(F.lit("U9").alias("symbol"))))
    return I.missing_ranges(stored, asked)


@query(f"WITH {GAPS} SELECT * FROM mr")
def missing_ranges(spark, d):
    return _gaps(spark, d)


@query("""WITH s AS (SELECT symbol, min(trade_date) AS start_date, max(trade_date) AS end_date FROM fx_underlying_bars GROUP BY symbol),
b AS (SELECT s.*, z.bar_size, z.m FROM s, (VALUES ('1 min', 3), ('5 mins', 15), ('15 mins', 46), ('1 hour', 171), ('1 day', 1200)) AS z(bar_size, m)),
k AS (SELECT *, CAST(unnest(range(0, end_date - start_date, m + 1)) AS INTEGER) AS o FROM b)
SELECT symbol, bar_size, start_date, end_date, start_date + o AS chunk_start, least(start_date + o + m, end_date) AS chunk_end FROM k""")
def date_chunks(spark, d):
    spans = daily(spark, d).groupBy("symbol").agg(F.min("trade_date").alias("start_date"), F.max("trade_date").alias("end_date"))
    sizes = config.bar_sizes(spark)
    ranges = spans.withColumn("bar_size", F.explode(F.array(*[F.lit(n) for n, _ in config.BARS_PER_DAY])))
    return I.date_chunks(ranges, sizes)


@query("""SELECT t.event_id, t.symbol, CAST(t.ts AS DATE) AS trade_date, t.last, u.close AS underlying_price FROM fx_ticks t JOIN fx_underlying_bars u ON u.symbol = t.symbol AND u.trade_date = CAST(t.ts AS DATE)""")
def attach_underlying_close(spark, d):
    from .base import ticks

    out = I.attach_close(ticks(spark, d), daily(spark, d), "ts")
    return out.select("event_id", "symbol", "trade_date", "last", "underlying_price")


@query(f"WITH {CQ}, u AS (SELECT symbol, snapshot_time, max(underlying_price) AS price FROM fx_quotes GROUP BY ALL) SELECT cq.symbol, cq.snapshot_time, expiry, strike, option_type, u.price AS spot FROM cq JOIN u ON u.symbol = cq.symbol AND u.snapshot_time = cq.snapshot_time")
def attach_spot(spark, d):
    q = cleaned(spark, d)
    under = q.groupBy("symbol", "snapshot_time").agg(F.max("underlying_price").alias("price"))
    return joins.attach_spot(q, under).select("symbol", "snapshot_time", "expiry", "strike", "option_type", "spot")


@query("""SELECT w.symbol, w.snapshot_time, w.expiry, w.strike, w.option_type, q.bid, q.ask, q.symbol IS NULL AS to_fetch
FROM (SELECT DISTINCT symbol, snapshot_time, expiry, strike + 1e-8 AS strike, o AS option_type FROM fx_quotes, (SELECT unnest(['C', 'P']) AS o)) w
LEFT JOIN (SELECT *, CASE WHEN bid > 0 THEN bid END AS b, CASE WHEN ask > 0 THEN ask END AS a FROM fx_quotes) q ON q.symbol = w.symbol AND q.snapshot_time = w.snapshot_time AND q.expiry = w.expiry AND round(q.strike, 6) = round(w.strike, 6) AND q.option_type = w.option_type""")
def reading_lookup(spark, d):
    from .base import quotes

    q = quotes(spark, d)
    wanted = q.select("symbol", "snapshot_time", "expiry", (F.col("strike") + 1e-8).alias("strike")).distinct().withColumn("option_type", F.explode(F.array(F.lit("C"), F.lit("P"))))
    return joins.reading_lookup(wanted, q)


@query("""WITH m AS (SELECT *, epoch_us(ts) AS us, CASE WHEN what_to_show = 'BID_ASK' THEN 2 ELSE 1 END AS cost FROM fx_attempts)
SELECT batch_id, contract_id, attempt_seq, ts, status, what_to_show, cost, CAST(sum(cost) OVER w AS BIGINT) AS window_cost, sum(cost) OVER w > 56 AS over_budget FROM m WINDOW w AS (PARTITION BY contract_id % 8 ORDER BY us RANGE BETWEEN 599999999 PRECEDING AND CURRENT ROW)""")
def rolling_request_cost(spark, d):
    log = attempts(spark, d).withColumn("client", F.col("contract_id") % 8)
    return I.rolling_cost(log, ["client"], "ts", S.request_cost(F.col("what_to_show"))).drop("client")


@query(f"""WITH {RESOLVED}, rc AS (SELECT *, unnest(range(0, end_date - resolved_start, 172)) AS o FROM rs WHERE resolved_start <= end_date),
ck AS (SELECT symbol, strike, expiry, option_type, what_to_show, resolved_start + CAST(o AS INTEGER) AS chunk_start, least(resolved_start + CAST(o AS INTEGER) + 171, end_date) AS chunk_end FROM rc),
ld AS (SELECT b.* FROM fx_option_bars b JOIN ck USING (symbol, strike, expiry, option_type, what_to_show) WHERE is_incoming = 1 AND CAST(bar_ts AS DATE) BETWEEN chunk_start AND chunk_end),
a AS (SELECT *, row_number() OVER (PARTITION BY symbol, strike, expiry, option_type, what_to_show, bar_ts ORDER BY close, volume) AS rn FROM ld),
nb AS (SELECT symbol, strike, expiry, option_type, what_to_show, bar_ts FROM a ANTI JOIN (SELECT * FROM fx_option_bars WHERE is_incoming = 0) s USING (symbol, strike, expiry, option_type, what_to_show, bar_ts) WHERE rn = 1),
al AS (SELECT symbol, strike, expiry, option_type, what_to_show, bar_ts FROM fx_option_bars WHERE is_incoming = 0 UNION ALL SELECT * FROM nb),
w AS (SELECT DISTINCT symbol, strike, expiry, option_type, what_to_show, CAST(bar_ts AS DATE) AS trade_date FROM ld),
v AS (SELECT w.symbol, count(*) AS expected, count(h.symbol) AS completed FROM w LEFT JOIN (SELECT DISTINCT symbol, strike, expiry, option_type, what_to_show, CAST(bar_ts AS DATE) AS trade_date FROM al) h USING (symbol, strike, expiry, option_type, what_to_show, trade_date) GROUP BY w.symbol),
c AS (SELECT symbol, count(DISTINCT (strike, expiry, option_type, what_to_show)) AS n_contracts, count(*) AS n_chunks FROM ck GROUP BY symbol)
SELECT c.symbol, n_contracts, n_chunks, coalesce(n_new, 0) AS n_new, expected, completed, CASE WHEN completed > 0 THEN 'COMPLETED' ELSE 'FAILED' END AS status FROM c LEFT JOIN v ON v.symbol = c.symbol LEFT JOIN (SELECT symbol, count(*) AS n_new FROM nb GROUP BY symbol) n ON n.symbol = c.symbol""")
def bar_backfill(spark, d):
    """Where each contract's request starts, put on the list of work, leased, cut in chunks and loaded; bars and states in one commit."""
    every = T.write_and_read(bars(spark, d), [])
    job = Backfill(T.fresh_store(spark), bar_part=F.date_format("bar_ts", "yyyy"))
    job.store.publish([job.store.stage("bars", every.filter("is_incoming = 0").drop("is_incoming"), job.bars.part)])
    asked = resolved(every).filter("resolved_start <= end_date").select(*CONTRACT, F.col("resolved_start").alias("start_date"), "end_date", F.lit("1 hour").alias("bar_size"))
    job.run("first", asked, clean.normalize_bars(every.filter("is_incoming = 1").drop("is_incoming"), distinct=False), dt.datetime(2024, 1, 20, 12))
    return job.rollup()
