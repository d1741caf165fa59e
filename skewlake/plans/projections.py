"""Cleaning, scalar functions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..functions import pricing
from ..operators import clean, joins, progress
from ..operators import universe as U
from .base import asof, CQ, now, STATES, S, attempts, bars, cleaned, daily, expiries, query, quotes, strikes, table, view

QUOTE_COLUMNS = ["symbol", "snapshot_time", "expiry", "strike", "option_type"]


@query(f"WITH {CQ} SELECT * FROM cq")
def clean_quotes(spark, d):
    return cleaned(spark, d)


@query("SELECT DISTINCT symbol, strike, expiry, option_type, what_to_show, bar_ts, CASE WHEN NOT isnan(close) THEN close END AS close, volume FROM fx_option_bars")
def normalize_bars(spark, d):
    return clean.normalize_bars(bars(spark, d).drop("is_incoming").withColumns({"average": F.lit(0.0), "barCount": F.lit(1)}))


@query("""SELECT b.symbol, b.strike, b.expiry, b.option_type, b.bar_ts, b.close, c.n_bars, md5(b.symbol || '_' || 'run') AS collection_batch
FROM (SELECT * FROM fx_option_bars WHERE is_incoming = 1) b JOIN (SELECT symbol, strike, expiry, option_type, count(*) AS n_bars FROM fx_option_bars GROUP BY ALL) c
ON b.symbol = c.symbol AND b.strike = c.strike AND b.expiry = c.expiry AND b.option_type = c.option_type""")
def tag_bars(spark, d):
    key = ["symbol", "strike", "expiry", "option_type"]
    contracts = bars(spark, d).groupBy(*key).agg(F.count(F.lit(1)).alias("n_bars"))
    rows = bars(spark, d, 1).select(*key, "bar_ts", "close")
    return clean.tag_bars(rows, contracts, key, S.batch_id(F.col("symbol"), F.lit("run")))


@query("SELECT c_custkey, CASE WHEN upper(trim(s)) = 'SPXW' THEN 'SPX' ELSE upper(trim(s)) END AS symbol FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN ' spxw ' ELSE lower(c_mktsegment) END AS s FROM customer)")
def normalize_symbol(spark, d):
    raw = F.when(F.col("c_custkey") % 3 == 0, " spxw ").otherwise(F.lower("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", S.normalize_symbol(raw).alias("symbol"))


SYMBOLS = "CASE s_suppkey % 4 WHEN 0 THEN 'SPX' WHEN 1 THEN 'NDX' WHEN 2 THEN 'AVGO' ELSE 'GE' END"


@query(f"""SELECT s_suppkey, symbol, CASE WHEN symbol IN ('SPX', 'SPXW') THEN 'IND' ELSE 'STK' END AS kind,
CASE symbol WHEN 'SPX' THEN 'CBOE' WHEN 'NDX' THEN 'NASDAQ' ELSE 'SMART' END AS exchange FROM (SELECT s_suppkey, {SYMBOLS} AS symbol FROM supplier)""")
def classify_instrument(spark, d):
    return joins.classify_instruments(table(spark, d, "supplier").select("s_suppkey", F.expr(SYMBOLS).alias("symbol")), config.exchanges(spark))


@query(f"SELECT s_suppkey, symbol, CASE WHEN symbol = 'AVGO' THEN 'BID_ASK' ELSE 'TRADES' END AS what_to_show FROM (SELECT s_suppkey, {SYMBOLS} AS symbol FROM supplier)")
def what_to_show(spark, d):
    return joins.what_to_show(table(spark, d, "supplier").select("s_suppkey", F.expr(SYMBOLS).alias("symbol")), config.symbol_settings(spark))


@query("SELECT symbol, expiry, CASE WHEN symbol = 'SPX' AND expiry - DATE '2024-01-02' <= 30 THEN 'SPXW' END AS trading_class FROM (SELECT DISTINCT CASE WHEN symbol = 'S1' THEN 'SPX' ELSE symbol END AS symbol, expiry FROM fx_quotes)")
def trading_class(spark, d):
    q = quotes(spark, d).select(F.when(F.col("symbol") == "S1", "SPX").otherwise(F.col("symbol")).alias("symbol"), "expiry").distinct()
    return q.withColumn("trading_class", S.trading_class(F.col("symbol"), S.dte(F.col("expiry"), asof())))


@query("SELECT doc_id, left(text, 500) AS error_message FROM documents")
def truncate_error(spark, d):
    return table(spark, d, "documents").select("doc_id", S.truncate_error(F.col("text")).alias("error_message"))


@query("SELECT event_id, ts FROM events WHERE isodow(ts) <= 5 AND CAST(ts AS TIME) >= TIME '09:30:00' AND CAST(ts AS TIME) <= TIME '16:15:00'")
def market_hours(spark, d):
    return table(spark, d, "events").filter(S.in_market_hours(F.col("ts"))).select("event_id", "ts")


@query("SELECT DISTINCT symbol, expiry FROM fx_quotes WHERE expiry > DATE '2024-03-02'")
def future_expiries(spark, d):
    return expiries(spark, d).filter(F.col("expiry") > F.lit("2024-03-02").cast("date"))


@query("SELECT DISTINCT symbol, strike / 2 AS strike FROM fx_quotes WHERE (strike / 2) % 1 = 0")
def integral_strikes(spark, d):
    return strikes(spark, d).select("symbol", (F.col("strike") / 2).alias("strike")).filter(F.col("strike") % 1 == 0)


@query(f"WITH {CQ} SELECT symbol, snapshot_time, expiry, strike, option_type FROM sq WHERE incomplete = 0")
def complete_reading(spark, d):
    return cleaned(spark, d).filter(clean.complete_reading()).select(*QUOTE_COLUMNS)


@query("""SELECT contract_id, last_completed, coalesce(TIMESTAMP '2024-01-20 12:00:00' - last_completed >= INTERVAL '6' HOUR, true) AS may_run
FROM (SELECT contract_id, max(CASE WHEN status = 'COMPLETE' THEN ts END) AS last_completed FROM fx_attempts GROUP BY ALL)""")
def min_interval_gate(spark, d):
    log = attempts(spark, d)
    done = progress.last_completed(log, "contract_id", "ts", "COMPLETE")
    return progress.min_interval_gate(log.select("contract_id").distinct(), done, "contract_id", now(), 6)


@query(f"WITH {STATES} SELECT batch_id, contract_id, status, backoff_until FROM states WHERE status IN ('PENDING', 'RETRY', 'IN_PROGRESS') AND (backoff_until IS NULL OR backoff_until <= TIMESTAMP '2024-01-20 12:00:00')")
def queue_eligible(spark, d):
    states = progress.checkpoint_state(attempts(spark, d), ["batch_id", "contract_id"], "attempt_seq", "ts")
    return progress.queue_eligible(states, now().cast("timestamp_ntz")).select("batch_id", "contract_id", "status", "backoff_until")


@query("SELECT d AS asof, d - CASE WHEN isodow(d) = 7 THEN 2 ELSE 1 END AS start_date FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)")
def collection_window(spark, d):
    days = table(spark, d, "events").select(F.to_date("ts").alias("asof")).distinct()
    return days.withColumn("start_date", S.collection_start(F.col("asof"))).filter("start_date <> asof")


@query("""SELECT symbol, array_to_string(tenors, ',') AS tenors, array_to_string(deltas, ',') AS deltas, CAST(len(tenors) * len(deltas) * 2 AS INTEGER) AS expected_targets FROM (
SELECT symbol, CASE WHEN symbol = 'S1' THEN [180, 210, 240] ELSE [7, 14, 30, 60] END AS tenors, CASE WHEN symbol = 'S1' THEN ['0.05', '0.2'] ELSE ['0.01', '0.05', '0.1', '0.2'] END AS deltas FROM (SELECT DISTINCT symbol FROM fx_quotes))""")
def target_config(spark, d):
    own = config.symbol_targets(spark, [("S1", [240, 180, -5, 210, 180], [0.2, 0.05, 0.0, 0.2])])
    out = U.target_config(quotes(spark, d).select("symbol").distinct(), own, config.DEFAULT_TENORS, config.DEFAULT_DELTAS)
    return out.select("symbol", F.array_join(F.col("tenors_dte").cast("array<string>"), ",").alias("tenors"), F.array_join(F.col("deltas_abs").cast("array<string>"), ",").alias("deltas"), "expected_targets")


@query("SELECT symbol, trade_date, md5(symbol || '_' || strftime(trade_date, '%Y-%m-%dT00:00:00') || '_' || strftime(trade_date + 1, '%Y-%m-%dT00:00:00')) AS batch_id, md5(symbol || '_tenor_delta_' || strftime(trade_date, '%Y-%m-%dT00:00:00')) AS skew_batch_id FROM fx_underlying_bars")
def batch_id(spark, d):
    at = lambda c: S.iso(c.cast("timestamp"))
    day = F.col("trade_date")
    return daily(spark, d).select("symbol", "trade_date", S.batch_id(F.col("symbol"), at(day), at(F.date_add(day, 1))).alias("batch_id"), S.batch_id(F.concat("symbol", F.lit("_tenor_delta")), at(day)).alias("skew_batch_id"))


@query("SELECT symbol, min(trade_date) AS start_date, max(trade_date) AS end_date, (max(trade_date) - min(trade_date) + 1) || ' D' AS duration FROM fx_underlying_bars GROUP BY symbol")
def duration_days(spark, d):
    spans = daily(spark, d).groupBy("symbol").agg(F.min("trade_date").alias("start_date"), F.max("trade_date").alias("end_date"))
    return spans.withColumn("duration", S.duration(F.col("start_date"), F.col("end_date")))


@query("SELECT DISTINCT symbol, expiry, CAST(expiry - DATE '2024-01-02' AS INTEGER) AS dte FROM fx_quotes")
def dte(spark, d):
    return expiries(spark, d).withColumn("dte", S.dte(F.col("expiry"), asof()))


@query("""SELECT symbol, snapshot_time, expiry, strike, option_type, m AS moneyness, coalesce(abs(m - 1) < 0.01, false) AS is_atm
FROM (SELECT *, CASE WHEN spot > 0 THEN strike / spot END AS m FROM (SELECT *, CASE WHEN symbol = 'S2' THEN 0.0 ELSE underlying_price END AS spot FROM fx_quotes))""")
def moneyness(spark, d):
    spot = F.when(F.col("symbol") == "S2", 0.0).otherwise(F.col("underlying_price"))
    return quotes(spark, d).select(*QUOTE_COLUMNS, S.moneyness(F.col("strike"), spot).alias("moneyness")).withColumn("is_atm", S.is_atm(F.col("moneyness")))


@query(f"WITH {CQ} SELECT symbol, snapshot_time, expiry, strike, option_type, (iv_bid + iv_ask) / 2 AS iv_mid FROM cq")
def iv_mid(spark, d):
    return quotes(spark, d).select(*QUOTE_COLUMNS, S.iv_mid(F.col("iv_bid"), F.col("iv_ask")).alias("iv_mid"))


OFFSET = """round((CASE WHEN dl >= 0.4 THEN 0.012 WHEN dl >= 0.3 THEN 0.021 WHEN dl >= 0.2 THEN 0.031 WHEN dl >= 0.1 THEN 0.046 WHEN dl >= 0.05 THEN 0.06 WHEN dl >= 0.01 THEN 0.098 ELSE 0.3 END)
  * pow(greatest(1, expiry - DATE '2024-01-02') / CAST(30 AS DOUBLE), 0.4) * CASE WHEN option_type = 'P' THEN 1.5 ELSE 1.0 END, 8)"""


@query(f"SELECT symbol, expiry, dl AS delta, option_type, {OFFSET} AS offset_ratio FROM (SELECT DISTINCT symbol, expiry, abs(delta) AS dl, option_type FROM fx_quotes WHERE delta IS NOT NULL)")
def moneyness_offset(spark, d):
    q = quotes(spark, d).filter("delta IS NOT NULL").select("symbol", "expiry", F.abs("delta").alias("delta"), "option_type").distinct()
    return q.withColumn("offset_ratio", F.round(S.moneyness_offset(F.col("delta"), S.dte(F.col("expiry"), asof()), F.col("option_type")), 8))


@query("SELECT p_partkey, option_type, CASE WHEN option_type = 'C' THEN sigma ELSE -sigma END AS target_delta FROM fx_pricing")
def signed_target(spark, d):
    return view(spark, d, "fx_pricing").select("p_partkey", "option_type", S.signed_target(F.col("sigma"), F.col("option_type")).alias("target_delta"))


@query("SELECT attempt_seq, ts + least(30, greatest(1, attempt_seq % 40)) * INTERVAL '1' MINUTE AS backoff_until FROM fx_attempts")
def backoff_until(spark, d):
    return attempts(spark, d).select("attempt_seq", S.backoff_until(F.col("ts"), F.col("attempt_seq") % 40).alias("backoff_until"))


@query("SELECT attempt_seq, CASE WHEN what_to_show = 'BID_ASK' THEN 2 ELSE 1 END AS cost FROM fx_attempts")
def request_cost(spark, d):
    return attempts(spark, d).select("attempt_seq", S.request_cost(F.col("what_to_show")).alias("cost"))


@query("""SELECT event_id, reason, reason <> 'TRANSIENT' AND expiry < DATE '2024-01-15' AS terminal FROM (SELECT *, CASE WHEN contains(lower(error), 'no security definition') THEN 'NO_SECURITY_DEFINITION'
WHEN contains(lower(error), 'no historical market data') THEN 'NO_HISTORICAL_DATA' WHEN error IS NULL AND n_bars = 0 AND head_ts IS NULL THEN 'NO_BARS_NO_HEAD' ELSE 'TRANSIENT' END AS reason FROM fx_responses)""")
def classify_unavailable(spark, d):
    r = view(spark, d, "fx_responses").withColumn("reason", S.unavailability(F.col("n_bars"), F.col("head_ts"), F.col("error")))
    return r.select("event_id", "reason", ((F.col("reason") != "TRANSIENT") & (F.col("expiry") < F.lit("2024-01-15").cast("date"))).alias("terminal"))


@query("SELECT symbol, trade_date, CAST(trade_date AS TIMESTAMP) + CASE WHEN symbol = 'U1' THEN 975 ELSE 960 END * INTERVAL '1' MINUTE AS session_close FROM fx_underlying_bars")
def session_close_stamp(spark, d):
    kind = F.when(F.col("symbol") == "U1", "IND").otherwise("STK")
    return daily(spark, d).select("symbol", "trade_date", S.session_close(F.col("trade_date"), kind).alias("session_close"))


def _poly(x, coefficients):
    out = repr(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + CAST({c!r} AS DOUBLE))"
    return out


def _cdf(x):
    e = f"exp(-({x}) * ({x}) / 2)"
    return f"(CASE WHEN ({x}) > 0 THEN 1 - {e} * {_poly(f'abs({x})', pricing.NUMERATOR)} / {_poly(f'abs({x})', pricing.DENOMINATOR)} ELSE {e} * {_poly(f'abs({x})', pricing.NUMERATOR)} / {_poly(f'abs({x})', pricing.DENOMINATOR)} END)"


PRICED = "WITH p AS (SELECT *, (ln(s / k) + (r + sigma * sigma / 2) * t) / (sigma * sqrt(t)) AS a, sigma * sqrt(t) AS w, CASE WHEN option_type = 'C' THEN 1.0 ELSE -1.0 END AS g FROM fx_pricing)"
ARGS = ["s", "k", "t", "r", "sigma"]


@query(f"{PRICED} SELECT p_partkey, round(g * (s * {_cdf('g * a')} - k * exp(-r * t) * {_cdf('g * (a - w)')}), 8) AS price FROM p")
def bs_price(spark, d):
    return view(spark, d, "fx_pricing").select("p_partkey", F.round(pricing.bs_price(*map(F.col, ARGS), F.col("option_type")), 8).alias("price"))


@query(f"{PRICED} SELECT p_partkey, round({_cdf('a')} - CASE WHEN option_type = 'C' THEN 0 ELSE 1 END, 8) AS delta, round(exp(-a * a / 2) / 2.5066282746310002 / (s * w), 8) AS gamma FROM p")
def bs_greeks(spark, d):
    p = view(spark, d, "fx_pricing")
    return p.select("p_partkey", F.round(pricing.bs_delta(*map(F.col, ARGS), F.col("option_type")), 8).alias("delta"), F.round(pricing.bs_gamma(*map(F.col, ARGS)), 8).alias("gamma"))


@query("SELECT p_partkey, round(sigma, 5) AS sigma FROM fx_pricing")
def implied_vol(spark, d):
    p = view(spark, d, "fx_pricing").withColumn("price", pricing.bs_price(*map(F.col, ARGS), F.col("option_type")))
    return p.select("p_partkey", F.round(pricing.implied_vol("price", "s", "k", "t", "r", "option_type"), 5).alias("sigma"))
