"""Registration of queries with the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..fixtures import table, view, with_views
from ..functions import scalars as S
from ..operators import clean, universe
from ..sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TENORS, DELTAS = [45, 100, 170, 400], [0.1, 0.2]

#: Cleaned quotes, in SQL.
CQ = """cq AS (SELECT symbol, snapshot_time, expiry, strike, option_type, underlying_price, delta,
  CASE WHEN bid > 0 THEN bid END AS bid, CASE WHEN ask > 0 THEN ask END AS ask, CASE WHEN last > 0 THEN last END AS last,
  CAST(greatest(coalesce(volume, 0), 0) AS BIGINT) AS volume, CAST(coalesce(open_interest, 0) AS BIGINT) AS open_interest,
  CASE WHEN NOT isnan(iv_bid) THEN iv_bid END AS iv_bid, CASE WHEN NOT isnan(iv_ask) THEN iv_ask END AS iv_ask, gamma, theta, vega FROM fx_quotes),
sq AS (SELECT *, CASE WHEN bid > 0 AND ask > 0 AND iv_bid IS NOT NULL AND iv_ask IS NOT NULL AND delta IS NOT NULL AND gamma IS NOT NULL AND theta IS NOT NULL AND vega IS NOT NULL THEN 0 ELSE 1 END AS incomplete,
  abs(strike - underlying_price) AS strike_gap FROM cq)"""
GRID = """grid AS (SELECT symbol, target_tenor_dte, target_delta_abs, option_type, CASE WHEN option_type = 'C' THEN target_delta_abs ELSE -target_delta_abs END AS target_delta
  FROM (SELECT DISTINCT symbol FROM fx_quotes), (SELECT unnest([45, 100, 170, 400]) AS target_tenor_dte), (SELECT CAST(unnest([0.1, 0.2]) AS DOUBLE) AS target_delta_abs), (SELECT unnest(['C', 'P']) AS option_type)),
ne AS (SELECT symbol, target_tenor_dte, arg_min(expiry, abs(expiry - DATE '2024-01-02' - target_tenor_dte) * 100000 + (expiry - DATE '2024-01-02')) AS selected_expiry
  FROM (SELECT DISTINCT symbol, expiry FROM fx_quotes) JOIN (SELECT DISTINCT symbol, target_tenor_dte FROM grid) USING (symbol) WHERE expiry > DATE '2024-01-02' GROUP BY ALL),
plan AS (SELECT s.symbol, s.snapshot_time, g.target_tenor_dte, g.target_delta_abs, g.option_type, g.target_delta, ne.selected_expiry
  FROM (SELECT DISTINCT symbol, snapshot_time FROM fx_quotes) s JOIN grid g ON g.symbol = s.symbol LEFT JOIN ne ON ne.symbol = g.symbol AND ne.target_tenor_dte = g.target_tenor_dte),
best AS (SELECT * FROM (SELECT p.*, q.* EXCLUDE (symbol, snapshot_time, expiry, option_type), abs(q.delta - p.target_delta) AS gap,
  row_number() OVER (PARTITION BY p.symbol, p.snapshot_time, p.target_tenor_dte, p.target_delta_abs, p.option_type ORDER BY abs(q.delta - p.target_delta), q.incomplete, q.strike_gap, q.strike) AS rn
  FROM plan p JOIN sq q ON q.symbol = p.symbol AND q.snapshot_time = p.snapshot_time AND q.expiry = p.selected_expiry AND q.option_type = p.option_type WHERE q.delta IS NOT NULL) WHERE rn = 1)"""
STATUS = """st AS (SELECT p.symbol, p.snapshot_time, p.option_type, p.target_tenor_dte, p.target_delta_abs,
  CASE WHEN b.symbol IS NULL THEN 'MISSING_NO_CANDIDATE' WHEN b.incomplete = 1 THEN 'MISSING_NULL_FIELDS' ELSE 'SELECTED' END AS status,
  CASE WHEN p.selected_expiry IS NULL THEN 'no expiry for tenor' WHEN b.symbol IS NULL THEN 'no quote with delta' WHEN b.incomplete = 1 THEN 'best quote lacks readings' END AS reason,
  p.selected_expiry, b.strike AS selected_strike, b.delta AS selected_delta, b.gap AS delta_gap_abs
  FROM plan p LEFT JOIN best b ON b.symbol = p.symbol AND b.snapshot_time = p.snapshot_time AND b.option_type = p.option_type AND b.target_tenor_dte = p.target_tenor_dte AND b.target_delta_abs = p.target_delta_abs)"""
#: State of each contract after its attempts, in SQL.
STATES = """states AS (SELECT batch_id, contract_id, attempts, CASE WHEN st = 'RETRY' AND attempts >= 3 THEN 'FAILED' ELSE st END AS status,
  CASE WHEN st = 'RETRY' AND attempts < 3 THEN ended + least(30, greatest(1, attempts)) * INTERVAL '1' MINUTE END AS backoff_until, completed_at, ended AS last_attempt_at
  FROM (SELECT batch_id, contract_id, CAST(count(*) FILTER (WHERE status IN ('IN_PROGRESS', 'RETRY', 'FAILED')) AS INTEGER) AS attempts, arg_max(status, attempt_seq) AS st, arg_max(ts, attempt_seq) AS ended,
    arg_max(ts, attempt_seq) FILTER (WHERE status = 'COMPLETE' OR status LIKE 'VERIFIED_%') AS completed_at FROM fx_attempts GROUP BY ALL))"""


def asof() -> Column:
    return F.lit("2024-01-02").cast("date")


def now() -> Column:
    return F.lit("2024-01-20 12:00:00").cast("timestamp")


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register a function of (spark, sf_dir) under its name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLES[key] = with_views(sql)
        return f

    return add


def quotes(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "fx_quotes")


def stored_quotes(spark: SparkSession, d: str) -> DataFrame:
    """The quotes, written once, for queries that read them several times."""
    return tables.write_and_read(quotes(spark, d), [])


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_quotes(quotes(spark, d))


def clean_of(q: DataFrame) -> DataFrame:
    return clean.clean_quotes(q)


def grid(spark: SparkSession, d: str, q: DataFrame | None = None) -> DataFrame:
    symbols = (quotes(spark, d) if q is None else q).select("symbol").distinct()
    return universe.target_grid(universe.target_config(symbols, config.symbol_targets(spark), TENORS, DELTAS).drop("expected_targets"))


def strikes(spark: SparkSession, d: str) -> DataFrame:
    return quotes(spark, d).select("symbol", "strike").distinct()


def expiries(spark: SparkSession, d: str) -> DataFrame:
    return quotes(spark, d).select("symbol", "expiry").distinct()


def spots(spark: SparkSession, d: str) -> DataFrame:
    return quotes(spark, d).select("symbol", F.col("underlying_price").alias("spot")).distinct()


def attempts(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "fx_attempts")


def chains(spark: SparkSession, d: str) -> DataFrame:
    """A chain of calls and one of puts for each symbol, as if of two exchanges."""
    q = quotes(spark, d)
    return q.groupBy("symbol", F.when(F.col("option_type") == "C", "CBOE").otherwise("SMART").alias("exchange"), F.col("symbol").alias("trading_class")).agg(
        F.array_sort(F.collect_set("strike")).alias("strikes"), F.array_sort(F.collect_set(F.date_format("expiry", "yyyyMMdd"))).alias("expirations")
    )


CHAINS = """ch AS (SELECT symbol, CASE WHEN option_type = 'C' THEN 'CBOE' ELSE 'SMART' END AS exchange, symbol AS trading_class, list_sort(list(DISTINCT strike)) AS strikes, list_sort(list(DISTINCT strftime(expiry, '%Y%m%d'))) AS expirations FROM fx_quotes GROUP BY ALL)"""


def text_of(array: str):
    return F.array_join(F.col(array).cast("array<string>"), ",")


def bars(spark: SparkSession, d: str, incoming: int | None = None) -> DataFrame:
    b = view(spark, d, "fx_option_bars")
    return b if incoming is None else b.filter(F.col("is_incoming") == incoming).drop("is_incoming")


def daily(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "fx_underlying_bars")


def ticks(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "fx_ticks")


__all__ = [n for n in dir() if not n.startswith("__")] + ["S"]
