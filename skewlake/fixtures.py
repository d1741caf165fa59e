"""Views of market data derived from the base tables; each text runs unchanged on Spark and on DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The chain of a quote (symbol, snapshot, expiry, side), as the text of fx_quotes draws it, and how many rows a task takes for it.
CHAIN = [
    "CONCAT('S', CAST(l_suppkey AS STRING))",
    "TIMESTAMP '2024-01-02 10:00:00' + (l_orderkey % 2) * INTERVAL '1' HOUR",
    "DATE '2024-01-02' + CAST(30 * (1 + l_partkey % 6) AS INT)",
    "CASE WHEN l_linenumber % 2 = 1 THEN 'C' ELSE 'P' END",
]
TASK_ROWS = 200_000

VIEWS = {
    "fx_quotes": """
SELECT symbol, snapshot_time, expiry, strike, option_type, underlying_price,
  CASE WHEN k_qty = 1 THEN NULL WHEN option_type = 'C' THEN call_delta ELSE call_delta - 1 END AS delta,
  CASE WHEN k_disc = 0 THEN -1.0 ELSE k_qty * 0.25 END AS bid,
  CASE WHEN k_disc = 0 THEN -1.0 ELSE k_qty * 0.25 + 0.5 END AS ask,
  CASE WHEN k_qty < 5 THEN -1.0 ELSE k_qty * 0.25 + 0.25 END AS last,
  CAST(CASE WHEN k_qty < 5 THEN -1 ELSE k_qty * 10 END AS BIGINT) AS volume,
  k_n AS open_interest,
  CASE WHEN k_tax = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(0.25 AS DOUBLE) END AS iv_bid,
  CASE WHEN k_tax = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS iv_ask,
  CASE WHEN k_qty = 2 THEN NULL ELSE CAST(0.015625 AS DOUBLE) END AS gamma,
  CASE WHEN k_qty = 2 THEN NULL ELSE CAST(-0.03125 AS DOUBLE) END AS theta,
  CASE WHEN k_qty = 2 THEN NULL ELSE CAST(0.125 AS DOUBLE) END AS vega
FROM (
  SELECT CONCAT('S', CAST(l_suppkey AS STRING)) AS symbol,
    TIMESTAMP '2024-01-02 10:00:00' + (l_orderkey % 2) * INTERVAL '1' HOUR AS snapshot_time,
    DATE '2024-01-02' + CAST(30 * (1 + l_partkey % 6) AS INT) AS expiry,
    CAST(80 + l_partkey % 41 AS DOUBLE) AS strike,
    CASE WHEN l_linenumber % 2 = 1 THEN 'C' ELSE 'P' END AS option_type,
    CAST(98 + l_suppkey % 5 AS DOUBLE) AS underlying_price,
    0.5 - ((80 + l_partkey % 41) - (98 + l_suppkey % 5)) / CAST(64 AS DOUBLE) AS call_delta,
    MIN(l_discount) AS k_disc, MIN(l_quantity) AS k_qty, MIN(l_tax) AS k_tax, COUNT(*) AS k_n
  FROM lineitem GROUP BY 1,2,3,4,5,6,7) q
""",
    "fx_option_bars": """
SELECT CONCAT('S', CAST(l_suppkey % 5 AS STRING)) AS symbol,
  CAST(80 + l_partkey % 41 AS DOUBLE) AS strike,
  CAST(l_shipdate AS DATE) + CAST(30 * (1 + l_partkey % 12) AS INT) AS expiry,
  CASE WHEN l_linenumber % 2 = 1 THEN 'C' ELSE 'P' END AS option_type,
  CASE WHEN l_suppkey % 5 = 0 THEN 'BID_ASK' ELSE 'TRADES' END AS what_to_show,
  l_shipdate AS bar_ts, l_extendedprice / l_quantity AS close,
  CAST(l_quantity AS BIGINT) AS volume, l_orderkey % 2 AS is_incoming
FROM lineitem
""",
    "fx_underlying_bars": """
SELECT CONCAT('U', CAST(user_id % 5 AS STRING)) AS symbol, CAST(ts AS DATE) AS trade_date,
  MIN_BY(value, event_id) AS open, MAX(value) AS high, MIN(value) AS low,
  MAX_BY(value, event_id) AS close, COUNT(*) AS volume
FROM events WHERE (DAY(ts) + user_id % 5) % 6 <> 0 GROUP BY 1,2
""",
    "fx_ticks": """
SELECT event_id, ts, CONCAT('U', CAST(user_id % 5 AS STRING)) AS symbol, value AS last,
  CASE WHEN event_type = 'error' THEN -1.0 ELSE value - 0.25 END AS bid,
  CASE WHEN event_type = 'error' THEN -1.0 ELSE value + 0.25 END AS ask, 1 AS volume
FROM events
""",
    "fx_attempts": """
SELECT CONCAT('B', CAST(CAST(FLOOR(user_id / 2) AS BIGINT) AS STRING)) AS batch_id, user_id AS contract_id,
  event_id AS attempt_seq, ts,
  CASE event_type WHEN 'purchase' THEN 'COMPLETE' WHEN 'error' THEN 'RETRY'
    WHEN 'view' THEN 'IN_PROGRESS' WHEN 'signup' THEN 'PENDING'
    ELSE 'VERIFIED_UNAVAILABLE_EXPIRED' END AS status,
  CASE WHEN user_id % 3 = 0 THEN 'BID_ASK' ELSE 'TRADES' END AS what_to_show
FROM events
""",
    "fx_responses": """
SELECT event_id, user_id % 4 AS n_bars, CASE WHEN user_id % 3 = 0 THEN ts END AS head_ts,
  CASE event_type WHEN 'error' THEN 'No Security Definition has been found'
    WHEN 'click' THEN 'HMDS: no historical market data' WHEN 'view' THEN 'timeout' END AS error,
  CAST(ts AS DATE) + CAST(user_id % 21 - 10 AS INT) AS expiry
FROM events
""",
    "fx_pricing": """
SELECT p_partkey, CAST(100 AS DOUBLE) AS s, CAST(80 + p_partkey % 41 AS DOUBLE) AS k,
  (1 + p_partkey % 8) / CAST(8 AS DOUBLE) AS t, CAST(0.05 AS DOUBLE) AS r,
  CAST(0.1 AS DOUBLE) + (p_partkey % 7) / CAST(20 AS DOUBLE) AS sigma,
  CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'P' END AS option_type
FROM part
""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view, over the base table that its text reads."""
    base = next(t for t in ("lineitem", "events", "part") if f"FROM {t}" in VIEWS[name])
    rows = table(spark, sf_dir, base)
    return over(spark, name, base, by_chain(rows) if name == "fx_quotes" else rows)


def by_chain(rows: DataFrame) -> DataFrame:
    """Rows dealt by chain to so many tasks that each takes a bounded number of them, however large a file split is.

    Nearly every row is a quote of its own, so combining the rows of a split first saves little and holds a hash table of them all.
    Quotes, and chains gathered from them, need no further shuffle.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    return rows.repartition(tasks, *map(F.expr, CHAIN))


def over(spark: SparkSession, name: str, base: str, rows: DataFrame) -> DataFrame:
    """A derived view over the rows that stand for its base table; no view of the session is touched."""
    return spark.sql(VIEWS[name].replace(f"FROM {base}", "FROM {rows}"), rows=rows)


def with_views(sql: str) -> str:
    """SQL that names views, with their texts as common table expressions before its own."""
    used = [v for v in VIEWS if v in sql]
    if not used:
        return sql
    texts = ", ".join(f"{v} AS ({VIEWS[v]})" for v in used)
    sql = sql.strip()
    if sql.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {texts}, {sql[15:]}"
    return f"WITH {texts}, {sql[5:]}" if sql[:5].upper() == "WITH " else f"WITH {texts} {sql}"
