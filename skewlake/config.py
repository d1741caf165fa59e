"""Settings as small tables, so that runs vary without code edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values.
OFFSET_CURVE = [(0.40, 0.012), (0.30, 0.021), (0.20, 0.031), (0.10, 0.046), (0.05, 0.06), (0.01, 0.098)]
OFFSET_DEFAULT = 0.3
OFFSET_REF_DAYS, OFFSET_ALPHA, OFFSET_PUT_FACTOR = 30, 0.4, 1.5
DEFAULT_TENORS, DEFAULT_DELTAS = [7, 14, 30, 60], [0.01, 0.05, 0.10, 0.20]
SYMBOL_TARGETS = [("SPX", [180, 210, 240], [0.01, 0.05, 0.10, 0.20])]
MAX_HOPS, PATIENCE = 12, 2
BARS_PER_DAY = [("1 min", 390), ("5 mins", 78), ("15 mins", 26), ("1 hour", 7), ("1 day", 1)]
BARS_PER_CHUNK = 1200
REQUEST_BUDGET, REQUEST_WINDOW_S = 56, 600
INDEX_SYMBOLS = ["SPX", "SPXW"]
EXCHANGES = [
    ("DXJ", "ARCA"), ("GE", "SMART"), ("GVZ", "CBOE"), ("INDU", "CME"), ("NDX", "NASDAQ"), ("SPX", "CBOE"),
    ("SPXW", "CBOE"), ("TSX", "TSE"), ("VIX", "CFE"), ("VIX1D", "CBOE"), ("VIX3M", "CBOE"), ("VVIX", "CBOE"),
]
DEFAULT_EXCHANGE = "SMART"
SYMBOL_SETTINGS = [("AVGO", 10, 5, "BID_ASK")]
DEFAULT_STRIKES, DEFAULT_EXPIRIES, DEFAULT_WHAT = 10, 5, "TRADES"
PENDING_STATES = ["PENDING", "IN_PROGRESS", "RETRY"]
TERMINAL_STATES = ["COMPLETE", "VERIFIED_UNAVAILABLE_EXPIRED", "FAILED"]
RETRY_BUDGET = 3
ERROR_LENGTH = 500


def exchanges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXCHANGES, "symbol string, exchange string")


def bar_sizes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BARS_PER_DAY, "bar_size string, bars_per_day int")


def symbol_settings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SYMBOL_SETTINGS, "symbol string, strikes int, expiries int, what_to_show string")


def symbol_targets(spark: SparkSession, rows: list | None = None) -> DataFrame:
    return spark.createDataFrame(SYMBOL_TARGETS if rows is None else rows, "symbol string, tenors_dte array<int>, deltas_abs array<double>")
