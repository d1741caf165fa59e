"""Lookups by small tables and joins of quotes with their context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import scalars as S


def classify_instruments(symbols: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Kind and exchange of each symbol. exchanges is a setting of some dozen rows and is broadcast."""
    out = symbols.join(F.broadcast(exchanges), "symbol", "left")
    return out.withColumns({"kind": S.checked_kind(S.instrument_kind(F.col("symbol"))), "exchange": F.coalesce("exchange", F.lit(config.DEFAULT_EXCHANGE))})


def what_to_show(symbols: DataFrame, settings: DataFrame) -> DataFrame:
    """What kind of bars to ask for. settings has a row for each symbol that differs from the default, and is broadcast."""
    own = settings.select("symbol", "what_to_show")
    return symbols.join(F.broadcast(own), "symbol", "left").withColumn("what_to_show", F.coalesce("what_to_show", F.lit(config.DEFAULT_WHAT)))


def attach_spot(quotes: DataFrame, underlying: DataFrame) -> DataFrame:
    """Quotes with their snapshot's underlying price (underlying: symbol, snapshot_time, price)."""
    return quotes.join(underlying.select("symbol", "snapshot_time", F.col("price").alias("spot")), ["symbol", "snapshot_time"])


def reading_lookup(wanted: DataFrame, quotes: DataFrame) -> DataFrame:
    """Readings for wanted contracts by symbol, snapshot, expiry, strike to six decimals and side; to_fetch where there is none."""
    key = ["symbol", "snapshot_time", "expiry", "strike_key", "option_type"]
    rounded = lambda df: df.withColumn("strike_key", F.round("strike", 6))
    have = rounded(quotes).select(*key, "bid", "ask", F.lit(True).alias("held"))
    out = rounded(wanted).join(have, key, "left")
    return out.withColumn("to_fetch", ~F.coalesce("held", F.lit(False))).drop("held", "strike_key")
