"""Cleaning of quotes and bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

GREEKS = ["iv_bid", "iv_ask", "delta", "gamma", "theta", "vega"]


def clean_quotes(quotes: DataFrame) -> DataFrame:
    """No-quote prices become null, a missing or negative volume 0, missing open interest 0, NaN readings null."""
    return quotes.withColumns(
        {
            **{c: S.positive(F.col(c)) for c in ("bid", "ask", "last")},
            "volume": F.greatest(F.coalesce("volume", F.lit(0)), F.lit(0)).cast("long"),
            "open_interest": F.coalesce("open_interest", F.lit(0)).cast("long"),
            **{c: S.clean_number(F.col(c)) for c in GREEKS},
        }
    )


def complete_reading() -> Column:
    """Whether a cleaned quote has all readings."""
    return S.is_complete(*[F.col(c) for c in GREEKS], bid=F.col("bid"), ask=F.col("ask"))


def quote_metrics(quotes: DataFrame, asof: Column) -> DataFrame:
    """Days to expiry, moneyness, at-the-money flag and mid volatility of cleaned quotes."""
    ratio = S.moneyness(F.col("strike"), F.col("underlying_price"))
    return quotes.withColumns({"dte": S.dte(F.col("expiry"), asof), "moneyness": ratio, "is_atm": S.is_atm(ratio), "iv_mid": S.iv_mid(F.col("iv_bid"), F.col("iv_ask"))})


def normalize_bars(bars: DataFrame, distinct: bool = True) -> DataFrame:
    """Vendor extras dropped, times without zone, NaN prices null; exact repeats dropped, unless the caller drops repeated keys anyway."""
    prices = [c for c in ("open", "high", "low", "close") if c in bars.columns]
    out = bars.drop("average", "barCount").withColumns({**{c: S.clean_number(F.col(c)) for c in prices}, "bar_ts": F.col("bar_ts").cast("timestamp_ntz"), "volume": F.col("volume").cast("long")})
    return out.dropDuplicates() if distinct else out


def tag_bars(bars: DataFrame, contracts: DataFrame, key: list[str], batch: Column) -> DataFrame:
    """Bars with their contract's attributes and the batch that brought them."""
    return bars.join(contracts, key).withColumn("collection_batch", batch)
