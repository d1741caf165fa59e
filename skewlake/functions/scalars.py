"""Column functions of the domain. None reads a clock: as-of dates and times are arguments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def clean_number(c: Column) -> Column:
    """NaN is missing."""
    return F.nanvl(c, F.lit(None).cast("double"))


def positive(c: Column) -> Column:
    """Quotes of zero or less (no quote) are missing."""
    return F.when(clean_number(c.cast("double")) > 0, c)


def normalize_symbol(c: Column) -> Column:
    """Trimmed, upper case; the weekly class of the index goes by the index's name."""
    s = F.upper(F.trim(c))
    return F.when(s == "SPXW", "SPX").otherwise(s)


def instrument_kind(symbol: Column) -> Column:
    return F.when(symbol.isin(config.INDEX_SYMBOLS), "IND").otherwise("STK")


def checked_kind(kind: Column) -> Column:
    """The kind, or an error for one that isn't known."""
    return F.when(kind.isin("IND", "STK"), kind).otherwise(F.raise_error(F.concat(F.lit("unknown instrument kind: "), F.coalesce(kind, F.lit("null")))))


def trading_class(symbol: Column, days: Column) -> Column:
    """The weekly class for index options that expire within 30 days; null: the default class."""
    return F.when((symbol == "SPX") & (days <= 30), "SPXW")


def truncate_error(c: Column, n: int = config.ERROR_LENGTH) -> Column:
    return F.left(c, F.lit(n))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def batch_id(*parts: Column) -> Column:
    return F.md5(F.concat_ws("_", *parts))


def duration(start: Column, end: Column) -> Column:
    return F.concat((F.datediff(end, start) + 1).cast("string"), F.lit(" D"))


def dte(expiry: Column, asof: Column) -> Column:
    return F.datediff(expiry, asof)


def moneyness(strike: Column, spot: Column) -> Column:
    return F.when(spot > 0, F.try_divide(strike, spot))


def is_atm(ratio: Column) -> Column:
    return F.coalesce(F.abs(ratio - 1) < 0.01, F.lit(False))


def iv_mid(bid: Column, ask: Column) -> Column:
    return (clean_number(bid) + clean_number(ask)) / 2


def moneyness_offset(delta: Column, days: Column, option_type: Column) -> Column:
    """How far from spot to look for a delta: a step curve, wider for later expiries and for puts."""
    base = F.lit(config.OFFSET_DEFAULT)
    for threshold, offset in sorted(config.OFFSET_CURVE):
        base = F.when(F.abs(delta) >= threshold, F.lit(offset)).otherwise(base)
    scale = F.pow(F.greatest(F.lit(1), days) / F.lit(float(config.OFFSET_REF_DAYS)), F.lit(config.OFFSET_ALPHA))
    return base * scale * F.when(option_type == "P", config.OFFSET_PUT_FACTOR).otherwise(F.lit(1.0))


def starting_guess(spot: Column, offset: Column, option_type: Column) -> Column:
    return spot * F.when(option_type == "C", 1 + offset).otherwise(1 - offset)


def signed_target(delta_abs: Column, option_type: Column) -> Column:
    return F.when(option_type == "C", delta_abs).otherwise(-delta_abs)


def backoff_minutes(attempts: Column) -> Column:
    return F.least(F.lit(30), F.greatest(F.lit(1), attempts))


def backoff_until(now: Column, attempts: Column) -> Column:
    return now + F.make_dt_interval(F.lit(0), F.lit(0), backoff_minutes(attempts).cast("int"))


def request_cost(what_to_show: Column) -> Column:
    return F.when(what_to_show == "BID_ASK", 2).otherwise(1)


def unavailability(n_bars: Column, head: Column, error: Column) -> Column:
    """Why a response says that data can't be had, or TRANSIENT."""
    text = F.lower(error)
    return (
        F.when(text.contains("no security definition"), "NO_SECURITY_DEFINITION")
        .when(text.contains("no historical market data"), "NO_HISTORICAL_DATA")
        .when(error.isNull() & (n_bars == 0) & head.isNull(), "NO_BARS_NO_HEAD")
        .otherwise("TRANSIENT")
    )


def session_close(day: Column, kind: Column) -> Column:
    """16:00 of the day, 16:15 for indices."""
    minutes = F.when(kind == "IND", 975).otherwise(960)
    return day.cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)


def in_market_hours(ts: Column) -> Column:
    """Monday to Friday, 09:30 to 16:15, both ends included."""
    second = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    exact = second + F.when(F.date_trunc("second", ts) < ts, 1).otherwise(0)  # a fraction past the end is outside
    return (F.weekday(ts) <= 4) & (second >= 34200) & (exact <= 58500)


def is_complete(*required: Column, bid: Column, ask: Column) -> Column:
    """All readings present, and bid and ask above zero."""
    held = F.lit(True)
    for c in (*required, bid, ask):
        held = held & c.isNotNull() & ~F.isnan(c.cast("double"))
    return F.coalesce(held & (bid > 0) & (ask > 0), F.lit(False))


def collection_start(asof: Column) -> Column:
    """The day before; on a Sunday two days before."""
    return F.when(F.weekday(asof) == 6, F.date_sub(asof, 2)).otherwise(F.date_sub(asof, 1))
