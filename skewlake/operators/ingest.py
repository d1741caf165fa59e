"""Incremental ingest: what is missing, in which chunks to ask for it, and which arriving rows are new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config


def first_of_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the least by `order`. A hash aggregate with partial minima, not a sort."""
    rest = [c for c in rows.columns if c not in key]
    lead = [*order, *[c for c in rest if c not in order]]
    best = F.min(F.struct(*[F.col(f"`{c}`") for c in lead])).alias("best")
    return rows.groupBy(*key).agg(best).select(*[F.col(c) if c in key else F.col(f"best.{c}").alias(c) for c in rows.columns])


def insert_new(stored: DataFrame, arriving: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Arriving rows whose key isn't stored, one for each key. Inserting twice equals inserting once."""
    return first_of_key(arriving, key, order).join(stored.select(*key), key, "left_anti").select(*arriving.columns)


def verify_written(wanted: DataFrame, stored: DataFrame, key: list[str], day: str, ts: str) -> DataFrame:
    """Contracts of `wanted` that have a row with day <= ts < day + 1."""
    have = stored.select(*key, F.to_date(ts).alias(day)).distinct()
    return wanted.join(have, [*key, day], "left_semi")


def latest_bar(bars: DataFrame, key: list[str], ts: str) -> DataFrame:
    return bars.groupBy(*key).agg(F.max(ts).alias("latest"))


def start_of(start: Column, end: Column, latest: Column, head: Column) -> Column:
    """Where a request from start to end begins: at the latest stored bar; else at its own start if it spans a day at most; else at
    the vendor's earliest date, if known. Never before its own start."""
    short = F.datediff(end, start) <= 1
    return F.greatest(start, F.coalesce(F.to_date(latest), F.when(short, start), F.to_date(head), start))


def resolve_start(requests: DataFrame, latest: DataFrame, heads: DataFrame, key: list[str]) -> DataFrame:
    """Requests (start_date, end_date) with where each begins, from their latest stored bars and the vendor's first dates."""
    r = requests.join(latest, key, "left").join(heads, key, "left")
    return r.select(*requests.columns, start_of(F.col("start_date"), F.col("end_date"), F.col("latest"), F.col("head_ts")).alias("resolved_start"))


def eligible_requests(resolved: DataFrame) -> DataFrame:
    return resolved.filter("resolved_start IS NOT NULL AND resolved_start <= end_date")


def missing_ranges(stored: DataFrame, asked: DataFrame, by: str = "symbol", day: str = "trade_date") -> DataFrame:
    """Runs of days in [start_date, end_date] that aren't stored: before the first, between two, and after the last."""
    days = asked.join(stored.select(by, day).distinct(), by).filter(F.col(day).between(F.col("start_date"), F.col("end_date")))
    w = Window.partitionBy(by, "start_date", "end_date").orderBy(day)
    held = days.withColumn("before", F.lag(day).over(w)).withColumn("after", F.lead(day).over(w))
    head = held.select(by, "start_date", "end_date", F.coalesce(F.date_add("before", 1), F.col("start_date")).alias("range_start"), F.date_sub(day, 1).alias("range_end"))
    tail = held.filter("after IS NULL").select(by, "start_date", "end_date", F.date_add(day, 1).alias("range_start"), F.col("end_date").alias("range_end"))
    none = asked.join(days.select(by, "start_date", "end_date"), [by, "start_date", "end_date"], "left_anti").withColumns({"range_start": F.col("start_date"), "range_end": F.col("end_date")})
    return head.unionByName(tail).unionByName(none.select(*head.columns)).filter("range_start <= range_end").select(by, "range_start", "range_end")


def with_chunks(ranges: DataFrame, sizes: DataFrame, cover_tail: bool = False) -> DataFrame:
    """Ranges (start_date, end_date, bar_size) with the chunks to ask for, as an array of (chunk_start, chunk_end) each of about
    BARS_PER_CHUNK bars.

    A chunk that ends on the last day but one leaves the last day out, as requests end the day after; cover_tail asks for
    it too. An unknown bar size is an error.
    """
    known = ranges.join(F.broadcast(sizes), "bar_size", "left").withColumn("bars_per_day", F.coalesce("bars_per_day", F.raise_error(F.concat(F.lit("unknown bar size: "), F.coalesce("bar_size", F.lit("null")))).cast("int")))
    step = F.floor(F.lit(config.BARS_PER_CHUNK) / F.col("bars_per_day")).cast("int")
    last = F.col("end_date") if cover_tail else F.date_sub("end_date", 1)
    starts = F.when(F.col("start_date") <= last, F.sequence(F.col("start_date"), last, F.make_dt_interval(step + 1))).otherwise(F.array().cast("array<date>"))
    chunk = lambda s: F.struct(s.alias("chunk_start"), F.least(F.date_add(s, F.col("step")), F.col("end_date")).alias("chunk_end"))
    return known.withColumn("step", step).select(*ranges.columns, F.transform(starts, chunk).alias("chunks"))


def date_chunks(ranges: DataFrame, sizes: DataFrame, cover_tail: bool = False) -> DataFrame:
    """A row (chunk_start, chunk_end) for each chunk of the ranges."""
    return with_chunks(ranges, sizes, cover_tail).select(*ranges.columns, F.inline("chunks"))


def attach_close(bars: DataFrame, daily: DataFrame, ts: str) -> DataFrame:
    """Every bar of a day gets that day's close of its underlying (daily: symbol, trade_date, close)."""
    close = daily.select("symbol", "trade_date", F.col("close").alias("underlying_price"))
    return bars.withColumn("trade_date", F.to_date(ts)).join(close, ["symbol", "trade_date"])


def upsert(stored: DataFrame, arriving: DataFrame, key: list[str], version: str) -> DataFrame:
    """One row for each key, the one of the greatest version; of equal versions the arriving one."""
    both = stored.withColumn("arrived", F.lit(0)).unionByName(arriving.withColumn("arrived", F.lit(1)))
    rest = [c for c in stored.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(version, "arrived")).alias("row")
    return both.groupBy(*key).agg(best).select(*[F.col(c) if c in key else F.col(f"row.{c}").alias(c) for c in stored.columns])


def rolling_cost(log: DataFrame, by: list[str], ts: str, cost: Column, seconds: int = config.REQUEST_WINDOW_S, span: int = 12) -> DataFrame:
    """Cost of each request and those less than `seconds` before it, against the budget.

    by: what shares a budget. Requests at exactly `seconds` before no longer count. A busy client's log is cut in pieces of
    `span` windows of time; requests within a window of the next piece's begin are also given to that piece, as history
    only, so no task has to sort one client's whole log.
    """
    width = seconds * 1_000_000
    costed = log.withColumn("cost", cost).withColumn("at", F.unix_micros(F.col(ts).cast("timestamp")))
    piece = F.floor(F.col("at") / (span * width))
    copies = F.array(F.struct(piece.alias("piece"), F.lit(True).alias("own")), F.struct((piece + 1).alias("piece"), F.lit(False).alias("own")))
    needed = F.when(F.col("at") > (piece + 1) * (span * width) - width, copies).otherwise(F.slice(copies, 1, 1))
    w = Window.partitionBy(*by, "piece").orderBy("at").rangeBetween(-width + 1, 0)
    used = costed.select("*", F.inline(needed)).withColumn("window_cost", F.sum("cost").over(w)).filter("own")
    return used.withColumn("over_budget", F.col("window_cost") > config.REQUEST_BUDGET).drop("at", "piece", "own")
