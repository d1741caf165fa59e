"""Tick streams: reading, dedup, bars and contract state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .. import config
from ..functions import scalars as S
from ..operators.ingest import first_of_key
from ..sources.store import Store, day

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def read_events(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16, glob: str | None = None) -> DataFrame:
    """A stream of Parquet files with a declared schema; some files a trigger bound a micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)


def clean_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks with event time kept beside ingest time; no-quote prices null."""
    return ticks.withColumns({"ts": F.col("ts").cast("timestamp"), **{c: S.positive(F.col(c)) for c in ("last", "bid", "ask")}})


def stream_ticks(ticks: DataFrame, callback: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Give each micro-batch to a callback. A batch may come again after a failure, with the same number."""
    return clean_ticks(ticks).withColumn("ingested_at", F.current_timestamp()).writeStream.foreachBatch(callback).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedup_into(store: Store, table: str, key: list[str], part: Column, order: list[str]) -> Callable[[DataFrame, int], None]:
    """A callback that keeps the first row of each key for good, however late a repeat comes.

    The table is the state: a batch is set against the keys stored in the parts that it touches, and of these alone. A batch that comes
    again after a failure finds its rows there and adds none; within a batch the least by `order` is kept.
    """

    def take(batch: DataFrame, number: int) -> None:
        if number <= store.done(table):
            return
        rows = first_of_key(batch, key, order).persist()
        try:
            held = store.read(table, store.touched(rows, part), schema=rows._jdf.schema().toDDL()).select(*key)
            store.publish([store.stage(table, rows.join(held, key, "left_anti").select(*rows.columns), part)], batch=(table, number))
        finally:
            rows.unpersist()

    return take


def resample(ticks: DataFrame, size: str, by: str = "symbol", delay: str | None = None) -> DataFrame:
    """Open, high, low, close and volume of tumbling windows; ties in time go by event_id. Same on a table and on a stream."""
    t = ticks.withColumn("ts", F.col("ts").cast("timestamp"))
    t = t.withWatermark("ts", delay) if delay else t
    order = F.struct("ts", "event_id")
    bars = t.groupBy(by, F.window("ts", size).alias("w")).agg(F.min_by("last", order).alias("open"), F.max("last").alias("high"), F.min("last").alias("low"), F.max_by("last", order).alias("close"), F.sum("volume").alias("volume"))
    return bars.select(by, F.col("w.start").alias("bar_ts"), "open", "high", "low", "close", "volume")


#: Bar sizes, each made from the one before.
SIZES = [("1 min", 60), ("5 mins", 300), ("15 mins", 900), ("1 hour", 3600), ("1 day", 86400)]


def _folded(parts: DataFrame, by: list[str]) -> DataFrame:
    """Parts of bars put together; in any order and any grouping the same, as each keeps where its open and close lie."""
    first = F.min_by(F.struct("open", "open_ts", "open_id"), F.struct("open_ts", "open_id")).alias("f")
    last = F.max_by(F.struct("close", "close_ts", "close_id"), F.struct("close_ts", "close_id")).alias("l")
    out = parts.groupBy(*by, "bar_ts").agg(first, last, F.max("high").alias("high"), F.min("low").alias("low"), F.sum("volume").alias("volume"))
    return out.select(*by, "bar_ts", "f.*", "l.*", "high", "low", "volume")


def _minutes(ticks: DataFrame, by: str) -> DataFrame:
    t = ticks.select(by, F.col("ts").cast("timestamp").alias("ts"), "event_id", "last", F.col("volume").cast("long").alias("volume"))
    whole = [F.col("last").alias("open"), F.col("ts").alias("open_ts"), F.col("event_id").alias("open_id"), F.col("last").alias("close"), F.col("ts").alias("close_ts"), F.col("event_id").alias("close_id"), F.col("last").alias("high"), F.col("last").alias("low"), "volume"]
    return _folded(t.select(by, F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 60) * 60).alias("bar_ts"), *whole), [by])


def _wider(bars: DataFrame, by: str, seconds: int) -> DataFrame:
    start = F.timestamp_seconds(F.floor(F.unix_seconds("bar_ts") / seconds) * seconds)
    return _folded(bars.withColumn("bar_ts", start), [by])


def cascade(ticks: DataFrame, by: str = "symbol") -> DataFrame:
    """Bars of all SIZES from one pass over the ticks: minutes first, whose bars are then dealt to every wider size."""
    minutes = _minutes(ticks, by)
    sizes = F.explode(F.array(*[F.struct(F.lit(n).alias("bar_size"), F.lit(s).alias("seconds")) for n, s in SIZES]))
    dealt = minutes.select("*", sizes.alias("z")).withColumns({"bar_size": F.col("z.bar_size"), "bar_ts": F.timestamp_seconds(F.floor(F.unix_seconds("bar_ts") / F.col("z.seconds")) * F.col("z.seconds"))})
    return _folded(dealt, [by, "bar_size"]).select(by, "bar_size", "bar_ts", "open", "high", "low", "close", "volume")


def cascade_into(store: Store, by: str = "symbol") -> Callable[[DataFrame, int], None]:
    """A callback that keeps a table of bars for each size, by days: a batch's ticks are read once for minutes, and each size's bars are made
    anew from the size before for the days that the batch touches. Late ticks count like any other. All sizes change in one commit, which also
    holds the number of the batch, so that one that comes again is not counted twice.
    """
    part = day("bar_ts")

    def take(batch: DataFrame, number: int) -> None:
        if number <= store.done("bars"):
            return
        base, changes = store.version(), []
        arrived = store.stage("arrived", _minutes(batch, by), part)
        new, days = store.staged(arrived), list(arrived.parts)
        for i, (name, seconds) in enumerate(SIZES):
            table = f"bars {name}"
            if i == 0:
                bars = _folded(new.unionByName(store.read(table, days, base, arrived.schema)), [by])
            else:
                bars = _wider(store.staged(changes[-1]), by, seconds)
            changes.append(store.stage(table, bars, part, replace=True, emptied=days))
        store.publish(changes, base, batch=("bars", number))

    return take


def bars_of(store: Store, size: str) -> DataFrame:
    """The stored bars of a size."""
    return store.read(f"bars {size}").drop("open_ts", "open_id", "close_ts", "close_id")


STATE = "attempts int, seq long, status string, at timestamp, done_seq long, done_at timestamp, error string, reason string, evidence string, wakes long"
SHOWN = "contract_id long, status string, attempts int, backoff_until timestamp, completed_at timestamp, last_attempt_at timestamp, error string, reason string, evidence string, released boolean"


class CheckpointProcessor(StatefulProcessor):
    """State of one contract: attempts, the last attempt with its error, reason and evidence, and when it was last completed.

    A contract that waits for its backoff has a timer; when it ends, the contract is given once more, as released.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)

    def _shown(self, key, s: tuple, released: bool) -> pd.DataFrame:
        attempts, _, status, at, _, done_at, error, reason, evidence, wakes = s
        shown = "FAILED" if status == "RETRY" and attempts >= config.RETRY_BUDGET else status
        until = pd.NaT if wakes is None or released else pd.Timestamp(wakes, unit="ms")
        return pd.DataFrame({
            "contract_id": [key[0]], "status": [shown], "attempts": [attempts], "backoff_until": pd.to_datetime([until]), "completed_at": pd.to_datetime([done_at]),
            "last_attempt_at": pd.to_datetime([at]), "error": [error], "reason": [reason], "evidence": [evidence], "released": [released],
        })

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old = self.state.get() if self.state.exists() else (0, -1, None, None, -1, None, None, None, None, None)
        attempts, seq, status, at, done_seq, done_at, error, reason, evidence, wakes = old
        for pdf in rows:
            attempts += int(pdf["status"].isin(["IN_PROGRESS", "RETRY", "FAILED"]).sum())
            last = pdf.loc[pdf["attempt_seq"].idxmax()]
            if last["attempt_seq"] > seq:
                seq, status, at = int(last["attempt_seq"]), last["status"], last["ts"].to_pydatetime()
                error, reason, evidence = (None if pd.isna(last[c]) else last[c] for c in ("error", "reason", "evidence"))
            finished = pdf[(pdf["status"] == "COMPLETE") | pdf["status"].str.startswith("VERIFIED_", na=False)]
            if len(finished) and finished["attempt_seq"].max() > done_seq:
                last = finished.loc[finished["attempt_seq"].idxmax()]
                done_seq, done_at = int(last["attempt_seq"]), last["ts"].to_pydatetime()
        if wakes is not None:
            self.handle.deleteTimer(wakes)
            wakes = None
        if status == "RETRY" and attempts < config.RETRY_BUDGET:
            wakes = int(pd.Timestamp(at).value // 1_000_000) + 60_000 * min(30, max(1, attempts))
            self.handle.registerTimer(wakes)
        now = (attempts, seq, status, at, done_seq, done_at, error, reason, evidence, wakes)
        self.state.update(now)
        yield self._shown(key, now, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        s = self.state.get()
        if s[-1] == expiredTimerInfo.getExpiryTimeInMs():
            now = (*s[:-1], None)
            self.state.update(now)
            yield self._shown(key, s, True)

    def close(self) -> None:
        pass


def stream_checkpoints(log: DataFrame) -> DataFrame:
    """The changing state of each contract, keyed by contract, and a row with `released` when its backoff ends by the clock. log: contract_id,
    attempt_seq, ts, status, and error, reason and evidence where it has them. Needs the RocksDB state store."""
    told = {c: F.lit(None).cast("string") for c in ("error", "reason", "evidence") if c not in log.columns}
    t = log.withColumns({"ts": F.col("ts").cast("timestamp"), **told})
    return t.groupBy("contract_id").transformWithStateInPandas(statefulProcessor=CheckpointProcessor(), outputStructType=SHOWN, outputMode="Update", timeMode="ProcessingTime")
