"""Streams over the event files, read to their end so that results can be compared."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import over
from ..sources import tables as T
from ..sources.store import day
from ..streaming import ticks as K
from .base import query, ticks


def _source(spark: SparkSession, d: str, view: str) -> DataFrame:
    """A derived view over the events as a stream. Events may come as one file or a folder of files."""
    name = "events.parquet"
    table = spark.read.parquet(f"{d}/{name}")
    single = table.inputFiles()[0].rstrip("/").endswith(f"/{name}") if table.inputFiles() else True
    schema = table._jdf.schema().toDDL()
    events = K.read_events(spark, d if single else f"{d}/{name}", schema, glob=name if single else None)
    return over(spark, view, "events", events)


def _collect(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """Run a stream over all that is there; each batch's rows are kept with its number."""
    path = f"{T.shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/rows/n={number}")

    running = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.parquet(f"{path}/rows").drop("n")


@query("SELECT symbol, count(*) AS n_ticks, count(bid) AS n_bids, sum(volume) AS volume FROM (SELECT symbol, volume, CASE WHEN bid > 0 THEN bid END AS bid FROM fx_ticks) GROUP BY symbol")
def stream_ticks(spark, d):
    stream = K.clean_ticks(_source(spark, d, "fx_ticks"))
    return _collect(spark, stream, "append").groupBy("symbol").agg(F.count(F.lit(1)).alias("n_ticks"), F.count("bid").alias("n_bids"), F.sum("volume").alias("volume"))


def _into(stream: DataFrame, store, take) -> None:
    """Run a stream to its end, each batch given to a callback that changes a store."""
    stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{store.root}/_stream-{uuid.uuid4().hex}").trigger(availableNow=True).start().awaitTermination()


@query("SELECT DISTINCT symbol, ts FROM fx_ticks")
def stream_dedup(spark, d):
    """A stored log replayed into a table that holds each key once, whatever the order of the files."""
    store = T.fresh_store(spark)
    _into(K.clean_ticks(_source(spark, d, "fx_ticks")).select("symbol", "ts", "event_id"), store, K.dedup_into(store, "ticks", ["symbol", "ts"], day("ts"), ["event_id"]))
    return store.read("ticks").select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("""SELECT symbol, time_bucket(INTERVAL '15 minutes', ts) AS bar_ts, arg_min(last, (epoch_us(ts), event_id)) AS open, max(last) AS high, min(last) AS low, arg_max(last, (epoch_us(ts), event_id)) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM fx_ticks GROUP BY ALL""")
def resample_bars(spark, d):
    return K.resample(ticks(spark, d), "15 minutes")


@query("""SELECT symbol, z.bar_size, CAST(time_bucket(z.width, ts) AS TIMESTAMP) AS bar_ts, arg_min(last, (epoch_us(ts), event_id)) AS open, max(last) AS high, min(last) AS low, arg_max(last, (epoch_us(ts), event_id)) AS close, CAST(sum(volume) AS BIGINT) AS volume
FROM fx_ticks, (VALUES ('1 min', INTERVAL '1 minute'), ('5 mins', INTERVAL '5 minutes'), ('15 mins', INTERVAL '15 minutes'), ('1 hour', INTERVAL '1 hour'), ('1 day', INTERVAL '1 day')) AS z(bar_size, width) GROUP BY ALL""")
def resample_all_sizes(spark, d):
    return K.cascade(ticks(spark, d))
