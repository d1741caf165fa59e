"""Sinks, sources and streams."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from skewlake.plans import base, streams
from skewlake.sources import tables
from skewlake.streaming import ticks


def test_overwriting_a_snapshot_again_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "v int, day string")
    path = str(tmp_path / "t")
    tables.overwrite_partitions(rows, path, ["day"])
    tables.overwrite_partitions(rows.filter("day = 'b'"), path, ["day"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b"), (3, "b")]
    tables.append(rows.filter("day = 'a'"), path, ["day"])
    assert spark.read.parquet(path).count() == 4


def test_delete_keeps_nulls(spark):
    t = spark.createDataFrame([("x",), ("y",), (None,)], "batch_id string")
    assert {r[0] for r in tables.delete_rows(t, F.col("batch_id") == "x").collect()} == {"y", None}


def test_missing_chain_is_an_error(spark):
    chains = spark.createDataFrame([("A", [1.0])], "symbol string, strikes array<double>")
    with pytest.raises(Exception, match="no chain for B"):
        tables.require_chain(chains, spark.createDataFrame([("A",), ("B",)], "symbol string")).collect()


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("DB_URL", "jdbc:postgresql://host/db")
    o = tables.jdbc_options("bars", "id", 0, 10, 4)
    assert o["url"].endswith("host/db") and o["numPartitions"] == "4" and o["partitionColumn"] == "id"


def test_scan_pushes_filters_and_columns(spark, data):
    df = tables.read_table(spark, f"{data}/events.parquet").filter(F.col("user_id") == 3).select("event_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,3)" in plan and "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_callback_gets_every_tick(spark, data, tmp_path):
    seen = []
    q = ticks.stream_ticks(streams._source(spark, data, "fx_ticks"), lambda batch, n: seen.append((n, batch.count(), set(batch.columns))), str(tmp_path))
    q.awaitTermination()
    assert sum(n for _, n, _ in seen) == base.ticks(spark, data).count() and all({"ts", "ingested_at"} <= c for *_, c in seen)


def test_streamed_state_equals_batch(spark, data, tmp_path):
    """Three batches with clock timers: the last state of each contract is that of the table, and who waits is released once."""
    from skewlake.operators.progress import checkpoint_state, queue_eligible

    told = ("error", "reason", "evidence")
    few = spark.range(30).selectExpr("'Z' AS batch_id", "9000 + id % 20 AS contract_id", "1000000 + id AS attempt_seq", "TIMESTAMP_NTZ '2024-02-01 10:00:00' AS ts", "IF(id < 20, 'RETRY', 'COMPLETE') AS status", "'TRADES' AS what_to_show")
    log = base.attempts(spark, data).unionByName(few).withColumns({c: F.when(F.col("attempt_seq") % (3 + i) > 0, F.concat(F.lit(f"{c} "), "attempt_seq")) for i, c in enumerate(told)})
    folder = str(tmp_path / "log")
    log.orderBy("attempt_seq").repartition(3).write.parquet(folder)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = ticks.read_events(spark, folder, "batch_id string, contract_id long, attempt_seq long, ts timestamp_ntz, status string, what_to_show string, error string, reason string, evidence string", 1)
    got, released, seen, shown = {}, {}, set(), ("status", "attempts", "backoff_until", "completed_at", "last_attempt_at", *told)

    def take(batch, n):
        seen.add(n)
        for r in batch.collect():
            if r["released"]:
                released.setdefault(r["contract_id"], []).append((n, r["backoff_until"], r["status"]))
            else:
                got[r["contract_id"]] = (n, tuple(r[c] for c in shown))

    # with clock timers a stream has always more to do, so it runs until all rows were read and one batch more
    running = ticks.stream_checkpoints(stream).writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="200 milliseconds").start()
    total, deadline = log.count(), time.time() + 120
    while sum(p["numInputRows"] for p in running.recentProgress) < total and time.time() < deadline:
        time.sleep(0.2)
    last = len(running.recentProgress)
    while len(running.recentProgress) < last + 1 and time.time() < deadline:
        time.sleep(0.2)
    running.stop()
    states = checkpoint_state(log, ["contract_id"], "attempt_seq", "ts", told=told)
    assert {k: v for k, (_, v) in got.items()} == {r["contract_id"]: tuple(r[c] for c in shown) for r in states.collect()}
    assert {0, 1, 2} <= seen
    # backoffs of the log have long ended by the clock: who waits at the end was released after its last change
    waiting = {r["contract_id"] for r in queue_eligible(states, F.current_timestamp()).filter("status = 'RETRY'").collect()}
    assert waiting and all(released[k][-1][0] >= got[k][0] for k in waiting)
    assert all(until is None and status == "RETRY" for rows in released.values() for _, until, status in rows)
    assert all(len({n for n, *_ in rows}) == len(rows) for rows in released.values())


def test_streamed_bars_equal_table_bars(spark, data, tmp_path):
    from skewlake.plans.streams import _collect, _source

    stream = ticks.resample(_source(spark, data, "fx_ticks"), "1 hour", delay="60 days")
    got = _collect(spark, stream, "update")
    last = got.groupBy("symbol", "bar_ts").agg(F.max_by(F.struct("open", "high", "low", "close", "volume"), "batch").alias("x")).select("symbol", "bar_ts", "x.*")
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(last) == key(ticks.resample(base.ticks(spark, data), "1 hour"))
    assert isinstance(last.first()["bar_ts"], dt.datetime)


def test_stream_dedup_over_batches(spark, data, tmp_path):
    """A log of 200 days and more in files of three batches, the later days first."""
    from skewlake.plans import registry
    from skewlake.plans.base import ticks

    events = spark.read.parquet(f"{data}/events.parquet")
    path = str(tmp_path / "events.parquet")
    events.withColumn("ts", events.ts + F.expr("INTERVAL 200 DAYS")).repartition(40).write.parquet(path)
    events.coalesce(1).write.mode("append").parquet(path)
    got = registry.queries()["stream_dedup"](spark, str(tmp_path))
    assert got.count() == ticks(spark, str(tmp_path)).select("symbol", "ts").distinct().count()


def test_late_repeats_are_neither_doubled_nor_lost(spark, tmp_path):
    from skewlake.sources.store import Store, day

    store = Store(spark, str(tmp_path / "s"))
    take = ticks.dedup_into(store, "t", ["k", "ts"], day("ts"), ["v"])
    at = lambda d: dt.datetime(2024, 1, d, 10)
    batch = lambda rows: spark.createDataFrame(rows, "k string, ts timestamp, v int")
    take(batch([("a", at(20), 2), ("a", at(20), 1), ("b", at(20), 3)]), 0)
    take(batch([("a", at(1), 4), ("a", at(20), 5)]), 1)  # a late row, and a repeat
    take(batch([("a", at(1), 4), ("a", at(20), 5)]), 1)  # the batch comes again
    take(batch([("a", at(1), 6), ("c", at(2), 7)]), 2)  # a late repeat
    assert sorted(map(tuple, store.read("t").collect())) == [("a", at(1), 4), ("a", at(20), 1), ("b", at(20), 3), ("c", at(2), 7)]
    parts = store.manifest()["tables"]["t"]["parts"]
    assert {p: len(n) for p, n in parts.items()} == {"2024-01-20": 1, "2024-01-01": 1, "2024-01-02": 1}


def test_streamed_cascade_equals_table(spark, data, tmp_path):
    """All sizes from a stream in several batches, with late ticks, equal those of the table; a batch that comes again counts once."""
    from skewlake.plans.streams import _into
    from skewlake.sources.store import Store

    every = base.ticks(spark, data)
    path = str(tmp_path / "ticks")
    every.repartition(3, "event_id").write.parquet(path)
    store = Store(spark, str(tmp_path / "s"))
    take, seen = ticks.cascade_into(store), []

    def twice(batch, n):
        seen.append(n)
        take(batch, n)
        take(batch, n)

    _into(ticks.read_events(spark, path, every._jdf.schema().toDDL(), 1), store, twice)
    assert len(seen) == 3
    want = ticks.cascade(every)
    for size, _ in ticks.SIZES:
        columns = ["symbol", "bar_ts", "open", "high", "low", "close", "volume"]
        got = sorted(map(tuple, ticks.bars_of(store, size).select(*columns).collect()))
        assert got == sorted(map(tuple, want.filter(F.col("bar_size") == size).select(*columns).collect())) and got


def test_jdbc_round_trip(spark):
    """Written to an embedded store and read back in parts, bounds asked for once; null and one-value columns, and an empty table."""
    url = f"jdbc:derby:memory:t{time.time_ns()};create=true"
    rows = spark.sql("SELECT id AS k, IF(id % 7 = 0, NULL, CAST(id * 3 AS BIGINT)) AS v, CONCAT('n', id) AS name FROM range(100)")
    tables.write_jdbc(rows, "t", 3, url)
    back = tables.read_jdbc_split(spark, "t", "v", 4, url)
    assert back.rdd.getNumPartitions() == 4
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(back.select("k", "v", "name")) == key(rows)
    tables.write_jdbc(rows.filter("k = 1"), "one", 3, url)
    assert key(tables.read_jdbc_split(spark, "one", "v", 4, url)) == [(1, 3, "n1")]
    tables.write_jdbc(rows.filter("k < 0"), "nobody", 3, url)
    assert tables.read_jdbc_split(spark, "nobody", "v", 4, url).count() == 0
