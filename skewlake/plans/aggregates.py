"""Aggregations, chain summaries and progress roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, progress
from ..operators import universe as U
from .base import CHAINS, CQ, STATES, attempts, bars, chains, cleaned, query, table, text_of, ticks



@query("SELECT contract_id, max(CASE WHEN status = 'COMPLETE' THEN ts END) AS last_completed FROM fx_attempts GROUP BY contract_id")
def last_completed(spark, d):
    return progress.last_completed(attempts(spark, d), "contract_id", "ts", "COMPLETE")


KEY = ["symbol", "strike", "expiry", "option_type", "what_to_show"]


@query("SELECT symbol, strike, expiry, option_type, what_to_show, max(bar_ts) AS latest FROM fx_option_bars WHERE is_incoming = 0 GROUP BY ALL")
def latest_bar(spark, d):
    from ..operators.ingest import latest_bar as latest

    return latest(bars(spark, d, 0), KEY, "bar_ts")


@query("SELECT symbol, arg_max(last, ts) AS price, arg_max(event_id, ts) AS event_id, CAST(arg_max(volume, ts) AS INTEGER) AS volume FROM fx_ticks GROUP BY symbol")
def latest_price(spark, d):
    last = F.max_by(F.struct(F.col("last").alias("price"), "event_id", "volume"), "ts").alias("x")
    return ticks(spark, d).groupBy("symbol").agg(last).select("symbol", "x.*")


@query(f"""WITH {STATES} SELECT batch_id, count(*) AS total, count(*) FILTER (WHERE status IN ('COMPLETE', 'VERIFIED_UNAVAILABLE_EXPIRED', 'FAILED')) AS terminal,
count(*) FILTER (WHERE status IN ('PENDING', 'IN_PROGRESS', 'RETRY')) AS pending, CASE WHEN count(*) FILTER (WHERE status IN ('PENDING', 'IN_PROGRESS', 'RETRY')) = 0 THEN 'COMPLETED' ELSE 'IN_PROGRESS' END AS status FROM states GROUP BY batch_id""")
def batch_progress(spark, d):
    return progress.batch_progress(progress.checkpoint_state(attempts(spark, d), ["batch_id", "contract_id"], "attempt_seq", "ts"))


@query(f"""WITH {CQ} SELECT symbol, snapshot_time, count(*) AS n_contracts, count(*) FILTER (WHERE incomplete = 0) AS n_stored, CASE WHEN count(*) FILTER (WHERE incomplete = 0) > 0 THEN 'COMPLETED' ELSE 'FAILED' END AS status,
CASE WHEN count(*) FILTER (WHERE incomplete = 0) = 0 THEN 'No data stored' END AS error_message FROM sq GROUP BY symbol, snapshot_time""")
def snapshot_progress(spark, d):
    out = progress.rollup(cleaned(spark, d), ["symbol", "snapshot_time"], clean.complete_reading(), "No data stored")
    return out.select("symbol", "snapshot_time", F.col("expected").alias("n_contracts"), F.col("completed").alias("n_stored"), "status", "error_message")


@query("SELECT status, count(*) AS n FROM fx_attempts GROUP BY status")
def status_counts(spark, d):
    return attempts(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT symbol, array_to_string(list_sort(list(DISTINCT strike)), ',') AS strikes, array_to_string(list_sort(list(DISTINCT strftime(expiry, '%Y%m%d'))), ',') AS expirations FROM fx_quotes GROUP BY symbol")
def chain_union(spark, d):
    return U.chain_union(chains(spark, d), "symbol", ["strikes", "expirations"]).select("symbol", text_of("strikes").alias("strikes"), text_of("expirations").alias("expirations"))


@query(f"WITH {CHAINS} SELECT symbol, exchange, trading_class, CAST(len(strikes) AS INTEGER) AS n_strikes, CAST(len(expirations) AS INTEGER) AS n_expirations FROM ch")
def chain_summary(spark, d):
    return U.chain_summary(chains(spark, d))


@query("SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem")
def distinct_rows(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey").dropDuplicates()


@query("""WITH l AS (SELECT batch_id, max(attempt_seq) AS s FROM fx_attempts GROUP BY batch_id), a AS (SELECT DISTINCT 'B' || (c_custkey % 120) AS batch_id FROM customer)
SELECT a.batch_id, l.s IS NOT NULL AS known, f.status, f.ts AS resume_at FROM a LEFT JOIN l ON a.batch_id = l.batch_id LEFT JOIN fx_attempts f ON f.batch_id = l.batch_id AND f.attempt_seq = l.s""")
def batch_lookup(spark, d):
    last = F.max_by(F.struct("status", F.col("ts").alias("resume_at")), "attempt_seq").alias("x")
    held = attempts(spark, d).groupBy("batch_id").agg(last).select("batch_id", "x.*")
    asked = table(spark, d, "customer").select(F.concat(F.lit("B"), (F.col("c_custkey") % 120).cast("string")).alias("batch_id")).distinct()
    return progress.batch_lookup(asked, held)


@query(f"WITH {STATES} SELECT * FROM states")
def checkpoint_state(spark, d):
    return progress.checkpoint_state(attempts(spark, d), ["batch_id", "contract_id"], "attempt_seq", "ts")


@query(f"WITH {STATES} SELECT CAST(substr(batch_id, 2) AS BIGINT) % 10 AS symbol_id, count(*) FILTER (WHERE status = 'COMPLETE') > 0 AS success FROM states GROUP BY ALL")
def symbol_result(spark, d):
    states = progress.checkpoint_state(attempts(spark, d), ["batch_id", "contract_id"], "attempt_seq", "ts")
    by = states.withColumn("symbol_id", F.substr("batch_id", F.lit(2)).cast("long") % 10)
    return progress.rollup(by, ["symbol_id"], F.col("status") == "COMPLETE", "nothing completed").select("symbol_id", (F.col("completed") > 0).alias("success"))


