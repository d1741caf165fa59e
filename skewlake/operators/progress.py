"""Progress of contracts and batches, folded from attempt logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import scalars as S

COUNTED = ["IN_PROGRESS", "RETRY", "FAILED"]


def checkpoint_state(log: DataFrame, key: list[str], order: str, ts: str, budget: int = config.RETRY_BUDGET, count_in_progress: bool = True, told: tuple[str, ...] = ()) -> DataFrame:
    """State of each contract after its whole log: last status, attempts, backoff and time of completion.

    told: columns of the log, such as error, reason and evidence, that each attempt overwrites; the last one's are given.

    Attempts is a plain count, so no fold is needed: counts and the last row come from one aggregate, with partial results
    before the shuffle. RETRY with its budget used up is FAILED; a RETRY within the budget waits for its backoff.
    """
    counted = COUNTED if count_in_progress else [s for s in COUNTED if s != "IN_PROGRESS"]
    finished = F.col("status").startswith("VERIFIED_") | (F.col("status") == "COMPLETE")
    out = log.groupBy(*key).agg(
        F.count_if(F.col("status").isin(counted)).cast("int").alias("attempts"),
        F.max_by(F.struct("status", F.col(ts).alias("at"), *told), F.col(order)).alias("last"),
        F.max_by(F.when(finished, F.col(ts)), F.when(finished, F.col(order))).alias("completed_at"),
    )
    exhausted = (F.col("last.status") == "RETRY") & (F.col("attempts") >= budget)
    status = F.when(exhausted, "FAILED").otherwise(F.col("last.status"))
    waits = (F.col("last.status") == "RETRY") & ~exhausted
    return out.select(*key, status.alias("status"), "attempts", F.when(waits, S.backoff_until(F.col("last.at"), F.col("attempts"))).alias("backoff_until"), "completed_at", F.col("last.at").alias("last_attempt_at"), *[F.col(f"last.{c}").alias(c) for c in told])


def batch_progress(states: DataFrame) -> DataFrame:
    """Totals of each batch; COMPLETED when it has contracts and none is pending."""
    out = states.groupBy("batch_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status").isin(config.TERMINAL_STATES)).alias("terminal"), F.count_if(F.col("status").isin(config.PENDING_STATES)).alias("pending"))
    return out.withColumn("status", F.when((F.col("total") > 0) & (F.col("pending") == 0), "COMPLETED").otherwise("IN_PROGRESS"))


def queue_eligible(states: DataFrame, now: Column) -> DataFrame:
    return states.filter(F.col("status").isin(config.PENDING_STATES) & F.coalesce(F.col("backoff_until") <= now, F.lit(True)))


def work_queue(contracts: DataFrame, by: list[str], asof: Column, price: str) -> DataFrame:
    """Contracts in the order of work: soonest expiry, then strike nearest to price, then strike and side."""
    w = Window.partitionBy(*by).orderBy(F.datediff("expiry", asof), F.abs(F.col("strike") - F.col(price)), "strike", "option_type")
    return contracts.withColumn("queue_place", F.row_number().over(w))


def last_completed(progress: DataFrame, by: str, ts: str, done: str = "COMPLETED") -> DataFrame:
    return progress.groupBy(by).agg(F.max(F.when(F.col("status") == done, F.col(ts))).alias("last_completed"))


def min_interval_gate(symbols: DataFrame, completed: DataFrame, by: str, now: Column, hours: float) -> DataFrame:
    """Whether each symbol may run: nothing completed yet, or at least `hours` ago."""
    gap = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_completed").cast("timestamp"))
    return symbols.join(completed, by, "left").withColumn("may_run", F.coalesce(gap >= int(hours * 3_600_000_000), F.lit(True)))


def rollup(rows: DataFrame, by: list[str], ok: Column, message: str) -> DataFrame:
    """COMPLETED where any row is ok, else FAILED with a message."""
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("expected"), F.count_if(ok).alias("completed"), F.count_if(~ok).alias("missing"))
    return out.withColumn("status", F.when(F.col("completed") > 0, "COMPLETED").otherwise("FAILED")).withColumn("error_message", F.when(F.col("completed") == 0, S.truncate_error(F.lit(message))))


def batch_lookup(asked: DataFrame, progress: DataFrame) -> DataFrame:
    """For each asked batch whether it is known, its status and where to resume."""
    held = progress.select("batch_id", "status", "resume_at", F.lit(True).alias("known"))
    return asked.join(held, "batch_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))
