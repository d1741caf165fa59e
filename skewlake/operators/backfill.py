"""Bars loaded from a list of work that outlives its runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import scalars as S
from ..sources import tables as T
from ..sources.store import Change, Store, bucket
from . import ingest as I
from .bars import BAR_KEY, CONTRACT, Bars

#: The list of work, one row for each contract.
WORK = """symbol string, strike double, expiry date, option_type string, what_to_show string, start_date date, end_date date,
bar_size string, status string, attempts int, run string, lease_until timestamp, backoff_until timestamp, last_error string,
unavailable_reason string, probe_evidence string, n_chunks long, n_new long, expected long, completed long,
last_attempt_at timestamp, completed_at timestamp"""


class Backfill:
    """A store's tables `bars` and `latest` (see Bars) and `work` (parts: open and finished contracts, by bucket), and runs that fill them.

    Finished contracts are never written again; each run writes the open ones anew.

    A run leases eligible contracts, loads their chunks, and publishes their bars with their new states in one commit. A run that
    stops before has stored no bar and changed no state but the lease; when that is over, the next run takes its contracts again.
    Times are arguments, so a run can be repeated.
    """

    def __init__(self, store: Store, lease: dt.timedelta = dt.timedelta(hours=1), budget: int = config.RETRY_BUDGET, buckets: int = 16, bar_part: Column | None = None):
        self.store, self.lease, self.budget = store, lease, budget
        self.work_part = F.concat(F.when(F.col("status").isin(config.TERMINAL_STATES), "done-").otherwise("open-"), bucket(buckets, *CONTRACT))
        self.bars = Bars(store, bar_part, buckets)

    def work(self) -> DataFrame:
        return self.store.read("work", schema=WORK)

    def _open(self, version: int) -> list[str]:
        return [p for p in self.store.parts("work", version) if p.startswith("open-")]

    def _changed(self, rows: DataFrame, version: int) -> list[Change]:
        """Stage rows as the whole of the open contracts, and those that are finished beside the ones that were."""
        staged = self.store.stage("work", rows, self.work_part, replace=True, emptied=self._open(version))
        done = {p: names for p, names in staged.parts.items() if p.startswith("done-")}
        return [Change("work", staged.schema, True, {p: names for p, names in staged.parts.items() if p not in done}), Change("work", staged.schema, False, done)]

    def eligible(self, now: Column) -> Column:
        """Pending, not waiting for its backoff, and under no run's lease."""
        waits = lambda c: F.coalesce(F.col(c) > now, F.lit(False))
        return F.col("status").isin(config.PENDING_STATES) & ~waits("backoff_until") & ~waits("lease_until")

    def take(self, run: str, requests: DataFrame, now: dt.datetime, prices: DataFrame | None = None, most: int | None = None) -> int:
        """Add requests (contract, start_date, end_date, bar_size) that aren't on the list, and lease what is eligible; the number leased.

        With `most`, so many contracts are leased: those that expire soonest, then those whose strike is nearest to the symbol's price.
        """
        base, at = self.store.version(), F.lit(now)
        listed = self.store.read("work", version=base, schema=WORK)
        waiting = self.store.read("work", self._open(base), base, WORK)
        none = [f for f in self.store.spark.createDataFrame([], WORK).schema if f.name not in requests.columns]
        new = requests.join(listed, CONTRACT, "left_anti").select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in none]).withColumns({"status": F.lit("PENDING"), "attempts": F.lit(0)}).select(*listed.columns)
        open_ = waiting.filter(self.eligible(at)).unionByName(new)
        leased = {"status": F.lit("IN_PROGRESS"), "attempts": F.col("attempts") + 1, "run": F.lit(run), "lease_until": F.lit(now + self.lease), "backoff_until": F.lit(None).cast("timestamp"), "last_attempt_at": at}
        if most is None:
            taken = open_.withColumns(leased)
        else:
            near = open_ if prices is None else open_.join(prices.select("symbol", "price"), "symbol", "left")
            gap = F.lit(0.0) if prices is None else F.abs(F.col("strike") - F.col("price"))
            first = near.orderBy(F.datediff("expiry", at.cast("date")), gap, *CONTRACT).limit(most).select(*CONTRACT, F.lit(True).alias("first"))
            marked = open_.join(first, CONTRACT, "left")
            taken = marked.withColumns({c: F.when(F.col("first"), v).otherwise(F.col(c)) for c, v in leased.items()}).drop("first")
        changes = self._changed(taken.unionByName(waiting.filter(~self.eligible(at))), base)
        count = self.store.staged(changes[0]).filter((F.col("run") == run) & (F.col("lease_until") == leased["lease_until"])).count()
        if count:
            self.store.publish(changes, base)
        return count

    def load(self, run: str, arriving: DataFrame, now: dt.datetime, heads: DataFrame | None = None, errors: DataFrame | None = None) -> int:
        """Load what a run has leased from the arriving bars, check what was staged, and publish bars and states together.

        A contract is COMPLETE when each day on which bars arrived has bars among those stored or staged. Without any bar its
        error (errors: contract, error) and the vendor's first date (heads: contract, head_ts) say why: it is
        VERIFIED_UNAVAILABLE_EXPIRED where data can't be had and the contract has expired, else RETRY after a backoff, and FAILED
        when its budget is used up. Returns the number of the commit.
        """
        base, at = self.store.version(), F.lit(now)
        open_ = self.store.read("work", self._open(base), base, WORK)
        leased = (F.col("run") == run) & (F.col("status") == "IN_PROGRESS")
        mine = I.with_chunks(open_.filter(leased), config.bar_sizes(self.store.spark))
        day = F.to_date("bar_ts")
        wanted = F.exists("chunks", lambda c: day.between(c["chunk_start"], c["chunk_end"]))
        loaded = arriving.join(mine.select(*CONTRACT, "chunks"), CONTRACT).filter(wanted).select(*arriving.columns)
        parts = self.store.touched(arriving, self.bars.part)
        judged = T.write_and_read(self.bars.judged(loaded, [c for c in arriving.columns if c not in BAR_KEY], parts), [])
        bars = self.store.stage("bars", judged.filter("is_new").drop("is_new"), self.bars.part)
        # days with arriving bars, and those of them that are held: stored before, or found in what was staged
        marks = judged.select(*CONTRACT, day.alias("day"), F.lit(1).alias("want"), F.when(F.col("is_new"), 0).otherwise(1).alias("have"), F.lit(0).alias("new"))
        marks = marks.unionByName(self.store.staged(bars).select(*CONTRACT, day.alias("day"), F.lit(0).alias("want"), F.lit(1).alias("have"), F.lit(1).alias("new")))
        days = marks.groupBy(*CONTRACT, "day").agg(F.max("want").alias("want"), F.max("have").alias("have"), F.sum("new").alias("new"))
        told = days.groupBy(*CONTRACT).agg(F.sum("want").alias("x_expected"), F.sum(F.col("want") * F.col("have")).alias("x_completed"), F.sum("new").alias("x_new"))
        out = mine.join(told, CONTRACT, "left").withColumn("x_chunks", F.size("chunks").cast("long"))
        out = out.join(heads.select(*CONTRACT, "head_ts"), CONTRACT, "left") if heads is not None else out.withColumn("head_ts", F.lit(None).cast("timestamp"))
        out = out.join(errors.select(*CONTRACT, "error"), CONTRACT, "left") if errors is not None else out.withColumn("error", F.lit(None).cast("string"))
        many = F.coalesce("x_expected", F.lit(0))
        reason = S.unavailability(many, F.col("head_ts"), F.col("error"))
        done = (many > 0) & (F.col("x_completed") == many)
        gone = (many == 0) & (reason != "TRANSIENT") & (F.col("expiry") < at.cast("date"))
        spent = F.col("attempts") >= self.budget
        status = F.when(done, "COMPLETE").when(gone, "VERIFIED_UNAVAILABLE_EXPIRED").when(spent, "FAILED").otherwise("RETRY")
        evidence = F.concat(F.lit("bars="), many.cast("string"), F.lit(" head="), F.coalesce(F.col("head_ts").cast("string"), F.lit("none")))
        states = out.withColumns({
            "n_chunks": F.col("x_chunks"), "n_new": F.coalesce("n_new", F.lit(0).cast("long")) + F.coalesce("x_new", F.lit(0).cast("long")),
            "expected": F.col("x_expected"), "completed": F.col("x_completed"), "lease_until": F.lit(None).cast("timestamp"),
            "backoff_until": F.when(status == "RETRY", S.backoff_until(at, F.col("attempts"))), "last_error": S.truncate_error(F.col("error")),
            "unavailable_reason": F.when(gone, reason), "probe_evidence": F.when(many == 0, evidence), "completed_at": F.when(done | gone, at), "status": status,
        }).select(*open_.columns)
        return self.store.publish([*self.bars.changes(bars, base), *self._changed(states.unionByName(open_.filter(~F.coalesce(leased, F.lit(False)))), base)], base)

    def run(self, name: str, requests: DataFrame, arriving: DataFrame, now: dt.datetime, most: int | None = None, prices: DataFrame | None = None, **told: DataFrame) -> int:
        """Lease and load; the number of contracts taken. Nothing is read or written further where none is eligible."""
        n = self.take(name, requests, now, prices, most)
        if n:
            self.load(name, arriving, now, **told)
        return n

    def rollup(self) -> DataFrame:
        """By symbol: contracts and chunks asked for, bars stored, days expected and found; COMPLETED where any was found."""
        asked = self.work().filter("n_chunks > 0").groupBy("symbol")
        out = asked.agg(F.count(F.lit(1)).alias("n_contracts"), F.sum("n_chunks").alias("n_chunks"), F.sum("n_new").alias("n_new"), F.sum("expected").alias("expected"), F.sum("completed").alias("completed"))
        return out.withColumn("status", F.when(F.coalesce("completed", F.lit(0)) > 0, "COMPLETED").otherwise("FAILED"))
