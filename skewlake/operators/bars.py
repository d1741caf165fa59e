"""Stored bars by month, with the latest bar of each contract kept beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.store import Change, Store, bucket, month
from . import ingest as I

CONTRACT = ["symbol", "strike", "expiry", "option_type", "what_to_show"]
BAR_KEY = [*CONTRACT, "bar_ts"]


class Bars:
    """A store's tables `bars` (parts: months) and `latest` (one row for each contract; parts: buckets), which change in one commit.

    An insertion reads the keys of just those months that arriving bars touch, and rewrites just those buckets of `latest` whose contracts
    got bars. So the latest bar of every contract costs a read of as many rows as there are contracts, whatever the number of bars.
    Where bars came before `latest` was kept, it isn't begun, as it would lack them: maxima are then taken from all
    stored bars, until `gather` has made it. Bars should change through `changes` or `insert` only.
    """

    def __init__(self, store: Store, part: Column | None = None, buckets: int = 16):
        self.store, self.buckets = store, buckets
        self.part = month("bar_ts") if part is None else part
        self.latest_part = bucket(buckets, *CONTRACT)

    def judged(self, arriving: DataFrame, order: list[str], parts: list[str] | None = None) -> DataFrame:
        """The first arriving bar of each key by `order`, and whether it is new. Of the stored bars only the parts that arriving bars touch are
        read (or those named in `parts`), and of these the keys alone."""
        parts = self.store.touched(arriving, self.part) if parts is None else parts
        held = self.store.read("bars", parts, schema=arriving._jdf.schema().toDDL()).select(*BAR_KEY, F.lit(True).alias("held"))
        lead = F.struct(*order).alias("bar")
        both = arriving.select(*BAR_KEY, lead).unionByName(held, allowMissingColumns=True)
        best = both.groupBy(*BAR_KEY).agg(F.min("bar").alias("bar"), F.coalesce(F.max("held"), F.lit(False)).alias("held")).filter("bar IS NOT NULL")
        return best.select(*[F.col(c) if c in BAR_KEY else F.col(f"bar.{c}").alias(c) for c in arriving.columns], (~F.col("held")).alias("is_new"))

    def stage(self, arriving: DataFrame, order: list[str]) -> Change:
        """Stage the arriving bars whose key isn't stored, one for each key; inserting twice equals inserting once."""
        return self.store.stage("bars", self.judged(arriving, order).filter("is_new").drop("is_new"), self.part)

    def _kept(self, version: int) -> bool:
        """Whether `latest` covers all bars of a commit."""
        tables = self.store.manifest(version)["tables"]
        return any(tables.get("latest", {"parts": {}})["parts"]) or not tables.get("bars", {"parts": {}})["parts"]

    def changes(self, staged: Change, base: int | None = None) -> list[Change]:
        """Staged bars with what they change in `latest`, to be published together on the commit `base`."""
        base = self.store.version() if base is None else base
        new = I.latest_bar(self.store.staged(staged), CONTRACT, "bar_ts")
        if not self._kept(base):  # nothing to change, but a conflict should others make it meanwhile
            return [staged, Change("latest", new._jdf.schema().toDDL(), True, {str(i): [] for i in range(self.buckets)})]
        later = lambda old, new: I.latest_bar(old.unionByName(new), CONTRACT, "latest")
        return [staged, self.store.rewrite("latest", new, self.latest_part, later, base)]

    def insert(self, arriving: DataFrame, order: list[str]) -> Change:
        """Store the arriving bars whose key isn't stored and move the latest bars of their contracts on, in one commit."""
        base = self.store.version()
        staged = self.stage(arriving, order)
        self.store.publish(self.changes(staged, base), base)
        return staged

    def gather(self) -> None:
        """Make `latest` anew from all stored bars, for a store that was filled without it."""
        base = self.store.version()
        every = I.latest_bar(self.store.read("bars", version=base), CONTRACT, "bar_ts")
        self.store.publish([self.store.stage("latest", every, self.latest_part, replace=True, emptied=self.store.parts("latest", base))], base, alone=True)

    def latest(self, asked: DataFrame | None = None) -> DataFrame:
        """contract, latest: of every contract with bars, or of those in `asked`; from `latest` where it is kept, else from the bars."""
        version = self.store.version()
        if not self._kept(version):
            rows = self.store.read("bars", version=version)
            rows = rows if asked is None else rows.join(asked.select(*CONTRACT).distinct(), CONTRACT, "left_semi")
            return I.latest_bar(rows, CONTRACT, "bar_ts")
        ts = self.store.manifest(version)["tables"].get("latest", {}).get("schema")
        if ts is None:
            raise ValueError(f"no bars in {self.store.root}")
        rows = self.store.read("latest", version=version)
        return rows if asked is None else rows.join(asked.select(*CONTRACT).distinct(), CONTRACT, "left_semi")
