"""Tables that change together: Parquet folders named by a manifest, which one small file publishes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column by which staged rows are parted; it names folders only.
PART = "stored_part"


class Conflict(Exception):
    """Another commit has changed a part that this one builds on."""


@dataclass
class Change:
    """Staged folders of one table by part. Where `replace` holds they take the place of the part's folders, else they join them."""

    table: str
    schema: str
    replace: bool
    parts: dict[str, list[str]] = field(default_factory=dict)


class Store:
    """A folder of versioned tables.

    Rows are staged under fresh names, which no reader looks at. A manifest lists the folders of each table by part (a string, such as a
    day or a bucket), and a numbered manifest comes into being by one rename that never replaces a file: readers see all tables of a
    commit or none, and a commit that was stopped before leaves nothing but unnamed folders. Parts are what a manifest grows with, so
    they should be days, months or buckets, not keys.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._fs.mkdirs(self._path(f"{self.root}/_commits"))

    def _names(self, folder: str) -> list[str]:
        return [f.getPath().getName() for f in self._fs.listStatus(self._path(folder))]

    def version(self) -> int:
        """Number of the last commit; 0 before the first."""
        return max((int(n[:-5]) for n in self._names(f"{self.root}/_commits") if n.endswith(".json") and n[0] != "."), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """Tables with their schemas and the folders of each part, as of a commit."""
        version = self.version() if version is None else version
        if not version:
            return {"tables": {}}
        stream = self._fs.open(self._path(f"{self.root}/_commits/{version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def parts(self, table: str, version: int | None = None) -> list[str]:
        return list(self.manifest(version)["tables"].get(table, {"parts": {}})["parts"])

    def read(self, table: str, parts: Iterable[str] | None = None, version: int | None = None, schema: str | None = None) -> DataFrame:
        """The rows of a table, or of some parts of it, as of a commit. No other part's files are so much as listed."""
        held = self.manifest(version)["tables"].get(table, {"schema": schema, "parts": {}})
        wanted = None if parts is None else set(parts)
        folders = [f"{self.root}/{table}/{name}" for part, names in held["parts"].items() if wanted is None or part in wanted for name in names]
        if held["schema"] is None:
            raise ValueError(f"no table {table} in {self.root}")
        return self.spark.read.schema(held["schema"]).parquet(*folders) if folders else self.spark.createDataFrame([], held["schema"])

    def staged(self, change: Change) -> DataFrame:
        """The rows of a change as they were written, before or after it is published."""
        folders = [f"{self.root}/{change.table}/{name}" for names in change.parts.values() for name in names]
        return self.spark.read.schema(change.schema).parquet(*folders) if folders else self.spark.createDataFrame([], change.schema)

    def stage(self, table: str, rows: DataFrame, part: Column, replace: bool = False, emptied: Iterable[str] = ()) -> Change:
        """Write rows under a fresh name, in folders by part. Parts named in `emptied` that get no rows are left without any."""
        schema = rows._jdf.schema().toDDL()
        name = f"v-{uuid.uuid4().hex}"
        path = f"{self.root}/{table}/{name}"
        rows.withColumn(PART, part).hint("rebalance", PART).write.partitionBy(PART).parquet(path)
        change = Change(table, schema, replace, {p: [] for p in emptied})
        for folder in self._names(path):
            if folder.startswith(f"{PART}="):
                value = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder[len(PART) + 1 :])
                change.parts[value] = [f"{name}/{folder}"]
        return change

    def touched(self, rows: DataFrame, part: Column) -> list[str]:
        """The parts in which rows lie; as many as a manifest names."""
        return [r[0] for r in rows.select(part.cast("string")).distinct().collect()]

    def merge(self, table: str, rows: DataFrame, part: Column, key: list[str], version: int | None = None) -> Change:
        """Stage rows in place of those of the same key. Rows are computed once; only the parts that they touch are read and written anew."""
        change = self.stage(table, rows, part, replace=True)
        held = self.manifest(version)["tables"].get(table, {"parts": {}})["parts"]
        if old := [p for p in change.parts if p in held]:
            kept = self.read(table, old, version).join(self.staged(change).select(*key).distinct(), key, "left_anti").select(*[F.col(f"`{c}`") for c in rows.columns])
            for p, names in self.stage(table, kept, part).parts.items():
                change.parts[p] += names
        return change

    def rewrite(self, table: str, rows: DataFrame, part: Column, combine: Callable[[DataFrame, DataFrame], DataFrame], base: int | None = None) -> Change:
        """Stage what `combine` makes of stored rows and arriving ones. Rows are computed once; only the parts that they touch are read and written anew."""
        arriving = self.stage(table, rows, part)
        new = self.staged(arriving)
        stored = self.read(table, arriving.parts, base, arriving.schema)
        return self.stage(table, combine(stored, new), part, replace=True, emptied=arriving.parts)

    def without(self, table: str, gone: Column, part: Column, parts: Iterable[str] | None = None) -> Change:
        """Stage a deletion: parts that hold such rows are written anew without them, all others keep their files.

        Where `parts` names those that may hold such rows, no other is read. A null condition keeps the row.
        """
        goes = F.coalesce(gone, F.lit(False))
        hit = self.touched(self.read(table, parts).filter(goes), part)
        return self.stage(table, self.read(table, hit).filter(~goes), part, replace=True, emptied=hit)

    def done(self, stream: str) -> int:
        """Number of the last batch of a stream that has been published; -1 before the first."""
        return self.manifest().get("streams", {}).get(stream, -1)

    def publish(self, changes: list[Change], base: int | None = None, batch: tuple[str, int] | None = None, alone: bool = False) -> int:
        """Make changes the next commit, all at once, and give its number. batch: the stream and the number of its batch that this holds.

        base: the commit that the changes were made from; the last one by default. Where others have committed since, the changes are put
        on top of theirs, unless one of them changed a part that is replaced here: then a Conflict is raised and nothing is done.
        alone: any commit since is a Conflict, for changes that build on whole tables.
        """
        base = self.version() if base is None else base
        then = self.manifest(base)["tables"]
        while True:
            last = self.version()
            if alone and last != base:
                raise Conflict(f"there are commits after {base}")
            manifest = self.manifest(last)
            now = manifest["tables"]
            for c in changes:
                before, after = (t.get(c.table, {"parts": {}})["parts"] for t in (then, now))
                if c.replace and any(before.get(p) != after.get(p) for p in c.parts):
                    raise Conflict(f"{c.table} changed after commit {base}")
            for c in changes:
                table = now.setdefault(c.table, {"schema": c.schema, "parts": {}})
                for part, names in c.parts.items():
                    table["parts"][part] = [*([] if c.replace else table["parts"].get(part, [])), *names]
                table["parts"] = {p: names for p, names in table["parts"].items() if names}
            streams = manifest.get("streams", {}) | (dict([batch]) if batch else {})
            if self._put(last + 1, {"tables": now, "streams": streams}):
                return last + 1

    def _put(self, version: int, manifest: dict) -> bool:
        """Write a manifest beside its place and rename it there; false where that commit exists already."""
        draft = self._path(f"{self.root}/_commits/.draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            self._files.rename(draft, self._path(f"{self.root}/_commits/{version:012d}.json"), options)
        except Exception as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def month(column: str) -> Column:
    return F.date_format(column, "yyyy-MM")


def bucket(n: int, *columns: str) -> Column:
    """A part by hash of a key, so that a change of few keys touches few files."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("string")
