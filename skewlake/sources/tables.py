"""Reading and writing of tables: Parquet by default, JDBC by setting."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Store, day


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table with a declared schema; filters and columns reach the scan."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def scan_bars(bars: DataFrame, symbols: list[str], what: str, start: Column, end: Column, ts: str = "bar_ts") -> DataFrame:
    """Bars of symbols and kind with start <= ts < end."""
    return bars.filter(F.col("symbol").isin(symbols) & (F.col("what_to_show") == what) & (F.col(ts) >= start) & (F.col(ts) < end))


def scan_daily(daily: DataFrame, symbol: str, start: Column, end: Column) -> DataFrame:
    return daily.filter((F.col("symbol") == symbol) & F.col("trade_date").between(start, end))


def scan_chain(chains: DataFrame, exchange: str, trading_class: str | None = None) -> DataFrame:
    kept = chains.filter(F.col("exchange") == exchange)
    return kept if trading_class is None else kept.filter(F.col("trading_class") == trading_class)


def require_chain(chains: DataFrame, symbols: DataFrame) -> DataFrame:
    """The chains of the symbols; a symbol without one is an error when its row is read."""
    out = symbols.join(chains, "symbol", "left")
    return out.withColumn("strikes", F.coalesce("strikes", F.raise_error(F.concat(F.lit("no chain for "), "symbol")).cast("array<double>")))


def append(rows: DataFrame, path: str, by: list[str]) -> None:
    """One write for a batch. Rows are dealt by the partition columns and a salt, so few files arise and no task gets a whole hot partition."""
    dealt = rows.hint("rebalance", *by)
    dealt.write.mode("append").partitionBy(*by).parquet(path)


def overwrite_partitions(rows: DataFrame, path: str, by: list[str]) -> None:
    """Replace just the partitions that rows have: writing a snapshot again leaves the table as after the first time."""
    rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_and_read(rows: DataFrame, by: list[str], folder: str | None = None) -> DataFrame:
    """Write a snapshot in one action, by partitions if any are named, and read it back; for callers that go on from what was stored."""
    spark = rows.sparkSession
    path = f"{folder or shared_folder(spark)}/snapshot-{uuid.uuid4().hex}"
    if by:
        overwrite_partitions(rows, path, by)
    else:
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


def write_snapshot(store: Store, rows: DataFrame, complete: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write quotes of snapshots, the price of each underlying and the progress of each snapshot in one commit; all as read back.

    Readers see the three tables of a commit or none. Writing a snapshot again takes the place of its rows, so twice equals once. A
    snapshot without a complete quote is FAILED.
    """
    by, part, base = ["symbol", "snapshot_time"], day("snapshot_time"), store.version()
    quotes = store.merge("quotes", rows.withColumn("complete", complete), part, by, base)
    written = store.staged(quotes)
    underlying = store.merge("underlying", written.groupBy(*by).agg(F.max("underlying_price").alias("price")), part, by, base)
    counts = written.groupBy(*by).agg(F.count(F.lit(1)).alias("contracts_total"), F.count_if("complete").alias("contracts_processed"))
    done = F.col("contracts_processed") > 0
    counts = counts.withColumn("status", F.when(done, "COMPLETED").otherwise("FAILED")).withColumn("error_message", F.when(~done, "no complete quote"))
    store.publish([quotes, underlying, store.merge("progress", counts, part, by, base)], base)
    return store.read("quotes"), store.read("underlying"), store.read("progress")


def write_skew(store: Store, rows: DataFrame, status: DataFrame, progress: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write the snapshot rows of selected targets, what became of every target, and the progress of each snapshot in one commit; all as read back.

    Readers see the three tables of a commit or none. A snapshot that is written again replaces its rows in all three, even where it has no
    selected target any more. The three frames should be drawn from one written table, as status is read twice.
    """
    by, part, base = ["symbol", "snapshot_time"], day("snapshot_time"), store.version()
    told = store.merge("skew_status", status, part, by, base)
    again = status.select(*by).distinct()
    new = store.stage("skew_rows", rows, part, replace=True, emptied=told.parts)
    if old := [p for p in told.parts if p in store.parts("skew_rows", base)]:
        kept = store.read("skew_rows", old, base).join(again, by, "left_anti").select(*rows.columns)
        for p, names in store.stage("skew_rows", kept, part).parts.items():
            new.parts[p] = [*new.parts.get(p, []), *names]
    store.publish([new, told, store.merge("skew_progress", progress, part, by, base)], base)
    return store.read("skew_rows"), store.read("skew_status"), store.read("skew_progress")


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all executors share. Where none is set a local session uses its warehouse; a cluster must name it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return path or spark.conf.get("spark.sql.warehouse.dir")


def fresh_store(spark: SparkSession) -> Store:
    """An empty store in the shared folder."""
    return Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")


def delete_rows(table: DataFrame, gone: Column) -> DataFrame:
    """The rows that stay; a null condition stays, as in SQL."""
    return table.filter(~F.coalesce(gone, F.lit(False)))


def jdbc_options(table: str, partition_column: str | None = None, lower: str | None = None, upper: str | None = None, partitions: int = 16, url: str | None = None) -> dict[str, str]:
    """Options for a relational store. Address and credentials come from the environment (DB_URL, DB_USER, DB_PASSWORD) where not given."""
    options = {"url": url or os.environ.get("DB_URL", "jdbc:postgresql://localhost:5432/market"), "dbtable": table}
    options |= {k: os.environ[v] for k, v in (("user", "DB_USER"), ("password", "DB_PASSWORD")) if os.environ.get(v)}
    if partition_column:
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions)}
    return options


def read_jdbc(spark: SparkSession, table: str, **partitioning) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(table, **partitioning)).load()


def read_jdbc_split(spark: SparkSession, table: str, column: str, partitions: int = 16, url: str | None = None) -> DataFrame:
    """A table read in parts of equal spans of a numeric column, whose bounds the store is asked for once. Rows without a value come too."""
    name = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(jdbc_options(table, url=url)["url"]).quoteIdentifier(column)
    ends = read_jdbc(spark, f"(SELECT MIN({name}) AS low, MAX({name}) AS high FROM {table}) ends", url=url).first()
    low, high = ends[0], ends[1]
    if low is None:
        return read_jdbc(spark, table, url=url)
    return read_jdbc(spark, table, partition_column=column, lower=low, upper=high + 1, partitions=max(1, min(partitions, int(high - low) + 1)), url=url)


def write_jdbc(rows: DataFrame, table: str, partitions: int = 16, url: str | None = None, mode: str = "append") -> None:
    """Each of at most `partitions` tasks writes its rows over one connection."""
    rows.coalesce(partitions).write.format("jdbc").options(**jdbc_options(table, url=url)).mode(mode).save()
