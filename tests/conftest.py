import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import os

    from pyspark.sql import SparkSession

    os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def same():
    """Compare a DataFrame with what DuckDB gives for SQL over the tables of a folder."""
    import duckdb

    def run(df, sql, folder=DATA):
        db = duckdb.connect()
        for f in Path(folder).glob("*.parquet"):
            db.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
        r = db.sql(sql)
        names, want = list(r.columns), r.fetchall()
        cols = sorted(df.columns)
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        key = lambda row: tuple(map(repr, row))
        fix = lambda row: tuple(round(x, 9) if isinstance(x, float) else x for x in row)
        got = sorted((fix(tuple(row[c] for c in cols)) for row in df.collect()), key=key)
        assert got == sorted((fix(tuple(row[i] for i in at)) for row in want), key=key)

    return run
