"""Tables that change together, the list of work, and insertions that read only what they touch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skewlake.operators import clean
from skewlake.operators.backfill import CONTRACT, Backfill
from skewlake.operators.bars import BAR_KEY, Bars
from skewlake.plans import base
from skewlake.sources import tables
from skewlake.sources.store import Conflict, Store, bucket, day, month

NOW = dt.datetime(2024, 1, 20, 12)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def table(spark, values):
    return spark.createDataFrame(values, "k int, d string, v int")


def test_commits_show_all_tables_or_none(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.version() == 0
    a, b = (store.stage(n, table(spark, [(1, "x", 1), (2, None, 2)]), F.col("d")) for n in ("a", "b"))
    with pytest.raises(ValueError, match="no table a"):
        store.read("a")
    assert rows(store.staged(a)) == rows(table(spark, [(1, "x", 1), (2, None, 2)]))
    assert store.publish([a, b]) == 1
    assert rows(store.read("a")) == rows(store.read("b")) == rows(table(spark, [(1, "x", 1), (2, None, 2)]))
    store.stage("a", table(spark, [(3, "y", 3)]), F.col("d"))  # stopped before its commit
    assert store.read("a").count() == 2
    store.publish([store.stage("a", table(spark, [(3, "y", 3)]), F.col("d"))])
    assert store.read("a").count() == 3 and store.read("a", version=1).count() == 2


def test_merge_replaces_keys_and_leaves_other_parts(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.publish([store.stage("t", table(spark, [(1, "x", 1), (2, "x", 2), (3, "y", 3)]), F.col("d"))])
    y = store.manifest()["tables"]["t"]["parts"]["y"]
    change = store.merge("t", table(spark, [(1, "x", 9)]), F.col("d"), ["k"])
    store.publish([change])
    assert rows(store.read("t")) == [(1, "x", 9), (2, "x", 2), (3, "y", 3)]
    assert store.manifest()["tables"]["t"]["parts"]["y"] == y
    store.publish([store.merge("t", table(spark, [(1, "x", 9)]), F.col("d"), ["k"])])
    assert rows(store.read("t")) == [(1, "x", 9), (2, "x", 2), (3, "y", 3)]


def test_delete_writes_only_parts_that_hold_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.publish([store.stage("t", table(spark, [(1, "x", 1), (2, "x", None), (3, "y", 3), (4, "z", 1)]), F.col("d"))])
    before = store.manifest()["tables"]["t"]["parts"]
    store.publish([store.without("t", F.col("v") == 1, F.col("d"))])
    after = store.manifest()["tables"]["t"]["parts"]
    assert rows(store.read("t")) == [(2, "x", None), (3, "y", 3)]
    assert after["y"] == before["y"] and after["x"] != before["x"] and "z" not in after


def test_conflicts(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.publish([store.stage("t", table(spark, [(1, "x", 1), (3, "y", 3)]), F.col("d"))])
    one, other, apart = (store.merge("t", table(spark, [r]), F.col("d"), ["k"]) for r in ((1, "x", 5), (1, "x", 6), (3, "y", 7)))
    store.publish([one], base=1)
    with pytest.raises(Conflict):
        store.publish([other], base=1)
    store.publish([apart], base=1)
    assert rows(store.read("t")) == [(1, "x", 5), (3, "y", 7)]
    assert not store._put(2, {"tables": {}})


def test_snapshot_twice_equals_once_and_keeps_others(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    q = spark.sql("SELECT 'A' AS symbol, TIMESTAMP '2024-01-02 10:00:00' AS snapshot_time, 1.0D AS bid, 100.0D AS underlying_price")
    later = q.withColumn("snapshot_time", F.expr("TIMESTAMP '2024-01-02 11:00:00'"))
    ok = F.col("bid") > 0
    for part in (q, later, q, q.withColumn("bid", F.lit(None).cast("double"))):
        quotes, underlying, progress = tables.write_snapshot(store, part, ok)
    assert quotes.count() == underlying.count() == progress.count() == 2
    assert rows(progress.select("status")) == [("COMPLETED",), ("FAILED",)]


def stopped(*args, **kwargs):
    raise RuntimeError("stopped")


def test_snapshot_that_is_stopped_shows_nothing(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    q = spark.sql("SELECT 'A' AS symbol, TIMESTAMP '2024-01-02 10:00:00' AS snapshot_time, 1.0D AS bid, 100.0D AS underlying_price")
    tables.write_snapshot(store, q, F.col("bid") > 0)
    real, made = store.stage, []

    def third(*args, **kwargs):
        made.append(args)
        return stopped() if len(made) == 3 else real(*args, **kwargs)

    monkeypatch.setattr(store, "stage", third)
    with pytest.raises(RuntimeError):
        tables.write_snapshot(store, q.withColumn("symbol", F.lit("B")), F.col("bid") > 0)
    assert {r[0] for t in ("quotes", "underlying", "progress") for r in store.read(t).select("symbol").collect()} == {"A"}


def made(spark, tmp_path, name="s", **options):
    day_ = lambda n: dt.date(2024, 1, n)
    contracts = [("A", float(k), dt.date(2024, 2, 1) if k < 8 else dt.date(2024, 1, 10), "C", "TRADES") for k in range(10)]
    requests = spark.createDataFrame([(*c, day_(2), day_(6), "1 hour") for c in contracts], "symbol string, strike double, expiry date, option_type string, what_to_show string, start_date date, end_date date, bar_size string")
    bars = [(*c, dt.datetime(2024, 1, d, 10), 1.0 + d, 5) for c in contracts[:7] for d in (2, 3)]
    arriving = spark.createDataFrame([*bars, *bars[:3], (*contracts[0], dt.datetime(2024, 1, 20), 1.0, 1)], "symbol string, strike double, expiry date, option_type string, what_to_show string, bar_ts timestamp_ntz, close double, volume long")
    return Backfill(Store(spark, str(tmp_path / name)), **options), requests, arriving


def test_backfill_resumes_and_ends(spark, tmp_path, monkeypatch):
    job, requests, arriving = made(spark, tmp_path)
    assert job.run("r1", requests, arriving, NOW, most=3, prices=spark.createDataFrame([("A", 5.0)], "symbol string, price double")) == 3
    # soonest expiry first, then nearest to the price
    assert rows(job.work().filter("run = 'r1'").select("strike", "status")) == [(5.0, "COMPLETE"), (8.0, "VERIFIED_UNAVAILABLE_EXPIRED"), (9.0, "VERIFIED_UNAVAILABLE_EXPIRED")]
    stored = job.store.read("bars").count()
    with monkeypatch.context() as m:
        m.setattr(job.store, "publish", lambda changes, base=None, real=job.store.publish: stopped() if any(c.table == "bars" for c in changes) else real(changes, base))
        with pytest.raises(RuntimeError):
            job.run("r2", requests, arriving, NOW)
    assert job.store.read("bars").count() == stored
    assert job.run("r3", requests, arriving, NOW) == 0  # all is leased
    assert job.run("r4", requests, arriving, NOW + dt.timedelta(hours=2)) == 7
    assert job.store.read("bars").count() == 14
    states = {r["strike"]: r for r in job.work().collect()}
    assert len(states) == 10 and states[0.0]["status"] == "COMPLETE" and states[0.0]["attempts"] == 2 and states[0.0]["n_new"] == 2
    assert states[7.0]["status"] == "RETRY" and states[7.0]["backoff_until"] == NOW + dt.timedelta(hours=2, minutes=2) and states[7.0]["probe_evidence"] == "bars=0 head=none"
    before = job.store.version()
    assert job.run("r5", requests, arriving, NOW + dt.timedelta(hours=2, minutes=1)) == 0 and job.store.version() == before
    assert job.run("r6", requests, arriving, NOW + dt.timedelta(hours=3), errors=requests.select(*CONTRACT, F.lit("timeout").alias("error"))) == 1
    last = job.work().filter("strike = 7").first()
    assert (last["status"], last["attempts"], last["last_error"], last["unavailable_reason"]) == ("FAILED", 3, "timeout", None)
    assert job.run("r7", requests, arriving, NOW + dt.timedelta(hours=9)) == 0 and job.store.read("bars").count() == 14
    assert rows(job.rollup()) == [("A", 10, 10, 14, 14, 14, "COMPLETED")]


def test_finished_work_is_not_written_again(spark, tmp_path):
    job, requests, arriving = made(spark, tmp_path)
    job.run("r1", requests, arriving, NOW, most=5)
    done = {p: n for p, n in job.store.manifest()["tables"]["work"]["parts"].items() if p.startswith("done-")}
    job.run("r2", requests, arriving, NOW + dt.timedelta(hours=2))
    after = job.store.manifest()["tables"]["work"]["parts"]
    assert done and all(set(n) <= set(after[p]) for p, n in done.items())


def test_insert_reads_only_touched_parts(spark, data, tmp_path):
    """Arriving bars of one month: the plan names that month's folder and no other, and of its columns the keys."""
    held = Bars(Store(spark, str(tmp_path / "s")))
    stored, arriving = base.bars(spark, data, 0), clean.normalize_bars(base.bars(spark, data, 1))
    held.store.publish([held.store.stage("bars", stored, held.part)])
    some = arriving.filter("date_format(bar_ts, 'yyyy-MM') = '1996-03'").cache()
    judged = held.judged(some, ["close", "volume"])
    files = {f for f in held.store.read("bars", held.store.touched(some, month("bar_ts"))).inputFiles()}
    assert files and all("stored_part=1996-03" in f for f in files) and len(held.store.parts("bars")) > 50
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "close" not in plan.split("ReadSchema")[1].split("\n")[0]
    new = {tuple(r[c] for c in BAR_KEY) for r in some.select(*BAR_KEY).distinct().join(stored.select(*BAR_KEY), BAR_KEY, "left_anti").collect()}
    assert {tuple(r[c] for c in BAR_KEY) for r in judged.filter("is_new").collect()} == new
    before = held.store.read("bars").count()
    for _ in range(2):
        held.insert(some, ["close", "volume"])
        assert held.store.read("bars").count() == before + len(new)


def bar(k, day_, hour=10, symbol="A"):
    return (symbol, float(k), dt.date(2024, 2, 1), "C", "TRADES", dt.datetime(2024, *day_, hour), 1.0, 5)


def bars_of(spark, values):
    return spark.createDataFrame(values, "symbol string, strike double, expiry date, option_type string, what_to_show string, bar_ts timestamp_ntz, close double, volume long")


def latest(df):
    return sorted((r["strike"], r["latest"].month, r["latest"].day) for r in df.collect())


def test_latest_bars_are_kept(store, spark):
    held = Bars(store)
    with pytest.raises(ValueError, match="no bars"):
        held.latest()
    held.insert(bars_of(spark, [bar(1, (1, 2)), bar(1, (1, 3)), bar(2, (1, 2)), bar(3, (2, 2))]), ["close", "volume"])
    assert latest(held.latest()) == [(1.0, 1, 3), (2.0, 1, 2), (3.0, 2, 2)]
    before = store.manifest()["tables"]["latest"]["parts"]
    # an older bar of 1, a stored one of 3, and later ones of 2: only the bucket of 1 and that of 2 are written
    held.insert(bars_of(spark, [bar(1, (1, 1)), bar(3, (2, 2)), bar(2, (3, 1)), bar(2, (3, 4))]), ["close", "volume"])
    after = store.manifest()["tables"]["latest"]["parts"]
    assert latest(held.latest()) == [(1.0, 1, 3), (2.0, 3, 4), (3.0, 2, 2)] and store.read("bars").count() == 7
    touched = set(store.touched(bars_of(spark, [bar(1, (1, 1)), bar(2, (1, 1))]), held.latest_part))
    assert {p for p in after if after[p] != before.get(p)} == touched
    assert latest(held.latest(bars_of(spark, [bar(2, (1, 1)), bar(9, (1, 1))]))) == [(2.0, 3, 4)]
    assert all("/latest/" in f for f in held.latest().inputFiles())
    n = store.version()
    held.insert(bars_of(spark, []), ["close", "volume"])
    assert store.version() == n + 1 and latest(held.latest()) == [(1.0, 1, 3), (2.0, 3, 4), (3.0, 2, 2)]


def test_latest_without_kept_maxima(store, spark):
    """A store that was filled without them is scanned, until they are gathered; neither side overlooks the other's commit."""
    held, order = Bars(store), ["close", "volume"]
    store.publish([store.stage("bars", bars_of(spark, [bar(1, (1, 2)), bar(2, (1, 5))]), held.part)])
    held.insert(bars_of(spark, [bar(1, (3, 2))]), order)
    assert not store.parts("latest") and latest(held.latest()) == [(1.0, 3, 2), (2.0, 1, 5)]
    assert latest(held.latest(bars_of(spark, [bar(2, (1, 1))]))) == [(2.0, 1, 5)]
    base = store.version()
    late = held.changes(held.stage(bars_of(spark, [bar(2, (4, 4))]), order), base)
    held.gather()
    with pytest.raises(Conflict):
        store.publish(late, base)
    held.insert(bars_of(spark, [bar(2, (4, 4))]), order)
    assert all("/latest/" in f for f in held.latest().inputFiles()) and latest(held.latest()) == [(1.0, 3, 2), (2.0, 4, 4)]


def test_gather_gives_way_to_commits(store, spark, monkeypatch):
    held = Bars(store)
    store.publish([store.stage("bars", bars_of(spark, [bar(1, (1, 2))]), held.part)])
    real = store.stage

    def meanwhile(table, *args, **kwargs):
        if table == "latest":
            store.publish([real("bars", bars_of(spark, [bar(1, (5, 2))]), held.part)])
        return real(table, *args, **kwargs)

    monkeypatch.setattr(store, "stage", meanwhile)
    with pytest.raises(Conflict):
        held.gather()
    assert latest(held.latest()) == [(1.0, 5, 2)]


def test_backfill_keeps_latest_bars(spark, tmp_path):
    job, requests, arriving = made(spark, tmp_path)
    job.run("r1", requests, arriving, NOW, most=5)
    job.run("r2", requests, arriving, NOW + dt.timedelta(hours=2))
    want = {r["strike"]: r["t"] for r in job.store.read("bars").groupBy("strike").agg(F.max("bar_ts").alias("t")).collect()}
    assert {r["strike"]: r["latest"] for r in job.bars.latest().collect()} == want and len(want) == 7
    assert all("/latest/" in f for f in job.bars.latest().inputFiles())


def test_part_names(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-02 10:00:00' AS t, 'k' AS k")
    assert df.select(day("t"), month("t")).first()[:] == ("2024-01-02", "2024-01")
    assert 0 <= int(df.select(bucket(4, "k")).first()[0]) < 4


def test_upsert_leaves_other_parts(store, spark):
    from skewlake.operators import ingest

    part, put = F.substring("id", 1, 1), lambda old, new: ingest.upsert(old, new, ["id"], "v")
    df = lambda rows: spark.createDataFrame(rows, "id string, v int, x string")
    store.publish([store.rewrite("t", df([("a1", 1, "p"), ("a1", 3, "q"), ("b1", 1, "r"), ("b2", 5, "s")]), part, put)])
    before = store.manifest()["tables"]["t"]["parts"]
    new = df([("b1", 2, "u"), ("b2", 4, "late"), ("c1", None, None)])
    for _ in range(2):
        store.publish([store.rewrite("t", new, part, put)])
        assert sorted((r["id"], r["v"], r["x"]) for r in store.read("t").collect()) == [("a1", 3, "q"), ("b1", 2, "u"), ("b2", 5, "s"), ("c1", None, None)]
    after = store.manifest()["tables"]["t"]["parts"]
    assert after["a"] == before["a"] and after["b"] != before["b"]
    store.publish([store.rewrite("t", new.limit(0), part, put)])
    assert store.manifest()["tables"]["t"]["parts"] == after


def test_skew_run_lands_whole(store, spark, monkeypatch):
    import datetime as dt

    at = lambda h, d=2: dt.datetime(2024, 1, d, h)
    rows = lambda r: spark.createDataFrame(r, "symbol string, snapshot_time timestamp_ntz, strike double")
    told = lambda r: spark.createDataFrame(r, "symbol string, snapshot_time timestamp_ntz, status string")
    run = lambda a, b: tables.write_skew(store, rows(a), told(b), told(b).groupBy("symbol", "snapshot_time").agg(F.count_if(F.col("status") == "SELECTED").alias("completed")))
    got = lambda name: sorted(tuple(r) for r in store.read(name).collect())
    both = [("A", at(1), "SELECTED"), ("A", at(1), "MISSING_NO_CANDIDATE"), ("B", at(2), "SELECTED")]
    for _ in range(2):
        run([("A", at(1), 5.0), ("B", at(2), 6.0)], both)
        assert got("skew_rows") == [("A", at(1), 5.0), ("B", at(2), 6.0)] and got("skew_progress") == [("A", at(1), 1), ("B", at(2), 1)]
    # a run that stops between two tables shows nothing
    publish = store.publish
    monkeypatch.setattr(store, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError()))
    with pytest.raises(RuntimeError):
        run([], [("A", at(1), "MISSING_NO_CANDIDATE")])
    assert got("skew_rows") == [("A", at(1), 5.0), ("B", at(2), 6.0)] and got("skew_status") == sorted(both)
    # a snapshot that is written again without a selected target loses its rows, and no other snapshot of the day does
    monkeypatch.setattr(store, "publish", publish)
    run([], [("A", at(1), "MISSING_NO_CANDIDATE"), ("C", at(1, 3), "MISSING_NO_CANDIDATE")])
    assert got("skew_rows") == [("B", at(2), 6.0)]
    assert got("skew_status") == [("A", at(1), "MISSING_NO_CANDIDATE"), ("B", at(2), "SELECTED"), ("C", at(1, 3), "MISSING_NO_CANDIDATE")]
    assert got("skew_progress") == [("A", at(1), 0), ("B", at(2), 1), ("C", at(1, 3), 0)]
