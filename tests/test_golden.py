"""Values traced by hand, and properties."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from skewlake import config
from skewlake.functions import pricing
from skewlake.functions import scalars as S
from skewlake.operators import ingest, joins, progress, select, universe

DAY = dt.date(2024, 1, 1)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_prices_and_volatility(spark):
    a = [F.lit(float(x)) for x in (100, 100, 0.25, 0.05, 0.2)]
    assert one(spark, pricing.bs_price(*a, F.lit("C"))) == pytest.approx(4.6149971, abs=1e-7)
    assert one(spark, pricing.bs_price(*a, F.lit("P"))) == pytest.approx(3.3727772, abs=1e-7)
    df = spark.createDataFrame([(4.6149971296, 100.0, 100.0, 0.25, 0.05, "C"), (500.0, 100.0, 100.0, 0.25, 0.05, "C")], "p double, s double, k double, t double, r double, o string")
    got = [r["x"] for r in df.select(pricing.implied_vol(*map(F.col, "psktro")).alias("x")).collect()]
    assert got[0] == pytest.approx(0.2, abs=1e-6) and got[1] is None


@pytest.mark.parametrize(("delta", "days", "side", "want"), [(0.10, 180, "C", 0.094193), (0.10, 180, "P", 0.141289), (0.005, 30, "C", 0.3)])
def test_moneyness_offset(spark, delta, days, side, want):
    assert one(spark, S.moneyness_offset(F.lit(delta), F.lit(days), F.lit(side))) == pytest.approx(want, abs=1e-6)


def test_strikes(spark):
    chain = spark.createDataFrame([("X", float(k)) for k in range(5, 201, 5)], "symbol string, strike double")
    spots = spark.createDataFrame([("X", 100.0)], "symbol string, spot double")
    guesses = spots.withColumn("guess", F.explode(F.array(F.col("spot") * 1.3, F.col("spot") * 0.7)))
    assert sorted(r["strike"] for r in universe.candidate_strikes(chain, guesses, ["symbol"]).collect()) == [65, 70, 75, 125, 130, 135]
    near = universe.nearest_strike(spark.createDataFrame([("X", 123.0), ("X", 7.5)], "symbol string, guess double"), chain, ["symbol"])
    assert {r["guess"]: r["selected_strike"] for r in near.collect()} == {123.0: 125.0, 7.5: 5.0}
    wing = universe.wing_candidates(chain, spots, [0.3, 0.05], config.OFFSET_CURVE)
    assert sorted(r["strike"] for r in wing.collect()) == [90, 95, 100, 105, 110]


def test_moneyness_and_flags(spark):
    assert one(spark, S.moneyness(F.lit(100.0), F.lit(100.0))) == 1.0 and one(spark, S.is_atm(F.lit(1.0))) is True
    assert one(spark, S.moneyness(F.lit(100.0), F.lit(0.0))) is None and one(spark, S.is_atm(F.lit(None).cast("double"))) is False
    assert [one(spark, S.backoff_minutes(F.lit(n))) for n in (0, 5, 99)] == [1, 5, 30]
    assert one(spark, S.positive(F.lit(-1.0))) is None and one(spark, S.positive(F.lit(7554.29))) == 7554.29


@pytest.mark.parametrize(("at", "want"), [("2024-01-05 09:30:00", True), ("2024-01-05 16:15:00", True), ("2024-01-05 16:15:00.000001", False), ("2024-01-05 09:29:59.9", False), ("2024-01-06 12:00:00", False)])
def test_market_hours(spark, at, want):
    assert one(spark, S.in_market_hours(F.lit(at).cast("timestamp"))) is want


def test_unknown_kind_and_bar_size_are_errors(spark):
    with pytest.raises(Exception, match="unknown instrument kind"):
        one(spark, S.checked_kind(F.lit("FUT")))
    ranges = spark.createDataFrame([(DAY, DAY + dt.timedelta(9), "2 mins")], "start_date date, end_date date, bar_size string")
    with pytest.raises(Exception, match="unknown bar size"):
        ingest.date_chunks(ranges, config.bar_sizes(spark)).collect()


def test_chunks(spark):
    days = lambda n: DAY + dt.timedelta(n)
    rows = [(DAY, days(8), "1 min"), (days(3), days(3), "1 min"), (days(4), days(2), "1 min")]
    ranges = spark.createDataFrame(rows, "start_date date, end_date date, bar_size string")
    got = lambda **o: sorted(((r["chunk_start"] - DAY).days, (r["chunk_end"] - DAY).days) for r in ingest.date_chunks(ranges, config.bar_sizes(spark), **o).collect() if r["end_date"] == days(8))
    assert got() == [(0, 3), (4, 7)] and got(cover_tail=True) == [(0, 3), (4, 7), (8, 8)]


def test_missing_ranges_of_nothing(spark):
    stored = spark.createDataFrame([], "symbol string, trade_date date")
    asked = spark.createDataFrame([("A", DAY, DAY + dt.timedelta(3))], "symbol string, start_date date, end_date date")
    assert [tuple(r) for r in ingest.missing_ranges(stored, asked).collect()] == [("A", DAY, DAY + dt.timedelta(3))]


def test_insert_twice_is_insert_once(spark):
    new = spark.createDataFrame([(1, 5), (1, 4), (2, 6)], "k int, v int")
    old = spark.createDataFrame([(2, 1)], "k int, v int")
    once = old.union(ingest.insert_new(old, new, ["k"], ["v"]))
    assert sorted(map(tuple, once.collect())) == [(1, 4), (2, 1)]
    assert ingest.insert_new(once, new, ["k"], ["v"]).count() == 0


def test_two_failed_cycles_use_up_the_budget(spark):
    log = spark.createDataFrame([(1, n, "2024-01-01 00:00:00", s) for n, s in enumerate(["IN_PROGRESS", "RETRY"] * 2)], "c int, n int, ts string, status string").withColumn("ts", F.col("ts").cast("timestamp"))
    r = progress.checkpoint_state(log, ["c"], "n", "ts").first()
    assert (r["attempts"], r["status"], r["backoff_until"]) == (4, "FAILED", None)
    assert progress.checkpoint_state(log, ["c"], "n", "ts", count_in_progress=False).first()["status"] == "RETRY"


def test_window_cost_leaves_out_the_edge(spark):
    log = spark.createDataFrame([(0, "2024-01-01 00:00:00"), (0, "2024-01-01 00:10:00"), (0, "2024-01-01 00:19:59")], "c int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = ingest.rolling_cost(log, ["c"], "ts", F.lit(2)).orderBy("ts").collect()
    assert [r["window_cost"] for r in got] == [2, 2, 4]


def walk(quotes, first, target, spot, hops, patience):
    """The bounded search, step by step."""
    q = sorted(quotes)
    rank = lambda i: (float("inf") if q[i][1] is None else abs(q[i][1] - target), 0 if q[i][2] and q[i][1] is not None else 1, abs(q[i][0] - spot))
    above, below = [i for i in range(len(q)) if q[i][0] >= first][:1], [i for i in range(len(q)) if q[i][0] < first][-1:]
    if above and q[above[0]][0] == first:
        start, way = above[0], 0
    elif above and (not below or rank(above[0]) < rank(below[0])):
        start, way = above[0], 1
    else:
        start, way = below[0], -1
    best, idle, counted, hop = None, 0, 0, 0

    def look(i):
        nonlocal best, counted, way_new
        if not 0 <= i < len(q):
            return None
        strike, delta, full = q[i]
        if delta is None:
            return False
        counted += 1
        score = (abs(delta - target), 0 if full else 1, abs(strike - spot))
        if best is None or score < best[0]:
            best, way_new = (score, strike), way_new if i == start else (i > start) - (i < start)
            return True
        return False

    while True:
        way_new = way
        seen = [x for x in (look(i) for i in ([start] if hop == 0 else [start - hop] if way < 0 else [start + hop] if way > 0 else [start - hop, start + hop])) if x is not None]
        way = way_new
        if hop and seen:
            idle = 0 if any(seen) else idle + 1
        if idle >= patience or counted >= hops + 1 or hop > len(q):
            return best and best[1]
        hop += 1


@pytest.mark.parametrize("seed", range(4))
def test_bounded_walk(spark, seed):
    rng = random.Random(seed)
    rows, targets, want = [], [], {}
    for s in range(12):
        strikes = rng.sample(range(80, 121), rng.randint(1, 14))
        mine = [(float(k), None if rng.random() < 0.2 else round(rng.random(), 2), rng.random() < 0.8) for k in strikes]
        rows += [(f"S{s}", DAY, DAY, "C", k, 100.0, d, 1.0 if f else None) for k, d, f in mine]
        for t in (0.2, 0.6):
            guess, hops = float(rng.randrange(76, 125)), (3, 100)[seed % 2]
            targets.append((f"S{s}", DAY, DAY, "C", t, guess))
            want[f"S{s}", t] = walk(mine, guess, t, 100.0, hops, (2, 100)[seed // 2])
    q = spark.createDataFrame(rows, "symbol string, snapshot_time date, expiry date, option_type string, strike double, underlying_price double, delta double, bid double")
    q = q.withColumns({c: F.lit(1.0) for c in ("ask", "iv_bid", "iv_ask", "gamma", "theta", "vega")})
    t = spark.createDataFrame(targets, "symbol string, snapshot_time date, selected_expiry date, option_type string, target_delta double, starting_strike double")
    got = {(r["symbol"], r["target_delta"]): r["best"] and r["best"]["strike"] for r in select.best_delta_bounded(t, q, (3, 100)[seed % 2], (2, 100)[seed // 2]).collect()}
    assert got == want


def test_wide_walk_is_best_delta(spark, data):
    from skewlake.plans import base, selection

    q = base.cleaned(spark, data).filter("delta IS NOT NULL")
    targets = selection._guessed(spark, data, *selection._facts(spark, data)[1:])
    wide = select.best_delta_bounded(targets, q, 200, 200).select("symbol", "snapshot_time", "option_type", "target_tenor_dte", "target_delta_abs", F.col("best.gap").alias("walked"))
    best = select.best_delta(targets.drop("guess", "starting_strike"), q, ["delta"]).select("symbol", "snapshot_time", "option_type", "target_tenor_dte", "target_delta_abs", F.col("best.gap").alias("least"))
    both = wide.join(best, ["symbol", "snapshot_time", "option_type", "target_tenor_dte", "target_delta_abs"]).toPandas()
    assert len(both) and (both["walked"] == both["least"]).all()  # deltas fall with strikes here, so the walk can't miss the least gap


def test_lookups_have_defaults(spark):
    got = joins.classify_instruments(spark.createDataFrame([("SPX",), ("ZZ",)], "symbol string"), config.exchanges(spark))
    assert {r["symbol"]: (r["kind"], r["exchange"]) for r in got.collect()} == {"SPX": ("IND", "CBOE"), "ZZ": ("STK", "SMART")}


def test_cdf_is_the_normal_distribution():
    x = pd.Series([-40, -8.5, -3, -0.1, 0, 1, 7.5])
    assert pricing._cdf(x.to_numpy()) == pytest.approx([0.5 * math.erfc(-v / math.sqrt(2)) for v in x], abs=1e-13)


def test_nearest_over_ranges(spark):
    """A sorted merge over many ranges gives what comparing all pairs gives, with ties, repeats and groups without a chain."""
    import random

    from pyspark.sql import functions as F

    r = random.Random(4)
    chain = [("A", float(r.randrange(0, 400) * 2)) for _ in range(150)] + [("B", 7.0)]
    asked = [("A", float(x)) for x in range(-20, 830, 3)] + [("B", 1e6), ("C", 1.0), ("A", 11.0), ("A", None)]
    got = universe.nearest(spark.createDataFrame(asked, "symbol string, p double"), spark.createDataFrame(chain, "symbol string, v double"), ["symbol"], F.col("v"), F.col("p"), 16.0, "v")
    want = {(s, p, min((abs(v - p), v) for t, v in chain if t == s)[1]) for s, p in asked if p is not None and s != "C"}
    rows = [tuple(x) for x in got.collect()]
    assert set(rows) == want and len(rows) == len(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") >= 3 and "Join Cross" not in plan
