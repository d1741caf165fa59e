"""Chains gathered once: choices, walks and starts from them."""

import datetime as dt
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skewlake import fixtures
from skewlake.operators import select, universe
from skewlake.plans import base, registry, selection

DAY, KEY = dt.date(2024, 1, 2), ["symbol", "snapshot_time", "selected_expiry", "option_type"]


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_are_chains(spark, data):
    """What later steps read many times is a row for each chain and each expiry, not for each quote."""
    chains, snaps, strikes = selection._facts(spark, data)
    n = selection.quotes(spark, data).select("symbol", "snapshot_time", "expiry", "option_type").distinct().count()
    assert chains.count() == n and chains.select(F.sum(F.size("chain"))).first()[0] == selection.quotes(spark, data).count()
    assert strikes.count() == selection.expiries(spark, data).count()
    assert "Window" not in planned(universe.starting_strikes(snaps.join(strikes.select("symbol", "expiry"), "symbol").withColumn("guess", F.col("spot")), strikes, ["symbol", "expiry"]))


def test_walks_go_over_arrays(spark, data):
    """No fold for each target: all of a batch walk at once, and no quote is sorted beside its targets."""
    text = planned(registry.queries()["best_delta_bounded"](spark, data))
    assert "ArrowEvalPython" in text and "aggregate(" not in text and "ShuffledHashJoin" in text


@pytest.mark.parametrize("seed", range(2))
def test_walk_ties_and_unknown_distances(spark, seed):
    """Batches of several chains equal one target at a time: equal gaps fall to completeness, then distance from spot, of which an unknown one is least."""
    r = random.Random(seed)
    chains = [[(float(k), r.choice([None, 0.1, 0.3, 0.5]), r.randrange(2), r.choice([None, 1.0, 2.0])) for k in sorted(r.sample(range(40), r.randint(1, 20)))] for _ in range(40)]
    asked = [[(float(r.randrange(-2, 43)), r.choice([0.2, 0.4])) for _ in range(r.randint(1, 4))] for _ in chains]
    walk = select.walk_places(4, 2).func
    lists = lambda rows, i: pa.array([[x[i] for x in row] for row in rows])
    got = walk(*[lists(chains, i) for i in range(4)], lists(asked, 0), lists(asked, 1)).to_pylist()
    for chain, targets, places in zip(chains, asked, got):
        assert places == [one_walk(chain, *t, 4, 2) for t in targets]


def one_walk(chain, first, target, hops, patience):
    score = lambda i: (float("inf") if chain[i][1] is None else abs(chain[i][1] - target), chain[i][2], -1.0 if chain[i][3] is None else chain[i][3])
    p = sum(q[0] < first for q in chain)
    if p < len(chain) and chain[p][0] == first:
        at, way = p, 0
    else:
        at, way = (p, 1) if p == 0 or p < len(chain) and score(p) < score(p - 1) else (p - 1, -1)
    best, idle, counted = (at if chain[at][1] is not None else None), 0, int(chain[at][1] is not None)
    for h in range(1, 99):
        if idle >= patience or counted > hops:
            break
        looked = [i for i, side in ((at - h, -1), (at + h, 1)) if way * side >= 0 and 0 <= i < len(chain)]
        better = False
        for i in looked:
            if chain[i][1] is not None:
                counted += 1
                if best is None or score(i) < score(best):
                    best, way, better = i, (1 if i > at else -1), True
        if looked:
            idle = 0 if better else idle + 1
    return best


def test_starting_strikes(spark):
    r = random.Random(3)
    chain = [("A", sorted(float(x * 2) for x in r.sample(range(100), 30))), ("B", [7.0]), ("E", [])]
    asked = [("A", float(x)) for x in range(-5, 210, 3)] + [("A", 11.0), ("B", 1e6), ("B", None), ("C", 1.0), ("E", 1.0)]
    got = universe.starting_strikes(spark.createDataFrame(asked, "symbol string, guess double"), spark.createDataFrame(chain, "symbol string, strikes array<double>"), ["symbol"])
    held = {s: k for s, k in chain if k}
    want = [(s, g, min((abs(k - g), k) for k in held[s])[1]) for s, g in asked if g is not None and s in held]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert "Sort" not in planned(got)


def test_skew_plan_is_stored(spark, data, monkeypatch):
    """The run asks for each target's expiry once: what walks and what is told read the same stored plan."""
    seen, real = [], select.walked_chains
    monkeypatch.setattr(selection.P, "walked_chains", lambda targets, *a: seen.append(planned(targets)) or real(targets, *a))
    selection.skew_snapshot(spark, data)
    assert seen and "Window" not in seen[0]


def some(spark, seed=5):
    r = random.Random(seed)
    rows = [(f"S{s}", DAY, DAY, o, float(k), 100.0, r.choice([None, 0.1, 0.2, 0.3, 0.4]), r.choice([None, 1.0])) for s in range(8) for o in "CP" for k in r.sample(range(90, 111), r.randint(1, 9))]
    q = spark.createDataFrame(rows, "symbol string, snapshot_time date, expiry date, option_type string, strike double, underlying_price double, delta double, bid double")
    q = q.withColumns({c: F.lit(1.0) for c in ("ask", "iv_bid", "iv_ask", "gamma", "theta", "vega")})
    t = [(f"S{s}", DAY, DAY, o, x) for s in range(9) for o in "CP" for x in (0.15, 0.3)]
    return rows, q, t + t[:3], spark.createDataFrame(t + t[:3] + [("S1", DAY, None, "C", 0.15)], "symbol string, snapshot_time date, selected_expiry date, option_type string, target_delta double")


def test_best_delta_from_chains(spark):
    """Equal to comparing all quotes of a chain, each target once; the wide rows are neither joined in copies nor sorted."""
    rows, q, asked, targets = some(spark)
    want = {}
    for s, _, e, o, x in asked:
        scores = [(abs(d - x), int(b is None), abs(k - 100.0), k, d, b) for s2, _, _, o2, k, _, d, b in rows if (s2, o2) == (s, o) and d is not None]
        want[s, e, o, x] = min(scores, key=lambda v: v[:4]) if scores else None
    told = lambda df: {(r[0], r[2], r[3], r["target_delta"]): r["best"] and tuple(r["best"][c] for c in ("gap", "incomplete", "strike_gap", "strike", "delta", "bid")) for r in df.select(*KEY, "target_delta", "best").collect()}
    inner, left = (select.best_delta(targets, q, ["delta", "bid"], how) for how in ("inner", "left"))
    assert told(inner) == {k: v for k, v in want.items() if v} and inner.count() == len(told(inner))
    assert told(left) == want | {("S1", None, "C", 0.15): None} and left.count() == len(want) + 1
    assert "SortAggregate" not in planned(inner) and "SortMergeJoin" not in planned(inner)


def test_best_delta_query_sorts_no_quotes(spark, data):
    text = planned(registry.queries()["best_delta"](spark, data))
    assert "ShuffledHashJoin" in text and not re.search(r"\bmin\(CASE", text)


def test_exhaustive_snapshot_copies_no_readings(spark, data):
    """Readings come from places in chains after the choice, so no target carries those of every quote."""
    plan = selection._best(spark, data, selection.KEEP)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" in plan and not re.search(r"\bmin\(CASE", plan) and "array_min(" in plan


def test_quotes_and_chains_take_one_shuffle_into_bounded_tasks(spark, data, monkeypatch):
    """No task combines the rows of a whole file split: they are dealt by chain before, to as many tasks as their number asks for, and then lie as chains need them."""
    monkeypatch.setattr(fixtures, "TASK_ROWS", 500)
    chains = select.gathered(base.cleaned(spark, data), ["delta"])
    above, below = planned(chains).split("Exchange")
    assert "collect_list" in above and "Aggregate" not in below
    assert chains.rdd.getNumPartitions() == -(-fixtures.table(spark, data, "lineitem").count() // 500) > 4
    held = chains.groupBy(F.spark_partition_id()).agg(F.sum(F.size("chain")).alias("n"))
    assert held.agg(F.max("n")).first()[0] < 1000
