"""Every query of the library against its SQL in DuckDB, over the smallest tables."""

import pytest

from skewlake.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, data, same, name):
    same(QUERIES[name](spark, data), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries()) and set(QUERIES) <= set(e.queries())


def test_contract_universe_of_every_symbol(spark, data):
    from skewlake.plans.base import quotes

    rows = {(r["symbol"], r["strike"], r["expiry"], r["option_type"]) for r in quotes(spark, data).select("symbol", "strike", "expiry", "option_type").distinct().collect()}
    strikes, expiries = {}, {}
    for s, k, e, _ in rows:
        strikes.setdefault(s, set()).add(k)
        expiries.setdefault(s, set()).add(e)
    want = {(s, k, e, o) for s in strikes for k in strikes[s] for e in expiries[s] for o in "CP"} - rows
    assert any(s >= "S3" for s, *_ in want)
    got = QUERIES["contract_universe"](spark, data).select("symbol", "strike", "expiry", "option_type").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
