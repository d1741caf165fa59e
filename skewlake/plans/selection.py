"""Universe building and the choice of contracts for a target grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..operators import clean, progress
from ..operators import select as P
from ..operators import universe as U
from ..sources import tables as T
from .base import asof, clean_of, cleaned, CQ, GRID, STATUS, S, expiries, grid, query, quotes, spots, stored_quotes, strikes

BY = ["symbol", "snapshot_time", "option_type", "target_tenor_dte", "target_delta_abs"]


@query("SELECT s.symbol, s.strike, e.expiry, o AS option_type FROM (SELECT DISTINCT symbol, strike FROM fx_quotes) s JOIN (SELECT DISTINCT symbol, expiry FROM fx_quotes) e ON e.symbol = s.symbol, (SELECT unnest(['C', 'P']) AS o) EXCEPT SELECT symbol, strike, expiry, option_type FROM fx_quotes")
def contract_universe(spark, d):
    """Contracts to be followed, less those already quoted."""
    every = U.contract_universe(strikes(spark, d), expiries(spark, d), ["symbol"])
    key = ["symbol", "strike", "expiry", "option_type"]
    return every.select(*key).join(quotes(spark, d).select(*key).distinct(), key, "left_anti")


@query(f"WITH {GRID} SELECT * FROM grid")
def target_grid(spark, d):
    return grid(spark, d)


@query(f"WITH {CQ}, {GRID} SELECT * FROM ne")
def nearest_expiry(spark, d):
    return U.nearest_expiry(grid(spark, d).select("symbol", "target_tenor_dte").distinct(), expiries(spark, d), asof())


@query("""SELECT g.symbol, g.guess, arg_min(s.strike, abs(s.strike - g.guess) * 1000000 + s.strike) AS selected_strike FROM (SELECT DISTINCT symbol, underlying_price + v AS guess FROM fx_quotes, (SELECT CAST(unnest([-7.5, 0.5, 9]) AS DOUBLE) AS v)) g
JOIN (SELECT DISTINCT symbol, strike FROM fx_quotes) s ON s.symbol = g.symbol GROUP BY ALL""")
def nearest_strike(spark, d):
    guesses = spots(spark, d).select("symbol", F.explode(F.array(*[F.col("spot") + v for v in (-7.5, 0.5, 9.0)])).alias("guess"))
    return U.nearest_strike(guesses, strikes(spark, d), ["symbol"])


@query(f"WITH {CQ}, {GRID} SELECT symbol, snapshot_time, target_tenor_dte, target_delta_abs, option_type, 'MISSING_NO_CANDIDATE' AS status FROM plan WHERE symbol = 'S1'")
def missing_targets(spark, d):
    """Targets that no expiry serves: those of a symbol whose chain is left out."""
    plan = P.plan_targets(quotes(spark, d), grid(spark, d), asof(), expiries(spark, d).filter(F.col("symbol") != "S1"))
    return plan.filter("selected_expiry IS NULL").select("symbol", "snapshot_time", "target_tenor_dte", "target_delta_abs", "option_type", F.lit("MISSING_NO_CANDIDATE").alias("status"))


def _facts(spark, d, keep: tuple = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored chains of quotes, and from them their snapshots with spots and the strikes of each expiry: some rows for each symbol, which later steps ask for often."""
    chains = T.write_and_read(P.gathered(cleaned(spark, d), list(keep), "underlying_price"), [])
    snaps = chains.select("symbol", "snapshot_time", F.explode(F.array_distinct("chain.underlying_price")).alias("spot")).distinct()
    each = chains.groupBy("symbol", F.col("selected_expiry").alias("expiry")).agg(F.collect_set("chain.strike").alias("sets"))
    strikes = each.select("symbol", "expiry", F.array_sort(F.array_compact(F.array_distinct(F.flatten("sets")))).alias("strikes"))
    return chains, T.write_and_read(snaps, []), T.write_and_read(strikes, [])


def _plan(spark, d, snaps: DataFrame, strikes: DataFrame) -> DataFrame:
    return P.plan_targets(snaps, grid(spark, d, snaps), asof(), strikes.select("symbol", "expiry"))


RANKED = "rk AS (SELECT symbol, strike, row_number() OVER (PARTITION BY symbol ORDER BY strike) AS place FROM (SELECT DISTINCT symbol, strike FROM fx_quotes)), sp AS (SELECT DISTINCT symbol, underlying_price AS spot FROM fx_quotes)"


def _near(point: str, name: str, table: str = "rk") -> str:
    return f"{name} AS (SELECT sp.symbol, arg_min(place, abs(strike - ({point})) * 1000000 + strike) AS at FROM sp JOIN {table} ON {table}.symbol = sp.symbol GROUP BY sp.symbol)"


@query(f"WITH {RANKED}, {_near('spot - 5.5', 'lo')}, {_near('spot + 6.25', 'hi')} SELECT sp.symbol, spot - 5.5 AS low, spot + 6.25 AS high, strike FROM sp JOIN lo ON lo.symbol = sp.symbol JOIN hi ON hi.symbol = sp.symbol JOIN rk ON rk.symbol = sp.symbol AND place BETWEEN lo.at - 3 AND hi.at + 3")
def strike_band(spark, d):
    days = spots(spark, d).select("symbol", (F.col("spot") - 5.5).alias("low"), (F.col("spot") + 6.25).alias("high"))
    return U.strike_band(strikes(spark, d), days, 3)


@query(f"WITH {RANKED}, {_near('spot', 'c')} SELECT sp.symbol, spot, strike FROM sp JOIN c ON c.symbol = sp.symbol JOIN rk ON rk.symbol = sp.symbol AND place > c.at AND place <= c.at + 5")
def strikes_above(spark, d):
    return U.strikes_above(strikes(spark, d), spots(spark, d), 5)


@query(f"WITH {RANKED}, h AS (SELECT symbol, strike / 2 AS strike, row_number() OVER (PARTITION BY symbol ORDER BY strike) AS place FROM rk WHERE (strike / 2) % 1 = 0), {_near('spot / 2', 'c', 'h')} SELECT sp.symbol, spot / 2 AS spot, strike FROM sp JOIN c ON c.symbol = sp.symbol JOIN h ON h.symbol = sp.symbol AND place BETWEEN c.at - 3 AND c.at + 3")
def strikes_around_spot(spark, d):
    halves = strikes(spark, d).select("symbol", (F.col("strike") / 2).alias("strike"))
    return U.strikes_around_spot(halves, spots(spark, d).select("symbol", (F.col("spot") / 2).alias("spot")), 7)


OFFSET = """(CASE WHEN dl >= 0.4 THEN 0.012 WHEN dl >= 0.3 THEN 0.021 WHEN dl >= 0.2 THEN 0.031 WHEN dl >= 0.1 THEN 0.046 WHEN dl >= 0.05 THEN 0.06 WHEN dl >= 0.01 THEN 0.098 ELSE 0.3 END)
  * pow(greatest(1, expiry - DATE '2024-01-02') / CAST(30 AS DOUBLE), 0.4) * CASE WHEN o = 'P' THEN 1.5 ELSE 1.0 END"""


@query(f"""WITH rk AS (SELECT symbol, expiry, strike, row_number() OVER (PARTITION BY symbol, expiry ORDER BY strike) AS place FROM (SELECT DISTINCT symbol, expiry, strike FROM fx_quotes)),
g AS (SELECT symbol, expiry, o, dl, spot * CASE WHEN o = 'C' THEN 1 + {OFFSET} ELSE 1 - {OFFSET} END AS guess FROM (SELECT DISTINCT symbol, expiry, underlying_price AS spot FROM fx_quotes), (SELECT unnest(['C', 'P']) AS o), (SELECT CAST(unnest([0.1, 0.2]) AS DOUBLE) AS dl)),
a AS (SELECT g.symbol, g.expiry, guess, arg_min(place, abs(strike - guess) * 1000000 + strike) AS pos FROM g JOIN rk ON rk.symbol = g.symbol AND rk.expiry = g.expiry GROUP BY ALL)
SELECT DISTINCT a.symbol, a.expiry, strike FROM a JOIN rk ON rk.symbol = a.symbol AND rk.expiry = a.expiry AND place BETWEEN pos - 1 AND pos + 1""")
def candidate_strikes(spark, d):
    chain = quotes(spark, d).select("symbol", "expiry", "strike").distinct()
    wanted = expiries(spark, d).join(spots(spark, d), "symbol").withColumn("target_delta_abs", F.explode(F.array(F.lit(0.1), F.lit(0.2)))).withColumn("option_type", F.explode(U.sides()))
    return U.candidate_strikes(chain, U.delta_guesses(wanted, S.dte(F.col("expiry"), asof())), ["symbol", "expiry"], 1)


@query("SELECT symbol, expiry, strike, CASE WHEN row_number() OVER (PARTITION BY symbol, expiry ORDER BY strike) <= count(*) OVER (PARTITION BY symbol, expiry) / 2 THEN 'P' ELSE 'C' END AS option_type FROM (SELECT DISTINCT symbol, expiry, strike FROM fx_quotes)")
def split_put_call(spark, d):
    return U.split_put_call(quotes(spark, d).select("symbol", "expiry", "strike").distinct(), ["symbol", "expiry"])


KEEP = ["delta", "bid", "ask", "last", "volume", "open_interest", "underlying_price", "iv_bid", "iv_ask", "gamma", "theta", "vega"]


def _best(spark, d, keep: list[str]) -> DataFrame:
    chains, snaps, strikes = _facts(spark, d, tuple(keep))
    return P.best_of_chains(_plan(spark, d, snaps, strikes).filter("selected_expiry IS NOT NULL"), chains, keep)


def _status(spark, d) -> DataFrame:
    chains, snaps, strikes = _facts(spark, d)
    return P.status_of(P.best_of_chains(_plan(spark, d, snaps, strikes), chains, ["delta"], "left"))


@query(f"WITH {CQ}, {GRID} SELECT symbol, snapshot_time, option_type, target_tenor_dte, target_delta_abs, selected_expiry, strike AS selected_strike, delta AS selected_delta, gap AS delta_gap_abs, incomplete FROM best")
def best_delta(spark, d):
    best = _best(spark, d, ["delta"])
    return best.select(*BY, "selected_expiry", F.col("best.strike").alias("selected_strike"), F.col("best.delta").alias("selected_delta"), F.col("best.gap").alias("delta_gap_abs"), F.col("best.incomplete").alias("incomplete"))


def _guessed(spark, d, snaps: DataFrame, strikes: DataFrame, plan: DataFrame | None = None) -> DataFrame:
    """Targets with the strike of the chain that is nearest to the guess, whether or not it is quoted in the snapshot."""
    plan = (_plan(spark, d, snaps, strikes) if plan is None else plan).filter("selected_expiry IS NOT NULL").join(snaps.select("symbol", "spot").distinct(), "symbol")
    guessed = U.delta_guesses(plan, S.dte(F.col("selected_expiry"), asof())).drop("spot")
    return U.starting_strikes(guessed, strikes.withColumnRenamed("expiry", "selected_expiry"), ["symbol", "selected_expiry"])


#: The bounded walk of each target, hop by hop, and the best quote of its last hop, in SQL.
WALK = f"""sp AS (SELECT DISTINCT symbol, underlying_price AS spot FROM fx_quotes),
t AS (SELECT symbol, snapshot_time, target_tenor_dte, target_delta_abs AS dl, option_type AS o, target_delta, selected_expiry AS expiry FROM plan WHERE selected_expiry IS NOT NULL),
g AS (SELECT t.*, spot * CASE WHEN o = 'C' THEN 1 + {OFFSET} ELSE 1 - {OFFSET} END AS guess FROM t JOIN sp ON sp.symbol = t.symbol),
ss AS (SELECT g.symbol, snapshot_time, target_tenor_dte, dl, o, target_delta, g.expiry, arg_min(strike, abs(strike - guess) * 1000000 + strike) AS s0 FROM g JOIN (SELECT DISTINCT symbol, expiry, strike FROM fx_quotes) c ON c.symbol = g.symbol AND c.expiry = g.expiry GROUP BY ALL),
pq AS MATERIALIZED (SELECT symbol, snapshot_time, expiry, option_type AS o, strike, delta, incomplete, strike_gap, row_number() OVER (PARTITION BY symbol, snapshot_time, expiry, option_type ORDER BY strike) AS place FROM sq),
sc AS (SELECT ss.*, strike, place, ROW(coalesce(abs(delta - target_delta), CAST('inf' AS DOUBLE)), incomplete, strike_gap) AS score FROM ss JOIN pq USING (symbol, snapshot_time, expiry, o)),
nr AS (SELECT symbol, snapshot_time, target_tenor_dte, dl, o, target_delta, expiry, s0, min(strike) FILTER (strike >= s0) AS ka, arg_min(place, strike) FILTER (strike >= s0) AS pa, arg_min(score, strike) FILTER (strike >= s0) AS a, arg_max(place, strike) FILTER (strike < s0) AS pb, arg_max(score, strike) FILTER (strike < s0) AS b FROM sc GROUP BY ALL),
s1 AS (SELECT *, CASE WHEN ka = s0 OR pb IS NULL OR a < b THEN pa ELSE pb END AS start, CASE WHEN ka = s0 THEN 0 WHEN pb IS NULL OR a < b THEN 1 ELSE -1 END AS dir FROM nr),
wk AS (SELECT s.symbol, s.snapshot_time, s.target_tenor_dte, s.dl, s.o, s.target_delta, s.expiry, s.start, s.dir, 0 AS hop, 0 AS idle, CASE WHEN q.delta IS NULL THEN 0 ELSE 1 END AS counted,
    CASE WHEN q.delta IS NOT NULL THEN ROW(abs(q.delta - s.target_delta), q.incomplete, q.strike_gap, q.strike, q.delta) END AS best
  FROM s1 s JOIN pq q ON q.symbol = s.symbol AND q.snapshot_time = s.snapshot_time AND q.expiry = s.expiry AND q.o = s.o AND q.place = s.start
  UNION ALL
  SELECT symbol, snapshot_time, target_tenor_dte, dl, o, target_delta, expiry, start, CASE WHEN up THEN 1 WHEN down THEN -1 ELSE dir END, hop + 1, CASE WHEN NOT seen THEN idle WHEN up OR down THEN 0 ELSE idle + 1 END, counted + n, CASE WHEN up THEN h WHEN down THEN l ELSE best END
  FROM (SELECT *, h IS NOT NULL AND (CASE WHEN down THEN l ELSE best END IS NULL OR (h[1], h[2], h[3]) < (CASE WHEN down THEN l[1] ELSE best[1] END, CASE WHEN down THEN l[2] ELSE best[2] END, CASE WHEN down THEN l[3] ELSE best[3] END)) AS up
    FROM (SELECT *, l IS NOT NULL AND (best IS NULL OR (l[1], l[2], l[3]) < (best[1], best[2], best[3])) AS down
      FROM (SELECT w.*, lo.place IS NOT NULL OR hi.place IS NOT NULL AS seen, CASE WHEN lo.delta IS NULL THEN 0 ELSE 1 END + CASE WHEN hi.delta IS NULL THEN 0 ELSE 1 END AS n,
          CASE WHEN lo.delta IS NOT NULL THEN ROW(abs(lo.delta - w.target_delta), lo.incomplete, lo.strike_gap, lo.strike, lo.delta) END AS l,
          CASE WHEN hi.delta IS NOT NULL THEN ROW(abs(hi.delta - w.target_delta), hi.incomplete, hi.strike_gap, hi.strike, hi.delta) END AS h
        FROM wk w LEFT JOIN pq lo ON lo.symbol = w.symbol AND lo.snapshot_time = w.snapshot_time AND lo.expiry = w.expiry AND lo.o = w.o AND lo.place = w.start - w.hop - 1 AND w.dir <= 0
        LEFT JOIN pq hi ON hi.symbol = w.symbol AND hi.snapshot_time = w.snapshot_time AND hi.expiry = w.expiry AND hi.o = w.o AND hi.place = w.start + w.hop + 1 AND w.dir >= 0
        WHERE w.idle < {config.PATIENCE} AND w.counted < {config.MAX_HOPS + 1} AND w.hop < {(config.MAX_HOPS + 1) * config.PATIENCE})))),
bb AS (SELECT symbol, snapshot_time, o AS option_type, target_tenor_dte, dl AS target_delta_abs, expiry AS selected_expiry, last(best ORDER BY hop) AS b FROM wk GROUP BY ALL)"""


@query(f"WITH RECURSIVE {CQ}, {GRID}, {WALK} SELECT symbol, snapshot_time, option_type, target_tenor_dte, target_delta_abs, selected_expiry, b[4] AS selected_strike, b[5] AS selected_delta, b[1] AS delta_gap_abs FROM bb")
def best_delta_bounded(spark, d):
    chains, snaps, strikes = _facts(spark, d)
    best = P.walked_chains(_guessed(spark, d, snaps, strikes), chains, config.MAX_HOPS, config.PATIENCE)
    return best.select(*BY, "selected_expiry", F.col("best.strike").alias("selected_strike"), F.col("best.delta").alias("selected_delta"), F.col("best.gap").alias("delta_gap_abs"))


@query(f"""WITH {CQ}, {GRID}, sp AS (SELECT DISTINCT symbol, underlying_price AS spot FROM fx_quotes), t AS (SELECT DISTINCT symbol, selected_expiry AS expiry, target_delta_abs AS dl, option_type AS o FROM plan WHERE selected_expiry IS NOT NULL),
g AS (SELECT t.*, spot * CASE WHEN o = 'C' THEN 1 + {OFFSET} ELSE 1 - {OFFSET} END AS guess FROM t JOIN sp ON sp.symbol = t.symbol)
SELECT g.symbol, g.expiry AS selected_expiry, dl AS target_delta_abs, o AS option_type, arg_min(strike, abs(strike - guess) * 1000000 + strike) AS selected_strike FROM g JOIN (SELECT DISTINCT symbol, expiry, strike FROM fx_quotes) c ON c.symbol = g.symbol AND c.expiry = g.expiry GROUP BY ALL""")
def starting_strike(spark, d):
    _, snaps, strikes = _facts(spark, d)
    return _guessed(spark, d, snaps, strikes).select("symbol", "selected_expiry", "target_delta_abs", "option_type", F.col("starting_strike").alias("selected_strike")).distinct()


@query("""SELECT symbol, snapshot_time, expiry, strike, option_type, CAST(row_number() OVER (PARTITION BY symbol, snapshot_time ORDER BY expiry - DATE '2024-01-02', abs(strike - underlying_price), strike, option_type) AS INTEGER) AS queue_place FROM fx_quotes""")
def work_queue(spark, d):
    contracts = quotes(spark, d).select("symbol", "snapshot_time", "expiry", "strike", "option_type", "underlying_price")
    return progress.work_queue(contracts, ["symbol", "snapshot_time"], asof(), "underlying_price").drop("underlying_price")


@query("SELECT symbol, expiry FROM (SELECT symbol, expiry, row_number() OVER (PARTITION BY symbol ORDER BY expiry) AS rn FROM (SELECT DISTINCT symbol, expiry FROM fx_quotes WHERE expiry > DATE '2024-03-02')) WHERE rn <= 3")
def first_expiries(spark, d):
    return U.first_expiries(expiries(spark, d), 3, F.lit("2024-03-02").cast("date"))


@query(f"WITH {CQ}, {GRID}, {STATUS} SELECT * FROM st")
def skew_target_status(spark, d):
    """The flagship: grid, nearest expiry, best quote, and what became of each target."""
    return _status(spark, d).drop("best")


def _named(told: DataFrame) -> DataFrame:
    return told.withColumn("collection_batch", S.batch_id(F.concat("symbol", F.lit("_tenor_delta")), S.iso(F.col("snapshot_time").cast("timestamp"))))


def snapshot_rows(told: DataFrame, asof) -> DataFrame:
    """The row of each selected target, with the readings of its quote."""
    out = told.filter("status = 'SELECTED'").select("symbol", "snapshot_time", F.col("selected_expiry").alias("expiry"), F.col("best.strike").alias("strike"), "option_type", "target_tenor_dte", "target_delta_abs", S.dte(F.col("selected_expiry"), asof).alias("dte"), F.col("best.gap").alias("delta_gap_abs"), *[F.col(f"best.{c}").alias(c) for c in KEEP], "collection_batch")
    return out.withColumns({"iv_mid": S.iv_mid(F.col("iv_bid"), F.col("iv_ask")), "rho": F.lit(None).cast("double"), "moneyness": S.moneyness(F.col("strike"), F.col("underlying_price"))})


@query(f"""WITH RECURSIVE {CQ}, {GRID}, {WALK},
ws AS (SELECT p.*, b IS NOT NULL AS found, b[2] = 0 AS whole, b[4] AS strike, b[1] AS gap FROM plan p LEFT JOIN bb USING (symbol, snapshot_time, option_type, target_tenor_dte, target_delta_abs)),
wt AS (SELECT *, CASE WHEN NOT found THEN 'MISSING_NO_CANDIDATE' WHEN NOT whole THEN 'MISSING_NULL_FIELDS' ELSE 'SELECTED' END AS status FROM ws),
wp AS (SELECT symbol, snapshot_time, count(*) AS expected, count(*) FILTER (WHERE status = 'SELECTED') AS completed, count(*) FILTER (WHERE status <> 'SELECTED') AS missing FROM wt GROUP BY ALL)
SELECT wt.symbol, wt.snapshot_time, wt.selected_expiry AS expiry, wt.strike, wt.option_type, target_tenor_dte, target_delta_abs, CAST(CASE WHEN status = 'SELECTED' THEN wt.selected_expiry - DATE '2024-01-02' END AS INTEGER) AS dte, gap AS delta_gap_abs,
delta, bid, ask, last, volume, open_interest, sq.underlying_price, iv_bid, iv_ask, gamma, theta, vega, (iv_bid + iv_ask) / 2 AS iv_mid, CAST(NULL AS DOUBLE) AS rho, wt.strike / sq.underlying_price AS moneyness,
md5(wt.symbol || '_tenor_delta_' || strftime(wt.snapshot_time, '%Y-%m-%dT%H:%M:%S')) AS collection_batch, status, expected, completed, missing, CASE WHEN completed > 0 THEN 'COMPLETED' ELSE 'FAILED' END AS run_status
FROM wt JOIN wp ON wp.symbol = wt.symbol AND wp.snapshot_time = wt.snapshot_time
LEFT JOIN sq ON status = 'SELECTED' AND sq.symbol = wt.symbol AND sq.snapshot_time = wt.snapshot_time AND sq.expiry = wt.selected_expiry AND sq.option_type = wt.option_type AND sq.strike = wt.strike""")
def skew_snapshot(spark, d):
    """The run as a whole: expiry, starting strike and bounded walk for each target; rows, status and progress in one commit; what a reader sees of the three."""
    chains, snaps, strikes = _facts(spark, d, tuple(KEEP))
    plan = T.write_and_read(_plan(spark, d, snaps, strikes), [])
    best = P.walked_chains(_guessed(spark, d, snaps, strikes, plan), chains, config.MAX_HOPS, config.PATIENCE, KEEP)
    told = P.status_of(plan.join(best.select(*BY, "best"), BY, "left"))
    told = T.write_and_read(_named(told), [])
    by = ["symbol", "snapshot_time"]
    done = progress.rollup(told, [*by, "collection_batch"], F.col("status") == "SELECTED", "no target filled")
    rows, status, done = T.write_skew(T.fresh_store(spark), snapshot_rows(told, asof()), told.drop("best"), done)
    readings = rows.drop("expiry", "strike", "delta_gap_abs", "collection_batch")
    seen = status.drop("reason", "selected_delta").withColumnsRenamed({"selected_expiry": "expiry", "selected_strike": "strike"}).join(readings, BY, "left")
    return seen.join(done.select(*by, "expected", "completed", "missing", F.col("status").alias("run_status")), by)


@query(f"""WITH {CQ}, {GRID} SELECT symbol, snapshot_time, selected_expiry AS expiry, strike, option_type, target_tenor_dte, target_delta_abs, CAST(selected_expiry - DATE '2024-01-02' AS INTEGER) AS dte, gap AS delta_gap_abs,
delta, bid, ask, last, volume, open_interest, underlying_price, iv_bid, iv_ask, gamma, theta, vega, (iv_bid + iv_ask) / 2 AS iv_mid, CAST(NULL AS DOUBLE) AS rho, strike / underlying_price AS moneyness,
md5(symbol || '_tenor_delta_' || strftime(snapshot_time, '%Y-%m-%dT%H:%M:%S')) AS collection_batch FROM best WHERE incomplete = 0""")
def skew_snapshot_exhaustive(spark, d):
    """Rows of the targets that the best quote of the whole chain fills, written once by snapshot and given as read back."""
    kept = _best(spark, d, KEEP).filter("best.incomplete = 0").withColumn("status", F.lit("SELECTED"))
    out = snapshot_rows(_named(kept), asof())
    return T.write_and_read(out.withColumn("snapshot_date", F.to_date("snapshot_time")), ["snapshot_date"]).drop("snapshot_date")


@query(f"""WITH {CQ}, {GRID}, {STATUS} SELECT symbol, snapshot_time, count(*) AS expected, count(*) FILTER (WHERE status = 'SELECTED') AS completed, count(*) FILTER (WHERE status <> 'SELECTED') AS missing,
CASE WHEN count(*) FILTER (WHERE status = 'SELECTED') > 0 THEN 'COMPLETED' ELSE 'FAILED' END AS status, CASE WHEN count(*) FILTER (WHERE status = 'SELECTED') = 0 THEN 'no target filled' END AS error_message FROM st GROUP BY symbol, snapshot_time""")
def skew_progress(spark, d):
    return progress.rollup(_status(spark, d), ["symbol", "snapshot_time"], F.col("status") == "SELECTED", "no target filled")


@query(f"""WITH {CQ}, {RANKED}, {_near('spot', 'c')}, ex AS (SELECT symbol, expiry, row_number() OVER (PARTITION BY symbol ORDER BY expiry) AS rn FROM (SELECT DISTINCT symbol, expiry FROM fx_quotes WHERE expiry > DATE '2024-01-02')),
k AS (SELECT rk.symbol, rk.strike, ex.expiry FROM rk JOIN c ON c.symbol = rk.symbol AND rk.place BETWEEN c.at - 5 AND c.at + 5 JOIN ex ON ex.symbol = rk.symbol AND rn <= 2)
SELECT symbol, snapshot_time, count(*) AS n_contracts, count(*) FILTER (WHERE incomplete = 0) AS n_stored, count(*) FILTER (WHERE abs(strike / underlying_price - 1) < 0.01) AS n_atm, max(underlying_price) AS price, CASE WHEN count(*) FILTER (WHERE incomplete = 0) > 0 THEN 'COMPLETED' ELSE 'FAILED' END AS status FROM sq JOIN k USING (symbol, strike, expiry) GROUP BY ALL""")
def quote_snapshot(spark, d):
    """Strikes around spot by the first expiries, cleaned quotes with metrics; quotes, underlying and progress written, and the roll-up of what was stored."""
    q = stored_quotes(spark, d)
    near = U.strikes_around_spot(q.select("symbol", "strike").distinct(), q.select("symbol", F.col("underlying_price").alias("spot")).distinct(), 10).select("symbol", "strike")
    contracts = U.contract_universe(near, U.first_expiries(q.select("symbol", "expiry").distinct(), 2, asof()), ["symbol"])
    rows = clean.quote_metrics(clean_of(q).join(contracts, ["symbol", "strike", "expiry", "option_type"]), asof())
    quotes, underlying, done = T.write_snapshot(T.fresh_store(spark), rows, clean.complete_reading())
    by = ["symbol", "snapshot_time"]
    back = quotes.groupBy(*by).agg(F.count_if("is_atm").alias("n_atm"))
    told = done.select(*by, F.col("contracts_total").alias("n_contracts"), F.col("contracts_processed").alias("n_stored"), "status")
    return back.join(underlying, by).join(told, by)
