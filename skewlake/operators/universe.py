"""Strikes, expiries, contracts and target grids. Chains are rows (symbol, strike) and (symbol, expiry)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def sides() -> Column:
    return F.array(F.lit("C"), F.lit("P"))


def chain_union(chains: DataFrame, by: str, arrays: list[str]) -> DataFrame:
    """Distinct sorted elements of array columns over all chains of a symbol, combined before they are gathered."""
    out = None
    for a in arrays:
        one = chains.select(by, F.explode(a).alias("x")).distinct().groupBy(by).agg(F.array_sort(F.collect_list("x")).alias(a))
        out = one if out is None else out.join(one, by, "full")
    return out


def chain_summary(chains: DataFrame) -> DataFrame:
    return chains.select("symbol", "exchange", "trading_class", F.size("strikes").alias("n_strikes"), F.size("expirations").alias("n_expirations"))


def clean_targets(values: Column) -> Column:
    """Values above zero, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.filter(values, lambda x: x > 0)))


def target_config(symbols: DataFrame, overrides: DataFrame, tenors: list[int], deltas: list[float]) -> DataFrame:
    """Tenors and deltas of each symbol, its own or the default, and how many targets they make."""
    t = F.coalesce(F.col("tenors_dte"), F.array(*map(F.lit, tenors)))
    d = F.coalesce(F.col("deltas_abs"), F.array(*map(F.lit, deltas)))
    out = symbols.join(overrides, "symbol", "left").select("symbol", clean_targets(t).alias("tenors_dte"), clean_targets(d).alias("deltas_abs"))
    return out.withColumn("expected_targets", F.size("tenors_dte") * F.size("deltas_abs") * 2)


def target_grid(config: DataFrame) -> DataFrame:
    """Each symbol's tenors by deltas by calls and puts."""
    grid = config.select("symbol", F.explode("tenors_dte").alias("target_tenor_dte"), "deltas_abs")
    grid = grid.select("symbol", "target_tenor_dte", F.explode("deltas_abs").alias("target_delta_abs"))
    return grid.withColumn("option_type", F.explode(sides())).withColumn("target_delta", S.signed_target(F.col("target_delta_abs"), F.col("option_type")))


def contract_universe(strikes: DataFrame, expiries: DataFrame, by: list[str]) -> DataFrame:
    """Strikes by expiries by calls and puts of one symbol (and day), never across symbols."""
    return strikes.join(expiries, by).withColumn("option_type", F.explode(sides()))


def nearest(groups: DataFrame, chain: DataFrame, by: list[str], value: Column, point: Column, width: float, out: str) -> DataFrame:
    """For each row of groups the chain's element whose value is nearest to the point; of two as near the smaller. Groups without one are left out.

    value, point: numbers, of a chain row and of a row of groups; out: the chain column that is given. A sorted merge: both sides
    go in one table, and each point takes the last element before it and the first after it. The work is linear in the rows of both,
    however many points ask one chain. Chains are cut in ranges of `width`, each a task's group of its own; what lies before and
    after a range comes from the ranges' ends, which are few.
    """
    rows = groups.distinct()
    at, near = "nearest_at", ["nearest_v", "nearest_x"]
    element = F.struct(value.cast("double").alias("v"), F.col(out).alias("x"))
    sides = chain.select(*by, element.alias("e")).filter("e.v IS NOT NULL").select(*by, F.floor(F.col("e.v") / width).alias("range"), F.col("e.v").alias(at), "e")
    asked = rows.select(*by, F.struct(*rows.columns).alias("row"), point.cast("double").alias(at)).filter(F.col(at).isNotNull())
    asked = asked.withColumn("range", F.floor(F.col(at) / width))
    # the last element of earlier ranges and the first of later ones, for every range that holds elements or points
    ends = sides.groupBy(*by, "range").agg(F.min("e").alias("low"), F.max("e").alias("high")).unionByName(asked.select(*by, "range").distinct(), allowMissingColumns=True)
    ends = ends.groupBy(*by, "range").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    order = Window.partitionBy(*by).orderBy("range")
    ends = ends.select(*by, "range", F.last("high", True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"), F.first("low", True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("later"))
    both = asked.unionByName(sides, allowMissingColumns=True)
    up = Window.partitionBy(*by, "range").orderBy(at, F.col("e").isNull(), "e.x").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*by, "range").orderBy(F.col(at).desc(), F.col("e").isNull(), F.col("e.x").desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("before", F.last("e", True).over(up)).withColumn("after", F.last("e", True).over(down)).filter("row IS NOT NULL")
    found = found.join(ends, [*by, "range"]).select("row", at, F.coalesce("before", "earlier").alias("b"), F.coalesce("after", "later").alias("a"))
    lower = F.col("a").isNull() | (F.col(at) - F.col("b.v") <= F.col("a.v") - F.col(at))
    best = F.when(F.col("b").isNotNull() & lower, F.col("b")).otherwise(F.col("a"))
    return found.withColumn("best", best).filter("best IS NOT NULL").select("row.*", F.col("best.x").alias(out))


def nearest_expiry(tenors: DataFrame, expiries: DataFrame, asof: Column) -> DataFrame:
    """The expiry after the as-of date nearest to each tenor; of equal ones the earlier."""
    later = expiries.filter(F.col("expiry") > asof)
    return nearest(tenors, later.select("symbol", F.col("expiry").alias("selected_expiry")).distinct(), ["symbol"], F.datediff("selected_expiry", asof), F.col("target_tenor_dte"), 3650, "selected_expiry")


def nearest_strike(guesses: DataFrame, strikes: DataFrame, by: list[str], guess: str = "guess") -> DataFrame:
    """The strike nearest to each guess; of equal ones the lower."""
    return nearest(guesses, strikes.withColumnRenamed("strike", "selected_strike"), by, F.col("selected_strike"), F.col(guess), 10_000, "selected_strike")


def nearest_in(values: Column, point: Column) -> Column:
    """The element of a sorted array that is nearest to a point; of equal ones the lower."""

    def of(n: Column) -> Column:
        above, under = F.get(values, n), F.get(values, n - 1)
        return F.when(under.isNull() | (above - point < point - under), above).otherwise(under)

    return F.element_at(F.transform(F.array(F.size(F.filter(values, lambda v: v < point))), of), 1)


def starting_strikes(guesses: DataFrame, chain: DataFrame, by: list[str], guess: str = "guess") -> DataFrame:
    """Rows with the strike nearest to their guess, for chains gathered as sorted arrays (`by`, strikes: hundreds); rows without a guess are left out.

    The arrays are the small side, of which a hash table is made, so neither side is sorted and rows keep no array. Where a chain isn't
    so bounded, `nearest_strike` merges both sides.
    """
    out = guesses.filter(F.col(guess).isNotNull()).join(chain.select(*by, "strikes").hint("shuffle_hash"), by)
    return out.select(*guesses.columns, nearest_in(F.col("strikes"), F.col(guess)).alias("starting_strike")).filter("starting_strike IS NOT NULL")


def ranked_strikes(strikes: DataFrame, by: list[str]) -> DataFrame:
    """Strikes with their place in the chain, from 1. A chain is one symbol's (or expiry's) strikes: hundreds of rows."""
    return strikes.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy("strike")))


def place_of(ranked: DataFrame, points: DataFrame, by: list[str], point: str, out: str) -> DataFrame:
    """The place of the strike nearest to a point; of equal ones the lower."""
    best = points.join(ranked, by).groupBy(*points.columns).agg(F.min(F.struct(F.abs(F.col("strike") - F.col(point)).alias("gap"), "strike", "place")).alias("b"))
    return best.select(*points.columns, F.col("b.place").alias(out))


def strike_band(strikes: DataFrame, days: DataFrame, n: int) -> DataFrame:
    """Strikes from n below the one nearest `low` to n above the one nearest `high`, ends of the chain respected."""
    ranked = ranked_strikes(strikes, ["symbol"])
    edges = place_of(ranked, place_of(ranked, days, ["symbol"], "low", "lo_place"), ["symbol"], "high", "hi_place")
    return edges.join(ranked, "symbol").filter(F.col("place").between(F.col("lo_place") - n, F.col("hi_place") + n)).select(*days.columns, "strike")


def strikes_above(strikes: DataFrame, spots: DataFrame, n: int) -> DataFrame:
    """The n strikes after the one nearest to spot."""
    ranked = ranked_strikes(strikes, ["symbol"])
    return place_of(ranked, spots, ["symbol"], "spot", "at").join(ranked, "symbol").filter((F.col("place") > F.col("at")) & (F.col("place") <= F.col("at") + n)).select(*spots.columns, "strike")


def strikes_around_spot(strikes: DataFrame, spots: DataFrame, n: int) -> DataFrame:
    """Whole-number strikes, n // 2 on either side of the one nearest to spot."""
    ranked = ranked_strikes(strikes.filter(F.col("strike") % 1 == 0), ["symbol"])
    return place_of(ranked, spots, ["symbol"], "spot", "at").join(ranked, "symbol").filter(F.col("place").between(F.col("at") - n // 2, F.col("at") + n // 2)).select(*spots.columns, "strike")


def candidate_strikes(strikes: DataFrame, guesses: DataFrame, by: list[str], wing: int = 1) -> DataFrame:
    """Distinct strikes within `wing` places of any guess. guesses: columns `by` and guess."""
    ranked = ranked_strikes(strikes, by)
    at = place_of(ranked, guesses.select(*by, "guess").distinct(), by, "guess", "at")
    return at.join(ranked, by).filter(F.col("place").between(F.col("at") - wing, F.col("at") + wing)).select(*by, "strike").distinct()


def delta_guesses(grid: DataFrame, days: Column) -> DataFrame:
    """Where to look for each target: spot moved by the offset for its delta and days to expiry."""
    offset = S.moneyness_offset(F.col("target_delta_abs"), days, F.col("option_type"))
    return grid.withColumn("guess", S.starting_guess(F.col("spot"), offset, F.col("option_type")))


def wing_candidates(strikes: DataFrame, spots: DataFrame, deltas: list[float], curve: list[tuple[float, float]], default: float = 0.12, wing: int = 1) -> DataFrame:
    """Older rule: strikes around spot and around spot moved by the offset of exactly that delta."""
    table = dict(curve)
    moves = [0.0] + [m for d in deltas for m in (table.get(round(d, 2), default), -table.get(round(d, 2), default))]
    guesses = spots.withColumn("guess", F.explode(F.array(*[F.col("spot") * (1.0 + m) for m in moves])))
    return candidate_strikes(strikes, guesses, ["symbol"], wing)


def split_put_call(strikes: DataFrame, by: list[str]) -> DataFrame:
    """The lower half of each chain (up to n / 2) as puts, the rest as calls."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    return ranked_strikes(strikes, by).withColumn("option_type", F.when(F.col("place") <= n / 2, "P").otherwise("C")).drop("place")


def first_expiries(expiries: DataFrame, n: int, asof: Column | None = None) -> DataFrame:
    """Each symbol's first n expiries; only later ones where an as-of date is given."""
    kept = expiries if asof is None else expiries.filter(F.col("expiry") > asof)
    turn = F.row_number().over(Window.partitionBy("symbol").orderBy("expiry"))
    return kept.withColumn("turn", turn).filter(F.col("turn") <= n).drop("turn")
