"""Choice of the contract nearest each target of a grid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import complete_reading
from .universe import nearest_expiry

CHAIN = ["symbol", "snapshot_time", "selected_expiry", "option_type"]


def scored(quotes: DataFrame, spot: str = "underlying_price") -> DataFrame:
    """Cleaned quotes with what ranks them: whether a reading is missing, and the distance of strike from spot."""
    return quotes.withColumn("incomplete", F.when(complete_reading(), 0).otherwise(1)).withColumn("strike_gap", F.abs(F.col("strike") - F.col(spot)))


def gathered(quotes: DataFrame, keep: list[str], *more: str) -> DataFrame:
    """Chains: a row for each symbol, snapshot, expiry and side, with its cleaned quotes (hundreds) as an array sorted by strike.

    A quote has what ranks it (strike, delta, incomplete, strike_gap), then keep and more. Rows of a chain are brought together before
    they are gathered, as they seldom lie together.
    """
    fields = list(dict.fromkeys(["strike", "delta", "incomplete", "strike_gap", *keep, *more]))
    q = scored(quotes).withColumnRenamed("expiry", "selected_expiry").select(*CHAIN, F.struct(*fields).alias("q"))
    return q.groupBy(*CHAIN).agg(F.sort_array(F.collect_list("q")).alias("chain"))


def _asked(targets: DataFrame) -> DataFrame:
    """The targets of each chain as an array. A small side, of which a hash table is made, so that the chains beside it are never sorted."""
    return targets.groupBy(*CHAIN).agg(F.collect_set(F.struct(*[c for c in targets.columns if c not in CHAIN])).alias("asked")).hint("shuffle_hash")


def _answered(asked: DataFrame, answer: str, columns: list[str]) -> DataFrame:
    """Every target t of the array with its answer, from the chain beside it."""
    out = asked.select(*CHAIN, F.expr(f"inline(transform(asked, (t, i) -> named_struct('t', t, 'best', {answer})))"))
    return out.select(*[F.col(c) if c in CHAIN else F.col(f"t.{c}") for c in columns], "best")


def best_delta(targets: DataFrame, quotes: DataFrame, keep: list[str], how: str = "inner") -> DataFrame:
    """For each target the quote of the smallest (delta gap, incomplete, distance from spot, strike).

    targets: symbol, snapshot_time, selected_expiry, option_type, target_delta and any more; each is given once. Quotes without delta are
    no candidates. With how "left", targets without a candidate stay, with a null best.
    """
    return best_of_chains(targets, gathered(quotes, keep), keep, how)


def best_of_chains(targets: DataFrame, chains: DataFrame, keep: list[str], how: str = "inner") -> DataFrame:
    """The same from gathered chains: one join, in which no quote is copied to a target and nothing is sorted; the least score is told from places."""
    score = "CASE WHEN q.delta IS NOT NULL THEN named_struct('gap', abs(q.delta - t.target_delta), 'incomplete', q.incomplete, 'strike_gap', q.strike_gap, 'strike', q.strike, 'at', j) END"
    kept = "".join(f", '{c}', get(chain, b.at).{c}" for c in keep if c != "strike")
    best = f"CASE WHEN b IS NOT NULL THEN named_struct('gap', b.gap, 'incomplete', b.incomplete, 'strike_gap', b.strike_gap, 'strike', b.strike{kept}) END"
    least = f"element_at(transform(array(array_min(transform(chain, (q, j) -> {score}))), b -> {best}), 1)"
    out = _answered(_asked(targets).join(chains, CHAIN, how), least, targets.columns)
    return out if how == "left" else out.filter("best IS NOT NULL")


def walk_places(max_hops: int, patience: int):
    """The walks of many targets at once, hop by hop over arrays: the place of each target's quote in its chain, null where none has a delta.

    Of a batch of chains come the scores as lists sorted by strike and the starts and deltas of their targets as lists. State of a walk:
    best and its gap, way (0: either side), idle (hops in a row without improvement), counted (quotes with a delta).
    """

    def flat(lists: pa.Array) -> np.ndarray:
        return lists.flatten().to_numpy(zero_copy_only=False).astype(float)

    def walk(strikes: pa.Array, deltas: pa.Array, incompletes: pa.Array, strike_gaps: pa.Array, starts: pa.Array, wanted: pa.Array) -> pa.Array:
        ends, of = np.asarray(strikes.offsets, "int64"), np.asarray(starts.offsets, "int64")
        ends, of = ends - ends[0], of - of[0]
        row = np.repeat(np.arange(len(of) - 1), np.diff(of))
        low, high = ends[row], ends[row + 1]
        strike, delta, start, want = flat(strikes), flat(deltas), flat(starts), flat(wanted)
        known, rest = ~np.isnan(delta), _places(flat(incompletes), flat(strike_gaps))
        inside = lambda i: np.clip(i, 0, len(strike) - 1)
        gap_at = lambda i, t: np.where(known[i], np.abs(delta[i] - want[t]), np.inf)
        less = lambda g, i, best_g, best_i: (g < best_g) | ((g == best_g) & (rest[i] < rest[best_i]))
        every = np.arange(len(row))
        # how many strikes of the chain lie under the start
        p, top = low.copy(), high.copy()
        while (p < top).any():
            mid = (p + top) // 2
            under = (p < top) & (strike[inside(mid)] < start)
            p, top = np.where(under, mid + 1, p), np.where(under | (p >= top), top, mid)
        # a start that isn't quoted moves to the better of its neighbours by score, of equal ones the lower, and the walk goes on that way only
        above, under = inside(p), inside(p - 1)
        exact = (p < high) & (strike[above] == start)
        up = exact | (p == low) | ((p < high) & less(gap_at(above, every), above, gap_at(under, every), under))
        at, way = np.where(up, above, under), np.where(exact, 0, np.where(up, 1, -1))
        best, gap = np.where(known[at], at, -1), gap_at(at, every)
        idle, counted = np.zeros(len(row), "int64"), known[at].astype("int64")
        on = every
        for hop in range(1, (max_hops + 1) * patience + 1):
            on = on[(idle[on] < patience) & (counted[on] <= max_hops) & (((way[on] <= 0) & (at[on] - hop >= low[on])) | ((way[on] >= 0) & (at[on] + hop < high[on])))]
            if not len(on):
                break
            b, g, w, better = best[on], gap[on], way[on], np.zeros(len(on), bool)
            for side in (-1, 1):
                i = inside(at[on] + side * hop)
                seen = (way[on] * side >= 0) & (at[on] + side * hop >= low[on]) & (at[on] + side * hop < high[on]) & known[i]
                new = gap_at(i, on)
                take = seen & ((b < 0) | less(new, i, g, b))
                b, g, w, better = np.where(take, i, b), np.where(take, new, g), np.where(take, side, w), better | take
                counted[on] += seen
            best[on], gap[on], way[on], idle[on] = b, g, w, np.where(better, 0, idle[on] + 1)
        return pa.ListArray.from_arrays(pa.array(of, "int32"), pa.array(best - low, "int32", mask=best < 0))

    return F.arrow_udf(walk, "array<int>")


def _places(incomplete: np.ndarray, strike_gap: np.ndarray) -> np.ndarray:
    """One number for (incomplete, strike_gap) of the same order; an unknown distance is the least."""
    gaps = np.unique(np.nan_to_num(strike_gap, nan=-1.0, posinf=np.inf), return_inverse=True)[1]
    return incomplete * (gaps.max(initial=0) + 1) + gaps


def best_delta_bounded(targets: DataFrame, quotes: DataFrame, max_hops: int, patience: int, keep: list[str] | None = None) -> DataFrame:
    """Search outward from starting_strike, as a bounded walk over the quotes that are present.

    Quotes are ranked by strike; hop h looks at both sides of the start until one improves, then only at that side. A start
    that had to be moved off an unquoted strike goes one way only. A null delta is no improvement and isn't counted. The walk
    ends after `patience` hops without improvement or at max_hops + 1 counted quotes.

    Each chain is gathered once as a sorted array beside its targets, and each walk reads it by place: one join, and no quote is
    copied to a target. Targets whose chain has no quote are left out. keep: columns of the quote that come with its score.
    """
    return walked_chains(targets, gathered(quotes, keep or []), max_hops, patience, keep)


def walked_chains(targets: DataFrame, chains: DataFrame, max_hops: int, patience: int, keep: list[str] | None = None) -> DataFrame:
    """The same from gathered chains. Only scores and starts go to the walks, and only places come back."""
    both = _asked(targets).join(chains, CHAIN)
    places = walk_places(max_hops, patience)(*[F.col(c) for c in ("chain.strike", "chain.delta", "chain.incomplete", "chain.strike_gap", "asked.starting_strike", "asked.target_delta")])
    kept = "".join(f", '{c}', q.{c}" for c in keep or [] if c not in ("strike", "delta"))
    best = f"CASE WHEN q IS NOT NULL THEN named_struct('gap', abs(q.delta - t.target_delta), 'incomplete', q.incomplete, 'strike_gap', q.strike_gap, 'strike', q.strike, 'delta', q.delta{kept}) END"
    return _answered(both.withColumn("places", places), f"element_at(transform(array(get(chain, get(places, i))), q -> {best}), 1)", targets.columns)


def target_status(targets: DataFrame, quotes: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each target: SELECTED, MISSING_NULL_FIELDS (the best quote lacks a reading) or MISSING_NO_CANDIDATE."""
    return status_of(best_delta(targets, quotes, keep, "left"))


def status_of(chosen: DataFrame) -> DataFrame:
    """What became of targets: status and reason, from selected_expiry and the best quote, which is null where there is none."""
    status = F.when(F.col("best").isNull(), "MISSING_NO_CANDIDATE").when(F.col("best.incomplete") == 1, "MISSING_NULL_FIELDS").otherwise("SELECTED")
    reason = F.when(F.col("selected_expiry").isNull(), "no expiry for tenor").when(F.col("best").isNull(), "no quote with delta").when(F.col("best.incomplete") == 1, "best quote lacks readings")
    return chosen.select(
        *_key(chosen), status.alias("status"), reason.alias("reason"), "selected_expiry",
        F.col("best.strike").alias("selected_strike"), F.col("best.delta").alias("selected_delta"), F.col("best.gap").alias("delta_gap_abs"), "best",
    )


def _key(targets: DataFrame) -> list[str]:
    return ["symbol", "snapshot_time", "option_type", "target_tenor_dte", "target_delta_abs"]


def plan_targets(quotes: DataFrame, grid: DataFrame, asof: Column, expiries: DataFrame | None = None) -> DataFrame:
    """Every target of every snapshot with the expiry that serves its tenor; null where there's none."""
    snaps = quotes.select("symbol", "snapshot_time").distinct()
    expiries = quotes.select("symbol", "expiry").distinct() if expiries is None else expiries
    tenors = nearest_expiry(grid.select("symbol", "target_tenor_dte").distinct(), expiries, asof)
    return snaps.join(grid, "symbol").join(tenors, ["symbol", "target_tenor_dte"], "left")
