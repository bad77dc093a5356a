"""Odds, fees, ladders, quotes, fills and decisions.  Prices are cents, probabilities 0 to 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FEE = 0.07
NO_EDGE = -100.0


def valid_american(odds: Column) -> Column:
    return odds.isNotNull() & (F.abs(odds) >= 100)


def decimal_odds(american: Column) -> Column:
    return F.when(american > 0, 1 + american / 100).when(american < 0, 1 + F.lit(100.0) / F.abs(american))


def implied_probability(american: Column) -> Column:
    return F.when(american > 0, F.lit(100.0) / (american + 100)).when(american < 0, F.abs(american) / (F.abs(american) + 100))


def point_key(point: Column) -> Column:
    """Text of a line, empty where there is none, so that it can be part of a key."""
    return F.coalesce(point.cast("string"), F.lit(""))


def complement(best: Column) -> Column:
    return F.lit(100) - best


def fee_per_contract(price: Column, coeff: float = FEE) -> Column:
    p = price / 100
    return F.lit(coeff) * p * (1 - p) * 100


def fee_total(price: Column, contracts: Column, coeff: float = FEE) -> Column:
    """Fees of a trade, rounded up to whole cents (after dropping the noise of binary fractions)."""
    return F.ceil(F.round(fee_per_contract(price, coeff) * contracts, 9)).cast("double")


def walk_ladder(ladder: Column, size: Column, limit: Column) -> Column:
    """Struct (filled, cost) of taking up to ``size`` from an ascending array of (price, size).

    The sweep ends at the first level above the limit, at the first empty level, and when the size is filled.
    """
    zero = F.struct(F.lit(0).cast("long").alias("filled"), F.lit(0).cast("long").alias("cost"), F.lit(False).alias("done"))

    def step(acc: Column, level: Column) -> Column:
        take = F.least(level["size"].cast("long"), size.cast("long") - acc["filled"])
        done = acc["done"] | (level["price"] > limit) | (take <= 0)
        return F.struct(
            (acc["filled"] + F.when(done, 0).otherwise(take)).cast("long").alias("filled"), (acc["cost"] + F.when(done, 0).otherwise(take * level["price"])).cast("long").alias("cost"), done.alias("done")
        )

    return F.aggregate(ladder, zero, step)


def average(walked: Column) -> Column:
    return F.when(walked["filled"] > 0, walked["cost"] / walked["filled"])


def reserve_uncertainty(std: Column, coeff: float) -> Column:
    return F.lit(coeff) * std * 100


def reserve_adverse(lag_ns: Column, coeff: float) -> Column:
    return F.coalesce(F.lit(coeff) * lag_ns / 1e9, F.lit(0.0))


def edge(fair: Column, avg: Column, uncertainty: Column, adverse: Column) -> Column:
    """Cents gained per contract after fees and reserves; ``NO_EDGE`` where nothing can be had."""
    return F.coalesce(fair - avg - fee_per_contract(avg) - uncertainty - adverse, F.lit(NO_EDGE))


def fill_outcome(stale: Column, status: Column, levels: Column, best: Column, limit: Column, filled: Column, size: Column) -> Column:
    return (
        F.when(stale, "stale").when(status != "open", "suspended").when(levels == 0, "no_fill").when(best > limit, "miss").when(filled == 0, "miss").when(filled >= size, "filled").otherwise("partial")
    )


def expected_profit(fair: Column, avg: Column, filled: Column) -> Column:
    return F.when(filled > 0, (fair - avg) * filled - fee_total(avg, filled)).otherwise(F.lit(0.0))


def closing_value(closing: Column, avg: Column, filled: Column) -> Column:
    return F.when(filled > 0, closing - avg)


def decision(rows: dict[str, Column], min_edge: float, watch_margin: float) -> tuple[Column, Column]:
    """(action, reason) from the first of the checks that fails, then from the edge."""
    e = rows["edge"]
    # The reasons, and the order in which they count.
    ladder = [
        (~rows["material"], "watch", "debounced_nonmaterial"), (~rows["sequence_ok"], "skip", "sequence_gap"), (rows["status"] != "open", "skip", None),
        (rows["age_ns"] > rows["max_age_ns"], "skip", "stale_state"), (rows["lag_ns"] > rows["max_lag_ns"], "skip", "provider_lag_exceeded"), (rows["ood"], "watch", "out_of_distribution"),
        (rows["filled"] <= 0, "watch", "no_liquidity"), (rows["allowed"] <= 0, "skip", "risk_limit_reached"), (e >= min_edge, "bet", "edge_clears_threshold"), (e >= min_edge - watch_margin, "watch", "thin_edge"),
    ]
    action = reason = None
    for test, act, why in ladder:
        test, why = F.coalesce(test, F.lit(False)), F.lit(why) if why else F.concat(F.lit("market_"), rows["status"])
        action = F.when(test, act) if action is None else action.when(test, act)
        reason = F.when(test, why) if reason is None else reason.when(test, why)
    return action.otherwise("skip"), reason.otherwise("no_edge")


def allowed_size(exposure: Column, desired: Column, limit: float) -> Column:
    return F.greatest(F.lit(0.0), F.least(desired, F.lit(limit) - exposure))


def valid_price(price: Column) -> Column:
    return price.between(1, 99)


def ladder_problem(ladder: Column) -> Column:
    """Why an array of (price, size) is no ladder: a price outside 1 to 99, a negative size, a price twice; null if it is one."""
    prices = F.transform(ladder, lambda x: x["price"])
    out = F.when(~F.forall(ladder, lambda x: F.coalesce(x["price"].between(1, 99), F.lit(False))), "price_out_of_range")
    return out.when(~F.forall(ladder, lambda x: F.coalesce(x["size"] >= 0, F.lit(False))), "negative_size").when(F.size(prices) != F.size(F.array_distinct(prices)), "duplicate_level")
