"""Availability reports, sources, features and market shapes as column rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.texts import lookup

# Probability of playing by reported status, and trust by kind of source.
ACTIVE = {
    "available": 0.99, "confirmed_starter": 0.99, "probable": 0.90, "probable_starter": 0.85, "questionable": 0.50, "game_time_decision": 0.50, "doubtful": 0.25, "out": 0.0, "scratched": 0.0,
}
GONE, THERE = ("out", "scratched"), ("available", "probable", "probable_starter", "confirmed_starter")
CONFIRMED, ACTIONABLE = 0.99, 0.85
LATE_S, CONFLICT_S = 90 * 60, 12 * 3600
CRITICAL = ("starting_pitcher_scratched", "player_ruled_out", "game_postponed", "confirmed_differs_from_projected", "unexpected_starter")
# A run of expected lead in logits, and a point.
RUN_LOGIT, POINT_LOGIT = 0.35, 1 / 6


def active_probability(status: Column) -> Column:
    return lookup(status, ACTIVE)


def expected_minutes(status: Column, projected: Column, reported: Column, restriction: Column) -> Column:
    """Minutes weighted by the probability of playing; unknown without a basis, unless the player is out."""
    base = F.coalesce(reported, projected)
    capped = F.least(base, restriction)
    p = active_probability(status)
    return F.when(base.isNull(), F.when(status.isin(*GONE), 0.0)).when(p.isNull(), capped).otherwise(F.round(capped * p, 2))


def confidence(confirmed: Column, base: Column) -> Column:
    return F.when(confirmed, CONFIRMED).otherwise(F.coalesce(base, F.lit(0.5)))


def actionable(confirmed: Column, kind: Column, value: Column) -> Column:
    return F.when(confirmed, True).when(kind == "social", False).otherwise(value >= ACTIONABLE)


def change_type(status: Column, before: Column, role: Column, restriction_changed: Column, projected_starter: Column) -> Column:
    """What a report changes; ``projected_starter`` is null without a projection."""
    return (
        F.when((role == "starting_pitcher") & (status == "scratched"), "starting_pitcher_scratched").when(status.isin(*GONE) & ~before.isin(*GONE), "player_ruled_out")
        .when(status.isin(*THERE) & before.isin(*GONE, "doubtful"), "player_became_available").when(restriction_changed, "minutes_restriction")
        .when(~projected_starter & (status == "confirmed_starter"), "unexpected_starter").otherwise("status_change")
    )


def severity(change: Column, needs_confirmation: Column, seconds_to_game: Column) -> Column:
    late = F.coalesce(seconds_to_game.between(0, LATE_S), F.lit(False))
    return F.when(needs_confirmation, "info").when(change.isin(*CRITICAL) | late, "critical").otherwise("warning")


def outcome_role(market: Column, name: Column, home: Column, away: Column) -> Column:
    """Role of an outcome by its normalised name."""
    total = F.when(name.isin("over", "under"), name).otherwise("unknown")
    side = F.when((name != "") & (name == home), "home").when((name != "") & (name == away), "away").when(name == "draw", "draw").otherwise("unknown")
    return F.when(market == "totals", total).otherwise(side)


def contract_key(market: Column, point: Column) -> Column:
    """What makes one contract: the line of totals, the size of a spread's line, nothing otherwise."""
    return F.when(market == "spreads", F.abs(point)).when(market == "totals", point)


def contract_problem(market: Column, over: Column, under: Column, home: Column, away: Column, draw: Column, unknown: Column) -> Column:
    """First problem of a contract from its counts by role, null when it is complete."""
    a, b = F.when(market == "totals", over).otherwise(home), F.when(market == "totals", under).otherwise(away)
    return F.when(unknown > 0, "unknown_outcome").when((market != "totals") & (draw > 0), "draw").when((a > 1) | (b > 1), "duplicate").when((a < 1) | (b < 1), "missing")


def poll_due(now: Column, last: Column, releases: Column, interval_s: Column) -> Column:
    """A release lies in (last, now], or the interval has passed; a source with neither is polled once."""
    released = F.exists(releases, lambda r: (r <= now) & (last.isNull() | (r > last)))
    passed = last.isNull() | (F.unix_micros(now.cast("timestamp")) - F.unix_micros(last.cast("timestamp")) >= interval_s.cast("long") * 1_000_000)
    return released | F.when(interval_s.isNotNull(), passed).otherwise(last.isNull() & (F.size(releases) == 0))


def is_stale(now: Column, updated: Column, most_s: int) -> Column:
    return F.coalesce(F.unix_micros(now.cast("timestamp")) - F.unix_micros(updated.cast("timestamp")) > most_s * 1_000_000, F.lit(True))


def run_features(s: dict[str, Column]) -> dict[str, Column]:
    """Fourteen features of a baseball state: ``s`` names its columns."""
    lead, flag = s["score_home"] - s["score_away"], lambda c: s[c].cast("double")
    return {
        "pregame_prior": (s["exp_home"] - s["exp_away"]) * RUN_LOGIT, "inning_norm": s["inning"] / 9, "is_bottom": (s["half"] == "bottom").cast("double"), "outs_norm": s["outs"] / 2, "on_first": flag("on_first"),
        "on_second": flag("on_second"), "on_third": flag("on_third"), "lead_norm": lead / 4, "lead_late": lead * s["progress"] / 4, "pitcher": s["pitcher"], "bullpen": s["bullpen"], "bullpen_left": s["bullpen_left"],
        "lineup_norm": s["lineup"] / 9, "is_home": flag("is_home"),
    }


def margin_features(s: dict[str, Column]) -> dict[str, Column]:
    """Thirteen features of a basketball state."""
    lead = s["score_home"] - s["score_away"]
    return {
        "pregame_prior": s["exp_margin"] * POINT_LOGIT, "total_norm": s["exp_total"] / 220, "period_norm": s["period"] / 4, "time_left": s["time_left"], "lead_norm": lead / 12, "lead_late": lead * (1 - s["time_left"]) / 12,
        "possession": F.when(s["possession"] == "home", 1.0).when(s["possession"] == "away", -1.0).otherwise(0.0), "pace_norm": s["pace"] / 100, "timeouts_home": s["timeouts_home"] / 7, "timeouts_away": s["timeouts_away"] / 7,
        "fouls": (s["fouls_home"] - s["fouls_away"]) / 5, "strength": (s["strength_home"] - s["strength_away"]) / 10, "availability": s["availability_home"] - s["availability_away"],
    }


def trade_problem(price: Column, complement: Column, count: Column, side: Column) -> Column:
    """Why a trade print cannot be kept; null where it can."""
    out = F.when(price.isNull() & complement.isNull(), "no_price").when(~F.coalesce(price, 100 - complement).between(1, 99), "price_out_of_range")
    out = out.when(price + complement != 100, "prices_disagree").when(F.coalesce(count, F.lit(0)) <= 0, "no_quantity")
    return out.when(side.isNotNull() & ~side.isin("yes", "no"), "unknown_side")


def market_problem(ticker: Column, event: Column, opens: Column, closes: Column, status: Column) -> Column:
    """Why a market cannot be kept; null where it can."""
    out = F.when(F.coalesce(F.trim(ticker), F.lit("")) == "", "no_ticker").when(~F.startswith(ticker, event), "ticker_of_other_event").when(opens > closes, "closes_before_open")
    return out.when(~status.isin("open", "closed", "settled", "halted"), "unknown_status")


def order_problem(side: Column, price: Column, size: Column, quote: Column, active: Column, same_as_last: Column) -> Column:
    """Why a decided order is not sent: malformed, off its quote, or a repetition of one that still stands; null where it is."""
    out = F.when(~F.coalesce(side.isin("yes", "no"), F.lit(False)), "unknown_side").when(~F.coalesce(price.between(1, 99), F.lit(False)), "price_out_of_range").when(F.coalesce(size, F.lit(0)) <= 0, "no_size")
    return out.when(quote.isNull(), "no_quote").when(price > quote, "above_quote").when(active & same_as_last, "resubmission")


def postponement(before: Column, after: Column) -> Column:
    """The change that a game's new status is: ``postponed``, ``resumed``, or null."""
    gone = lambda c: F.coalesce(c.isin("postponed", "suspended", "cancelled"), F.lit(False))
    return F.when(~gone(before) & gone(after), "postponed").when(gone(before) & ~gone(after), "resumed")
