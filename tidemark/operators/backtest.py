"""Replay of a market's ladders to latency curves: both sides, sizes, fees, partial fills."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import pricing
from tidemark.operators.asof import as_of_join, next_trigger
from tidemark.operators.slices import Slices, last_known
from tidemark.operators.windows import checkpointed

SIDES = ("yes", "no")


@dataclass(frozen=True)
class EdgeRule:
    """Take the side with the greater edge after fees if it is at least ``min_edge`` cents, up to ``slip`` above its best ask."""

    min_edge: float = 2.0
    size: int = 20
    slip: int = 1
    fee: float = pricing.FEE


def ladder_views(events: DataFrame, market: str, time: str, order: str, slices: Slices | None = None) -> DataFrame:
    """Every book event with the ladders and the status that hold after it.

    ``events``: ``kind``, ``yes_ladder``, ``no_ladder`` (ascending arrays of price and size, null where not told) and
    ``market_status``.  An ``ob_snapshot`` states both sides, an ``ob_delta`` the sides that it tells; a status holds until
    the next, whatever comes between, and is ``open`` before the first.  Events without market or time are left out.
    """
    book = events.where(F.col(market).isNotNull() & F.col(time).isNotNull() & F.col("kind").isin("ob_snapshot", "ob_delta", "trade", "market_status"))
    snapshot, delta = F.col("kind") == "ob_snapshot", F.col("kind") == "ob_delta"
    told = {f"{s}_ladder": F.when(snapshot | (delta & F.col(f"{s}_ladder").isNotNull()), F.struct(F.col(f"{s}_ladder").alias("v"))) for s in SIDES}
    told["status"] = F.when(F.col("kind") == "market_status", F.col("market_status"))
    views = last_known(book.withColumns(told), [market], [time, order], list(told), slices and slices(F.col(time)))
    return views.withColumns({**{f"{s}_ladder": F.col(f"{s}_ladder")["v"] for s in SIDES}, "status": F.coalesce("status", F.lit("open"))})


def best_ask(ladder: Column) -> Column:
    return F.when(F.size(ladder) > 0, F.element_at(ladder, 1)["price"])


def closing_prices(views: DataFrame, market: str, time: str, order: str) -> DataFrame:
    """Per market ``yes_close`` and ``no_close``: the last trade on the side, else its best ask at the end."""
    at = lambda test, value: F.max(F.when(test, F.struct(time, order, value.alias("v"))))["v"]
    trade = lambda s: at((F.col("kind") == "trade") & (F.col("trade_side") == s) & F.col("trade_price").isNotNull(), F.col("trade_price"))
    last = lambda s: at(F.lit(True), best_ask(F.col(f"{s}_ladder")))
    return views.groupBy(market).agg(*[F.coalesce(trade(s), last(s)).alias(f"{s}_close") for s in SIDES])


def decisions(triggers: DataFrame, views: DataFrame, market: str, time: str, order: str, fair: str, rule: EdgeRule, slices: Slices | None = None) -> DataFrame:
    """Orders that triggers lead to: ``side``, ``limit``, ``fair_cents``, ``edge`` and the next trigger's time.

    A trigger sees the book as of its time, and orders only in an open market, with a fair probability, on a side whose
    ladder it can take something from.  Equal edges go to yes.
    """
    timed = next_trigger(triggers.where(F.col(market).isNotNull() & F.col(time).isNotNull()).select(market, time, order, fair), [market], time, slices)
    seen = as_of_join(timed, views.withColumn("view_order", F.col(order)).withColumn("view_at", F.col(time)), [market], time, "view_at", ["view_order", "yes_ladder", "no_ladder", "status"], slices=slices)
    seen = seen.where((F.col("status") == "open") & F.col(fair).isNotNull() & F.col("matched_at").isNotNull())
    none = F.array().cast("array<struct<price:int,size:bigint>>")
    limit = {s: best_ask(F.col(f"{s}_ladder")) + rule.slip for s in SIDES}
    walks = [pricing.walk_ladder(F.coalesce(f"{s}_ladder", none), F.lit(rule.size), limit[s]).alias(f"{s}_walk") for s in SIDES]
    seen = seen.select("*", F.inline(F.array(F.struct(*walks))))  # a generator: filters above it don't sweep the ladders again
    seen = seen.withColumns({f"{s}_avg": pricing.average(F.col(f"{s}_walk")) for s in SIDES})
    quotes = {}
    for s in SIDES:
        value, avg = (F.col(fair) if s == "yes" else 1 - F.col(fair)) * 100, F.col(f"{s}_avg")
        edge = value - avg - pricing.fee_per_contract(avg, rule.fee)
        quotes[s] = F.when(avg.isNotNull(), F.struct(edge.alias("edge"), F.lit(s).alias("side"), limit[s].alias("limit"), value.alias("fair_cents")))
    # "yes" is the greater word, so that a tie of edges goes to it.
    chosen = seen.withColumn("q", F.array_max(F.array_compact(F.array(*quotes.values())))).where(F.col("q.edge") >= rule.min_edge)
    return chosen.select(market, time, order, "next_at", "q.side", "q.limit", "q.fair_cents", "q.edge")


def fills(orders: DataFrame, views: DataFrame, closing: DataFrame, market: str, time: str, order: str, rule: EdgeRule, grid_us: Sequence[int], slices: Slices | None = None) -> DataFrame:
    """Every order at every latency of the grid: what the book gives it on arrival.

    ``outcome`` is stale (a later trigger came first), suspended, no_fill (empty side), miss, partial or filled; ``profit``
    is after fees, ``available`` the edge that the best ask leaves, ``clv`` the closing price less the average paid.
    """
    arrival = F.timestamp_micros(F.unix_micros(F.col(time).cast("timestamp")) + F.col("latency_us")).cast(orders.schema[time].dataType)
    late = orders.withColumn("latency_us", F.explode(F.array(*[F.lit(g).cast("long") for g in grid_us]))).withColumn("arrival", arrival)
    met = as_of_join(late, views.withColumn("view_order", F.col(order)).withColumn("view_at", F.col(time)), [market], "arrival", "view_at", ["view_order", "yes_ladder", "no_ladder", "status"], slices=slices)
    met = met.join(closing, market, "left").withColumn("ladder", F.when(F.col("side") == "yes", F.col("yes_ladder")).otherwise(F.col("no_ladder")))
    ladder, best = F.coalesce("ladder", F.array().cast("array<struct<price:int,size:bigint>>")), best_ask(F.col("ladder"))
    stale = F.coalesce(F.col("next_at") <= F.col("arrival"), F.lit(False))
    met = met.select("*", F.inline(F.array(F.struct(pricing.walk_ladder(ladder, F.lit(rule.size), F.col("limit")).alias("walked")))))
    outcome = pricing.fill_outcome(stale, F.coalesce("status", F.lit("open")), F.size(ladder), best, F.col("limit"), F.col("walked")["filled"], F.lit(rule.size))
    met = met.withColumns({"outcome": outcome, "available": F.col("fair_cents") - best, "avg_price": pricing.average(F.col("walked"))})
    filled = F.when(F.col("outcome").isin("filled", "partial"), F.col("walked")["filled"]).otherwise(F.lit(0).cast("long"))
    close = F.when(F.col("side") == "yes", F.col("yes_close")).otherwise(F.col("no_close"))
    paid = met.withColumn("filled", filled)
    fee = pricing.fee_total(F.col("avg_price"), F.col("filled"), rule.fee)
    profit = F.when(F.col("filled") > 0, (F.col("fair_cents") - F.col("avg_price")) * F.col("filled") - fee).otherwise(0.0)
    return paid.select(market, time, order, "side", "limit", "latency_us", "outcome", "filled", "avg_price", profit.alias("profit"), "available", pricing.closing_value(close, F.col("avg_price"), F.col("filled")).alias("clv"))


def curves(filled: DataFrame) -> DataFrame:
    """Per latency: orders, those still actionable, fills, partial fills, fill rate, mean profit, available edge and clv."""
    got = F.col("filled") > 0
    return filled.groupBy("latency_us").agg(
        F.count("*").alias("n_orders"), F.count_if(~F.col("outcome").isin("stale", "suspended")).alias("n_actionable"), F.count_if(got).alias("n_fills"), F.count_if(F.col("outcome") == "partial").alias("n_partial"),
        F.sum("filled").alias("contracts"), F.avg(F.when(got, 1.0).otherwise(0.0)).alias("fill_rate"), F.avg("profit").alias("mean_profit"), F.avg("available").alias("mean_edge"), F.avg("clv").alias("mean_clv"),
    )


def replay(events: DataFrame, triggers: DataFrame, market: str, time: str, order: str, fair: str, rule: EdgeRule, grid_us: Sequence[int], slices: Slices | None = None) -> DataFrame:
    """From book events and triggers to fills at every latency: three as-of scans, no loop over orders.

    Views are read three times and orders twice, so both are written to the checkpoint folder rather than made again.
    """
    views = checkpointed(ladder_views(events, market, time, order, slices))
    orders = checkpointed(decisions(triggers, views, market, time, order, fair, rule, slices))
    return fills(orders, views, closing_prices(views, market, time, order), market, time, order, rule, grid_us, slices)
