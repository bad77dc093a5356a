"""Books, backtests over a latency grid and tracking geometry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import pricing


def ladders(levels: DataFrame, book: Sequence[str], price: str, size: str) -> DataFrame:
    """Ascending array of (price, size) per book; a price's sizes are added.  A book has at most 99 prices."""
    summed = levels.groupBy(*book, price).agg(F.sum(size).alias("__s"))
    return summed.groupBy(*book).agg(F.sort_array(F.collect_list(F.struct(F.col(price).alias("price"), F.col("__s").alias("size")))).alias("ladder"))


def book_state(updates: DataFrame, market: Sequence[str], order: Sequence[str], is_snapshot: str, side: str, price: str, quantity: str) -> DataFrame:
    """Levels that hold at the end of each market's updates.

    A snapshot starts an epoch and clears the book; within the last epoch, which a market's last snapshot begins, the last
    quantity of a price counts and one of zero or less removes it; prices outside 1 to 99 are ignored.  Only aggregates, so
    a busy market is spread over its prices.
    """
    begun = updates.where(F.col(is_snapshot)).groupBy(*[F.col(m).alias(f"__{m}") for m in market]).agg(F.max(F.struct(*order)).alias("__begun"))
    same = [F.col(m).eqNullSafe(F.col(f"__{m}")) for m in market]
    last = updates.join(begun, same).where(F.struct(*order) >= F.col("__begun"))
    newest = last.where(F.col(price).between(1, 99)).groupBy(*market, side, price).agg(F.max(F.struct(*order, quantity))[quantity].alias(quantity))
    return newest.where(F.col(quantity) > 0)


def best_prices(levels: DataFrame, market: Sequence[str], side: str, price: str) -> DataFrame:
    """Best bid of each side and the asks they imply."""
    best = levels.groupBy(*market).agg(F.max(F.when(F.col(side) == "yes", F.col(price))).alias("best_yes"), F.max(F.when(F.col(side) == "no", F.col(price))).alias("best_no"))
    return best.withColumns({"yes_ask": pricing.complement(F.col("best_no")), "no_ask": pricing.complement(F.col("best_yes"))})


def latency_curves(decisions: DataFrame, grid_ns: Sequence[int], at_ns: str, next_ns: str, edge: str, profit: str, clv: str | None = None) -> DataFrame:
    """Per latency: decisions, those still actionable, fill rate, mean profit, mean edge at arrival, and mean closing-line
    value of what was filled.

    A decision pays only if it arrives before the next trigger.  ``edge`` is the edge that the book offers, also to one
    that comes late, so it is averaged over all decisions; it is null where there is none.  The grid is a short literal
    array, so rows are exploded in place and the aggregate is partial.
    """
    rows = decisions.withColumn("latency_ns", F.explode(F.array(*[F.lit(g).cast("long") for g in grid_ns])))
    stale = F.coalesce(F.col(next_ns) <= F.col(at_ns) + F.col("latency_ns"), F.lit(False))
    out = [
        F.count("*").alias("n"), F.count_if(~stale).alias("n_actionable"), F.avg(F.when(stale, 0.0).otherwise(F.col(profit))).alias("mean_profit"), F.avg(edge).alias("mean_edge"),
        F.avg(F.when(stale, 0.0).otherwise(1.0)).alias("fill_rate"),
    ]
    return rows.groupBy("latency_ns").agg(*out, *([F.avg(F.when(~stale, F.col(clv))).alias("mean_clv")] if clv else []))


def break_even(curve: DataFrame, x: str, y: str) -> DataFrame:
    """Where the curve first turns negative, interpolated; its first point if it starts so, null if it never does.

    A curve has one row per grid point, so its single window partition is as small as the grid.
    """
    w = W.partitionBy(F.lit(0)).orderBy(x)
    px, py = F.lag(x).over(w), F.lag(y).over(w)
    at = F.when(px.isNull(), F.col(x).cast("double")).when(py == F.col(y), F.col(x).cast("double")).otherwise(px + py / (py - F.col(y)) * (F.col(x) - px))
    return curve.withColumn("__at", at).agg(F.min(F.when(F.col(y) < 0, F.struct(x, "__at")))["__at"].alias("break_even"))


def spacing(points: DataFrame, frame: Sequence[str], x: str, y: str, most: int = 64) -> DataFrame:
    """Mean distance of all pairs in a frame, null below two points.  A frame is one instant of a court or field: its
    points are players, fewer than ``most``, and are paired inside their row."""
    frames = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*frame).agg(F.collect_list(F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))).alias("ps"))
    frames = frames.where(F.when(F.size("ps") > most, F.raise_error(F.lit("too many points for a frame"))).otherwise(F.lit(True)))
    later = lambda i: F.slice(F.col("ps"), i + 2, F.size("ps"))
    from_one = lambda p, i: F.aggregate(later(i), F.lit(0.0), lambda s, q: s + F.hypot(p["x"] - q["x"], p["y"] - q["y"]))
    total = F.aggregate(F.transform("ps", from_one), F.lit(0.0), lambda s, d: s + d)
    n = F.size("ps")
    return frames.select(*frame, n.alias("n_points"), F.when(n >= 2, total / (n * (n - 1) / 2)).alias("spacing"))


def nearest(handlers: DataFrame, others: DataFrame, frame: Sequence[str], x: str, y: str) -> DataFrame:
    """Distance from each handler to the nearest of the others in its frame, null without any."""
    o = others.select(*frame, F.col(x).alias("__x"), F.col(y).alias("__y"))
    both = handlers.join(o, list(frame), "left").withColumn("__d", F.hypot(F.col(x) - F.col("__x"), F.col(y) - F.col("__y")))
    return both.groupBy(*handlers.columns).agg(F.min("__d").alias("distance"))


def average_fill(fills: DataFrame, order: Sequence[str], quantity: str, price: str) -> DataFrame:
    return fills.groupBy(*order).agg(F.sum(quantity).alias("filled"), (F.sum(F.col(quantity) * F.col(price)) / F.sum(quantity)).alias("avg_price"))
