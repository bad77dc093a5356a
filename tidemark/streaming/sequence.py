"""Gap-aware ordering, live totals and limiters, in batch and as streams.

The batch tracker is made of windows on the stream's key; the others are folds (see ``folds``), of which both forms
share the state machine.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.streaming.folds import BucketFold, LiveFold, PaceFold, PipelineFold, SequenceFold, fold, fold_stream

VERDICT = "stream_key string, arrival long, sequence long, status string, healthy boolean, n_ready long, n_missing long, correction string"
TRACKED = ("arrival", "sequence", "content", "flagged")


def track(events: DataFrame) -> DataFrame:
    """Batch form over (``stream_key``, ``arrival``, ``sequence``, ``content``, ``flagged``); see ``SequenceFold``.

    A position is released at the latest first arrival of all positions from the anchor to it, if none of them lacks:
    a running maximum over positions.  The newest position released by an arrival is carried forward over arrivals.
    What is missing then is what lies up to the highest position, less the positions that came as a new highest.
    """
    key = "stream_key"
    loose = events.where("sequence IS NULL").select(
        key, "arrival", "sequence", F.lit("unsequenced").alias("status"), F.lit(True).alias("healthy"), F.lit(1).cast("long").alias("n_ready"), F.lit(0).cast("long").alias("n_missing"),
        F.lit("not_applicable").alias("correction"),
    )
    by_arrival = W.partitionBy(key).orderBy("arrival")
    up_to = by_arrival.rowsBetween(W.unboundedPreceding, 0)
    same = W.partitionBy(key, "sequence").orderBy("arrival")
    seen = events.where("sequence IS NOT NULL").withColumns({"anchor": F.first("sequence").over(by_arrival), "high": F.max("sequence").over(up_to)})
    seen = seen.withColumn("new_high", F.coalesce(F.col("sequence") > F.lag("high").over(by_arrival), F.lit(True)).cast("long"))
    seen = seen.withColumns({"highs": F.sum("new_high").over(up_to), "copy": F.row_number().over(same), "was": F.lag("content").over(same)})
    first = seen.where("copy = 1 AND sequence >= anchor").select(key, "sequence", "anchor", "arrival", "new_high")
    by_position = W.partitionBy(key).orderBy("sequence")
    so_far = by_position.rowsBetween(W.unboundedPreceding, 0)
    placed = first.withColumns({"n": F.row_number().over(by_position), "released": F.max("arrival").over(so_far), "highs_below": F.sum("new_high").over(so_far)})
    freed = placed.where(F.col("sequence") - F.col("anchor") == F.col("n") - 1).groupBy(key, F.col("released").alias("arrival"))
    freed = freed.agg(F.count("*").alias("n_ready"), F.max("sequence").alias("top"), F.max("highs_below").alias("top_highs"))
    both = seen.join(freed, [key, "arrival"], "left")
    both = both.withColumns({"now": F.last("top", ignorenulls=True).over(up_to), "now_highs": F.last("top_highs", ignorenulls=True).over(up_to)})
    missing = F.col("high") - F.col("now") - (F.col("highs") - F.col("now_highs"))
    status = F.when(F.col("n_ready").isNotNull(), "in_order").when((F.col("copy") > 1) | (F.col("sequence") < F.col("anchor")), "duplicate").otherwise("gap")
    correction = F.when(F.col("copy") == 1, "original").when(F.col("was").eqNullSafe(F.col("content")) & ~F.col("flagged"), "unchanged").otherwise("correction")
    told = both.select(key, "arrival", "sequence", status.alias("status"), (missing == 0).alias("healthy"), F.coalesce("n_ready", F.lit(0)).alias("n_ready"), missing.alias("n_missing"), correction.alias("correction"))
    return told.unionByName(loose)


def track_stream(events: DataFrame) -> DataFrame:
    """Streaming form: a stream's rows arrive in order of ``arrival``."""
    return fold_stream(events, "stream_key", ["arrival"], TRACKED, SequenceFold, VERDICT)


def correction_status(events: DataFrame, key: Sequence[str], order: str, content: str, flagged: Column | None = None) -> DataFrame:
    """``correction`` of each row against the one before it under the same key: ``original``, ``unchanged``, ``correction``."""
    w = W.partitionBy(*key).orderBy(order)
    same = F.lag(content).over(w).eqNullSafe(F.col(content)) & ~(F.lit(False) if flagged is None else flagged)
    return events.withColumn("correction", F.when(F.row_number().over(w) == 1, "original").when(same, "unchanged").otherwise("correction"))


LIVE = "entity string, arrival long, sequence long, status string, needs_snapshot boolean, total long, n_applied long, n_corrections long"
LIVE_INPUTS = ("arrival", "kind", "sequence", "amount")


def live_totals(events: DataFrame, snapshot_first: bool = False) -> DataFrame:
    """Batch form over (``entity``, ``arrival``, ``kind``, ``sequence``, ``amount``): a row per event."""
    return fold(events, "entity", ["arrival"], LIVE_INPUTS, partial(LiveFold, snapshot_first=snapshot_first), LIVE)


def live_totals_stream(events: DataFrame, snapshot_first: bool = False) -> DataFrame:
    return fold_stream(events, "entity", ["arrival"], LIVE_INPUTS, partial(LiveFold, snapshot_first=snapshot_first), LIVE)


PACED = "key long, request long, at_us long, granted_us long"
ALLOWED = "key long, request long, allowed boolean"


def _pace(per_window: int, window_s: int, spacing_s: float):
    return partial(PaceFold, per_window=per_window, window_us=window_s * 1_000_000, spacing_us=int(spacing_s * 1e6))


def paced(requests: DataFrame, per_window: int, window_s: int, spacing_s: float = 0.0) -> DataFrame:
    """Sliding-window limiter: the instant (``granted_us``) at which each key's request may go.

    At most ``per_window`` grants lie in any trailing window; a request waits for the oldest of them to leave it and
    for the spacing from the last grant.
    """
    return fold(requests, "key", ["at_us", "request"], ["at_us", "request"], _pace(per_window, window_s, spacing_s), PACED)


def paced_stream(requests: DataFrame, per_window: int, window_s: int, spacing_s: float = 0.0) -> DataFrame:
    return fold_stream(requests, "key", ["at_us", "request"], ["at_us", "request"], _pace(per_window, window_s, spacing_s), PACED)


def token_bucket(requests: DataFrame, rate_per_s: float, capacity: float) -> DataFrame:
    """Token bucket per key: whether each request finds a token; tokens refill with time up to the capacity."""
    return fold(requests, "key", ["at_us", "request"], ["at_us", "request"], partial(BucketFold, rate_per_s=rate_per_s, capacity=capacity), ALLOWED)


def token_bucket_stream(requests: DataFrame, rate_per_s: float, capacity: float) -> DataFrame:
    return fold_stream(requests, "key", ["at_us", "request"], ["at_us", "request"], partial(BucketFold, rate_per_s=rate_per_s, capacity=capacity), ALLOWED)


PIPELINE = "stream_key string, arrival long, action string, status string, n_delivered long"
PIPELINE_INPUTS = ("arrival", "supported", "content", "redelivered", "corrects", "sequence", "fails", "deliveries")


def pipeline(events: DataFrame, most: int = 3) -> DataFrame:
    """Batch form of the event pipeline, see ``PipelineFold``; dead letters are the rows with action ``term``."""
    return fold(events, "stream_key", ["arrival"], PIPELINE_INPUTS, partial(PipelineFold, most=most), PIPELINE)


def pipeline_stream(events: DataFrame, most: int = 3) -> DataFrame:
    return fold_stream(events, "stream_key", ["arrival"], PIPELINE_INPUTS, partial(PipelineFold, most=most), PIPELINE)
