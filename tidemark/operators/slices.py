"""Scans in order of time for keys of any size, in two levels.

One window per key puts all rows of a busy key into one task.  Here a key's rows are dealt by (key, slice of time), a
window runs inside each slice, and what a slice inherits comes from a small table with one row per key and slice: its
last values are one partial aggregate, carried over the slices by a window of a few rows.  The results are those of one
window per key; a slice that is never empty of a key's rows only bounds how many of them a task holds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Slices = Callable[[Column], Column]

# Rows of all sides together that a task of a large join gets, so that what it sorts and holds does not grow with the tables.
ROWS_PER_TASK = 500_000


def dealt(key: Sequence[str], *frames: DataFrame) -> list[DataFrame]:
    """Frames that are about to be joined by ``key``, dealt by it into as many partitions as their rows need.

    Spark joins partitions until they are as many as the cores or 64 MB each, packed; a task's memory then grows with the
    tables, and packed keys take many times those 64 MB.  Rows are counted first, which on files reads what the filters need.  Tables that
    fit a task are left alone.
    """
    parts = -(-sum(df.count() for df in frames) // ROWS_PER_TASK)
    return [df.repartition(parts, *key) for df in frames] if parts > 1 else list(frames)


def by_seconds(seconds: int) -> Slices:
    """Slices of so many seconds."""
    return lambda time: F.floor(F.unix_seconds(time.cast("timestamp")) / seconds)


def by_share(df: DataFrame, time: str, slices: int) -> Slices:
    """Slices with about equally many rows of ``df``: bounds are approximate quantiles of time, one number per slice."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    bounds = sorted(set(df.agg(F.percentile_approx(micros, [k / slices for k in range(1, slices)], 10_000).alias("b")).first()["b"] or []))

    def slice_of(at: Column) -> Column:
        us = F.unix_micros(at.cast("timestamp"))
        return F.when(us.isNotNull(), F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b <= us))) if bounds else F.when(us.isNotNull(), 0)

    return slice_of


def _sliced(df: DataFrame, key: Sequence[str], slice_: Column) -> DataFrame:
    """With the key as one struct, so that null keys are a key like any other in joins, too."""
    return df.withColumns({"__key": F.struct(*key), "__slice": slice_})


def last_known(df: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str], slice_: Column | None = None) -> DataFrame:
    """Each of ``values`` as last seen at or before the row, nulls skipped.

    ``order`` begins with time; ``slice_`` must not fall while time rises.  Rows with equal order columns should be equal in
    ``values``.  Without ``slice_`` a key is one window.
    """
    if slice_ is None:
        w = W.partitionBy(*key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumns({v: F.last(v, ignorenulls=True).over(w) for v in values})
    rows = _sliced(df, key, slice_)
    inside = W.partitionBy("__key", "__slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    newest = [F.max(F.when(F.col(v).isNotNull(), F.struct(*order, F.col(v).alias("__v"))))["__v"].alias(f"__before_{i}") for i, v in enumerate(values)]
    ends = rows.groupBy("__key", "__slice").agg(*newest)
    earlier = W.partitionBy("__key").orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.withColumns({f"__before_{i}": F.last(f"__before_{i}", ignorenulls=True).over(earlier) for i in range(len(values))})
    local = rows.withColumns({v: F.last(v, ignorenulls=True).over(inside) for v in values})
    both = local.join(carried, ["__key", "__slice"], "left")
    return both.withColumns({v: F.coalesce(v, f"__before_{i}") for i, v in enumerate(values)}).select(*df.columns)


def next_time(times: DataFrame, key: Sequence[str], time: str, name: str, slice_: Column | None = None) -> DataFrame:
    """Distinct (key, time) with the key's next time as ``name``."""
    times = times.select(*key, time).distinct()
    if slice_ is None:
        return times.withColumn(name, F.lead(time).over(W.partitionBy(*key).orderBy(time)))
    rows = _sliced(times, key, slice_)
    starts = rows.groupBy("__key", "__slice").agg(F.min(time).alias("__start"))
    after = starts.withColumn("__after", F.lead("__start").over(W.partitionBy("__key").orderBy("__slice"))).drop("__start")
    inside = rows.withColumn(name, F.lead(time).over(W.partitionBy("__key", "__slice").orderBy(time)))
    return inside.join(after, ["__key", "__slice"], "left").withColumn(name, F.coalesce(name, "__after")).select(*times.columns, name)
