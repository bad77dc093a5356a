"""Reads as of a time: inclusive, and ambiguous rather than arbitrary when contents tie."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.slices import Slices, last_known, next_time


def as_of(df: DataFrame, anchor: Sequence[str], time: str, content: str, cutoff: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Per anchor the newest state at or before ``cutoff``.

    ``status`` is ``ambiguous`` where the newest instant has different contents (the content is then null), else
    ``ok``; a null content is a content like any other.  ``keep`` columns come together from one row of the newest
    instant, the least in their order.  The cutoff reaches the scan; both aggregates are partial.
    """
    state = F.struct(F.col(content).alias("c"), F.struct(*keep, F.lit(0).alias("_")).alias("k"))
    held = F.struct(F.col(content).alias("c"))
    by_time = df.where(F.col(time) <= cutoff).groupBy(*anchor, time).agg(F.min(held).alias("__low"), F.max(held).alias("__high"), F.min(state)["k"].alias("__keep"))
    newest = by_time.groupBy(*anchor).agg(F.max(F.struct(time, "__low", "__high", "__keep")).alias("n"))
    clear = F.col("n.__low.c").eqNullSafe(F.col("n.__high.c"))
    return newest.select(
        *anchor, F.col(f"n.{time}").alias(time), F.when(clear, F.col("n.__low.c")).alias(content), F.when(clear, "ok").otherwise("ambiguous").alias("status"), *[F.col(f"n.__keep.{c}").alias(c) for c in keep]
    )


def require_unambiguous(df: DataFrame) -> DataFrame:
    """Fail the job when a row is ambiguous."""
    return df.where(F.when(F.col("status") == "ambiguous", F.raise_error(F.lit("two contents at the newest instant"))).otherwise(F.lit(True)))


def as_of_join(left: DataFrame, right: DataFrame, key: Sequence[str], left_time: str, right_time: str, values: Sequence[str], strict: bool = False, slices: Slices | None = None) -> DataFrame:
    """Left rows with the values of the key's last right row at or before (``strict``: before) their time.

    Both sides are laid over each other on the key, one shuffle and one sort, never a product of the sides.  Ties
    among right rows go to the largest values.  With ``slices`` a busy key's rows are spread over slices of time.
    """
    names = left.columns
    one = left.select(*key, F.col(left_time).alias("__t"), F.lit(0 if strict else 1).alias("__side"), F.struct(*names).alias("__left"), F.lit(None).alias("__right"))
    two = right.select(*key, F.col(right_time).alias("__t"), F.lit(1 if strict else 0).alias("__side"), F.lit(None).alias("__left"), F.struct(F.col(right_time).alias("matched_at"), *values).alias("__right"))
    laid = one.unionByName(two).withColumn("__found", F.col("__right"))
    both = last_known(laid, key, ["__t", "__side", "__right"], ["__found"], slices and slices(F.col("__t"))).where(F.col("__left").isNotNull())
    return both.select(*[F.col(f"__left.{c}").alias(c) for c in names], "__found.matched_at", *[F.col(f"__found.{v}").alias(v) for v in values])


def next_trigger(df: DataFrame, key: Sequence[str], time: str, slices: Slices | None = None) -> DataFrame:
    """Rows with the key's first strictly later time; rows at one time share it."""
    return df.join(next_time(df, key, time, "next_at", slices and slices(F.col(time))), [*key, time], "left")


def newest_row(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order (planned as a window group limit)."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")


def latest_from_other_source(df: DataFrame, key: Sequence[str], time: str, row_id: str, source: str, value: str) -> DataFrame:
    """Rows with the last value that a different source gave for the key before them.

    A run of rows by one source ends where the source changes; what another source said last is the row before the
    run.
    """
    w = W.partitionBy(*key).orderBy(time, row_id)
    before = df.withColumn("__source", F.lag(source).over(w)).withColumn("__value", F.lag(value).over(w))
    starts = F.when(F.col("__source").isNull() | (F.col("__source") != F.col(source)), F.struct(F.col("__source").alias("s"), F.col("__value").alias("v")))
    found = before.withColumn("__run", F.last(starts, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return found.withColumn("other_source", F.col("__run.s")).withColumn("other_value", F.col("__run.v")).drop("__source", "__value", "__run")
