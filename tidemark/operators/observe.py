"""Writes with relational semantics over append-only observation logs.

A log has an *anchor* (the columns that name what is observed), a transaction time, a row id and a content hash.
All operators are windows or partial aggregates on the anchor: one shuffle, none of them collects.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _log(anchor: Sequence[str], time: str, row_id: str) -> W:
    return W.partitionBy(*anchor).orderBy(time, row_id)


def transitions(df: DataFrame, anchor: Sequence[str], time: str, row_id: str, content: str) -> DataFrame:
    """The rows whose content differs from their immediate predecessor's; a return to an earlier content is kept.

    A null content is a content like any other: a change to or from it is kept, a repetition is not.
    """
    w = _log(anchor, time, row_id)
    first, same = F.row_number().over(w) == 1, F.lag(content).over(w).eqNullSafe(F.col(content))
    return df.withColumn("__new", first | ~same).where("__new").drop("__new")


def reversals(df: DataFrame, anchor: Sequence[str], time: str, row_id: str, content: str) -> DataFrame:
    """Transitions back to the content before last."""
    kept = transitions(df, anchor, time, row_id, content)
    w = _log(anchor, time, row_id)
    back = (F.row_number().over(w) > 2) & F.lag(content, 2).over(w).eqNullSafe(F.col(content))
    return kept.withColumn("__back", back).where("__back").drop("__back")


def append_by_identity(df: DataFrame, identity: Sequence[str], time: str, row_id: str) -> DataFrame:
    """First observation of each identity, whatever lies between (trades and other facts that cannot recur)."""
    first = df.groupBy(*identity).agg(F.min(F.struct(time, row_id)).alias("__first"), F.count("*").alias("n_observed"))
    return first.select(*identity, F.col(f"__first.{time}").alias(time), F.col(f"__first.{row_id}").alias(row_id), "n_observed")


def drop_exact_replays(df: DataFrame, key: Sequence[str], row_id: str) -> DataFrame:
    """One row per full key, that of the smallest id."""
    return df.groupBy(*key).agg(F.min(row_id).alias(row_id))


def upsert(df: DataFrame, key: Sequence[str], time: str, row_id: str, attributes: Sequence[str]) -> DataFrame:
    """Current state: first and last observation, and the attributes as last seen (ties: the larger id)."""
    newest = F.max(F.struct(time, row_id, *attributes)).alias("__newest")
    out = df.groupBy(*key).agg(F.min(time).alias("first_observed_at"), F.max(time).alias("last_observed_at"), newest)
    return out.select(*key, "first_observed_at", "last_observed_at", *[F.col(f"__newest.{a}").alias(a) for a in attributes])


def corrections(df: DataFrame, anchor: Sequence[str], time: str, row_id: str, final: Column, substantive: Sequence[str], totals: Sequence[str] = ()) -> DataFrame:
    """Flag rows that change a final predecessor's substantive fields or lower a cumulative total."""
    w = _log(anchor, time, row_id)
    changed = F.lit(False)
    for c in substantive:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    fell = F.lit(False)
    for c in totals:
        fell = fell | F.coalesce(F.col(c) < F.lag(c).over(w), F.lit(False))
    was_final = F.coalesce(F.lag(final).over(w), F.lit(False))
    return df.withColumn("is_correction", (was_final & changed) | fell)


def idempotent_decisions(df: DataFrame, subject: Sequence[str], time: str, row_id: str, meaning: Sequence[str]) -> DataFrame:
    """Decisions whose meaning (a struct, candidates in order included) differs from the subject's latest one."""
    now = F.struct(*meaning)
    before = F.lag(now).over(_log(subject, time, row_id))
    return df.where(F.lit(True)).withColumn("__before", before).where(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(now)).drop("__before")


def validity(df: DataFrame, anchor: Sequence[str], time: str, row_id: str) -> DataFrame:
    """Half-open validity: from a row's time to the next row's of the anchor, open at the end of the log."""
    return df.withColumn("valid_to", F.lead(time).over(_log(anchor, time, row_id))).withColumnRenamed(time, "valid_from")


def active_at(df: DataFrame, start: str, end: str, at: Column) -> DataFrame:
    """Intervals that hold at an instant: started by then and not ended by then."""
    return df.where((F.col(start) <= at) & (F.col(end).isNull() | (F.col(end) > at)))


def ambiguous_aliases(df: DataFrame, alias: Sequence[str], entity: str) -> DataFrame:
    """Aliases with their number of entities and the flag of those with more than one."""
    return df.groupBy(*alias).agg(F.count_distinct(entity).alias("n_entities")).withColumn("is_ambiguous", F.col("n_entities") > 1)


def append_only_violations(before: DataFrame, after: DataFrame, row_id: str, content: Column) -> DataFrame:
    """Rows of an earlier state that a later one lacks or changed."""
    old = before.select(row_id, F.sha2(content, 256).alias("was"))
    new = after.select(row_id, F.sha2(content, 256).alias("now"))
    found = old.join(new, row_id, "left")
    return found.where("now IS NULL OR now <> was").select(row_id, F.when(F.col("now").isNull(), "deleted").otherwise("changed").alias("violation"))


def issues(events: DataFrame, key: Sequence[str], time: str, row_id: str, resolves: Column) -> DataFrame:
    """Data-quality issues as intervals: an event opens one unless one is open, a resolving event closes it.

    One window on the key: a run of openings counts from its first, and the first resolution after it ends it.
    """
    w = W.partitionBy(*key).orderBy(time, row_id)
    marked = events.withColumn("__end", resolves)
    starts = marked.withColumn("__new", ~F.col("__end") & F.coalesce(F.lag("__end").over(w), F.lit(True)))
    runs = starts.withColumn("__run", F.sum(F.col("__new").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0))).where("__run > 0")
    return runs.groupBy(*key, "__run").agg(F.min(time).alias("detected_at"), F.min(F.when(F.col("__end"), F.col(time))).alias("resolved_at"), F.count_if(~F.col("__end")).alias("n_seen")).drop("__run")
