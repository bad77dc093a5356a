"""Coverage, data-quality findings and grades."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Grade bands.
BANDS = ((0.95, "A"), (0.85, "B"), (0.70, "C"), (0.50, "D"))


def coverage(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and first and last time of each table (name -> frame, time column)."""
    each = [df.agg(F.count("*").alias("n_rows"), F.min(t).cast("string").alias("first_at"), F.max(t).cast("string").alias("last_at")).select(F.lit(n).alias("table_name"), "n_rows", "first_at", "last_at") for n, (df, t) in tables.items()]
    return reduce(DataFrame.unionByName, each)


def latest_status(df: DataFrame, key: Sequence[str], time: str, status: str) -> DataFrame:
    """Status at the key's newest time; several statuses at that time are all named, joined by ``|``."""
    newest = df.groupBy(*key, time).agg(F.array_join(F.sort_array(F.collect_set(status)), "|").alias(status)).groupBy(*key).agg(F.max(F.struct(time, status)).alias("n"))
    return newest.select(*key, F.col(f"n.{time}").alias(time), F.col(f"n.{status}").alias(status))


def equal_time_conflicts(df: DataFrame, anchor: Sequence[str], time: str, content: str) -> DataFrame:
    """Anchors and instants with more than one content."""
    return df.groupBy(*anchor, time).agg(F.count_distinct(content).alias("n_contents")).where("n_contents > 1")


def score(blocking: Column, issues: Column, notes: Column) -> Column:
    return F.when(blocking > 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - F.lit(0.1) * issues - F.lit(0.02) * notes))


def grade(value: Column, blocking: Column | None = None) -> Column:
    out = F.when(blocking > 0, "F") if blocking is not None else None
    for least, name in BANDS:
        out = out.when(value >= least, name) if out is not None else F.when(value >= least, name)
    return out.otherwise("F")


def grades(findings: DataFrame, key: Sequence[str], severity: str = "severity") -> DataFrame:
    """Counts by severity, score and grade."""
    n = {s: F.count_if(F.col(severity) == s).alias(s) for s in ("blocking", "issue", "note")}
    out = findings.groupBy(*key).agg(*n.values()).withColumn("score", F.round(score(F.col("blocking"), F.col("issue"), F.col("note")), 6))
    return out.withColumn("grade", grade(F.col("score"), F.col("blocking")))


def top_examples(df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str, n: int) -> DataFrame:
    """The first ``n`` values of each group in order, as an array, and the group's size.

    Ranks cut each group before anything is collected, so an array holds ``n`` values at most.
    """
    ranked = df.withColumn("__n", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("__n") <= n)
    examples = ranked.groupBy(*group).agg(F.transform(F.sort_array(F.collect_list(F.struct("__n", value))), lambda x: x[value]).alias("examples"))
    return df.groupBy(*group).agg(F.count("*").alias("n_rows")).join(examples, list(group))


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds, null when none does: splits rows into good and rejected."""
    out = None
    for name, rule in rules:
        out = F.when(rule, name) if out is None else out.when(rule, name)
    return out.otherwise(F.lit(None).cast("string"))
