"""Set operations, reconciliation and folds with conflicts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(declared: DataFrame, derived: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keyed set equality: every key with ``missing``, ``unexpected``, ``different`` or ``equal``."""
    a = declared.select(*key, F.struct(*values).alias("__a"))
    b = derived.select(*key, F.struct(*values).alias("__b"))
    both = a.join(b, list(key), "full_outer")
    status = F.when(F.col("__b").isNull(), "missing").when(F.col("__a").isNull(), "unexpected").when(F.col("__a").eqNullSafe(F.col("__b")), "equal").otherwise("different")
    return both.select(*key, status.alias("status"))


def distinct_ids(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct non-null ids of several one-column frames."""
    return reduce(DataFrame.union, frames).where(F.col(frames[0].columns[0]).isNotNull()).distinct()


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both differences: members of one side only, with the side."""
    return a.subtract(b).withColumn("side", F.lit("missing")).unionByName(b.subtract(a).withColumn("side", F.lit("unexpected")))


def one_to_one(df: DataFrame, source: str, target: str) -> DataFrame:
    """Targets that several sources claim."""
    return df.groupBy(target).agg(F.count_distinct(source).alias("n_sources")).where("n_sources > 1")


def fold(df: DataFrame, key: Sequence[str], rank: Sequence[Column], content: str) -> DataFrame:
    """Order-free fold: the content of least rank, and whether the key has conflicting contents."""
    out = df.groupBy(*key).agg(F.min(F.struct(*rank, F.col(content).alias("__c"))).alias("w"), F.count_distinct(content).alias("n_contents"))
    return out.select(*key, F.col("w.__c").alias(content), (F.col("n_contents") > 1).alias("conflict"))


def combine(df: DataFrame, key: Sequence[str], rules: dict[str, tuple[str, str]], order: Sequence[str] = ()) -> DataFrame:
    """Aggregate columns by named rules: output -> (rule, column).

    ``additive``, ``additive_optional`` (null stays null only when all are), ``maximum``, ``any``, ``any_evidence``
    (null unless some evidence), ``union`` (sorted distinct members of arrays), ``identity`` (the common value),
    ``precedence`` (by largest ``order``), ``first_evidence`` and ``latest`` (non-null by ``order``).  ``derived`` takes
    a Column over the other outputs.  ``conflicts`` lists, in order, the identity outputs with several values; such an
    output is null, and a caller that must not go on refuses rows with conflicts.
    """
    ranked = lambda c: F.struct(*order, F.col(c).alias("v"))
    how = {
        "additive": lambda c: F.sum(F.coalesce(c, F.lit(0))),
        "additive_optional": F.sum,
        "maximum": F.max,
        "any": lambda c: F.coalesce(F.bool_or(c), F.lit(False)),
        "any_evidence": F.bool_or,
        "union": lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))),
        "identity": lambda c: F.when(F.count_distinct(c) == 1, F.min(c)),
        "precedence": lambda c: F.max(ranked(c))["v"],
        "first_evidence": lambda c: F.min(F.when(F.col(c).isNotNull(), ranked(c)))["v"],
        "latest": lambda c: F.max(F.when(F.col(c).isNotNull(), ranked(c)))["v"],
    }
    plain = {out: x for out, x in rules.items() if x[0] != "derived"}
    disputed = [F.when(F.count_distinct(c) > 1, F.lit(out)) for out, (rule, c) in plain.items() if rule == "identity"]
    conflicts = F.array_compact(F.array(*disputed)) if disputed else F.array().cast("array<string>")
    folded = df.groupBy(*key).agg(*[how[rule](c).alias(out) for out, (rule, c) in plain.items()], conflicts.alias("conflicts"))
    return folded.withColumns({out: c for out, (rule, c) in rules.items() if rule == "derived"})
