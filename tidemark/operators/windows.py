"""Analytic operators over ordered rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.slices import Slices, last_known


def carry_forward(df: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str], slices: Slices | None = None) -> DataFrame:
    """Each value as last seen at or before the row; with ``slices`` of the first order column a busy key is spread."""
    return last_known(df, key, order, values, slices and slices(F.col(order[0])))


def slate_numbers(df: DataFrame, slate: Sequence[str], start: str, row_id: str, least_seconds: int) -> DataFrame:
    """Rank within a slate; null for all of it when two starts are closer than ``least_seconds``."""
    w = W.partitionBy(*slate).orderBy(start, row_id)
    gap = F.unix_micros(F.col(start).cast("timestamp")) - F.unix_micros(F.lag(start).over(w).cast("timestamp"))
    out = df.withColumn("__n", F.row_number().over(w)).withColumn("__gap", gap)
    close = F.min("__gap").over(W.partitionBy(*slate)) < least_seconds * 1_000_000
    return out.withColumn("number", F.when(F.coalesce(close, F.lit(False)), None).otherwise(F.col("__n"))).drop("__n", "__gap")


def chronological_split(df: DataFrame, order: Sequence[str], fraction: float, group: Sequence[str] = ()) -> DataFrame:
    """``train`` for the first ``int(n * fraction)`` rows in order, per group.

    Without a group the rank would need all rows in one task; instead rows are range-partitioned by order, ranked
    within partitions, and offset by the number of rows in earlier partitions.
    """
    if group:
        w = W.partitionBy(*group)
        return df.withColumn("train", F.row_number().over(w.orderBy(*order)) <= F.floor(F.count("*").over(w) * fraction))
    ranked = global_rank(df, order)
    total = df.agg(F.count("*").alias("__total"))
    return ranked.crossJoin(F.broadcast(total)).withColumn("train", F.col("rank") <= F.floor(F.col("__total") * fraction)).drop("__total", "rank")


def checkpointed(df: DataFrame) -> DataFrame:
    """A table in the session's checkpoint folder, which all executors share; a temporary one where none is set.

    Unlike ``DataFrame.checkpoint`` it computes the rows once, keeps columns that can be pruned, and survives lost executors
    just as well.  The tables stay there until the folder is cleared.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def global_rank(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rank`` from 1 in a total order, without a single task for all rows.

    Range bounds are sampled, so the placement is written before it is read twice.
    """
    placed = checkpointed(df.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()))
    within = placed.withColumn("__r", F.row_number().over(W.partitionBy("__p").orderBy(*order)))
    sizes = within.groupBy("__p").agg(F.max("__r").alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    return within.join(F.broadcast(before), "__p").withColumn("rank", F.col("__r") + F.col("__before")).drop("__p", "__r", "__before")


def speeds(df: DataFrame, key: Sequence[str], time: str, x: str, y: str) -> DataFrame:
    """Distance over time since the key's previous row; null at the first and where time does not advance."""
    w = W.partitionBy(*key).orderBy(time)
    dt = (F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.lag(time).over(w).cast("timestamp"))) / 1e6
    return df.withColumn("speed", F.when(dt > 0, F.hypot(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)) / dt))


def sequence_gaps(df: DataFrame, key: Sequence[str], sequence: str) -> DataFrame:
    """Runs of missing sequence numbers: key, ``missing_from``, ``missing_to``."""
    w = W.partitionBy(*key).orderBy(sequence)
    seen = df.select(*key, sequence).distinct().withColumn("before", F.lag(sequence).over(w))
    return seen.where(F.col(sequence) > F.col("before") + 1).select(*key, (F.col("before") + 1).alias("missing_from"), (F.col(sequence) - 1).alias("missing_to"))


def trailing_count(df: DataFrame, key: Sequence[str], time: str, seconds: int) -> DataFrame:
    """Rows of the key in the window of so many seconds that ends with the row."""
    w = W.partitionBy(*key).orderBy(F.unix_micros(F.col(time).cast("timestamp"))).rangeBetween(-seconds * 1_000_000 + 1, 0)
    return df.withColumn("n_trailing", F.count("*").over(w))


def select_first(df: DataFrame, key: Sequence[str], order: Sequence[Column], most: int, group: Sequence[str]) -> DataFrame:
    """Mark rows ``selected``, ``truncated`` or ``deduplicated`` so that the counts add up to those received."""
    copy = F.row_number().over(W.partitionBy(*group, *key).orderBy(*order))
    marked = df.withColumn("__copy", copy).withColumn("__first", F.col("__copy") == 1)
    place = F.row_number().over(W.partitionBy(*group, "__first").orderBy(*order))
    return marked.withColumn("__place", place).withColumn("outcome", F.when(~F.col("__first"), "deduplicated").when(F.col("__place") <= most, "selected").otherwise("truncated")).drop("__copy", "__first", "__place")
