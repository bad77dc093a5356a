"""Distributions, histograms, calibration and grids.  Everything is a partial aggregate plus small joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def distribution(df: DataFrame, value: str, key: Sequence[str] = ()) -> DataFrame:
    """count, mean, p50, p95, p99 (linear interpolation) and max."""
    pct = [F.percentile(value, F.lit(p / 100)).alias(f"p{p}") for p in (50, 95, 99)]
    return df.groupBy(*key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), *pct, F.max(value).alias("max"))


def bounds_1_2_5(decades: int) -> list[int]:
    return [m * 10**d for d in range(decades) for m in (1, 2, 5)]


def bucket_percentiles(df: DataFrame, value: str, bounds: Sequence[int], quantiles: Sequence[float], key: Sequence[str] = ()) -> DataFrame:
    """Percentiles from bucket counts: the bound of the bucket that reaches the rank, at most the maximum seen.

    Per key only the bucket counts are kept, so histograms of parts can be added.
    """
    bucket = F.aggregate(F.array(*[F.lit(b) for b in bounds]), F.lit(0), lambda n, b: n + F.when(F.col(value) > b, 1).otherwise(0))
    counts = df.groupBy(*key, bucket.alias("b")).agg(F.count("*").alias("n"), F.max(value).alias("top"))
    order = W.partitionBy(*key).orderBy("b") if key else W.partitionBy(F.lit(0)).orderBy("b")
    whole = W.partitionBy(*key) if key else W.partitionBy(F.lit(0))
    up = counts.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(whole)).withColumn("most", F.max("top").over(whole))
    limit = F.coalesce(F.get(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("b")), F.col("most"))
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.lit(q) * F.col("total")), F.least(limit, F.col("most")))).alias(f"p{round(q * 100)}") for q in quantiles]
    return up.groupBy(*key).agg(F.max("total").alias("n"), *at)


def reliability(df: DataFrame, p: str, y: str, bins: int = 10) -> DataFrame:
    """Per bin, empty ones included: count, mean prediction, rate and gap; the last bin is closed on the right."""
    at = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    counted = df.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(y).alias("rate"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "mean_p", "rate", F.abs(F.col("mean_p") - F.col("rate")).alias("gap"))


def calibration(df: DataFrame, p: str, y: str, bins: int = 10) -> DataFrame:
    """Brier score, expected calibration error and count, in one row."""
    at = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    per_bin = df.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.sum(p).alias("sp"), F.sum(y).alias("sy"), F.sum((F.col(p) - F.col(y)) * (F.col(p) - F.col(y))).alias("se"))
    return per_bin.agg((F.sum("se") / F.sum("n")).alias("brier"), (F.sum(F.abs(F.col("sp") - F.col("sy"))) / F.sum("n")).alias("ece"), F.sum("n").alias("n"))


def rate_grid(df: DataFrame, x: Column, y: Column, won: str, xs: Sequence[int], ys: Sequence[int]) -> DataFrame:
    """Win rate on a dense grid; cells never seen have no rate."""
    counted = df.groupBy(x.alias("gx"), y.alias("gy")).agg(F.count("*").alias("n"), F.avg(won).alias("rate"))
    spark = df.sparkSession
    cells = spark.range(len(xs)).select((F.col("id") + xs[0]).alias("gx")).crossJoin(F.broadcast(spark.range(len(ys)).select((F.col("id") + ys[0]).alias("gy"))))
    return cells.join(counted, ["gx", "gy"], "left").select("gx", "gy", F.coalesce("n", F.lit(0)).alias("n"), "rate")


def trained_bounds(df: DataFrame, columns: Sequence[str], slack: float = 0.1) -> DataFrame:
    """One row with each column's range, widened by a share of its span."""
    each = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
    for c in columns:
        span = F.col(f"hi_{c}") - F.col(f"lo_{c}")
        each = each.withColumns({f"lo_{c}": F.col(f"lo_{c}") - slack * span, f"hi_{c}": F.col(f"hi_{c}") + slack * span})
    return each


def out_of_bounds(df: DataFrame, bounds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``ood`` and ``ood_score`` (largest excess over the range, in spans) against one row of bounds."""
    score = F.lit(0.0)
    for c in columns:
        span = F.greatest(F.col(f"hi_{c}") - F.col(f"lo_{c}"), F.lit(1e-12))
        score = F.greatest(score, (F.col(f"lo_{c}") - F.col(c)) / span, (F.col(c) - F.col(f"hi_{c}")) / span)
    return df.crossJoin(F.broadcast(bounds)).withColumn("ood_score", score).withColumn("ood", F.col("ood_score") > 0).drop(*bounds.columns)


def complete_sum(df: DataFrame, key: Sequence[str], period: str, value: str) -> DataFrame:
    """Sum over periods, null when one of them is missing or unknown."""
    return df.groupBy(*key).agg(F.when(F.count(value) == F.max(period), F.sum(value)).alias("total"), F.max(period).alias("n_periods"))


def multiset_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Order-free digest of rows: count and two commutative sums of row hashes; no row order or collection is needed."""
    rows = df.select(F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in sorted(columns)]), 256).alias("h"))
    part = lambda i: F.sum(F.conv(F.substring("h", i, 12), 16, 10).cast("decimal(38,0)")).cast("string")
    return rows.agg(F.count("*").alias("n_rows"), part(1).alias("sum_a"), part(13).alias("sum_b"))


def set_digest(df: DataFrame, column: str) -> DataFrame:
    """SHA-256 of the sorted distinct values, for sets that are small by nature (plans, manifests)."""
    return df.select(F.col(column).cast("string").alias("v")).distinct().agg(F.count("*").alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list("v")), "\n"), 256).alias("digest"))
