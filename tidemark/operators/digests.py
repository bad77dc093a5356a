"""Two tables compared through digests of buckets, so that equal ones cost an aggregate each and no row is moved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _row_hash(columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits of the row's values as two whole numbers; nulls are told from every value."""
    told = F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})
    return F.xxhash64(told, F.lit(1)), F.xxhash64(told, F.lit(2))


def bucket_of(key: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Per bucket of keys: rows, and two sums over their hashes.  One partial aggregate: a task sends a row per bucket.

    Sums are over a multiset, so order does not matter and repeated rows do.
    """
    one, two = _row_hash([*key, *columns])
    rows = df.select(bucket_of(key, buckets).alias("bucket"), one.cast("decimal(38,0)").alias("a"), two.cast("decimal(38,0)").alias("b"))
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))


def table_digest(digests: DataFrame) -> DataFrame:
    """The root over the buckets: one row with the table's rows and digest."""
    return digests.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sha2(F.concat_ws("|", F.sum("a").cast("string"), F.sum("b").cast("string")), 256).alias("digest"))


def differing_buckets(left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Buckets whose digests differ; at most ``buckets`` rows."""
    one, two = (bucket_digests(df, key, columns, buckets) for df in (left, right))
    both = one.alias("l").join(two.alias("r"), "bucket", "full_outer")
    same = F.col("l.n").eqNullSafe(F.col("r.n")) & F.col("l.a").eqNullSafe(F.col("r.a")) & F.col("l.b").eqNullSafe(F.col("r.b"))
    return both.where(~same).select("bucket")


def differences(left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys on which two tables differ, with ``kind``: ``only_left``, ``only_right``, ``repeated`` (the number of rows differs)
    or ``changed``, and the rows on either side.

    Only rows of buckets that differ are compared, by key; the list of these buckets is bounded and broadcast.  A null key is
    a key like any other; repeated rows count; two empty tables have no differences; columns not named are not read.
    """
    found = F.broadcast(differing_buckets(left, right, key, columns, buckets))
    one, two = _row_hash([*key, *columns])

    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*key, bucket_of(key, buckets).alias("bucket"), one.cast("decimal(38,0)").alias("a"), two.cast("decimal(38,0)").alias("b"))
        return rows.join(found, "bucket", "left_semi").select(*key, F.lit(sign).alias("side"), (F.col("a") * sign).alias("a"), (F.col("b") * sign).alias("b"))

    per = side(left, 1).unionByName(side(right, -1)).groupBy(*key).agg(F.count_if(F.col("side") == 1).alias("n_left"), F.count_if(F.col("side") == -1).alias("n_right"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    kind = F.when(F.col("n_right") == 0, "only_left").when(F.col("n_left") == 0, "only_right").when(F.col("n_left") != F.col("n_right"), "repeated")
    return per.where((F.col("a") != 0) | (F.col("b") != 0)).select(*key, kind.otherwise("changed").alias("kind"), "n_left", "n_right")
