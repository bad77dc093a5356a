"""Exact deduplication of normalised texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: ``[\x20\x09-\x0D]``, deleted before texts are compared.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: More than twice any long, so length and id share one decimal that a hash aggregate can keep in place.
STEP = "1" + "0" * 20


def _step() -> F.Column:
    return F.lit(STEP).cast("decimal(21,0)")


def normalised(text_col: str) -> F.Column:
    return reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), SPACES, F.coalesce(F.col(text_col), F.lit("")))


def content_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per distinct normalised text: ``text_sha256``, ``keep_id``, ``group_size``."""
    rows = df.select(
        normalised(text_col).alias("norm"),
        (F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("decimal(10,0)") * _step() - F.col(id_col).cast("long")).alias("rank"),
    )
    groups = rows.groupBy(F.unhex(F.md5("norm")).alias("hash"), "norm").agg(F.max("rank").alias("rank"), F.count("*").alias("group_size"))
    keep = (F.round(F.col("rank") / _step(), 0).cast("decimal(10,0)") * _step() - F.col("rank")).cast("long")
    return groups.select(F.sha2("norm", 256).alias("text_sha256"), keep.alias("keep_id"), "group_size")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.  Ids are longs.

    Rows are grouped by a 128-bit content hash (MD5 of the normalised text) together with the bytes themselves, so
    texts that merely share a hash stay apart.  The aggregate is partial before its shuffle: a task sends each of its
    distinct texts once, however many copies it has, so a group however large is a row per task.  Its result, a row
    per group without the text, is joined back to the ids; that join may be hot on one key, which adaptive execution
    splits, and moves no texts.

    Of equal texts the one with the most code points in the original, then the smallest id, stays.  Null counts as
    empty; all empty texts form one group.  Very long texts are hashed and compared whole.  Different texts under one id
    are rows of their own, each in the group of its text.  Rows repeated with one id are each counted and get the same decision.  A
    row with a null id is counted but stays only where its group has no other.  An empty table gives an empty result;
    other columns are not read.
    """
    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.sha2(normalised(text_col), 256).alias("text_sha256"))
    joined = rows.join(content_groups(df, id_col, text_col).hint("merge"), "text_sha256")
    return joined.select(id_col, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, whole, one of each content; of rows with the id that stays and that content the one with the most
    code points in its original text, then the least of these texts.

    A row is decided by its content and its id together, so different texts under one id, or without id, each stay.  Null
    counts as empty; very long texts are compared whole; an empty table stays empty; other columns come through as they
    are, whatever their names.  Besides the grouping, rows cross the network once, to the groups of their content.
    """
    groups = content_groups(df, id_col, text_col).select(F.col("text_sha256").alias("content"), F.col("keep_id").alias("keep"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.struct(*df.columns).alias("row"), F.sha2(normalised(text_col), 256).alias("content"), F.col(id_col).cast("long").alias("id"), F.length(text).alias("n"), F.md5(text).alias("raw"))
    rows = rows.join(groups, "content").where(F.col("id").eqNullSafe(F.col("keep"))).drop("keep")
    first = F.row_number().over(W.partitionBy("content", "id").orderBy(F.desc("n"), "raw"))
    return rows.withColumn("place", first).where("place = 1").select(*[F.col("row")[c].alias(c) for c in df.columns])
