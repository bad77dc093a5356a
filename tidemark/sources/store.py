"""Readers and writers: partitioned frames, JSON-lines logs, raw responses, gated imports and projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRAME_PARTITIONS = ("sport", "game_id", "date")


class SchemaMismatch(ValueError):
    pass


def write_frames(df: DataFrame, path: str) -> None:
    """Append flat frame rows, one folder per sport, game and date; rows are dealt out by those first, so a folder
    gets few files."""
    df.repartition(*FRAME_PARTITIONS).write.mode("append").partitionBy(*FRAME_PARTITIONS).parquet(path)


def read_frames(spark: SparkSession, path: str, game_id: str | None = None, sport: str | None = None) -> DataFrame:
    """Frames of a game and sport; other folders are not opened."""
    df = spark.read.parquet(path)
    for name, value in (("sport", sport), ("game_id", game_id)):
        df = df if value is None else df.where(F.col(name) == value)
    return df


def regroup(df: DataFrame) -> DataFrame:
    """One row per frame with its samples in order of player."""
    sample = [c for c in df.columns if c not in ("sport", "game_id", "frame_time", "period")]
    return df.groupBy("sport", "game_id", "frame_time", "period").agg(F.sort_array(F.collect_list(F.struct("player_id", *[c for c in sample if c != "player_id"]))).alias("samples"))


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A JSON-lines log under a fixed schema; a line that does not fit fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def gated_import(df: DataFrame, required: Sequence[str], version_column: str, versions: Sequence[str], rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) rows of an import; a missing column is refused before anything is read."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaMismatch(f"missing columns: {', '.join(missing)}")
    from tidemark.operators.quality import first_reason

    marked = df.withColumn("reason", first_reason([("schema_version", ~F.coalesce(F.col(version_column).isin(*versions), F.lit(False))), *rules]))
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def raw_responses(df: DataFrame, provider: str, endpoint: str, params: str, body: str) -> DataFrame:
    """Raw payload rows with the hash of the body and of the request with it."""
    hashed = df.withColumn("body_hash", F.sha2(body, 256)).withColumn("body_bytes", F.octet_length(body))
    return hashed.withColumn("content_hash", F.sha2(F.concat_ws("\x1f", provider, endpoint, params, "body_hash"), 256))


def reproject(raw: DataFrame, body: str, schema: str, path: str) -> DataFrame:
    """Typed rows from archived JSON bodies: the array at ``path``, exploded; bodies that do not parse give none."""
    parsed = raw.withColumn("__p", F.from_json(body, schema))
    return parsed.withColumn("item", F.explode(F.col(f"__p.{path}"))).drop("__p", body).select("*", "item.*").drop("item")


def frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small constant dimensions."""
    return spark.createDataFrame(list(rows), schema)


def violations(df: DataFrame, rules: Sequence[tuple[str, Column]], row_id: str) -> DataFrame:
    """Every broken rule of every row, as rows."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules]), lambda r: r.isNotNull())
    return df.select(row_id, F.explode(broken).alias("rule"))


#: What makes a row a frame of tracking data rather than an event.
FRAME_COLUMNS = {"frame_time": None, "player_id": None, "x": ("double", "float"), "y": ("double", "float")}


def require_frames(df: DataFrame) -> DataFrame:
    """The rows, if their schema is that of frames; event data is refused before anything runs."""
    types = dict(df.dtypes)
    wrong = [c for c, kinds in FRAME_COLUMNS.items() if c not in types or (kinds and types[c] not in kinds)]
    if wrong:
        raise TypeError(f"frame data needs the columns {', '.join(wrong)}")
    return df


def frame_manifest(frames: DataFrame, keys: list[str], time: str) -> DataFrame:
    """One row per partition of frames: rows, first and last instant, and a digest that needs no order."""
    digest = F.sum(F.xxhash64(*frames.columns).cast("decimal(38,0)"))
    return frames.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.min(time).alias("first_at"), F.max(time).alias("last_at"), digest.alias("digest"))


def upsert_manifest(held: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The manifest with new entries in place of those of the same partition."""
    return held.join(new.select(*keys), keys, "left_anti").unionByName(new)
