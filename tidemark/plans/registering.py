"""Registration of queries together with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query by its function's name; ``sql`` gives the same rows, or None where SQL cannot."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant(text: str) -> Column:
    """A timestamp without zone, as the tables have them."""
    return F.to_timestamp_ntz(F.lit(text))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an observation log: anchor (user_id, event_type), time ts, content of three values."""
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select("event_id", "user_id", "event_type", "ts", "value", k.alias("k"), F.md5((k % 3).cast("string")).alias("content"))


#: The same log in SQL.
LOG = "WITH log AS (SELECT event_id, user_id, event_type, ts, value, CAST(props->>'k' AS INT) AS k, md5(CAST(CAST(props->>'k' AS INT) % 3 AS VARCHAR)) AS content FROM events) "
