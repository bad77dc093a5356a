"""The registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import queries_entities, queries_evidence, queries_games, queries_gated, queries_identity, queries_log, queries_market, queries_more, queries_rules, queries_status, queries_streams  # noqa: F401  (they register)
from tidemark.plans.registering import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["latest_as_of"](spark, sf_dir)
