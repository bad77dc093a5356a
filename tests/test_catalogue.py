"""Every registered query that has SQL gives the rows that DuckDB gives for it."""

import duckdb
import pandas as pd
import pytest

from tidemark.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def text(x):
    if hasattr(x, "__len__") and not isinstance(x, str):
        return str([text(y) for y in x])
    if x is None or x is pd.NA or x is pd.NaT or x != x:
        return "null"
    if isinstance(x, (bool,)) or type(x).__name__ == "bool_":
        return str(bool(x))
    return f"{float(x):.9g}" if isinstance(x, (int, float)) or hasattr(x, "dtype") else str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(map(text, r)) for r in df.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows_as_sql(name, spark, sf, duck):
    assert rows(catalogue.QUERIES[name](spark, sf).toPandas()) == rows(duck.sql(catalogue.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_queries_without_sql_run(name, spark, sf):
    assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
