"""Features that stem from a label are refused, whatever they are called."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.surfaces import LeakError, features_only, stems, surfaces


def test_renamed_labels_are_refused(spark, sf, tmp_path):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    closing = spark.createDataFrame([(1, 5.0)], "o_orderkey long, close double")
    customers = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_acctbal")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey).join(closing, "o_orderkey", "left")
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_totalprice"))).withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
    forbidden = [(orders, "o_orderstatus"), (closing, "close")]
    features, labels = surfaces(rows, ["o_orderkey"], ["o_totalprice", "c_acctbal", "rank"], ["label"], forbidden)
    assert features.columns == ["o_orderkey", "o_totalprice", "c_acctbal", "rank"] and labels.columns == ["o_orderkey", "label"]
    leaks = {
        "renamed": rows.select("o_orderkey", F.col("label").alias("form")),
        "aggregate": rows.groupBy("o_custkey").agg(F.avg(F.col("close") + 1).alias("price")),
        "window": rows.select("o_orderkey", F.lag("label").over(W.partitionBy("o_custkey").orderBy("o_orderkey")).alias("before")),
        "joined again": features.join(orders.select(F.col("o_orderkey").alias("k"), F.upper("o_orderstatus").alias("s")), F.col("o_orderkey") == F.col("k")),
        "union": rows.select(F.col("o_totalprice").alias("x")).union(rows.select("close")),
        "explode": rows.select("o_orderkey", F.explode(F.array("close")).alias("y")),
        "python": rows.select("o_orderkey", "label").mapInArrow(lambda batches: batches, "o_orderkey long, z int"),
        "read again": spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderstatus").alias("q")),
    }
    for name, df in leaks.items():
        with pytest.raises(LeakError):
            features_only(df, forbidden)
            raise AssertionError(name)
    clean = rows.where("label = 1").groupBy("o_custkey").agg(F.sum("c_acctbal").alias("sum")).union(rows.select("o_custkey", "o_totalprice"))
    assert features_only(clean, forbidden) is clean
    assert {c for _, c in stems(rows)["rank"]} == {"o_custkey", "o_totalprice"}
