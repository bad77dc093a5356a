"""Keyed state by position: a stream equals the batch over many positions, its state is bounded, and losses are reported."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import sequence, stateful

SCHEMA = "stream_key string, arrival long, sequence long, content string, flagged boolean, event_time timestamp"
CONF = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(CONF)
    spark.conf.set(CONF, stateful.PROVIDER)
    yield spark
    spark.conf.set(CONF, before)


def run(spark, df, tmp_path, parts, **how):
    """The rows in order of arrival, a file of them at a time."""
    rows = df.orderBy("arrival").collect()
    size = -(-len(rows) // parts)
    for k in range(parts):
        spark.createDataFrame(rows[k * size : (k + 1) * size], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{k:03d}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    q = stateful.track_stream(stream, **how).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination(600)
    return spark.read.parquet(f"{tmp_path}/out"), q.recentProgress


def test_stream_equals_batch_beyond_ten_thousand_positions(rocks, tmp_path):
    """Contents of all 12,000 positions stay known, so a correction of the first is still one at the end."""
    r = random.Random(3)
    order = list(range(1, 12_001))
    for k in range(0, len(order) - 8, 40):
        i, j = sorted((k, k + r.randrange(1, 8)))
        order[i], order[j] = order[j], order[i]
    rows = [("s", n, q, f"c{q}", False) for n, q in enumerate(order)]
    rows += [("s", 12_000, 1, "other", False), ("s", 12_001, 2, "c2", False), ("s", 12_002, 3, "c3", True), ("s", 12_003, None, "x", False), ("t", 5, 7, "a", False), ("t", 6, 9, "b", False)]
    df = rocks.createDataFrame(rows, "stream_key string, arrival long, sequence long, content string, flagged boolean").withColumn("event_time", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("arrival") / 100))
    got, _ = run(rocks, df, tmp_path, 3, patience="1 hour", keep="2 hours")
    names = [c.split()[0] for c in sequence.VERDICT.split(", ")]
    want = sorted(map(str, sequence.track(df.drop("event_time")).select(*names).collect()))
    assert sorted(map(str, got.where("status <> 'lost'").select(*names).collect())) == want
    assert got.where("status = 'lost'").count() == 0


def test_gaps_are_given_up_and_state_stays_bounded(rocks, tmp_path):
    """One position in fifty never comes: what it held back goes on, the loss is told, and contents are forgotten."""
    rows = [("s", n, n, "c", False) for n in range(1, 3001) if n % 50] + [("s", 3001, 40_000, "end", False)]
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.when(F.col("arrival") > 3000, 90_000).otherwise(F.col("arrival")))
    df = rocks.createDataFrame(rows, "stream_key string, arrival long, sequence long, content string, flagged boolean").withColumn("event_time", at)
    got, progress = run(rocks, df, tmp_path, 12, patience="30 seconds", keep="60 seconds")
    lost = got.where("status = 'lost'").collect()
    assert {x.sequence for x in lost if x.n_lost == 1} >= {50 * k for k in range(1, 58)}
    assert got.where("status IN ('in_order', 'lost')").agg(F.sum("n_ready")).first()[0] >= 3000 - 60 - 50
    sizes = [s["numRowsTotal"] for p in progress for s in p["stateOperators"]]
    assert max(sizes) < 1500  # a quarter of the positions, in their maps, indexes and timers
