"""Streaming results equal the batch fold; the gate, the sink and the limiter behave as stated."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import sequence, streams

ROWS = [("s", 1, 1, "a"), ("s", 2, 2, "b"), ("s", 3, 5, "e"), ("s", 4, 3, "c"), ("s", 5, 3, "x"), ("s", 6, 4, "d"), ("s", 7, None, "n"), ("t", 1, 5, "a"), ("t", 2, 3, "b"), ("t", 3, 6, "c")]
SCHEMA = "stream_key string, arrival long, sequence long, content string"


def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("flagged", F.lit(False))


def test_tracker_cases(spark):
    got = {(r.stream_key, r.arrival): (r.status, r.healthy, r.n_ready, r.n_missing, r.correction) for r in sequence.track(events(spark, ROWS)).collect()}
    assert got["s", 3] == ("gap", False, 0, 2, "original")
    assert got["s", 4] == ("in_order", False, 1, 1, "original")
    assert got["s", 5] == ("duplicate", False, 0, 1, "correction")
    assert got["s", 6] == ("in_order", True, 2, 0, "original")
    assert got["s", 7] == ("unsequenced", True, 1, 0, "not_applicable")
    assert got["t", 2] == ("duplicate", True, 0, 0, "original")


def test_stream_equals_batch(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for part, rows in enumerate((ROWS[:3], ROWS[3:6], ROWS[6:])):
        (source / f"{part}.json").write_text("".join(json.dumps(dict(zip(("stream_key", "arrival", "sequence", "content"), r), flagged=False)) + "\n" for r in rows))
        stream = spark.readStream.schema(f"{SCHEMA}, flagged boolean").option("maxFilesPerTrigger", 1).json(str(source))
        q = sequence.track_stream(stream).writeStream.option("checkpointLocation", str(tmp_path / "ck")).format("parquet").trigger(availableNow=True).start(str(out))
        q.awaitTermination(120)
    want = sorted(map(str, sequence.track(events(spark, ROWS)).collect()))
    assert sorted(map(str, spark.read.parquet(str(out)).select(*[c.split()[0] for c in sequence.VERDICT.split(", ")]).collect())) == want


def test_gate_and_sink(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    good = {"schema_version": "1.0", "envelope_id": "e1", "subject": "a.b", "stream_key": "s", "sequence": 1, "event_time": "2024-01-01T00:00:00Z", "content_hash": "h1"}
    lines = [good, good | {"envelope_id": "e2"}, good | {"schema_version": "9", "content_hash": "h3"}]
    (source / "0.json").write_text("\n".join(map(json.dumps, lines)) + "\nnot json\n")
    stream = streams.gate(streams.envelopes(spark, str(source)))
    streams.start(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    dead = spark.read.parquet(str(tmp_path / "out/dead"))
    assert sorted(r.dead_letter for r in dead.collect()) == ["schema_version", "undecodable"]
    ids = spark.read.parquet(str(tmp_path / "out/good"))
    assert ids.count() == 2


def test_deduplicated_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    row = {"schema_version": "1.0", "envelope_id": "e", "event_time": "2024-01-01T00:00:00Z", "subject": "a"}
    (source / "0.json").write_text("".join(json.dumps(row | {"content_hash": h}) + "\n" for h in ("x", "y", "x")))
    q = streams.deduplicated(streams.envelopes(spark, str(source))).writeStream.option("checkpointLocation", str(tmp_path / "ck")).format("parquet").trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_live_totals(spark):
    rows = [("g", 1, "delta", 5, 10), ("g", 2, "delta", 6, 1), ("g", 3, "delta", 9, 100), ("g", 4, "correction", 5, -2), ("g", 5, "delta", 6, 7), ("g", 6, "snapshot", 20, 50), ("g", 7, "delta", 21, 1)]
    df = spark.createDataFrame(rows, "entity string, arrival long, kind string, sequence long, amount long")
    got = [(r.status, r.total) for r in sequence.live_totals(df).orderBy("arrival").collect()]
    assert got == [("applied", 10), ("applied", 11), ("gap_detected", 11), ("correction_applied", 9), ("duplicate", 9), ("snapshot_applied", 50), ("applied", 51)]
    first = sequence.live_totals(df, snapshot_first=True).orderBy("arrival").first()
    assert (first.status, first.needs_snapshot) == ("gap_detected", True)


@pytest.mark.parametrize("per, spacing", [(2, 0.0), (3, 5.0)])
def test_limiter_never_exceeds_its_rate(spark, per, spacing):
    rows = [(1, i, i * 3_000_000) for i in range(30)]
    got = sequence.paced(spark.createDataFrame(rows, "key long, request long, at_us long"), per, 60, spacing).orderBy("request").collect()
    g = [r.granted_us for r in got]
    assert all(a <= b for a, b in zip((r.at_us for r in got), g))
    assert all(g[i + per] - g[i] >= 60_000_000 for i in range(len(g) - per))
    assert all(b - a >= spacing * 1e6 for a, b in zip(g, g[1:]))


def random_rows(seed):
    import random

    r, rows = random.Random(seed), []
    for key in ("a", "b", "c"):
        at = r.randrange(5)
        for arrival in range(1, 60):
            at += r.choice([1, 1, 1, 1, 2, 3, 0, -1, -2, -3])
            rows.append((key, arrival, None if r.random() < 0.05 else at, r.choice("xy")))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_windows_equal_the_fold(spark, seed):
    from tidemark.streaming.folds import SequenceFold

    rows = random_rows(seed)
    folds, want = {}, []
    for key, arrival, number, content in rows:
        fold = folds.setdefault(key, SequenceFold())
        want.append((key, *fold.step(arrival, number, content)))
        folds[key] = SequenceFold(json.loads(json.dumps(fold.dump())))  # what a stream does between micro-batches
    got = [tuple(r) for r in sequence.track(events(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_wide_gap_takes_no_room():
    from tidemark.streaming.folds import SequenceFold

    fold = SequenceFold()
    fold.step(1, 1, "a")
    assert fold.step(2, 10**15, "b")[5] == 10**15 - 2 and len(json.dumps(fold.dump())) < 300


@pytest.mark.parametrize("name", ["live", "paced", "bucket"])
def test_folds_as_streams_equal_batch(spark, tmp_path, name):
    schema = {"live": "entity string, arrival long, kind string, sequence long, amount long"}.get(name, "key long, request long, at_us long")
    forms = {
        "live": (sequence.live_totals, sequence.live_totals_stream, {}),
        "paced": (sequence.paced, sequence.paced_stream, {"per_window": 2, "window_s": 60, "spacing_s": 5.0}),
        "bucket": (sequence.token_bucket, sequence.token_bucket_stream, {"rate_per_s": 0.05, "capacity": 2.0}),
    }
    batch, stream_form, options = forms[name]
    if name == "live":
        rows = [("g", i, ["delta", "delta", "snapshot", "correction"][i * 7 % 4], i + (i % 5 == 0), i) for i in range(1, 30)]
    else:
        rows = [(i % 2, i, i * 7_000_000) for i in range(30)]
    source = tmp_path / "in"
    source.mkdir()
    names = [c.split()[0] for c in schema.split(", ")]
    for part in range(3):
        (source / f"{part}.json").write_text("".join(json.dumps(dict(zip(names, r))) + "\n" for r in rows[part * 10 : part * 10 + 10]))
        stream = spark.readStream.schema(schema).json(str(source))
        stream_form(stream, **options).writeStream.option("checkpointLocation", str(tmp_path / "ck")).format("parquet").trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination(120)
    want = batch(spark.createDataFrame(rows, schema), **options)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).select(*want.columns).collect())) == sorted(map(str, want.collect()))
