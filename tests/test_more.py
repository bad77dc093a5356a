"""Cases that the queries over the tables do not reach."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import pricing, times
from tidemark.operators import asof, entities, evidence, games, models, observe, provenance
from tidemark.sources import store
from tidemark.streaming import sequence
from tidemark.streaming.folds import PipelineFold, Ranges


def test_transitions_to_and_from_null(spark):
    rows = [("k", 1, "A"), ("k", 2, None), ("k", 3, None), ("k", 4, "A"), ("n", 1, None), ("n", 2, None)]
    df = spark.createDataFrame(rows, "a string, t int, c string").withColumn("id", F.col("t"))
    assert sorted((r.a, r.t) for r in observe.transitions(df, ["a"], "t", "id", "c").collect()) == [("k", 1), ("k", 2), ("k", 4), ("n", 1)]


def test_as_of_with_null_contents_and_kept_columns(spark):
    rows = [("x", 1, None, 9, 1), ("y", 1, None, 1, 2), ("y", 1, "A", 2, 1), ("z", 1, "A", 5, 1), ("z", 1, "A", 1, 7)]
    df = spark.createDataFrame(rows, "a string, t int, c string, p int, q int")
    got = {r.a: (r.c, r.status, r.p, r.q) for r in asof.as_of(df, ["a"], "t", "c", F.lit(5), keep=["p", "q"]).collect()}
    assert got["x"] == (None, "ok", 9, 1) and got["y"][:2] == (None, "ambiguous") and got["z"] == ("A", "ok", 1, 7)


def test_chains(spark):
    chains = {
        "whole": [("a", "b"), ("b", "c"), ("c", None)], "loop beside": [("a", "b"), ("b", None), ("c", "d"), ("d", "c")], "self loop": [("a", None), ("b", "b")], "circle": [("a", "b"), ("b", "a")],
        "lost": [("a", "b")], "two heads": [("a", "c"), ("b", "c"), ("c", None)], "twice": [("a", None), ("a", None)], "null page": [("a", None), (None, None)], "one": [("a", None)],
        "long": [(str(i), str(i + 1) if i < 99 else None) for i in range(100)], "tail loop": [("a", "b"), ("b", "c"), ("c", "b")],
    }
    df = spark.createDataFrame([(k, *p) for k, pages in chains.items() for p in pages], "run string, page string, next string")
    got = {r.run: r.verdict for r in provenance.chain_check(df, "run", "page", "next").collect()}
    want = {"whole": "complete", "loop beside": "unreachable", "self loop": "unreachable", "circle": "cycle", "lost": "missing", "two heads": "orphan", "twice": "duplicate", "null page": "duplicate", "one": "complete", "long": "complete", "tail loop": "complete"}
    assert got == want


def test_wall_clocks(spark):
    rows = [
        ("2024-07-04", "19:05", "America/New_York", "EDT", "2024-07-04 23:05"), ("2024-01-04", "19:05", "America/New_York", "EST", "2024-01-05 00:05"), ("2024-01-04", "19:05", "America/New_York", "EDT", "abbreviation_differs"),
        ("2024-03-10", "02:30", "America/New_York", None, "ambiguous_or_missing"), ("2024-11-03", "01:30", "America/New_York", None, "ambiguous_or_missing"), ("2024-11-03", "03:30", "America/New_York", "EST", "2024-11-03 08:30"),
        ("2024-03-10", "03:30", "America/Los_Angeles", "PDT", "2024-03-10 10:30"), ("2024-07-04", "19:05", "Europe/Rome", "EDT", "abbreviation_unknown"), ("2024-07-04", "19:05", "Moon", None, "unknown_zone"), ("2024-07-04", None, "UTC", None, "malformed"),
    ]
    df = spark.createDataFrame(rows, "day string, clock string, zone string, said string, want string")
    at, why = times.wall_clock(F.col("day"), F.col("clock"), F.col("zone"), F.col("said"))
    for r in df.select("want", at.alias("at"), why.alias("why")).collect():
        assert (r.why or r.at.strftime("%Y-%m-%d %H:%M")) == r.want


def test_pipeline_precedence():
    fold = PipelineFold(most=2)
    said = []
    for step in [
        (1, True, "a", False, False, 1, False, 1), (2, True, "c", False, False, 3, False, 1), (3, True, "b", False, False, 2, False, 1), (4, True, "a", False, False, 1, False, 1), (5, True, "a2", False, False, 1, False, 1),
        (6, False, "z", False, False, 4, False, 1), (7, True, "d", False, False, 4, True, 1), (8, True, "d", True, False, 4, True, 2), (9, True, "e", False, False, 5, True, 1), (10, True, "e", True, False, 5, False, 2), (11, True, "f", False, False, None, False, 1),
    ]:
        said.append(fold.step(*step)[1:])
        fold = PipelineFold(json.loads(json.dumps(fold.dump())), most=2)
    assert said == [
        ("ack", "delivered", 1), ("ack", "buffered_gap", 0), ("ack", "delivered", 2), ("ack", "duplicate", 0), ("ack", "correction", 1), ("term", "schema_mismatch", 0), ("retry", "retry", 0), ("term", "dead_letter", 0),
        ("retry", "retry", 0), ("ack", "delivered", 1), ("ack", "delivered", 1),
    ]


def test_released_events_are_never_lost():
    """Positions 1, 3 (fails), 4, then 2, which releases them: 3 and 4 wait in line, 3 is given up after three failures."""

    def run(steps, most=3):
        fold, out = PipelineFold(most=most), []
        for step in steps:
            out.append(fold.step(*step)[1:])
            fold = PipelineFold(json.loads(json.dumps(fold.dump())), most=most)
        return out, fold

    told = [(1, "a", False), (3, "c", True), (4, "d", False), (2, "b", False), (2, "b", False), (5, "e", False), (6, "f", False)]
    got, fold = run([(n, True, c, False, False, q, f, 1) for n, (q, c, f) in enumerate(told)])
    assert got == [("ack", "delivered", 1), ("ack", "buffered_gap", 0), ("ack", "buffered_gap", 0), ("ack", "delivered", 1), ("ack", "duplicate", 0), ("ack", "delivered+dead_letter", 2), ("ack", "delivered", 1)]
    assert not fold.line and not fold.held and list(fold.processed) == ["a", "b", "d", "e", "f"]
    # The releasing event itself fails: the others wait for its redelivery, and a later one does not overtake.
    steps = [(1, True, "a", False, False, 1, False, 1), (2, True, "c", False, False, 3, False, 1), (3, True, "b", False, False, 2, True, 1), (4, True, "d", False, False, 4, False, 1), (5, True, "b", True, False, 2, False, 2)]
    got, fold = run(steps)
    assert got == [("ack", "delivered", 1), ("ack", "buffered_gap", 0), ("retry", "retry", 0), ("ack", "in_line", 0), ("ack", "delivered", 3)]
    assert list(fold.processed) == ["a", "b", "c", "d"]


def test_pipeline_stream_equals_batch(spark, tmp_path):
    rows = [("s", i, i % 9 > 0, str(i % 6), False, i % 5 == 0, i - (i % 4 == 1), i % 7 == 0, 1 + i % 3) for i in range(1, 25)]
    schema = "stream_key string, arrival long, supported boolean, content string, redelivered boolean, corrects boolean, sequence long, fails boolean, deliveries long"
    source = tmp_path / "in"
    source.mkdir()
    names = [c.split()[0] for c in schema.split(", ")]
    for part in range(3):
        (source / f"{part}.json").write_text("".join(json.dumps(dict(zip(names, r))) + "\n" for r in rows[part * 8 : part * 8 + 8]))
        stream = spark.readStream.schema(schema).json(str(source))
        sequence.pipeline_stream(stream).writeStream.option("checkpointLocation", str(tmp_path / "ck")).format("parquet").trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination(120)
    want = sequence.pipeline(spark.createDataFrame(rows, schema))
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_ranges():
    r = Ranges()
    r.append(1, 3)
    r.append(4, 5)
    r.append(9, 9)
    r.remove(3)
    assert r.pairs == [[1, 2], [4, 5], [9, 9]] and 4 in r and 3 not in r and len(r) == 5
    r.drop_below(5)
    assert r.pairs == [[5, 5], [9, 9]]


def test_half_an_inning(spark):
    told = [
        ("status", {"status": "live"}), ("inning", {"inning": 2, "half": "top"}), ("at_bat", {"batter": "ann", "pitcher": "bo"}), ("pitch", {}), ("pitch", {"count": 2}), ("bases", {"1B": "ann"}), ("score", {"team": "away", "runs": 2}), ("out", {}), ("out", {"outs": 2}),
        ("correction", {"score": {"away": 1}}), ("score", {"team": "away"}), ("inning", {"inning": 2, "half": "bottom"}),
    ]
    df = spark.createDataFrame([("g", i, kind, json.dumps(p)) for i, (kind, p) in enumerate(told)], "entity string, n int, event_type string, payload string")
    got = {r.field: r.value for r in games.baseball_fields(df, ["n"]).collect()}
    assert got == {"game_status": "live", "inning": "2", "half": "bottom", "batter": "ann", "pitcher": "bo", "pitches": "3", "pitches.bo": "3", "1B": "", "2B": "", "3B": "", "score.away": "2", "outs": "0"}


def test_state_hash_does_not_depend_on_order(spark):
    rows = [("g", "a", "1"), ("g", "b", None), ("h", "b", "2")]
    one, two = (games.state_hashes(spark.createDataFrame(r, "entity string, field string, value string")).collect() for r in (rows, rows[::-1]))
    assert sorted(map(str, one)) == sorted(map(str, two)) and len(one) == 2


def test_frames_are_told_from_events(spark):
    frames = spark.createDataFrame([(1, "p", 1.0, 2.0)], "frame_time long, player_id string, x double, y double")
    assert store.require_frames(frames) is frames
    with pytest.raises(TypeError, match="x, y"):
        store.require_frames(frames.drop("x").withColumn("y", F.lit("far")))


def test_ladders(spark):
    rows = [([(50, 1), (51, 0)], None), ([(0, 1)], "price_out_of_range"), ([(5, -1)], "negative_size"), ([(5, 1), (5, 2)], "duplicate_level"), ([], None)]
    df = spark.createDataFrame(rows, "l array<struct<price:int,size:int>>, want string")
    assert all(r.got == r.want for r in df.select("want", pricing.ladder_problem(F.col("l")).alias("got")).collect())


def test_a_silent_breaker_says_nothing(spark):
    rows = [("a", 1, False, False), ("a", 2, False, True), ("b", 1, True, False), ("b", 2, True, False), ("c", 3, None, None)]
    df = spark.createDataFrame(rows, "s string, e int, team boolean, born boolean")
    got = {r.s: (r.e, r.outcome) for r in entities.narrow(df, ["s"], "e", [F.col("team"), F.col("born")]).collect()}
    assert got == {"a": (2, "matched"), "b": (None, "ambiguous"), "c": (3, "matched")}


def test_usage_without_counters_has_no_problems(spark):
    names = "reserved_attempts transport_starts successful_responses failed_responses retry_attempts pages_fetched".split()
    df = spark.createDataFrame([(1, *[None] * 6, None, None), (2, 1, 2, 2, 1, 0, 5, True, False)], "id int, " + ", ".join(f"{n} int" for n in names) + ", settled boolean, network_occurred boolean")
    got = {r.id: r.problems for r in evidence.usage_problems(df, ["id"], 0).collect()}
    assert got == {1: [], 2: ["more outcomes than transports", "more pages than successes", "more transports than attempts", "over the request cap", "retries do not close", "transports without network"]}


def test_ensemble_and_training_run(spark):
    g = models.synthetic(spark.range(3000).withColumn("at", F.col("id") * 7 % 3001), "id").withColumnRenamed("p", "truth")
    rows = g.withColumn("pressure", F.col("lead") / F.sqrt(1.05 - F.col("phase")))
    scored, grid = models.training_run(rows, ["pressure"], ["at", "id"], "id", members=3)
    got = scored.agg(F.avg(F.abs(F.col("p") - F.col("truth"))).alias("error"), F.max("std").alias("std"), F.count("*").alias("n"), F.min(F.col("high") - F.col("low")).alias("band")).first()
    assert got.n == 900 and got.error < 0.03 and 0 < got.std < 0.2 and got.band >= 0 and grid.where("champion").count() == 1


def test_backtest_by_hand(spark):
    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    books = spark.createDataFrame([("m", t(0), 1, 40, "open"), ("m", t(10), 2, 45, "open"), ("m", t(20), 3, 44, "halted")], "market string, ts timestamp_ntz, n int, yes_ask int, status string")
    triggers = spark.createDataFrame([("m", t(5), 1, 50), ("m", t(30), 2, 60)], "market string, ts timestamp_ntz, n int, fair int")
    got = {r.latency_us: r for r in games.backtest(books, triggers, "market", "ts", "n", F.col("fair") > F.col("yes_ask"), F.col("fair") - 7, "fair", [0, 6_000_000, 26_000_000]).collect()}
    assert [(got[k].n_orders, got[k].n_actionable, got[k].n_fills) for k in sorted(got)] == [(2, 1, 1), (2, 1, 0), (2, 0, 0)]
    assert got[0].mean_profit == 5.0 and got[0].mean_clv == 4.0 and got[0].mean_edge == 13.0


def test_filters_and_evidence(spark):
    from tidemark.plans import registry

    df = spark.createDataFrame([(1, "ab"), (2, "b"), (3, None)], "n int, s string")
    assert [r.n for r in df.where(registry.filters({"n": {"at_least": 1, "one_of": [1, 3]}, "s": {"starts": "a"}})).collect()] == [1]
    assert df.where(registry.filters({"s": {"equal": None}})).count() == 1 and df.where(registry.filters({})).count() == 3
    with pytest.raises(registry.PolicyError):
        registry.filters({"n": {"near": 1}})
    cited = registry.cite("plays", df.withColumnRenamed("n", "play_id"))
    assert registry.lane_digest("reconstructed", cited).first().n_rows == 3
    with pytest.raises(Exception, match="not of lane"):
        registry.lane_digest("forward", cited).collect()
    with pytest.raises(registry.PolicyError):
        registry.cite("labels", df)
