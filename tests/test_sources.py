import pytest
from pyspark.sql import functions as F

from tidemark.operators import models, stats
from tidemark.sources import store


def test_frames_round_trip_and_prune(spark, tmp_path):
    rows = [("nba", g, "2024-01-01", t, 1, p, float(p)) for g in ("g1", "g2") for t in (1, 2) for p in (7, 8)]
    df = spark.createDataFrame(rows, "sport string, game_id string, date string, frame_time int, period int, player_id int, x double")
    store.write_frames(df, str(tmp_path / "f"))
    back = store.read_frames(spark, str(tmp_path / "f"), game_id="g1", sport="nba")
    assert back.count() == 4
    assert "PartitionFilters: [isnotnull(game_id" in back._jdf.queryExecution().executedPlan().toString() or "game_id" in back._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:120]
    assert [len(r.samples) for r in store.regroup(back).collect()] == [2, 2]


def test_log_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i long, s string")
    store.append_log(df, str(tmp_path / "log"))
    store.append_log(df, str(tmp_path / "log"))
    assert store.read_log(spark, str(tmp_path / "log"), "i long, s string").count() == 4


def test_import_gate(spark):
    df = spark.createDataFrame([(1, "1"), (-1, "1"), (1, "2")], "n int, v string")
    good, bad = store.gated_import(df, ["n"], "v", ["1"], [("negative", F.col("n") < 0)])
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["negative", "schema_version"]
    with pytest.raises(store.SchemaMismatch):
        store.gated_import(df, ["x"], "v", ["1"], [])


def test_model_matches_the_truth(spark):
    df = spark.range(4000).withColumn("x", F.rand(1) * 2 - 1).withColumn("label", (F.rand(2) < models.sigmoid(3 * F.col("x") - 0.5)).cast("double")).withColumn("train", F.col("id") < 3000)
    best = models.fit_grid(df, ["x"], (0.3, 1.0, 3.0)).where("champion").first()
    assert abs(best.weights[0] - 3) < 0.5 and abs(best.intercept + 0.5) < 0.3
    scored = df.withColumn("p", models.sigmoid(models.linear(["x"], best.weights, best.intercept)))
    assert stats.calibration(scored, "p", "label").first().ece < 0.05


def test_surface(spark):
    s = models.surface(spark, [0.0, 0.5, 1.0], range(-2, 3), F.col("lead") * (1 + F.col("phase")))
    assert s.count() == 15 and abs(s.where("lead = 0").first().p - 0.5) < 1e-12
