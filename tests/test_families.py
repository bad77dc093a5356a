"""Families of features: the reviewed table, and reviews that hold for an interval."""

from tidemark.operators import evidence


def test_reviews_by_interval(spark):
    asked = spark.createDataFrame([(1, "prior_results", "2024-01-01"), (2, "lineups", "2024-01-01"), (3, "nobody_knows", "2024-01-01"), (4, None, "2024-01-01"), (5, "weather_forecast", "2024-06-01")], "id long, family string, at string")
    fixed = {r.id: (r.family_kind, r.family_league) for r in evidence.with_family(asked, "family").collect()}
    assert fixed == {1: ("event_derived", None), 2: ("forward_only", None), 3: (None, None), 4: (None, None), 5: ("versioned_snapshot", "lg_mlb")}
    assert len({f for f, _, _ in evidence.FAMILIES}) == 19
    reviews = spark.createDataFrame([("prior_results", "event_derived", None, None, "2024-01-01"), ("prior_results", "forward_only", None, "2024-01-01", None), ("lineups", "versioned_snapshot", "x", "2023-01-01", "2024-01-02")], "family string, kind string, league string, valid_from string, valid_to string")
    got = {r.id: (r.family_kind, r.family_league) for r in evidence.with_family(asked, "family", "at", reviews).collect()}
    assert got == {1: ("forward_only", None), 2: ("versioned_snapshot", "x"), 3: (None, None), 4: (None, None), 5: (None, None)}
