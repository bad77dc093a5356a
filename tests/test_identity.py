"""People, teams, listed events and markets, resolved from texts."""

from tidemark.operators import identity

SOURCES = "source long, provider string, ref string, league string, raw_name string, team string, birth_date string, season_low string, season_high string"


def test_people(spark):
    people = spark.createDataFrame([(1, "L", "2000-01-01", None, "1980-01-01"), (2, "L", "2001-01-01", "2004-01-01", "1981-01-01"), (3, "L", "2012-01-01", None, "1990-01-01"), (4, "M", None, None, None), (5, "L", None, None, "1981-01-01"), (6, "L", None, None, None)], "entity long, league string, debut string, final string, birth_date string")
    aliases = spark.createDataFrame(
        [("L", "jose perez", "", "", 1, False), ("L", "jose perez", "jr", "", 2, False), ("L", "jose perez", "", "p", 3, False), ("L", "jose perez", "", "q", 5, False), ("M", "jose perez", "", "", 4, False), ("L", "ann lee", "", "", 6, True), ("L", "ann lee", "", "", 1, False)],
        "league string, name string, suffix string, provider string, entity long, is_ambiguous boolean",
    )
    links = spark.createDataFrame([("p", "x1", 2), ("p", "x4", 4)], "provider string, ref string, entity long")
    members = spark.createDataFrame([(1, "T", "2003-05-01"), (2, "U", "2003-05-01"), (2, "T", "2009-01-01"), (3, "T", None)], "entity long, team string, on_date string")
    season = ("2003-01-01", "2003-12-31")
    cases = [
        ((1, "p", "x1", "L", "anyone", None, None, *season), ("matched", "exact_provider_id", 2, 1.0, "linked")),
        ((2, "p", "x4", "L", "José Pérez", None, None, *season), ("unmatched", "exact_provider_id", None, 0.0, "wrong_league")),
        ((3, "p", "n", "L", "José Pérez", "T", None, *season), ("matched", "team_normalized_name", 1, 0.95, "found")),  # 3's career misses, 2 was elsewhere
        ((4, "p", "n", "L", "JOSE PEREZ Jr.", None, None, *season), ("matched", "league_normalized_name", 2, 0.9, "found")),
        ((5, "p", "n", "L", "Jose Perez", None, None, *season), ("ambiguous", "league_normalized_name", None, 0.0, "several")),
        ((6, "p", "n", "L", "Jose Perez", None, "1981-01-01", *season), ("matched", "league_normalized_name", 2, 0.9, "found")),
        ((7, "q", "n", "L", "Jose Perez", None, "1981-01-01", *season), ("ambiguous", "league_normalized_name", None, 0.0, "several")),  # 2 and 5 share the birth
        ((8, "p", "n", "L", "Ann Lee", None, None, *season), ("ambiguous", "league_normalized_name", None, 0.0, "flagged_alias")),
        ((9, "p", "n", "L", " .. ", None, None, *season), ("unmatched", "none", None, 0.0, "empty_name")),
        ((10, "p", "n", "L", "Nobody Here", None, None, *season), ("unmatched", "none", None, 0.0, "no_candidate")),
        ((11, None, None, "M", "jose perez", None, None, None, None), ("matched", "league_normalized_name", 4, 0.9, "found")),
        ((12, "p", "n", "L", "jose perez II", None, None, None, None), ("unmatched", "none", None, 0.0, "no_candidate")),
    ]
    got = {r.source: (r.outcome, r.tier, r.entity, r.score, r.reason) for r in identity.resolve_people(spark.createDataFrame([c for c, _ in cases], SOURCES), links, aliases, people, members).collect()}
    assert got == {c[0]: want for c, want in cases}


def test_listed_events_and_markets(spark):
    series = spark.createDataFrame([("KXL", "L")], "series string, league string")
    codes = spark.createDataFrame([("L", "AB", 1), ("L", "ABC", 2), ("L", "CD", 3), ("L", "D", 4), ("L", "XYZ", 5)], "league string, code string, team long")
    aliases = spark.createDataFrame([("L", n, "", "", t, False) for n, t in (("alpha", 1), ("abacus", 2), ("cedar", 3), ("delta", 4), ("xylo", 5))] + [("L", "twin", "", "", t, False) for t in (1, 3)], "league string, name string, suffix string, provider string, entity long, is_ambiguous boolean")
    games = spark.createDataFrame([(10, "L", 1, 5, "2024-05-01", "19:05"), (11, "L", 3, 5, "2024-05-01", "13:00"), (12, "L", 3, 5, "2024-05-01", "19:00"), (13, "L", 2, 3, "2024-05-02", None)], "game long, league string, away long, home long, day string, clock string").selectExpr("game", "league", "away", "home", "CAST(day AS DATE) AS day", "clock")
    cases = [
        ("e1", "KXL", "KXL-24MAY01ABXYZ", "Alpha at Xylo", ("matched", 10, "agreed")),
        ("e2", "KXL", "KXL-24MAY01ABXYZ", "Xylo vs Alpha Winner?", ("matched", 10, "agreed")),
        ("e3", "KXL", "KXL-24MAY01ABXYZ", "Xylo at Alpha", ("conflict", None, "title_sides_differ")),
        ("e4", "KXL", "KXL-24MAY01ABXYZ", "Alpha at Cedar", ("conflict", None, "title_teams_differ")),
        ("e5", "KXL", "KXL-24MAY01ABXYZ", None, ("matched", 10, "agreed")),
        ("e6", "KXL", "KXL-24MAY01ABXYZ", "Twin at Xylo", ("incomplete", None, "title_team_unknown")),
        ("e7", "KXL", "KXL-24MAY01ABXYZ", "Something else", ("incomplete", None, "title_unreadable")),
        ("e8", "KXL", "KXL-24MAY01ABCD", None, ("ambiguous", None, "several_pairs")),  # AB+CD or ABC+D
        ("e9", "KXL", "KXL-24MAY01CDXYZ", None, ("ambiguous", None, "several_games")),
        ("e10", "KXL", "KXL-24MAY011900CDXYZ", "cedar @ xylo", ("matched", 12, "agreed")),
        ("e11", "KXL", "KXL-24MAY011930CDXYZ", None, ("conflict", None, "clock_differs")),
        ("e12", "KXL", "KXL-24MAY03CDXYZ", None, ("incomplete", None, "no_game")),
        ("e13", "KXL", "KXL-24MAY01QQXYZ", None, ("incomplete", None, "codes_unknown")),
        ("e14", "KXL", "nonsense", None, ("incomplete", None, "ticker_unreadable")),
        ("e15", "OTHER", "KXL-24MAY01ABXYZ", None, ("unsupported", None, "unsupported_series")),
    ]
    events = spark.createDataFrame([(e, s, t, x, "p") for e, s, t, x, _ in cases], "event string, series string, ticker string, title string, provider string")
    matched = identity.listed_events(events, series, codes, aliases, games)
    assert {r.event: (r.outcome, r.game, r.reason) for r in matched.collect()} == {c[0]: c[4] for c in cases}
    rules = "If Alpha wins the game against Xylo on May 1, 2024, then Yes."
    told = [
        ("m1", "e1", "KXL-24MAY01ABXYZ-AB", "Alpha", rules, ("matched", 1, "agreed")),
        ("m2", "e1", "KXL-24MAY01ABXYZ-XYZ", "Xylo", rules, ("conflict", None, "rules_differ")),
        ("m3", "e1", "KXL-24MAY01ABXYZ-AB", "Xylo", rules, ("conflict", None, "label_differs")),
        ("m4", "e1", "KXL-24MAY01ABXYZ-T45", None, rules, ("unsupported", None, "other_meaning")),
        ("m5", "e1", "KXL-24MAY02ABXYZ-AB", None, rules, ("conflict", None, "ticker_of_other_event")),
        ("m6", "e1", "KXL-24MAY01ABXYZ-AB", None, "No names here.", ("incomplete", None, "rules_unreadable")),
        ("m7", "e3", "KXL-24MAY01ABXYZ-AB", None, rules, ("incomplete", None, "event_not_matched")),
        ("m8", "e1", "KXL-24MAY01ABXYZ-AB", None, "If Alpha wins the game against Cedar on May 1, 2024, then Yes.", ("conflict", None, "opponent_differs")),
    ]
    markets = spark.createDataFrame([(m, e, t, y, r, "p") for m, e, t, y, r, _ in told], "market string, event string, ticker string, yes_title string, rules string, provider string")
    got = identity.listed_markets(markets, events, matched, codes, series, aliases, games)
    assert {r.market: (r.outcome, r.team, r.reason) for r in got.collect()} == {m[0]: m[5] for m in told}
    assert identity.listed_events(events.limit(0), series, codes, aliases, games).count() == 0
