"""Steps whose cost must follow their rows, also where many rows share a key: no node of the plan makes their product."""

import datetime as dt
import itertools
import random

import pytest

from tidemark.operators import entities, resolve


def most_rows(spark, df):
    """The rows of ``df``, and the most rows that any node of its plan made."""
    rows = df.collect()
    store = spark._jsparkSession.sharedState().statusStore()
    run = store.executionsList().last().executionId()
    values, nodes, most = store.executionMetrics(run), store.planGraph(run).allNodes(), 0
    for i in range(nodes.size()):
        metrics = nodes.apply(i).metrics()
        for k in range(metrics.size()):
            m = metrics.apply(k)
            if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                most = max(most, int(values.apply(m.accumulatorId()).replace(",", "")))
    return rows, most


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def test_windows_of_a_busy_key_make_no_pairs(spark):
    n = 1500
    events = spark.createDataFrame([(k, "x", "y", day(k % 7)) for k in range(n)], "a long, x string, y string, at timestamp_ntz")
    games = spark.createDataFrame([(k, "x", "y", day(k % 5), True) for k in range(n)], "b long, x string, y string, bt timestamp_ntz, neutral boolean")
    rows, most = most_rows(spark, entities.match_with_swaps(events, games, ("x", "y"), "a", "b", "at", "bt", 3600, 7200, "neutral"))
    assert len(rows) == n and {(r.tier, r.b, r.outcome) for r in rows} == {(1, None, "ambiguous"), (2, None, "ambiguous")}
    assert most < 20 * n
    rows, most = most_rows(spark, entities.match_or_create(events, games, ["x"], "a", "b", "at", "bt", [3600, 7200], [0.9, 0.8]))
    assert len(rows) == n and most < 20 * n


@pytest.mark.parametrize("seed", range(3))
def test_window_sets_are_those_of_all_pairs(spark, seed):
    """Repeated and missing ids, keys and times, and rows at the very edges of windows."""
    rng = random.Random(seed)
    pick = lambda *xs: rng.choice(xs)
    base = dt.datetime(1969, 12, 31)
    time = lambda: None if rng.random() < 0.05 else base + dt.timedelta(seconds=10 * rng.randrange(12) + pick(-1, 0, 0, 1), microseconds=pick(0, 0, 1))
    left = [(pick(*range(40), None), pick("k", "m", None), time()) for _ in range(60)]
    right = [(pick(*range(6), None), pick("k", "m", "z", None), time()) for _ in range(14)]
    tiers, widths = {}, [dt.timedelta(seconds=10), dt.timedelta(seconds=20)]
    for (a, k, t), (b, j, u) in itertools.product(left, right):
        if k is not None and k == j and t and u and abs(t - u) <= widths[1]:
            tiers.setdefault(a, {}).setdefault(1 if abs(t - u) <= widths[0] else 2, set()).add(b)
    want = {}
    for a, found in tiers.items():
        ids = found[min(found)] - {None}
        want[a] = (min(found), *((min(ids), "matched") if len(ids) == 1 else (None, "ambiguous")))
    frames = spark.createDataFrame(left, "a long, k string, at timestamp_ntz"), spark.createDataFrame(right, "b long, k string, bt timestamp_ntz")
    sets = resolve.window_sets(*frames, ["k"], "a", "b", "at", "bt", [20, 10])
    assert {r.a: (r.tier, r.b, r.outcome) for r in resolve.resolve_tiers(sets, ["a"], "tier", "b", last="last").collect()} == want


def test_a_roster_of_namesakes_makes_no_pairs(spark, tmp_path):
    from tidemark.plans import catalogue

    spark.range(1500).selectExpr("id * 70 AS c_custkey", "CAST(id % 3 AS INT) AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1500).selectExpr("id * 70 AS s_suppkey", "CAST(id % 2 AS INT) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    rows, most = most_rows(spark, catalogue.QUERIES["directory_match"](spark, str(tmp_path)))
    assert len(rows) == 1500 and most < 10 * 1500


def test_a_busy_slate_makes_no_pairs(spark):
    n = 1500
    official = spark.createDataFrame([(k, 10, 20 + k % 2, day(0)) for k in range(n)] + [(n, 10, 99, day(0)), (n + 1, 10, 22, day(0)), (n + 2, 10, 20, None)], "o long, home long, away long, day timestamp_ntz")
    games = spark.createDataFrame([(k, 1, 2, day(0)) for k in range(n)] + [(n, 1, 3, day(0)), (n, 1, 3, day(0)), (None, 1, 3, day(0)), (None, 1, 4, day(0))], "g long, home long, away long, day timestamp_ntz")
    teams = spark.createDataFrame([(10, 1), (20, 2), (21, 3), (22, 4)], "official_team long, team long")
    rows, most = most_rows(spark, entities.game_crosswalk(official, games, teams, "o", "g", "home", "away", "day"))
    want = {k: ("matched", n) if k % 2 else ("ambiguous", None) for k in range(n)} | {n: ("team_unknown", None), n + 1: ("no_game", None), n + 2: ("no_game", None)}
    assert {r.o: (r.verdict, r.g) for r in rows} == want and most < 10 * n


def test_namesakes_make_no_pairs(spark, tmp_path):
    from tidemark.plans import catalogue

    spark.range(1500).selectExpr("id * 50 AS c_custkey", "CAST(id % 3 AS INT) AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1500).selectExpr("id * 50 AS s_suppkey", "CAST(id % 2 AS INT) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    rows, most = most_rows(spark, catalogue.QUERIES["player_resolution"](spark, str(tmp_path)))
    assert len(rows) == 1500 and most < 20 * 1500


@pytest.mark.parametrize("seed", range(3))
def test_narrowing_by_sets_is_that_of_all_pairs(spark, seed):
    """Missing traits, keys and ids, and ids that occur several times."""
    rng = random.Random(seed)
    one = lambda n: rng.choice([*range(n), None])
    sources = [(one(40), one(3), one(3), one(3)) for _ in range(60)]
    held = [(one(8), one(3), one(3), one(3)) for _ in range(15)]
    want = {}
    for a in {r[0] for r in sources}:
        left = [(e, s, h) for s in sources for e, *h in held if s[0] == a and s[1] is not None and s[1] == h[0]]
        for i in (2, 3):
            met = [x for x in left if x[1][i] is not None and x[1][i] == x[2][i - 1]]
            left = met or left
        ids = {e for e, *_ in left} - {None}
        if left:
            want[a] = (min(ids), "matched") if len(ids) == 1 else (None, "ambiguous")
    frames = spark.createDataFrame(sources, "a long, name long, team long, born long"), spark.createDataFrame(held, "e long, name long, team long, born long")
    assert {r.a: (r.e, r.outcome) for r in entities.narrow_by(*frames, ["name"], ["team", "born"], "a", "e").collect()} == want


def test_people_of_one_name_make_no_pairs(spark):
    from tidemark.operators import identity

    n = 1200
    sources = spark.range(n).selectExpr("id AS source", "concat('p', id % 3) AS provider", "CAST(id AS STRING) AS ref", "'L' AS league", "'Ann Lee' AS raw_name", "concat('T', id % 9) AS team", "concat('b', id % 5) AS birth_date", "concat(2000 + id % 2, '-01-01') AS season_low", "concat(2000 + id % 2, '-12-31') AS season_high")
    entity = spark.range(n).withColumnRenamed("id", "entity")
    aliases = entity.selectExpr("'L' AS league", "'ann lee' AS name", "'' AS suffix", "CASE WHEN entity = 7 THEN 'p1' ELSE '' END AS provider", "entity", "entity = 7 AS is_ambiguous")
    people = entity.selectExpr("entity", "'L' AS league", "CASE WHEN entity > 1 THEN '2005-01-01' WHEN entity = 1 THEN '2001-06-01' END AS debut", "CAST(NULL AS STRING) AS final", "concat('b', entity % 5) AS birth_date")
    members = entity.selectExpr("entity", "'T1' AS team", "'2001-07-01' AS on_date")
    links = spark.createDataFrame([], "provider string, ref string, entity long")
    rows, most = most_rows(spark, identity.resolve_people(sources, links, aliases, people, members))
    want = {}
    for k in range(n):  # in 2000 only 0 is there; in 2001 also 1, and both were of team T1; their births differ
        born = {0: 0, 1: 1}.get(k % 5) if k % 2 else None
        told = ("flagged_alias", None) if k % 3 == 1 else ("found", 0) if k % 2 == 0 else ("found", born) if born is not None else ("several", None)
        want[k] = told
    assert {r.source: (r.reason, r.entity) for r in rows} == want and most < 30 * n


def test_large_certifications_are_dealt_by_rows(spark, monkeypatch):
    from tidemark.operators import provenance, slices

    expected = spark.range(900).selectExpr("id AS k").where("k <> 5")
    bytes_ = spark.range(900).selectExpr("id AS k", "CASE WHEN id <> 8 THEN concat('body ', id) END AS body").where("k <> 9")
    found = spark.range(900).selectExpr("id AS k", "CASE WHEN id > 10 THEN sha2(concat('body ', id), 256) WHEN id > 3 THEN 'else' END AS body_hash").where("k <> 6")
    found = found.unionByName(found.where("k = 7"))
    want = sorted([(5, "unplanned"), (6, "not_acquired"), (7, "acquired_twice"), (8, "body_missing"), (9, "body_missing")] + [(k, "hash_differs") for k in (4, 5, 7, 7, 10)])
    assert sorted(map(tuple, provenance.certification_failures(expected, found, bytes_, ["k"]).collect())) == want
    monkeypatch.setattr(slices, "ROWS_PER_TASK", 100)
    large = provenance.certification_failures(expected, found, bytes_, ["k"])
    assert sorted(map(tuple, large.collect())) == want and large.rdd.getNumPartitions() == 2 * 27


def test_large_leakage_checks_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    from tidemark.operators import slices
    from tidemark.plans import catalogue

    spark.range(1000).selectExpr("id AS o_orderkey", "TIMESTAMP_NTZ '2024-01-05 00:00:00' AS o_orderdate").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS o_orderkey, TIMESTAMP_NTZ '2024-01-05 00:00:00' AS o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(2000).selectExpr("CASE WHEN id < 1998 THEN id div 2 END AS l_orderkey", "CASE WHEN id > 0 THEN TIMESTAMP_NTZ '2024-01-05 00:00:00' - make_dt_interval(IF(id IN (1, 4, 5, 1999), 1, 0)) END AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    want = sorted([("label_before_cutoff", "blocking", k) for k in ("0", "2", "2")] + [("unlabelled", "note", "999")]) + [("unlabelled", "note", None)]
    read = lambda df: sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[2] is None, r[2]))
    assert read(catalogue.QUERIES["leakage_findings"](spark, str(tmp_path))) == want
    monkeypatch.setattr(slices, "ROWS_PER_TASK", 100)
    large = catalogue.QUERIES["leakage_findings"](spark, str(tmp_path))
    assert read(large) == want and large.rdd.getNumPartitions() == 31


def test_listings_of_a_busy_slate_make_no_pairs(spark):
    from tidemark.operators import identity

    n = 1500
    series, codes = spark.createDataFrame([("KXL", "L")], "series string, league string"), spark.createDataFrame([("L", "AB", 1), ("L", "XYZ", 2)], "league string, code string, team long")
    aliases = spark.createDataFrame([("L", "alpha", "", "", 1, False)], "league string, name string, suffix string, provider string, entity long, is_ambiguous boolean")
    tickers = "element_at(array('KXL-24MAY01ABXYZ', 'KXL-24MAY011905ABXYZ', 'KXL-24MAY012005ABXYZ', 'KXL-24MAY012105ABXYZ', 'KXL-24MAY02ABXYZ'), CAST(id % 5 + 1 AS INT))"
    events = spark.range(n).selectExpr("id AS event", "'KXL' AS series", f"{tickers} AS ticker", "CAST(NULL AS STRING) AS title", "'p' AS provider")
    games = spark.range(n).selectExpr("id AS game", "'L' AS league", "CAST(1 AS BIGINT) AS away", "CAST(2 AS BIGINT) AS home", "DATE '2024-05-01' AS day", "CASE WHEN id = 3 THEN '20:05' WHEN id > 5 THEN '19:05' END AS clock")
    rows, most = most_rows(spark, identity.listed_events(events, series, codes, aliases, games))
    told = [("several_games", None), ("several_games", None), ("agreed", 3), ("clock_differs", None), ("no_game", None)]
    assert {r.event: (r.reason, r.game) for r in rows} == {k: told[k % 5] for k in range(n)} and most < 20 * n
