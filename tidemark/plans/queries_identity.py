"""Queries that resolve people, listed events and their markets from texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import identity
from tidemark.plans.registering import query, read

PEOPLE = """WITH s AS (SELECT c_custkey AS source, 'p' || (c_custkey % 3) AS provider, 'L' || (c_custkey % 2) AS league, CASE WHEN c_custkey % 41 = 0 THEN '' ELSE 'jose nm' || (c_custkey % 37) END AS name,
    CASE WHEN c_custkey % 41 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN 'jr' WHEN c_custkey % 5 = 2 THEN 'ii' ELSE '' END AS suffix, c_nationkey AS team, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 7 END AS birth, 1996 + c_custkey % 6 AS season,
    CASE WHEN c_custkey % 10 = 0 THEN c_custkey % 50 + 1 END AS linked FROM customer),
p AS (SELECT s_suppkey AS entity, 'L' || (s_suppkey % 2) AS league, 'jose nm' || (s_suppkey % 37) AS name, CASE s_suppkey % 3 WHEN 1 THEN 'jr' WHEN 2 THEN 'ii' ELSE '' END AS suffix,
    CASE WHEN s_suppkey % 4 = 0 THEN 'p' || (s_suppkey % 3) ELSE '' END AS provider, s_suppkey % 29 = 0 AS flagged, CASE WHEN s_suppkey % 6 < 5 THEN 1990 + s_suppkey % 8 END AS debut, CASE WHEN s_suppkey % 5 < 3 THEN 1999 + s_suppkey % 4 END AS final,
    s_suppkey % 7 AS birth, s_nationkey AS team, 1996 + s_suppkey % 6 AS year FROM supplier),
c AS (SELECT s.source, p.entity, p.flagged, coalesce(p.debut <= s.season, true) AND coalesce(p.final >= s.season, true) AS fits, (p.team = s.team AND p.year = s.season) AS mate, coalesce(p.birth = s.birth, false) AS born
    FROM s JOIN p ON s.league = p.league AND s.name = p.name AND (p.provider = '' OR p.provider = s.provider) AND (s.suffix = '' OR s.suffix = p.suffix) WHERE s.linked IS NULL AND s.name <> ''),
k AS (SELECT source, bool_or(flagged) AS flagged, list(entity ORDER BY entity) FILTER (fits) AS ids, coalesce(list(entity ORDER BY entity) FILTER (fits AND mate), []) AS mates, coalesce(list(entity) FILTER (fits AND born), []) AS borns FROM c GROUP BY 1),
n AS (SELECT *, CASE WHEN len(ids) > 1 AND len(mates) > 0 THEN mates ELSE ids END AS left_over FROM k),
e AS (SELECT *, CASE WHEN len(left_over) = 1 THEN left_over[1] WHEN len(list_intersect(left_over, borns)) = 1 THEN list_intersect(left_over, borns)[1] END AS one FROM n),
r AS (SELECT s.source, s.linked, e.one, e.mates, CASE WHEN s.linked IS NOT NULL AND lp.league <> s.league THEN 'wrong_league' WHEN s.linked IS NOT NULL THEN 'linked' WHEN s.name = '' THEN 'empty_name' WHEN e.flagged THEN 'flagged_alias'
    WHEN e.ids IS NULL THEN 'no_candidate' WHEN e.one IS NULL THEN 'several' ELSE 'found' END AS reason FROM s LEFT JOIN e ON e.source = s.source LEFT JOIN p AS lp ON lp.entity = s.linked),
o AS (SELECT *, CASE WHEN linked IS NOT NULL THEN 'exact_provider_id' WHEN reason IN ('empty_name', 'no_candidate') THEN 'none' WHEN reason = 'found' AND len(mates) = 1 THEN 'team_normalized_name' ELSE 'league_normalized_name' END AS tier FROM r)
SELECT source, CASE WHEN reason IN ('linked', 'found') THEN 'matched' WHEN reason IN ('flagged_alias', 'several') THEN 'ambiguous' ELSE 'unmatched' END AS outcome, tier, CASE reason WHEN 'linked' THEN linked WHEN 'found' THEN one END AS entity,
CAST(CASE WHEN reason NOT IN ('linked', 'found') THEN 0 WHEN tier = 'exact_provider_id' THEN 1 WHEN tier = 'team_normalized_name' THEN 0.95 ELSE 0.9 END AS DOUBLE) AS score, reason FROM o"""


@query(PEOPLE)
def people_from_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as sources, suppliers as people who share 37 names, with suffixes, careers, teams and dates of birth."""
    c, s = read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier")
    text = lambda template: F.expr(template)
    sources = c.select(
        F.col("c_custkey").alias("source"), text("concat('p', c_custkey % 3)").alias("provider"), F.col("c_custkey").cast("string").alias("ref"), text("concat('L', c_custkey % 2)").alias("league"),
        text("CASE WHEN c_custkey % 41 = 0 THEN ' -- ' ELSE concat('José NM', c_custkey % 37, CASE c_custkey % 5 WHEN 1 THEN ', Jr.' WHEN 2 THEN ' II' ELSE '' END) END").alias("raw_name"), F.col("c_nationkey").cast("string").alias("team"),
        text("CASE WHEN c_custkey % 4 > 0 THEN CAST(c_custkey % 7 AS STRING) END").alias("birth_date"), text("concat(1996 + c_custkey % 6, '-03-01')").alias("season_low"), text("concat(1996 + c_custkey % 6, '-10-31')").alias("season_high"),
    )
    links = c.where("c_custkey % 10 = 0").select(text("concat('p', c_custkey % 3)").alias("provider"), F.col("c_custkey").cast("string").alias("ref"), (F.col("c_custkey") % 50 + 1).alias("entity"))
    league = text("concat('L', s_suppkey % 2)").alias("league")
    aliases = s.select(
        league, text("concat('jose nm', s_suppkey % 37)").alias("name"), text("CASE s_suppkey % 3 WHEN 1 THEN 'jr' WHEN 2 THEN 'ii' ELSE '' END").alias("suffix"),
        text("CASE WHEN s_suppkey % 4 = 0 THEN concat('p', s_suppkey % 3) ELSE '' END").alias("provider"), F.col("s_suppkey").alias("entity"), (F.col("s_suppkey") % 29 == 0).alias("is_ambiguous"),
    )
    people = s.select(
        F.col("s_suppkey").alias("entity"), league, text("CASE WHEN s_suppkey % 6 < 5 THEN concat(1990 + s_suppkey % 8, '-04-01') END").alias("debut"),
        text("CASE WHEN s_suppkey % 5 < 3 THEN concat(1999 + s_suppkey % 4, '-10-01') END").alias("final"), (F.col("s_suppkey") % 7).cast("string").alias("birth_date"),
    )
    members = s.select(F.col("s_suppkey").alias("entity"), F.col("s_nationkey").cast("string").alias("team"), text("concat(1996 + s_suppkey % 6, '-05-01')").alias("on_date"))
    return identity.resolve_people(sources, links, aliases, people, members)


#: Every order is a game of two nations of one region, twenty years later since tickers begin in 2000, and a listing of it that is
#: sometimes misread.
LISTED = """WITH nt AS (SELECT n_nationkey AS team, n_name, n_regionkey AS r, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i, ['AB', 'ABC', 'CD', 'XY', 'D'][row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey)] AS code FROM nation),
g AS (SELECT o_orderkey AS k, o_custkey % 5 AS r, o_custkey % 3 AS a, 3 + o_orderkey % 2 AS h, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS day, (18 + o_orderkey % 3) || ':05' AS clock FROM orders),
gm AS (SELECT g.*, a.team AS away, h.team AS home, a.code AS ac, h.code AS hc, a.n_name AS an, h.n_name AS hn, o.n_name AS other FROM g JOIN nt a ON a.r = g.r AND a.i = g.a JOIN nt h ON h.r = g.r AND h.i = g.h JOIN nt o ON o.r = g.r AND o.i = (g.a + 1) % 3),
e AS (SELECT *, k % 13 AS m, ac || CASE WHEN k % 13 = 3 THEN 'QQ' ELSE hc END AS pair, CASE WHEN k % 13 = 6 THEN NULL ELSE clock END AS told, CASE k % 13 WHEN 2 THEN NULL WHEN 0 THEN hn WHEN 7 THEN hn ELSE an END AS t1,
    CASE k % 13 WHEN 2 THEN NULL WHEN 0 THEN an WHEN 7 THEN an WHEN 1 THEN other ELSE hn END AS t2 FROM gm),
ps AS (SELECT e.k, count(*) AS n_pairs, min(a.team) AS away, min(h.team) AS home FROM e JOIN nt a ON a.r = e.r JOIN nt h ON h.r = e.r AND h.team <> a.team AND a.code || h.code = e.pair GROUP BY 1),
j AS (SELECT e.k, e.r, e.m, e.day, e.told, ps.n_pairs, ps.away, ps.home, f.team AS one, s.team AS two FROM e LEFT JOIN ps ON ps.k = e.k LEFT JOIN nt f ON f.n_name = e.t1 LEFT JOIN nt s ON s.n_name = e.t2),
d AS (SELECT j.k, count(*) AS n_day, count(*) FILTER (j.told IS NULL OR j.told = gm.clock) AS n_games, min(gm.k) FILTER (j.told IS NULL OR j.told = gm.clock) AS game FROM j JOIN gm ON j.n_pairs = 1 AND gm.away = j.away AND gm.home = j.home AND gm.day = j.day GROUP BY 1),
x AS (SELECT j.k, d.game, CASE WHEN m = 5 THEN 'unsupported_series' WHEN n_pairs IS NULL THEN 'codes_unknown' WHEN n_pairs > 1 THEN 'several_pairs' WHEN m = 2 THEN CASE WHEN n_games > 1 THEN 'several_games' ELSE 'agreed' END
    WHEN NOT ((one = away AND two = home) OR (one = home AND two = away)) THEN 'title_teams_differ' WHEN m <> 7 AND one <> away THEN 'title_sides_differ' WHEN n_day IS NULL THEN 'no_game' WHEN n_games = 0 THEN 'clock_differs'
    WHEN n_games > 1 THEN 'several_games' ELSE 'agreed' END AS reason FROM j LEFT JOIN d ON d.k = j.k)
SELECT k AS event, CASE WHEN reason = 'agreed' THEN 'matched' WHEN reason = 'unsupported_series' THEN 'unsupported' WHEN reason IN ('several_pairs', 'several_games') THEN 'ambiguous' WHEN reason = 'codes_unknown' THEN 'incomplete' ELSE 'conflict' END AS outcome,
CASE WHEN reason = 'agreed' THEN game END AS game, reason FROM x"""


@query(LISTED)
def listings_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1
    code = F.element_at(F.array(*map(F.lit, ("AB", "ABC", "CD", "XY", "D"))), place + 1)
    nations = F.broadcast(read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("team"), "n_name", F.col("n_regionkey").alias("r"), place.alias("i"), code.alias("code")))
    key = F.col("k")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 5).alias("r"), (F.col("o_custkey") % 3).alias("a"), (3 + F.col("o_orderkey") % 2).alias("h"), F.add_months(F.col("o_orderdate").cast("date"), 240).alias("day"), F.concat(18 + F.col("o_orderkey") % 3, F.lit(":05")).alias("clock")
    )
    of = lambda i, *names: nations.select("r", F.col("i").alias(i), *[F.col(c).alias(n) for c, n in zip(("team", "code", "n_name"), names, strict=True)])
    games = orders.join(of("a", "away", "ac", "an"), ["r", "a"]).join(of("h", "home", "hc", "hn"), ["r", "h"]).withColumn("o", (F.col("a") + 1) % 3).join(of("o", "_t", "_c", "other"), ["r", "o"])
    league, m = F.concat(F.lit("R"), F.col("r").cast("string")), key % 13
    clock = F.when(m == 6, "").otherwise(F.replace("clock", F.lit(":"), F.lit("")))
    ticker = F.concat(F.lit("KX"), F.col("r").cast("string"), F.lit("-"), F.upper(F.date_format("day", "yyMMMdd")), clock, "ac", F.when(m == 3, "QQ").otherwise(F.col("hc")))
    title = F.when(m == 0, F.concat("hn", F.lit(" at "), "an")).when(m == 1, F.concat("an", F.lit(" at "), "other")).when(m == 7, F.concat("hn", F.lit(" vs "), "an", F.lit(" Winner?"))).when(m != 2, F.concat("an", F.lit(" at "), "hn"))
    series = F.when(m == 5, "OTHER").otherwise(F.concat(F.lit("KX"), F.col("r").cast("string")))
    events = games.select(key.alias("event"), series.alias("series"), ticker.alias("ticker"), title.alias("title"), F.lit("p").alias("provider"))
    leagues = nations.select(F.concat(F.lit("KX"), F.col("r").cast("string")).alias("series"), league.alias("league")).distinct()
    codes = nations.select(league.alias("league"), "code", "team")
    aliases = nations.select(league.alias("league"), F.replace(F.lower("n_name"), F.lit("_"), F.lit(" ")).alias("name"), F.lit("").alias("suffix"), F.lit("").alias("provider"), F.col("team").alias("entity"), F.lit(False).alias("is_ambiguous"))
    return identity.listed_events(events, leagues, codes, aliases, games.select(key.alias("game"), league.alias("league"), "away", "home", "day", "clock"))
