"""Queries over entity resolution, crosswalks and links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import entities, resolve
from tidemark.plans.registering import instant, query, read

CUT = "2000-01-01 00:00:00"


@query("""WITH c AS (SELECT c_custkey, s_suppkey, c_nationkey = s_nationkey AS team, c_custkey // 50 % 3 = s_suppkey // 50 % 3 AS born FROM customer JOIN supplier ON c_custkey % 50 = s_suppkey % 50 WHERE s_suppkey % 4 = c_custkey % 4 OR s_suppkey % 4 = 0),
a AS (SELECT *, bool_or(team) OVER (PARTITION BY c_custkey) AS any_team FROM c), b AS (SELECT *, bool_or(born) OVER (PARTITION BY c_custkey) AS any_born FROM a WHERE team OR NOT any_team)
SELECT c_custkey, CASE WHEN count(DISTINCT s_suppkey) = 1 THEN min(s_suppkey) END AS s_suppkey, CASE WHEN count(DISTINCT s_suppkey) = 1 THEN 'matched' ELSE 'ambiguous' END AS outcome FROM b WHERE born OR NOT any_born GROUP BY 1""")
def player_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Namesakes of the source's scope or of none, told apart by team, then by date of birth."""
    c, s = read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier")
    scope = F.when(F.col("s_suppkey") % 4 > 0, (F.col("s_suppkey") % 4).cast("string")).otherwise("")
    traits = lambda k, team: {"name": F.col(k) % 50, "team": F.col(team), "born": F.floor(F.col(k) / 50) % 3}
    sources = c.withColumns(traits("c_custkey", "c_nationkey")).withColumn("scope", F.explode(entities.scopes((F.col("c_custkey") % 4).cast("string"))))
    held = s.withColumns(traits("s_suppkey", "s_nationkey")).withColumn("scope", scope)
    return entities.narrow_by(sources, held, ["name", "scope"], ["team", "born"], "c_custkey", "s_suppkey")


@query("""WITH t AS (SELECT s_suppkey, n_nationkey, CASE WHEN s_suppkey % 10 = 0 AND n_nationkey = s_nationkey THEN 1 WHEN s_suppkey % 3 = 0 AND n_nationkey % 5 = s_suppkey % 5 THEN 2 WHEN n_nationkey = s_suppkey % 40 THEN 3 END AS tier FROM supplier, nation),
g AS (SELECT s_suppkey, tier, count(*) AS n, min(n_nationkey) AS n_nationkey FROM t WHERE tier IS NOT NULL GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY tier) AS r FROM g), f AS (SELECT s_suppkey, CASE WHEN n = 1 THEN n_nationkey END AS n_nationkey, CASE WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS outcome, CASE WHEN n = 1 THEN [1.0, 0.99, 0.9][tier] END AS score FROM b WHERE r = 1)
SELECT s_suppkey, f.n_nationkey, coalesce(outcome, 'unmatched') AS outcome, CAST(score AS DOUBLE) AS score, concat_ws(',', CASE WHEN s_suppkey % 2 <> n.n_nationkey % 2 THEN 'roof' END, CASE WHEN s_nationkey % 5 <> n_regionkey THEN 'region' END) AS contradictions
FROM supplier LEFT JOIN f USING (s_suppkey) LEFT JOIN nation n ON n.n_nationkey = f.n_nationkey""")
def venue_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places by link, by name, by neighbourhood, and in what they contradict the matched one."""
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    link = s.where(key % 10 == 0).join(n, F.col("n_nationkey") == F.col("s_nationkey"))
    name = s.where(key % 3 == 0).join(n, F.col("n_nationkey") % 5 == key % 5)
    near = s.join(n, F.col("n_nationkey") == key % 40)
    found = entities.tiered(s, "s_suppkey", [(1.0, link), (0.99, name), (0.9, near)], "n_nationkey")
    both = found.join(s.select("s_suppkey", "s_nationkey"), "s_suppkey").join(n.select("n_nationkey", "n_regionkey"), "n_nationkey", "left")
    both = both.withColumns({"roof": key % 2, "held_roof": F.col("n_nationkey") % 2, "region": F.col("s_nationkey") % 5})
    differ = F.array_join(entities.contradictions(both, {"roof": ("roof", "held_roof"), "region": ("region", "n_regionkey")}), ",")
    return both.select("s_suppkey", "n_nationkey", "outcome", "score", differ.alias("contradictions"))


HALVES = "WITH h AS (SELECT o_orderkey AS a, o_custkey, o_orderdate AS ht, o_orderstatus = 'P' AS moved FROM orders WHERE o_orderkey % 2 = 0), g AS (SELECT o_orderkey AS b, o_custkey, o_orderdate AS bt FROM orders WHERE o_orderkey % 2 = 1), "


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = read(spark, sf_dir, "orders")
    return (
        o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("a"), "o_custkey", F.col("o_orderdate").alias("at"), (F.col("o_orderstatus") == "P").alias("moved")),
        o.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("b"), "o_custkey", F.col("o_orderdate").alias("bt")),
    )


@query(HALVES + """t AS (SELECT a, b, CASE WHEN abs(epoch_us(ht) - epoch_us(bt)) <= 86400000000 * 30 THEN 1 ELSE 2 END AS tier FROM h JOIN g USING (o_custkey) WHERE abs(epoch_us(ht) - epoch_us(bt)) <= 86400000000 * 120),
n AS (SELECT a, tier, count(DISTINCT b) AS n, min(b) AS b FROM t GROUP BY ALL), f AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY tier) AS r FROM n)
SELECT h.a, f.tier, CASE WHEN n = 1 THEN f.b END AS b, CAST(CASE WHEN n = 1 THEN least(CASE f.tier WHEN 1 THEN 0.98 ELSE 0.8 END, CASE WHEN moved THEN 0.85 ELSE 1 END) END AS DOUBLE) AS score, CASE WHEN n IS NULL THEN 'create' WHEN n = 1 THEN 'matched' ELSE 'review' END AS outcome FROM h LEFT JOIN f ON f.a = h.a AND r = 1""")
def match_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, g = _halves(spark, sf_dir)
    return entities.match_or_create(h, g, ["o_custkey"], "a", "b", "at", "bt", [86_400 * 30, 86_400 * 120], [0.98, 0.8], F.col("moved"), 0.85)


@query("""WITH h AS (SELECT o_orderkey AS a, o_custkey % 30 AS x, o_orderkey % 30 AS y, o_orderdate AS ht FROM orders WHERE o_orderkey % 2 = 0), g AS (SELECT o_orderkey AS b, o_custkey % 30 AS x, o_orderkey % 30 AS y, o_orderdate AS bt, o_orderstatus = 'O' AS neutral FROM orders WHERE o_orderkey % 2 = 1),
d AS (SELECT a, b, CASE WHEN abs(epoch_us(ht) - epoch_us(bt)) <= 86400000000 * 20 THEN 1 ELSE 2 END AS tier FROM h JOIN g USING (x, y) WHERE abs(epoch_us(ht) - epoch_us(bt)) <= 86400000000 * 90
UNION ALL SELECT a, b, 3 FROM h JOIN g ON h.x = g.y AND h.y = g.x AND neutral WHERE abs(epoch_us(ht) - epoch_us(bt)) <= 86400000000 * 90), n AS (SELECT a, tier, count(DISTINCT b) AS n, min(b) AS b FROM d GROUP BY ALL), f AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY tier) AS r FROM n)
SELECT h.a, f.tier, CASE WHEN n = 1 THEN f.b END AS b, CASE WHEN n IS NULL THEN 'unmatched' WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS outcome, coalesce(f.tier = 3, false) AS swapped FROM h LEFT JOIN f ON f.a = h.a AND r = 1""")
def sportsbook_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumns({"x": F.col("o_custkey") % 30, "y": F.col("o_orderkey") % 30})
    h = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("a"), "x", "y", F.col("o_orderdate").alias("at"))
    g = o.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("b"), "x", "y", F.col("o_orderdate").alias("bt"), (F.col("o_orderstatus") == "O").alias("neutral"))
    return entities.match_with_swaps(h, g, ("x", "y"), "a", "b", "at", "bt", 86_400 * 20, 86_400 * 90, "neutral")


@query("""WITH r AS (SELECT o_custkey, o_orderkey % 3 AS kind, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey % 5 + CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END END AS game FROM orders)
SELECT o_custkey, CASE WHEN count(DISTINCT game) = 1 AND count(DISTINCT kind) FILTER (game IS NOT NULL AND kind < 2) = 2 THEN min(game) END AS game,
CASE WHEN count(DISTINCT game) > 1 THEN 'conflict' WHEN count(DISTINCT game) = 1 AND count(DISTINCT kind) FILTER (game IS NOT NULL AND kind < 2) = 2 THEN 'matched' ELSE 'incomplete' END AS outcome FROM r GROUP BY 1""")
def exchange_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a ticker, a title and the rules each say a market is about; ticker and title are needed."""
    kind = F.element_at(F.array(F.lit("ticker"), F.lit("title"), F.lit("rules")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    game = F.when(F.col("o_orderkey") % 7 > 0, F.col("o_custkey") % 5 + F.when(F.col("o_totalprice") > 300000, 1).otherwise(0))
    return entities.agree(read(spark, sf_dir, "orders").select("o_custkey", kind.alias("kind"), game.alias("game")), "o_custkey", "game", "kind", ["ticker", "title"])


@query("""SELECT h.o_orderkey AS a, g.o_orderkey AS b FROM orders h JOIN orders g ON h.o_custkey = g.o_custkey AND CAST(h.o_orderdate - INTERVAL 5 HOUR AS DATE) = CAST(g.o_orderdate - INTERVAL 8 HOUR AS DATE) AND h.o_orderkey % 2 = 0 AND g.o_orderkey % 2 = 1""")
def date_slate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, g = _halves(spark, sf_dir)
    local = lambda c, hours: F.to_date(F.col(c) - F.expr(f"INTERVAL {hours} HOURS"))
    return entities.date_slate(h, g, ["o_custkey"], local("at", 5), local("bt", 8)).select("a", "b")


@query(f"""SELECT o_orderkey, o_orderstatus <> 'P' AND coalesce(CASE WHEN o_orderkey % 9 > 0 THEN o_orderdate END <= TIMESTAMP '{CUT}', false) AS historical,
o_orderstatus <> 'P' AND coalesce(CASE WHEN o_orderkey % 9 > 0 THEN o_orderdate END <= TIMESTAMP '{CUT}', false) AND o_orderpriority <> '1-URGENT' AS now FROM orders""")
def orientation_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumn("decided_at", F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderdate")))
    mapped = F.col("o_orderstatus") != "P"
    return o.select("o_orderkey", entities.readiness(o, mapped, "decided_at", instant(CUT)).alias("historical"), entities.readiness(o, mapped, "decided_at", instant(CUT), F.col("o_orderpriority") == "1-URGENT").alias("now"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN b IS NULL THEN 'refused' WHEN a IS NULL THEN 'insert' WHEN a = b THEN 'unchanged' WHEN l_returnflag = 'R' THEN 'replace' ELSE 'conflict' END AS outcome
FROM (SELECT *, CASE WHEN l_partkey % 3 > 0 THEN l_partkey % 4 END AS a, CASE WHEN l_suppkey % 5 > 0 THEN l_suppkey % 4 END AS b FROM lineitem)""")
def link_idempotency(spark: SparkSession, sf_dir: str) -> DataFrame:
    held, offered = F.when(F.col("l_partkey") % 3 > 0, F.col("l_partkey") % 4), F.when(F.col("l_suppkey") % 5 > 0, F.col("l_suppkey") % 4)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", entities.link_outcome(held, offered, F.col("l_returnflag") == "R").alias("outcome"))


@query("""WITH t AS (SELECT c_custkey, s_suppkey, CASE WHEN c_custkey % 20 = 0 AND s_suppkey = c_custkey % 100 THEN 1 WHEN c_custkey % 50 = s_suppkey % 50 AND c_nationkey = s_nationkey THEN 2 WHEN c_custkey % 70 = s_suppkey % 70 AND c_custkey % 2 = 0 THEN 3 END AS tier FROM customer, supplier),
g AS (SELECT c_custkey, tier, count(DISTINCT s_suppkey) AS n, min(s_suppkey) AS s FROM t WHERE tier IS NOT NULL GROUP BY ALL), f AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY tier) AS r FROM g)
SELECT c_custkey, tier, CASE WHEN n = 1 THEN s END AS s_suppkey, CASE WHEN n IS NULL THEN 'unmatched' WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS outcome FROM customer LEFT JOIN f USING (c_custkey) WHERE r = 1 OR r IS NULL""")
def directory_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster names by id, by name and team, by name."""
    c, s = read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier")
    key, sup = F.col("c_custkey"), F.col("s_suppkey")
    held = lambda n, *also: resolve.sets(s.withColumn("by", sup % n), ["by", *also], "s_suppkey")
    by_id = c.where(key % 20 == 0).withColumn("s_suppkey", key % 100).join(s.select("s_suppkey"), "s_suppkey")
    by_team = c.withColumns({"by": key % 50, "s_nationkey": F.col("c_nationkey")}).join(held(50, "s_nationkey"), ["by", "s_nationkey"])
    by_name = c.where(key % 2 == 0).withColumn("by", key % 70).join(held(70), "by")
    return entities.tiered(c, "c_custkey", [(1.0, by_id), (0.95, by_team), (0.9, by_name)], "s_suppkey").select("c_custkey", "tier", "s_suppkey", "outcome")


@query("""WITH p AS (SELECT DISTINCT l_orderkey AS s, l_orderkey // 2 * 3 + l_partkey % 4 // 2 + l_orderkey % 2 AS t FROM lineitem), n AS (SELECT *, count(*) OVER (PARTITION BY s) AS nt, count(*) OVER (PARTITION BY t) AS ns FROM p)
SELECT s, t, CASE WHEN s % 10 = 0 THEN 'unaudited' WHEN nt > 1 THEN 'source_shared' WHEN ns > 1 THEN 'target_shared' ELSE 'accepted' END AS verdict FROM n""")
def id_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.expr("l_orderkey div 2 * 3 + l_partkey % 4 div 2 + l_orderkey % 2")
    seen = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("s"), target.alias("t"))
    audited = read(spark, sf_dir, "orders").where("o_orderkey % 10 > 0").select(F.col("o_orderkey").alias("s"))
    return entities.crosswalk(seen, audited, "s", "t")


@query("""WITH x AS (SELECT n_nationkey AS official_team, n_nationkey % 7 AS team FROM nation WHERE n_nationkey % 6 > 0), o AS (SELECT o_orderkey, o_custkey % 25 AS home, o_orderkey % 25 AS away, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 2 = 0),
g AS (SELECT o_orderkey AS game, o_custkey % 7 AS home, o_orderkey % 7 AS away, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 2 = 1), j AS (SELECT o.o_orderkey, h.team AS hteam, a.team AS ateam, g.game FROM o LEFT JOIN x h ON h.official_team = o.home LEFT JOIN x a ON a.official_team = o.away LEFT JOIN g ON g.home = h.team AND g.away = a.team AND g.day = o.day)
SELECT o_orderkey, CASE WHEN min(hteam) IS NOT NULL AND min(ateam) IS NOT NULL AND count(DISTINCT game) = 1 THEN min(game) END AS game, CASE WHEN min(hteam) IS NULL OR min(ateam) IS NULL THEN 'team_unknown' WHEN count(DISTINCT game) = 0 THEN 'no_game' WHEN count(DISTINCT game) > 1 THEN 'ambiguous' ELSE 'matched' END AS verdict FROM j GROUP BY 1""")
def game_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    teams = read(spark, sf_dir, "nation").where("n_nationkey % 6 > 0").select(F.col("n_nationkey").cast("long").alias("official_team"), (F.col("n_nationkey") % 7).cast("long").alias("team"))
    official = o.where("o_orderkey % 2 = 0").select("o_orderkey", (F.col("o_custkey") % 25).alias("home"), (F.col("o_orderkey") % 25).alias("away"), "day")
    held = o.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("game"), (F.col("o_custkey") % 7).alias("home"), (F.col("o_orderkey") % 7).alias("away"), "day")
    return entities.game_crosswalk(official, held, teams, "o_orderkey", "game", "home", "away", "day")
