"""Queries over admission, leakage, accounts, outside reports and small validity rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import pricing
from tidemark.operators import adapters, digests, evidence
from tidemark.plans.registering import LOG, instant, observations, query, read
from tidemark.sources import store

CUT = "2000-01-01 00:00:00"
KINDS = ["static", "event_derived", "versioned_snapshot", "label_only", "forward_only"]

ASKED = """WITH a AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_orderkey % 29 = 0 AS superseded, ['static', 'event_derived', 'versioned_snapshot', 'label_only', 'forward_only'][1 + l_partkey % 5] AS kind, l_partkey % 31 = 0 AS unknown, l_suppkey % 7 = 0 AS wrong,
CASE WHEN l_partkey % 5 = 3 THEN l_suppkey % 9 > 0 ELSE l_suppkey % 9 = 0 END AS as_label, l_linenumber % 6 > 0 AS certified, l_quantity < 3 AS excluded, l_returnflag, l_linestatus, l_tax, l_orderkey % 5 AS d5, l_orderkey % 4 AS d4, l_suppkey % 4 AS s4 FROM lineitem),
b AS (SELECT *, CASE WHEN unknown THEN NULL ELSE kind END AS fk, CASE WHEN kind = 'label_only' THEN CASE WHEN l_tax < 0.07 THEN 'label_only' ELSE 'reconstructed' END ELSE CASE WHEN l_tax < 0.07 THEN 'reconstructed' ELSE 'label_only' END END AS lane,
CASE kind WHEN 'static' THEN CASE WHEN l_returnflag = 'A' THEN 'event_derived' ELSE 'static_identity' END WHEN 'event_derived' THEN 'event_derived' ELSE 'versioned_snapshot' END AS basis FROM a)
SELECT l_orderkey, l_linenumber, CASE WHEN superseded THEN 'corpus_superseded' WHEN fk IS NULL THEN 'unknown_family' WHEN fk = 'forward_only' THEN 'forward_only_family' WHEN wrong THEN 'wrong_league_for_family'
WHEN fk = 'label_only' AND NOT as_label THEN 'label_requested_as_feature' WHEN fk <> 'label_only' AND as_label THEN 'feature_requested_as_label' WHEN NOT certified THEN 'no_certification' WHEN excluded THEN 'certified_excluded'
WHEN lane <> CASE WHEN as_label THEN 'label_only' ELSE 'reconstructed' END THEN 'wrong_lane' WHEN as_label THEN 'admitted' WHEN fk = 'static' AND basis <> 'static_identity' THEN 'basis_contradicts_family'
WHEN fk = 'static' AND d4 = 0 THEN 'missing_crosswalk' WHEN fk = 'static' AND d4 = 1 THEN 'crosswalk_from_another_corpus' WHEN fk = 'static' AND d5 = 0 THEN 'crosswalk_digest_mismatch' WHEN fk = 'static' THEN 'admitted'
WHEN fk = 'event_derived' AND s4 = 0 THEN 'basis_contradicts_family' WHEN fk = 'event_derived' AND d5 = 1 THEN 'target_game_self_reference' WHEN d5 = 2 THEN 'basis_contradicts_family' WHEN l_shipdate > TIMESTAMP '2000-01-01 00:00:00' THEN 'not_yet_available' ELSE 'admitted' END AS decision FROM b"""


@query(ASKED)
def admission_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every outcome of the admission procedure."""
    c = F.col
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (c("l_partkey") % 5 + 1).cast("int"))
    li = read(spark, sf_dir, "lineitem").withColumn("kind", kind)
    label = F.when(c("kind") == "label_only", c("l_suppkey") % 9 > 0).otherwise(c("l_suppkey") % 9 == 0)
    usual, other = F.when(c("kind") == "label_only", "label_only").otherwise("reconstructed"), F.when(c("kind") == "label_only", "reconstructed").otherwise("label_only")
    basis = F.when(c("kind") == "static", F.when(c("l_returnflag") == "A", "event_derived").otherwise("static_identity")).when(c("kind") == "event_derived", "event_derived").otherwise("versioned_snapshot")
    told = F.when(c("l_orderkey") % 5 != 2, c("l_shipdate"))
    rows = li.select(
        "l_orderkey", "l_linenumber", (c("l_orderkey") % 29 == 0).alias("superseded"), F.when(c("l_partkey") % 31 > 0, c("kind")).alias("family_kind"), F.when(c("l_suppkey") % 7 == 0, "x").alias("family_league"), F.lit("y").alias("league"),
        label.alias("as_label"), (c("l_linenumber") % 6 > 0).alias("certified"), F.when(c("l_quantity") < 3, "excluded").otherwise("eligible").alias("eligibility"), F.when(c("l_tax") < 0.07, usual).otherwise(other).alias("lane"), basis.alias("basis"),
        F.when(c("l_orderkey") % 4 > 0, "x1").alias("crosswalk"), F.when(c("l_orderkey") % 4 > 0, F.when(c("l_orderkey") % 4 == 1, "c2").otherwise("c1")).alias("crosswalk_corpus"), F.lit("c1").alias("corpus"), (c("l_orderkey") % 5 > 0).alias("digest_ok"),
        F.when(c("l_suppkey") % 4 > 0, c("l_shipdate")).alias("completed_at"), F.lit("r").alias("rule"), (c("l_orderkey") % 5 == 1).alias("own_evidence"), told.alias("snapshot_at"), told.alias("available_at"),
    )
    return evidence.admission(rows, instant(CUT)).select("l_orderkey", "l_linenumber", "decision")


#: Families by their place in the table, the last one unreviewed; everything but family, league and clock is in order.
BY_FAMILY = """WITH a AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey % 20 AS f, l_suppkey % 2 AS nba, l_linenumber % 4 = 0 AS as_label, l_quantity >= 5 AS certified FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN f = 19 THEN 'unknown_family' WHEN f IN (12, 16, 17, 18) THEN 'forward_only_family' WHEN f BETWEEN 8 AND 11 AND nba = 1 OR f BETWEEN 13 AND 15 AND nba = 0 THEN 'wrong_league_for_family'
WHEN f = 7 AND NOT as_label THEN 'label_requested_as_feature' WHEN f <> 7 AND as_label THEN 'feature_requested_as_label' WHEN NOT certified THEN 'no_certification' WHEN f IN (0, 7) THEN 'admitted'
WHEN l_shipdate > TIMESTAMP '2000-01-01 00:00:00' THEN 'not_yet_available' ELSE 'admitted' END AS decision FROM a"""


@query(BY_FAMILY)
def family_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by the name of a family, classified by the reviewed table and then admitted or not."""
    c = F.col
    names = F.array(*[F.lit(f) for f, _, _ in evidence.FAMILIES], F.lit("unheard_of"))
    li = read(spark, sf_dir, "lineitem").withColumn("family", F.element_at(names, (c("l_partkey") % 20 + 1).cast("int")))
    asked = evidence.with_family(li, "family").withColumn("as_label", c("l_linenumber") % 4 == 0)
    basis = F.when(c("family_kind") == "static", "static_identity").otherwise(c("family_kind"))
    rows = asked.select(
        "l_orderkey", "l_linenumber", "family_kind", "family_league", "as_label", F.when(c("l_suppkey") % 2 == 1, "lg_nba").otherwise("lg_mlb").alias("league"), (c("l_quantity") >= 5).alias("certified"),
        F.lit(False).alias("superseded"), F.lit("eligible").alias("eligibility"), F.when(c("as_label"), "label_only").otherwise("reconstructed").alias("lane"), basis.alias("basis"), F.lit("x1").alias("crosswalk"), F.lit("c1").alias("crosswalk_corpus"),
        F.lit("c1").alias("corpus"), F.lit(True).alias("digest_ok"), c("l_shipdate").alias("completed_at"), F.lit("r").alias("rule"), F.lit(False).alias("own_evidence"), c("l_shipdate").alias("snapshot_at"), c("l_shipdate").alias("available_at"),
    )
    return evidence.admission(rows, instant(CUT)).select("l_orderkey", "l_linenumber", "decision")


@query("""WITH g AS (SELECT o_orderkey AS game, CASE WHEN o_orderkey % 17 > 0 THEN o_custkey END AS identity, o_orderdate + INTERVAL 60 DAY AS cutoff FROM orders), r AS (SELECT l_orderkey AS game, l_shipdate AS observed_at, l_linestatus = 'F' AS final FROM lineitem),
l AS (SELECT game, arg_max(final, observed_at) AS last FROM (SELECT game, observed_at, max(final) AS final FROM r GROUP BY ALL) GROUP BY 1), c AS (SELECT user_id, date_trunc('day', ts) AS day FROM events GROUP BY ALL HAVING count(DISTINCT event_type) > 2)
SELECT 'result_before_cutoff' AS rule, 'blocking' AS severity, 'game' AS entity_type, CAST(game AS VARCHAR) AS entity_id FROM g WHERE identity IS NOT NULL AND EXISTS (SELECT 1 FROM r WHERE r.game = g.game AND final AND observed_at <= cutoff)
UNION ALL SELECT 'equal_time_conflict', 'blocking', 'events', user_id || '@' || strftime(day, '%Y-%m-%d') FROM c UNION ALL SELECT 'eligibility_unknown', 'issue', 'forecast', CAST(p_partkey AS VARCHAR) FROM part WHERE p_size < 25 AND p_partkey % 6 = 0
UNION ALL SELECT 'label_unavailable', 'note', 'game', CAST(g.game AS VARCHAR) FROM g JOIN l ON l.game = g.game WHERE identity IS NOT NULL AND NOT last UNION ALL SELECT 'identity_missing', 'note', 'game', CAST(game AS VARCHAR) FROM g WHERE identity IS NULL""")
def leakage_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five corpus rules, in the order of a report."""
    c = F.col
    games = read(spark, sf_dir, "orders").select(c("o_orderkey").alias("game"), F.when(c("o_orderkey") % 17 > 0, c("o_custkey")).alias("identity"), (c("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("cutoff"))
    results = read(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("game"), c("l_shipdate").alias("observed_at")).agg(F.max(c("l_linestatus") == "F").alias("final"))
    forecasts = read(spark, sf_dir, "part").select(c("p_partkey").alias("forecast"), (c("p_size") < 25).alias("current"), F.when(c("p_partkey") % 6 > 0, True).alias("eligible"))
    day = F.date_format("ts", "yyyy-MM-dd")
    conflicts = read(spark, sf_dir, "events").groupBy("user_id", day.alias("day")).agg(F.count_distinct("event_type").alias("n")).where("n > 2").select(F.lit("events").alias("entity_type"), F.concat(F.col("user_id").cast("string"), F.lit("@"), "day").alias("entity_id"))
    return evidence.finding_order(evidence.leakage_rules(games, results, forecasts, conflicts))


@query("""WITH g AS (SELECT o_orderkey AS game, CASE WHEN o_orderkey % 17 > 0 THEN o_custkey END AS identity, o_orderdate, o_orderstatus FROM orders), s AS (SELECT o_orderkey AS game, o_orderdate - INTERVAL 5 DAY AS observed_at, o_orderdate + INTERVAL (o_orderkey % 23 - 10) DAY AS start FROM orders WHERE o_orderkey % 13 > 0
UNION ALL SELECT o_orderkey, o_orderdate - INTERVAL 5 DAY, o_orderdate + INTERVAL 40 DAY FROM orders WHERE o_orderkey % 19 = 0 AND o_orderkey % 13 > 0),
f AS (SELECT game, arg_min(start, start) AS cutoff, min(observed_at) AS seen, count(DISTINCT start) > 1 AS amb FROM s GROUP BY 1), r AS (SELECT l_orderkey AS game, l_shipdate AS observed_at, l_linestatus = 'F' AS final, CASE WHEN l_linenumber % 3 > 0 THEN CAST(l_linenumber % 3 AS VARCHAR) END AS winner FROM lineitem),
x AS (SELECT game, max(observed_at) AS label_at FROM r GROUP BY 1), y AS (SELECT game, label_at, arg_min(final, (final, coalesce(winner, ''))) AS final, arg_min(winner, (final, coalesce(winner, ''))) AS label, count(DISTINCT (final, coalesce(winner, ''))) > 1 AS amb FROM r JOIN x USING (game) WHERE observed_at = label_at GROUP BY ALL),
j AS (SELECT g.game, g.identity, CASE WHEN g.game % 11 > 0 THEN g.o_orderdate + INTERVAL (g.game % 9 - 6) DAY END AS linked_at, f.cutoff, f.seen, coalesce(f.amb, false) OR coalesce(y.amb, false) AS amb, y.label_at, y.final, y.label, EXISTS (SELECT 1 FROM r WHERE r.game = g.game AND r.observed_at <= f.cutoff) AS early FROM g LEFT JOIN f ON f.game = g.game LEFT JOIN y ON y.game = g.game),
e AS (SELECT *, CASE WHEN identity IS NULL THEN 'identity_missing' WHEN linked_at IS NULL THEN 'unlinked' WHEN cutoff IS NULL OR seen > cutoff THEN 'no_visible_schedule' WHEN amb THEN 'ambiguous' WHEN label_at IS NULL OR NOT coalesce(final, false) OR label IS NULL THEN 'no_final_label' WHEN label_at <= cutoff THEN 'label_not_after_cutoff' WHEN linked_at > cutoff THEN 'link_after_cutoff' WHEN early THEN 'result_visible_at_cutoff' END AS excluded FROM j)
SELECT game, cutoff, CASE WHEN excluded IS NULL THEN label END AS label, excluded FROM e""")
def pregame_rows_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pregame dataset with all reads as of their times and every reason of exclusion."""
    c, o = F.col, read(spark, sf_dir, "orders")
    days = lambda n: F.make_dt_interval(n)
    games = o.select(c("o_orderkey").alias("game"), F.when(c("o_orderkey") % 17 > 0, c("o_custkey")).alias("identity"))
    told = o.where("o_orderkey % 13 > 0")
    schedule = lambda df, n: df.select(c("o_orderkey").alias("game"), (c("o_orderdate") - days(F.lit(5))).alias("observed_at"), (c("o_orderdate") + days(n)).alias("start"))
    schedules = schedule(told, (c("o_orderkey") % 23 - 10).cast("int")).unionByName(schedule(told.where("o_orderkey % 19 = 0"), F.lit(40)))
    results = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("game"), c("l_shipdate").alias("observed_at"), (c("l_linestatus") == "F").alias("final"), F.when(c("l_linenumber") % 3 > 0, (c("l_linenumber") % 3).cast("string")).alias("winner"))
    links = o.where("o_orderkey % 11 > 0").select(c("o_orderkey").alias("game"), (c("o_orderdate") + days((c("o_orderkey") % 9 - 6).cast("int"))).alias("decided_at"))
    return evidence.pregame_dataset(games, schedules, results, links)


@query("""WITH u AS (SELECT o_custkey, CAST(count(*) AS INT) AS reserved, CAST(count(*) - max(o_orderkey % 3) AS INT) AS transports, CAST(count(*) FILTER (o_orderstatus <> 'P') AS INT) AS ok, CAST(CASE WHEN o_custkey % 5 > 0 THEN count(*) FILTER (o_orderstatus = 'P') END AS INT) AS bad, CAST(o_custkey % 3 AS INT) AS retries, CAST(count(*) FILTER (o_totalprice > 100000) AS INT) AS pages, o_custkey % 4 > 0 AS settled, o_custkey % 6 > 0 AS net FROM orders GROUP BY o_custkey)
SELECT o_custkey, array_to_string(list_sort(list_filter([CASE WHEN transports < 0 THEN 'transport_starts is negative' END, CASE WHEN transports > reserved THEN 'more transports than attempts' END, CASE WHEN ok + coalesce(bad, 0) > transports THEN 'more outcomes than transports' END,
CASE WHEN settled AND transports - ok - bad <> retries THEN 'retries do not close' END, CASE WHEN pages > ok THEN 'more pages than successes' END, CASE WHEN NOT net AND transports > 0 THEN 'transports without network' END, CASE WHEN reserved > 12 THEN 'over the request cap' END], lambda x: x IS NOT NULL)), ';') AS problems FROM u""")
def usage_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    n = lambda x: F.count_if(x).cast("int")
    u = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").cast("int").alias("reserved_attempts"), (F.count("*") - F.max(c("o_orderkey") % 3)).cast("int").alias("transport_starts"), n(c("o_orderstatus") != "P").alias("successful_responses"), n(c("o_orderstatus") == "P").alias("pending"), n(c("o_totalprice") > 100000).alias("pages_fetched"),
    )
    u = u.withColumns({"failed_responses": F.when(c("o_custkey") % 5 > 0, c("pending")), "retry_attempts": (c("o_custkey") % 3).cast("int"), "settled": c("o_custkey") % 4 > 0, "network_occurred": c("o_custkey") % 6 > 0})
    return evidence.usage_problems(u, ["o_custkey"], 12).withColumn("problems", F.array_join("problems", ";"))


@query("""WITH i AS (SELECT DISTINCT l_partkey AS id FROM lineitem), r AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 8 > 0 THEN CASE WHEN p_partkey % 40 = 1 THEN p_partkey - 1 ELSE p_partkey END + CASE WHEN p_partkey % 50 = 7 THEN 1000000 ELSE 0 END END AS g FROM part WHERE p_partkey % 9 > 0), k AS (SELECT p_partkey AS g, p_size % 2 AS l FROM part),
j AS (SELECT i.id, r.id IS NULL AS none, r.g, k.g IS NULL AS unknown, k.l FROM i LEFT JOIN r ON r.id = i.id LEFT JOIN k ON k.g = r.g), s AS (SELECT *, CASE WHEN g IS NOT NULL THEN count(*) OVER (PARTITION BY g) END AS n FROM j)
SELECT id, g AS game, CASE WHEN none THEN 'no_reference' WHEN g IS NULL THEN 'unresolved' WHEN unknown THEN 'unknown_game' WHEN l <> 1 THEN 'other_league' WHEN n > 1 THEN 'shared_target' END AS problem FROM s""")
def target_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, part = F.col("p_partkey"), read(spark, sf_dir, "part")
    game = F.when(key % 8 > 0, F.when(key % 40 == 1, key - 1).otherwise(key) + F.when(key % 50 == 7, 1_000_000).otherwise(0))
    references = part.where("p_partkey % 9 > 0").select(key.alias("id"), game.alias("game"))
    held = part.select(key.alias("game"), (F.col("p_size") % 2).alias("league"))
    return evidence.project_targets(read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id")), references, held, "id", "game", "league", F.lit(1))


@query("""WITH s AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderkey % 101 > 0), d AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus <> 'P')
SELECT (SELECT count(*) FROM s) AS n_sealed, (SELECT count(*) FROM d) AS n_derived, (SELECT count(*) FROM s WHERE k NOT IN (SELECT k FROM d)) AS unproven, (SELECT count(*) FROM d WHERE k NOT IN (SELECT k FROM s)) AS unsealed,
NOT EXISTS (SELECT 1 FROM s WHERE k NOT IN (SELECT k FROM d)) AND NOT EXISTS (SELECT 1 FROM d WHERE k NOT IN (SELECT k FROM s)) AS verified""")
def target_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_orderstatus")
    return evidence.population_check(o.where("o_orderkey % 101 > 0"), o.where("o_orderstatus <> 'P'"), "k", 1_000_000_000)


@query("""SELECT c_custkey, CASE WHEN count(o_orderkey) = 1 THEN min(o_orderkey) END AS o_orderkey, CASE WHEN count(o_orderkey) = 1 THEN 'one' ELSE 'none_or_many' END AS state FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def exactly_one_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return evidence.exactly_one(read(spark, sf_dir, "customer").select("c_custkey").join(o, "c_custkey", "left"), ["c_custkey"], "o_orderkey")


@query("""WITH a AS (SELECT s_nationkey % 5 AS ns, s_suppkey % 60 AS id, s_suppkey % 7 AS team FROM supplier), h AS (SELECT ns, id, count(DISTINCT team) AS n, min(team) AS team FROM a GROUP BY ALL)
SELECT c_custkey, c_nationkey % 5 AS ns, c_custkey % 60 AS id, CASE WHEN n = 1 THEN team END AS team, CASE WHEN n IS NULL THEN 'unattested' WHEN n > 1 THEN 'malformed' ELSE 'attested' END AS attestation FROM customer LEFT JOIN h ON h.ns = c_nationkey % 5 AND h.id = c_custkey % 60""")
def team_attestation(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 5).alias("ns"), (F.col("s_suppkey") % 60).alias("id"), (F.col("s_suppkey") % 7).alias("team"))
    c = read(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") % 5).alias("ns"), (F.col("c_custkey") % 60).alias("id"))
    return evidence.attested(c, a, "ns", "id", "team")


@query("SELECT c_custkey, CASE WHEN r_name IS NOT NULL AND n_nationkey % 3 > 0 THEN r_name || '.v' || (n_nationkey % 3) ELSE 'unqualified' END AS qualified FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def qualified_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey")).where("n_nationkey % 3 > 0")
    dims = n.select(F.col("n_nationkey").alias("c_nationkey"), F.concat("r_name", F.lit(".v"), F.col("n_nationkey") % 3).alias("qualified"))
    return evidence.qualified(read(spark, sf_dir, "customer"), dims, ["c_nationkey"]).select("c_custkey", "qualified")


@query(LOG + """, e AS (SELECT *, ['started', 'page', 'page', 'succeeded', 'failed'][1 + event_id % 5] AS kind FROM log), t AS (SELECT user_id, max(ts) AS ended_at, arg_max(kind, ts) AS st FROM e WHERE kind IN ('succeeded', 'failed') GROUP BY 1)
SELECT user_id, min(ts) FILTER (kind = 'started') AS started_at, any_value(t.ended_at) AS ended_at, coalesce(any_value(t.st), 'started') AS status, coalesce(sum(k) FILTER (kind = 'page'), 0) AS rows_read, coalesce(sum(1) FILTER (kind = 'failed'), 0) AS errors FROM e LEFT JOIN t USING (user_id) GROUP BY 1""")
def run_bookkeeping(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(x) for x in ("started", "page", "page", "succeeded", "failed")]), (F.col("event_id") % 5 + 1).cast("int"))
    e = observations(spark, sf_dir).withColumn("kind", kind).withColumns({"rows_read": F.when(F.col("kind") == "page", F.col("k")), "errors": F.when(F.col("kind") == "failed", 1)})
    return evidence.run_book(e, "user_id", "ts", "kind", ["rows_read", "errors"])


@query("""SELECT o_custkey, arg_max(o_orderkey, (CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 0 END, o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1""")
def settled_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "O", 2).otherwise(0)
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return evidence.settled(o, ["o_custkey"], rank, ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""SELECT l_orderkey, CASE WHEN bool_or(p NOT BETWEEN 1 AND 99) THEN 'price_out_of_range' WHEN bool_or(s < 0) THEN 'negative_size' WHEN count(DISTINCT p) < count(*) THEN 'duplicate_level' END AS problem
FROM (SELECT l_orderkey, l_partkey % 101 AS p, CAST(l_quantity AS BIGINT) - CASE WHEN l_suppkey % 20 = 0 THEN 60 ELSE 0 END AS s FROM lineitem) GROUP BY 1""")
def ladder_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.struct((F.col("l_partkey") % 101).alias("price"), (F.col("l_quantity").cast("long") - F.when(F.col("l_suppkey") % 20 == 0, 60).otherwise(0)).alias("size"))
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(level).alias("ladder")).select("l_orderkey", pricing.ladder_problem(F.col("ladder")).alias("problem"))


@query("""SELECT l_orderkey AS o_orderkey, count(*) AS n_rows, count(DISTINCT l_suppkey % 5) AS n_teams, count(DISTINCT l_partkey) AS n_players, count(*) FILTER (l_tax > 0.04) AS n_starters FROM lineitem GROUP BY 1""")
def page_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    person = F.struct(F.struct((F.col("l_suppkey") % 5).cast("string").alias("id")).alias("team"), F.struct(F.col("l_partkey").cast("string").alias("id")).alias("player"), (F.col("l_tax") > 0.04).alias("starter"))
    pages = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_json(F.struct(F.collect_list(person).alias("data"))).alias("body"))
    return adapters.page_shape(pages, "body", "o_orderkey").select("o_orderkey", *[F.col(c).cast("long").alias(c) for c in ("n_rows", "n_teams", "n_players", "n_starters")])


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reports, their lines as the players that they name."""
    word = F.element_at(F.array(*[F.lit(x) for x in ("Active", " out ", "Questionable", "doubtful", "gone")]), (F.col("l_linenumber") % 5 + 1).cast("int"))
    person = F.struct(
        F.concat(F.lit("Name "), F.col("l_suppkey") % 40).alias("name"), F.concat(F.lit("T"), F.col("l_suppkey") % 3).alias("team"), F.when(F.col("l_partkey") % 4 == 0, F.col("l_suppkey").cast("string")).alias("player_id"), word.alias("status"),
        F.when(F.col("l_returnflag") == "R", "knee").alias("reason"), F.when(F.col("l_linenumber") % 2 == 0, "starter").otherwise("bench").alias("role"),
    )
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("report")).agg(F.to_json(F.struct(F.sort_array(F.collect_list(person)).alias("players"))).alias("body"))


REPORTED = """WITH p AS (SELECT l_orderkey AS report, 'Name ' || (l_suppkey % 40) AS name, 'T' || (l_suppkey % 3) AS team, CASE WHEN l_partkey % 4 = 0 THEN CAST(l_suppkey AS VARCHAR) END AS player_id, ['available', 'out', 'questionable', 'doubtful', 'unknown'][1 + l_linenumber % 5] AS status, CASE WHEN l_linenumber % 2 = 0 THEN 'starter' ELSE 'bench' END AS role FROM lineitem),
w AS (SELECT s_suppkey AS player, CAST(s_suppkey AS VARCHAR) AS id, 'name ' || (s_suppkey % 40) AS name, 'T' || (s_suppkey % 3) AS team FROM supplier WHERE s_suppkey % 5 > 0)"""


def _roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").where("s_suppkey % 5 > 0").select(key.alias("player"), key.cast("string").alias("player_id"), F.concat(F.lit("NAME "), key % 40).alias("name"), F.concat(F.lit("T"), key % 3).alias("team"))


@query(REPORTED + """, a AS (SELECT p.*, w.player AS pa FROM p LEFT JOIN w ON w.id = p.player_id), b AS (SELECT name, team, count(*) AS n, min(player) AS q FROM w GROUP BY ALL), c AS (SELECT name, count(*) AS n, min(player) AS q FROM w GROUP BY 1),
j AS (SELECT a.*, CASE WHEN pa IS NOT NULL THEN pa WHEN b.n IS NOT NULL THEN CASE WHEN b.n = 1 THEN b.q END WHEN c.n = 1 THEN c.q END AS player FROM a LEFT JOIN b ON b.name = lower(a.name) AND b.team = a.team LEFT JOIN c ON c.name = lower(a.name))
SELECT report, player, status, CASE WHEN player IS NULL THEN 'unresolved' ELSE 'snapshot' END AS state, count(*) AS n FROM j GROUP BY ALL""")
def injury_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Injury and announcement reports: statuses mapped, people resolved or set aside."""
    rows = adapters.resolved(adapters.reported_players(_reports(spark, sf_dir), "body"), _roster(spark, sf_dir))
    return rows.groupBy("report", "player", "status", "state").agg(F.count("*").alias("n"))


@query(REPORTED + " SELECT report, report || ':pitcher:' || role AS subject, min(name) AS first_name, count(*) AS n FROM p GROUP BY ALL")
def probable_pitchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.pitcher_slots(adapters.reported_players(_reports(spark, sf_dir), "body"), "report")
    return rows.groupBy("report", "subject").agg(F.min("name").alias("first_name"), F.count("*").alias("n"))


@query(REPORTED + " SELECT report, team, array_to_string(list_sort(list(DISTINCT name)), ',') AS starters FROM p WHERE role = 'starter' GROUP BY ALL")
def lineup_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.lineups(adapters.reported_players(_reports(spark, sf_dir), "body"), "report").withColumn("starters", F.array_join("starters", ","))


@query("SELECT conv_id, turn, role AS author, role <> 'assistant' AS refused, false AS confirmed FROM conversations WHERE role IS NOT NULL")
def news_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations").where("role IS NOT NULL").select("conv_id", "turn", F.col("role").alias("author"))
    return adapters.authorised(c, spark.createDataFrame([("assistant",), ("editor",)], "author string"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'blank_name' WHEN p_partkey % 7 = 0 THEN 'half_coordinates' WHEN p_size * 4 > 90 THEN 'coordinates_out_of_range' WHEN p_partkey % 3 = 0 THEN 'unknown_roof' END AS reject FROM part""")
def venue_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size").cast("double")
    name, roof = F.when(key % 11 == 0, "  ").otherwise(F.col("p_name")), F.when(key % 3 == 0, "glass").when(key % 3 == 1, "dome")
    return read(spark, sf_dir, "part").select("p_partkey", adapters.venue_reject(name, size * 4, F.when(key % 7 > 0, size), roof).alias("reject"))


@query("SELECT count(*) FILTER (event_id % 6 = 0 OR user_id % 9 = 0) AS n_gaps, count(*) AS n_events FROM events")
def replay_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(F.when(F.col("user_id") % 9 > 0, F.col("user_id")).alias("market"), F.when(F.col("event_id") % 6 > 0, F.col("ts")).alias("at"))
    return adapters.replayable(e, "market", "at")[1]


@query("SELECT o_orderdate, o_orderpriority, o_orderkey FROM orders ORDER BY o_orderdate, o_orderpriority, o_orderkey")
def dataset_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.dataset_order(read(spark, sf_dir, "orders").select("o_orderdate", "o_orderpriority", "o_orderkey"), "o_orderdate", "o_orderpriority", "o_orderkey")


@query("""WITH m AS (SELECT user_id % 12 AS part, count(*) AS n_rows, min(ts) AS first_at, max(ts) AS last_at FROM events GROUP BY 1), n AS (SELECT user_id % 12 AS part, count(*) AS n_rows, min(ts) AS first_at, max(ts) AS last_at FROM events WHERE event_type = 'view' AND user_id % 12 < 4 GROUP BY 1)
SELECT * FROM m WHERE part NOT IN (SELECT part FROM n) UNION ALL SELECT * FROM n""")
def frame_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select((F.col("user_id") % 12).alias("part"), "ts", "event_type", "event_id")
    held, new = store.frame_manifest(e, ["part"], "ts"), store.frame_manifest(e.where("event_type = 'view' AND part < 4"), ["part"], "ts")
    return store.upsert_manifest(held, new, ["part"]).select("part", "n_rows", "first_at", "last_at")


#: Orders against a copy of them in which some are gone, some new, some told twice and some changed.
COPIES = """WITH l AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s FROM orders), r AS (SELECT k, c, CASE WHEN k % 89 = 0 THEN 'X' ELSE s END AS s FROM l WHERE k % 97 > 0
    UNION ALL SELECT k, c, s FROM l WHERE k % 83 = 0 AND k % 97 > 0 UNION ALL SELECT -k, c, s FROM l WHERE k % 79 = 0), """


def _copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    one = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"))
    two = one.where("k % 97 > 0").withColumn("s", F.when(F.col("k") % 89 == 0, "X").otherwise(F.col("s")))
    two = two.unionByName(one.where("k % 83 = 0 AND k % 97 > 0")).unionByName(one.where("k % 79 = 0").withColumn("k", -F.col("k")))
    return one, two


@query(COPIES + """p AS (SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right, a.v AS v, b.v AS w FROM (SELECT k, count(*) AS n, list(c || s ORDER BY c || s) AS v FROM l GROUP BY 1) a
FULL JOIN (SELECT k, count(*) AS n, list(c || s ORDER BY c || s) AS v FROM r GROUP BY 1) b ON a.k = b.k)
SELECT k, CASE WHEN n_right = 0 THEN 'only_left' WHEN n_left = 0 THEN 'only_right' WHEN n_left <> n_right THEN 'repeated' ELSE 'changed' END AS kind, n_left, n_right FROM p WHERE v IS DISTINCT FROM w""")
def certified_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.differences(*_copies(spark, sf_dir), ["k"], ["c", "s"])


@query(COPIES + """x AS (SELECT count(*) FILTER (k % 97 = 0) AS gone, count(*) FILTER (k % 97 > 0 AND k % 89 = 0 AND s <> 'X') AS changed FROM l)
SELECT (SELECT count(*) FROM l) AS n_left, (SELECT count(*) FROM r) AS n_right, (SELECT gone + changed = 0 FROM x) AS equal, true AS equal_to_itself""")
def table_certification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roots of both tables' digests, and of one table in another order of rows and partitions."""
    one, two = _copies(spark, sf_dir)
    root = lambda df, name: digests.table_digest(digests.bucket_digests(df, ["k"], ["c", "s"])).select(F.col("n").alias(f"n_{name}"), F.col("digest").alias(name))
    all_ = root(one, "left").crossJoin(root(two, "right")).crossJoin(root(one.repartition(7, "s"), "again"))
    return all_.select("n_left", "n_right", (F.col("left") == F.col("right")).alias("equal"), (F.col("left") == F.col("again")).alias("equal_to_itself"))
