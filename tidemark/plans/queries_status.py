"""Queries over availability reports, market shapes, features and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import status, texts, units
from tidemark.operators import asof, market, observe, provenance, resolve
from tidemark.plans.registering import LOG, instant, observations, query, read

NAMES = list(status.ACTIVE)
REPORTS = LOG + ", r AS (SELECT *, [" + ", ".join(f"'{n}'" for n in NAMES) + "][1 + event_id % 9] AS st, [" + ", ".join(str(p) for p in status.ACTIVE.values()) + "][1 + event_id % 9] AS p FROM log) "


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).withColumn("st", F.array(*[F.lit(n) for n in NAMES])[(F.col("event_id") % 9).cast("int")])


@query(REPORTS + "SELECT event_id, p, CASE WHEN k % 4 = 0 THEN CASE WHEN p = 0 THEN 0.0 END ELSE round(CAST(least(k, 30) AS DOUBLE) * p, 2) END AS minutes FROM r")
def expected_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.when(F.col("k") % 4 != 0, F.col("k").cast("double"))
    return _reports(spark, sf_dir).select("event_id", status.active_probability(F.col("st")).alias("p"), status.expected_minutes(F.col("st"), F.lit(None).cast("double"), k, F.lit(30.0)).alias("minutes"))


@query(REPORTS + """, b AS (SELECT *, coalesce(lag(st) OVER (PARTITION BY user_id ORDER BY ts, event_id), 'unknown') AS was, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) // 1000000 - epoch_us(ts) // 1000000 AS left_s FROM r),
c AS (SELECT *, CASE WHEN k % 10 = 0 AND st = 'scratched' THEN 'starting_pitcher_scratched' WHEN st IN ('out', 'scratched') AND was NOT IN ('out', 'scratched') THEN 'player_ruled_out' WHEN st IN ('available', 'probable', 'probable_starter', 'confirmed_starter') AND was IN ('out', 'scratched', 'doubtful') THEN 'player_became_available'
WHEN k % 7 = 0 THEN 'minutes_restriction' WHEN st = 'confirmed_starter' THEN 'unexpected_starter' ELSE 'status_change' END AS change FROM b)
SELECT event_id, change, CASE WHEN k % 5 = 0 THEN 'info' WHEN change IN ('starting_pitcher_scratched', 'player_ruled_out', 'unexpected_starter') OR coalesce(left_s BETWEEN 0 AND 5400, false) THEN 'critical' ELSE 'warning' END AS severity FROM c""")
def material_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    s = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / 1_000_000)
    r = _reports(spark, sf_dir).withColumn("was", F.coalesce(F.lag("st").over(w), F.lit("unknown"))).withColumn("left", s(F.lead("ts").over(w)) - s(F.col("ts")))
    change = status.change_type(F.col("st"), F.col("was"), F.when(F.col("k") % 10 == 0, "starting_pitcher").otherwise("bench"), F.col("k") % 7 == 0, F.lit(False))
    return r.withColumn("change", change).select("event_id", "change", status.severity(F.col("change"), F.col("k") % 5 == 0, F.col("left")).alias("severity"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 0.99 WHEN event_type = 'view' THEN 0.4 ELSE 0.9 END AS confidence, CASE WHEN event_id % 5 = 0 THEN true WHEN event_type = 'view' THEN false ELSE true END AS act FROM events")
def source_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    confirmed, social = F.col("event_id") % 5 == 0, F.col("event_type") == "view"
    c = status.confidence(confirmed, F.when(social, 0.4).otherwise(0.9))
    return read(spark, sf_dir, "events").select("event_id", c.alias("confidence"), status.actionable(confirmed, F.when(social, "social").otherwise("official"), c).alias("act"))


@query("""WITH o AS (SELECT l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN 'totals' ELSE 'spreads' END AS market, CASE WHEN l_linenumber = 6 THEN 'unknown' WHEN l_orderkey % 2 = 0 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'over' ELSE 'under' END ELSE CASE WHEN l_linenumber % 2 = 0 THEN 'home' WHEN l_linenumber = 7 THEN 'draw' ELSE 'away' END END AS role,
CASE WHEN l_orderkey % 2 = 0 THEN CAST(l_linenumber // 3 AS DOUBLE) ELSE abs(CAST(l_linenumber // 3 AS DOUBLE)) END AS line FROM lineitem),
c AS (SELECT l_orderkey, market, line, count(*) FILTER (role = 'over') AS o, count(*) FILTER (role = 'under') AS u, count(*) FILTER (role = 'home') AS h, count(*) FILTER (role = 'away') AS a, count(*) FILTER (role = 'draw') AS d, count(*) FILTER (role = 'unknown') AS x FROM o GROUP BY ALL)
SELECT l_orderkey, line, CASE WHEN x > 0 THEN 'unknown_outcome' WHEN market <> 'totals' AND d > 0 THEN 'draw' WHEN CASE WHEN market = 'totals' THEN o > 1 OR u > 1 ELSE h > 1 OR a > 1 END THEN 'duplicate' WHEN CASE WHEN market = 'totals' THEN o < 1 OR u < 1 ELSE h < 1 OR a < 1 END THEN 'missing' END AS problem FROM c""")
def market_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, even = F.col("l_linenumber"), F.col("l_orderkey") % 2 == 0
    name = F.when(n == 6, "zz").when(even, F.when(n % 2 == 0, "over").otherwise("under")).otherwise(F.when(n % 2 == 0, "lions").when(n == 7, "draw").otherwise("bears"))
    kind = F.when(even, "totals").otherwise("spreads")
    point = F.expr("l_linenumber div 3").cast("double") * F.when(~even & (n % 2 == 0), -1).otherwise(1)
    o = read(spark, sf_dir, "lineitem").select("l_orderkey", kind.alias("market"), status.outcome_role(kind, name, F.lit("lions"), F.lit("bears")).alias("role"), status.contract_key(kind, point).alias("line"))
    at = lambda r: F.count_if(F.col("role") == r).alias(r)
    c = o.groupBy("l_orderkey", "market", "line").agg(*[at(r) for r in ("over", "under", "home", "away", "draw", "unknown")])
    cols = [F.col(r) for r in ("over", "under", "home", "away", "draw", "unknown")]
    return c.select("l_orderkey", F.abs("line").alias("line"), status.contract_problem(F.col("market"), *cols).alias("problem"))


@query(LOG + "SELECT event_id, (k BETWEEN 6 AND 11 AND k % 3 <> 0) OR (k % 3 = 0 AND k % 2 = 0) AS due FROM (SELECT event_id, k FROM log)")
def poll_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = lambda h: F.timestamp_seconds(F.lit(1_704_067_200) + 3600 * h)
    k = F.col("k")
    scheduled = k % 3 != 0  # releases at 6 and 12, now at k, last poll at k - 6; the others every 5 hours
    releases = F.when(scheduled & (k < 12), F.array(hour(F.lit(6)))).otherwise(F.array().cast("array<timestamp>"))
    last = F.when(scheduled, hour(k - 6)).otherwise(hour(k - F.when(k % 2 == 0, 5).otherwise(4)))
    return observations(spark, sf_dir).select("event_id", status.poll_due(hour(k), last, releases, F.when(~scheduled, 18_000)).alias("due"))


@query(LOG + "SELECT user_id, max(ts) < TIMESTAMP '2024-01-30 20:00:00' AS stale FROM log GROUP BY 1")
def staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = observations(spark, sf_dir).groupBy("user_id").agg(F.max("ts").alias("at"))
    return last.select("user_id", status.is_stale(instant("2024-01-31 00:00:00"), F.col("at"), 4 * 3600).alias("stale"))


@query("""SELECT l_orderkey, l_linenumber, round((l_quantity - 25) * 0.35, 9) AS pregame_prior, round(l_linenumber / 9.0, 9) AS inning_norm, CAST(l_returnflag = 'R' AS INT) * 1.0 AS is_bottom, (l_partkey % 5 - l_suppkey % 4) / 4.0 AS lead_norm, round((l_partkey % 5 - l_suppkey % 4) * l_discount / 4, 9) + 0.0 AS lead_late FROM lineitem""")
def run_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit(0.0)
    s = {
        "score_home": F.col("l_partkey") % 5, "score_away": F.col("l_suppkey") % 4, "exp_home": F.col("l_quantity"), "exp_away": F.lit(25), "inning": F.col("l_linenumber"), "half": F.when(F.col("l_returnflag") == "R", "bottom").otherwise("top"),
        "outs": zero, "on_first": zero, "on_second": zero, "on_third": zero, "progress": F.col("l_discount"), "pitcher": zero, "bullpen": zero, "bullpen_left": zero, "lineup": zero, "is_home": zero,
    }
    f = status.run_features(s)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *[(F.round(f[c], 9) + 0.0).alias(c) for c in ("pregame_prior", "inning_norm", "is_bottom", "lead_norm", "lead_late")])


@query("""SELECT l_orderkey, l_linenumber, round((l_quantity - 25) / 6.0, 9) AS pregame_prior, round((l_partkey % 5 - l_suppkey % 4) * (1 - l_discount) / 12, 9) AS lead_late, CASE l_returnflag WHEN 'R' THEN 1.0 WHEN 'A' THEN -1.0 ELSE 0.0 END AS possession FROM lineitem""")
def margin_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit(0.0)
    names = ("exp_total", "period", "pace", "timeouts_home", "timeouts_away", "fouls_home", "fouls_away", "strength_home", "strength_away", "availability_home", "availability_away")
    s = dict.fromkeys(names, zero) | {"score_home": F.col("l_partkey") % 5, "score_away": F.col("l_suppkey") % 4, "exp_margin": F.col("l_quantity") - 25, "time_left": F.col("l_discount")}
    s["possession"] = F.when(F.col("l_returnflag") == "R", "home").when(F.col("l_returnflag") == "A", "away")
    f = status.margin_features(s)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *[F.round(f[c], 9).alias(c) for c in ("pregame_prior", "lead_late", "possession")])


@query(LOG + """, h AS (SELECT event_id, user_id, ts, content, lag(content) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS was FROM log) SELECT event_id, was IS NULL OR was <> content AS novel FROM h""")
def report_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    return observations(spark, sf_dir).withColumn("was", F.lag("content").over(w)).select("event_id", (F.col("was").isNull() | (F.col("was") != F.col("content"))).alias("novel"))


@query("""WITH l AS (SELECT l_orderkey, list_sort(list_distinct(list(l_suppkey) FILTER (l_linenumber <= 3))) AS a, list_sort(list_distinct(list(l_suppkey) FILTER (l_linenumber >= 2))) AS b FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_sort(list_filter(coalesce(b, []), lambda x: NOT list_contains(coalesce(a, []), x))), ',') AS entered, array_to_string(list_sort(list_filter(coalesce(a, []), lambda x: NOT list_contains(coalesce(b, []), x))), ',') AS left_out FROM l""")
def lineup_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda c: F.collect_set(F.when(c, F.col("l_suppkey")))
    text = lambda ids: F.array_join(F.array_sort(ids).cast("array<string>"), ",")
    both = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(at(F.col("l_linenumber") <= 3).alias("a"), at(F.col("l_linenumber") >= 2).alias("b"))
    return both.select("l_orderkey", text(F.array_except("b", "a")).alias("entered"), text(F.array_except("a", "b")).alias("left_out"))


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS newest FROM orders GROUP BY 1")
def superseding_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey"))["o_orderkey"].alias("newest"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'ABC' WHEN s_suppkey % 4 = 1 THEN 'AB' END AS first, CASE WHEN s_suppkey % 4 = 0 THEN 'LAD' WHEN s_suppkey % 4 = 1 THEN 'LAC' END AS second FROM supplier")
def ticker_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("s_suppkey") % 4
    code = F.when(m == 0, "ABCLAD").when(m == 1, "ABLAC").when(m == 2, "XXYY").otherwise("NYNYN")
    found = texts.unique_split(code, ["ABC", "AB", "LAD", "LAC", "NY", "NYN", "YN"])  # NYNYN splits in two ways
    return read(spark, sf_dir, "supplier").select("s_suppkey", found["first"].alias("first"), found["second"].alias("second"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN 'scheduled' WHEN 'click' THEN 'live' WHEN 'purchase' THEN 'final' ELSE 'unknown' END AS status, CASE event_type WHEN 'view' THEN 'true' WHEN 'click' THEN 'false' END AS roof FROM events")
def status_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return read(spark, sf_dir, "events").select("event_id", texts.lookup(kind, {"view": "scheduled", "click": "live", "purchase": "final"}, "unknown").alias("status"), units.roof_applies(F.when(kind == "view", "open").when(kind == "click", "dome")).cast("string").alias("roof"))


@query("SELECT l_partkey, pos - 1 AS level_index, price, size FROM (SELECT l_partkey, price, size, row_number() OVER (PARTITION BY l_partkey ORDER BY price) AS pos FROM (SELECT l_partkey, l_linenumber AS price, CAST(sum(l_quantity) AS BIGINT) AS size FROM lineitem GROUP BY ALL))")
def ladder_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = read(spark, sf_dir, "lineitem").withColumn("q", F.col("l_quantity").cast("long"))
    return market.ladders(levels, ["l_partkey"], "l_linenumber", "q").select("l_partkey", F.posexplode("ladder").alias("level_index", "l")).select("l_partkey", "level_index", F.col("l.price").alias("price"), F.col("l.size").alias("size"))


@query("SELECT l_suppkey, round(sum(abs(l_quantity - 25)), 6) AS exposure, round(greatest(0, least(500, 60000 - sum(abs(l_quantity - 25)))), 6) AS allowed FROM lineitem GROUP BY 1")
def gross_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.pricing import allowed_size

    e = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum(F.abs(F.col("l_quantity") - 25)).alias("e"))
    return e.select("l_suppkey", F.round("e", 6).alias("exposure"), F.round(allowed_size(F.col("e"), F.lit(500.0), 60_000.0), 6).alias("allowed"))


@query("""WITH h AS (SELECT o_custkey AS a, o_orderkey % 7 AS b, o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 2 = 0), s AS (SELECT o_custkey AS b, o_orderkey % 7 AS a, o_orderkey AS other FROM orders WHERE o_orderkey % 2 = 1)
SELECT h.o_orderkey, s.other FROM h JOIN s ON h.a = s.a AND h.b = s.b""")
def swapped_orientation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    home = o.where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("a"), (F.col("o_orderkey") % 7).alias("b"), "o_orderkey")
    away = o.where("o_orderkey % 2 = 1").select(F.col("o_custkey").alias("b"), (F.col("o_orderkey") % 7).alias("a"), F.col("o_orderkey").alias("other"))
    return home.join(away, ["a", "b"]).select("o_orderkey", "other")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 OR c_custkey % 10 <= 7 THEN CASE WHEN c_custkey % 4 = 3 THEN false ELSE true END ELSE false END AS overlaps FROM customer""")
def season_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    debut = F.when(F.col("c_custkey") % 5 != 0, 2000 + F.col("c_custkey") % 10)
    final = F.when(F.col("c_custkey") % 4 == 3, 1999)
    return read(spark, sf_dir, "customer").select("c_custkey", resolve.seasons_overlap(debut, final, F.lit(2005), F.lit(2007)).alias("overlaps"))


@query(LOG + """, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, event_type) AS r FROM log WHERE ts <= TIMESTAMP '2024-01-15') SELECT user_id, date_trunc('day', ts) AS day, event_type FROM n WHERE r = 1""")
def capability_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = observations(spark, sf_dir).where(F.col("ts") <= instant("2024-01-15 00:00:00")).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    return provenance.newest_state(log, ["user_id"], "day", rank, "event_type")


@query("""WITH t AS (SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS parts FROM lineitem GROUP BY 1) SELECT o_orderkey, CASE WHEN parts IS NULL THEN CASE WHEN o_orderstatus = 'F' THEN 'final_without_data' END WHEN o_orderstatus = 'O' THEN 'score_before_final' WHEN parts % 10 <> 0 THEN 'total_differs' END AS finding FROM orders LEFT JOIN t ON l_orderkey = o_orderkey""")
def result_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_quantity").cast("long")).alias("parts"))
    both = read(spark, sf_dir, "orders").join(parts, "o_orderkey", "left").withColumn("total", F.col("parts") - F.col("parts") % 10)
    rules = [("final_without_data", F.col("parts").isNull() & (F.col("o_orderstatus") == "F")), ("score_before_final", F.col("parts").isNotNull() & (F.col("o_orderstatus") == "O")), ("total_differs", F.col("parts") != F.col("total"))]
    from tidemark.operators.quality import first_reason

    return both.select("o_orderkey", first_reason(rules).alias("finding"))


@query("SELECT o_custkey, count(*) AS n_rows, count(DISTINCT o_orderstatus) AS n_states, CASE WHEN count(DISTINCT o_orderpriority) > 4 THEN 'conflicting' WHEN count(*) < 3 THEN 'sparse' ELSE 'clean' END AS verdict FROM orders GROUP BY 1")
def identity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_rows"), F.count_distinct("o_orderstatus").alias("n_states"), F.count_distinct("o_orderpriority").alias("n_names"))
    return a.select("o_custkey", "n_rows", "n_states", F.when(F.col("n_names") > 4, "conflicting").when(F.col("n_rows") < 3, "sparse").otherwise("clean").alias("verdict"))


@query("SELECT o_orderpriority, count(*) AS pending FROM orders o WHERE o_orderstatus = 'P' AND NOT EXISTS (SELECT 1 FROM orders x WHERE x.o_custkey = o.o_custkey AND (x.o_orderdate, x.o_orderkey) > (o.o_orderdate, o.o_orderkey)) GROUP BY 1")
def pending_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = asof.newest_row(read(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return last.where("o_orderstatus = 'P'").groupBy("o_orderpriority").agg(F.count("*").alias("pending"))


@query(LOG + "SELECT user_id, event_type, first_observed_at, last_observed_at, latest FROM (SELECT user_id, event_type, min(ts) AS first_observed_at, max(ts) AS last_observed_at, arg_max(k, (ts, event_id)) AS latest FROM log GROUP BY ALL)")
def status_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = observations(spark, sf_dir).withColumn("latest", F.col("k"))
    return observe.upsert(log, ["user_id", "event_type"], "ts", "event_id", ["latest"])


@query("""WITH c AS (SELECT event_type, CAST(props->>'k' AS INT) AS provider, CAST(props->>'k' AS INT) * 2 AS internal FROM events) SELECT component, count(*) AS n, CAST(max(us) AS BIGINT) AS worst, CAST(sum(us) AS BIGINT) AS total FROM (SELECT 'provider' AS component, provider AS us FROM c UNION ALL SELECT 'internal', internal FROM c) GROUP BY 1""")
def latency_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = observations(spark, sf_dir).select(F.col("k").alias("provider"), (F.col("k") * 2).alias("internal")).unpivot([], ["provider", "internal"], "component", "us")
    return c.groupBy("component").agg(F.count("*").alias("n"), F.max("us").cast("long").alias("worst"), F.sum("us").alias("total"))


@query("SELECT phase, lead0, round(1 / (1 + exp(-(lead0 * 0.35 * (1 + phase)))), 9) AS p FROM (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0]) AS phase), (SELECT unnest(range(-5, 6)) AS lead0)")
def probability_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.models import surface

    s = surface(spark, [0.0, 0.25, 0.5, 0.75, 1.0], range(-5, 6), F.col("lead") * 0.35 * (1 + F.col("phase")))
    return s.select("phase", F.col("lead").cast("long").alias("lead0"), F.round("p", 9).alias("p"))
