"""Queries over the event pipeline, synthetic data, trained models and further rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import status, texts, times, units
from tidemark.operators import entities, market, models, observe, provenance, resolve, stats
from tidemark.plans.registering import LOG, instant, observations, query, read
from tidemark.streaming import sequence


@query(LOG + """, a AS (SELECT CAST(user_id AS VARCHAR) AS stream_key, k % 50 AS c, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS arrival FROM log),
s AS (SELECT *, event_id % 20 > 0 AS ok, c % 13 = 0 AS fails, CASE WHEN event_id % 20 > 0 THEN row_number() OVER (PARTITION BY stream_key, c, event_id % 20 > 0 ORDER BY arrival) END AS n FROM a),
t AS (SELECT *, CASE WHEN NOT ok THEN 'schema_mismatch' WHEN fails THEN CASE WHEN 1 + event_id % 4 >= 3 THEN 'dead_letter' ELSE 'retry' END WHEN n > 1 THEN 'duplicate' WHEN event_id % 9 = 0 THEN 'correction' ELSE 'delivered' END AS status FROM s)
SELECT stream_key, arrival, CASE WHEN status IN ('schema_mismatch', 'dead_letter') THEN 'term' WHEN status = 'retry' THEN 'retry' ELSE 'ack' END AS action, status, CAST(status IN ('delivered', 'correction') AS BIGINT) AS n_delivered FROM t""")
def event_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema gate, dedup, corrections, retries and dead letters over unsequenced streams; tests cover sequences."""
    log, code = observations(spark, sf_dir), F.col("k") % 50
    n = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    events = log.select(
        F.col("user_id").cast("string").alias("stream_key"), n.alias("arrival"), (F.col("event_id") % 20 > 0).alias("supported"), code.cast("string").alias("content"), F.lit(False).alias("redelivered"), (F.col("event_id") % 9 == 0).alias("corrects"),
        F.lit(None).cast("long").alias("sequence"), (code % 13 == 0).alias("fails"), (1 + F.col("event_id") % 4).alias("deliveries"),
    )
    return sequence.pipeline(events, most=3)


U = "((((o_orderkey % 1000003) * 2654435 + {0} * 40503 + 12345) % 1000003) * (((o_orderkey % 1000003) * 2654435 + {0} * 40503 + 12345) % 1000003) % 1000003)::DOUBLE / 1000003"


@query(f"""WITH g AS (SELECT o_orderkey, {U.format(1)} AS phase, CAST(floor({U.format(2)} * 21) AS BIGINT) - 10 AS lead, {U.format(3)} AS u FROM orders), p AS (SELECT *, 1 / (1 + exp(-(lead * 0.25 / sqrt(1.0 - phase + 0.05)))) AS p FROM g)
SELECT o_orderkey, round(phase, 9) AS phase, lead, round(p, 9) AS p, CAST(u < p AS INT)::DOUBLE AS label FROM p""")
def synthetic_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = models.synthetic(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    return g.select("o_orderkey", F.round("phase", 9).alias("phase"), "lead", F.round("p", 9).alias("p"), "label")


@query()
def training_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training pipeline over synthetic games: how the champion is calibrated on later games, against the truth."""
    g = models.synthetic(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey").withColumnRenamed("p", "truth")
    rows = g.withColumn("pressure", F.col("lead") / F.sqrt(1.05 - F.col("phase")))
    scored, _ = models.training_run(rows, ["pressure", "phase"], ["o_orderdate", "o_orderkey"], "o_orderkey")
    return stats.calibration(scored.withColumn("y", F.col("label")), "p", "y")


@query("""WITH h AS (SELECT o_orderkey AS a, o_custkey, o_orderdate AS ht, o_orderpriority AS provider FROM orders WHERE o_orderkey % 2 = 0), g AS (SELECT o_orderkey AS b, o_custkey, o_orderdate AS bt, o_orderpriority AS provider FROM orders WHERE o_orderkey % 2 = 1)
SELECT a, b, CASE WHEN abs(epoch_us(ht) - epoch_us(bt)) <= 86400000000 * 10 THEN 1 ELSE 2 END AS tier FROM h JOIN g ON h.o_custkey = g.o_custkey AND h.provider <> g.provider WHERE abs(epoch_us(ht) - epoch_us(bt)) <= 86400000000 * 60""")
def matches_of_other_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "provider")
    h = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("a"), "o_custkey", F.col("o_orderdate").alias("ht"), "provider")
    g = o.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("b"), "o_custkey", F.col("o_orderdate").alias("bt"), "provider")
    return resolve.window_matches(h, g, ["o_custkey"], "a", "b", "ht", "bt", [86_400 * 10, 86_400 * 60], ["provider"])


@query("""SELECT x.o_orderkey AS a, y.o_orderkey AS b FROM orders x JOIN orders y ON x.o_custkey % 1000 = y.o_orderkey % 1000 AND x.o_orderkey % 1000 = y.o_custkey % 1000""")
def swapped_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumns({"home": F.col("o_custkey") % 1000, "away": F.col("o_orderkey") % 1000})
    return entities.swapped(o.select("home", "away", F.col("o_orderkey").alias("a")), o.select("home", "away", F.col("o_orderkey").alias("b")), "home", "away").select("a", "b")


@query(LOG + """, m AS (SELECT user_id, ts, event_id, event_type = 'purchase' AS ends, lag(event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM log),
r AS (SELECT *, sum(CAST(NOT ends AND coalesce(was, true) AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM m)
SELECT user_id, min(ts) AS detected_at, min(ts) FILTER (ends) AS resolved_at, count(*) FILTER (NOT ends) AS n_seen FROM r WHERE run > 0 GROUP BY user_id, run""")
def quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe.issues(observations(spark, sf_dir), ["user_id"], "ts", "event_id", F.col("event_type") == "purchase")


@query("""WITH l AS (SELECT l_suppkey, l_shipdate, l_linenumber AS price, CAST(sum(l_quantity) AS BIGINT) AS size FROM lineitem GROUP BY ALL), b AS (SELECT l_suppkey, l_shipdate, string_agg(price || 'x' || (size // 20), ',' ORDER BY price) AS book FROM l GROUP BY ALL),
t AS (SELECT *, lag(book) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS was FROM b) SELECT l_suppkey, l_shipdate, book FROM t WHERE was IS NULL OR was <> book""")
def book_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books appended only where a ladder differs from the one before."""
    li = read(spark, sf_dir, "lineitem").withColumn("q", F.col("l_quantity").cast("long"))
    books = market.ladders(li, ["l_suppkey", "l_shipdate"], "l_linenumber", "q")
    text = F.array_join(F.transform("ladder", lambda x: F.concat(x["price"].cast("string"), F.lit("x"), F.floor(x["size"] / 20).cast("string"))), ",")
    return observe.transitions(books.withColumn("book", text), ["l_suppkey"], "l_shipdate", "book", "book").select("l_suppkey", "l_shipdate", "book")


@query("""WITH d AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'O' ELSE 'F' END AS declared FROM customer WHERE c_custkey % 5 > 0), o AS (SELECT o_custkey AS k, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS observed FROM orders WHERE o_custkey % 7 > 0 GROUP BY 1)
SELECT coalesce(d.k, o.k) AS k, declared, observed, CASE WHEN declared IS NULL THEN 'undeclared' WHEN observed IS NULL THEN 'unobserved' WHEN declared = observed THEN 'confirmed' ELSE 'contradicted' END AS verdict FROM d FULL JOIN o ON d.k = o.k""")
def declared_capability(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "customer").where("c_custkey % 5 > 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, "O").otherwise("F").alias("state"))
    seen = read(spark, sf_dir, "orders").where("o_custkey % 7 > 0").groupBy(F.col("o_custkey").alias("k")).agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus"))["o_orderstatus"].alias("state"))
    return provenance.capability(d, seen, ["k"], "state")


ROUND = "SELECT k, CASE WHEN st IS NOT NULL THEN st WHEN s.moved IS NULL THEN 'no_snapshot' WHEN s.moved = start THEN 'converged' END AS st, CASE WHEN st IS NULL AND s.moved IS NOT NULL AND s.moved <> start THEN s.moved ELSE start END AS start FROM {0} ASOF LEFT JOIN s ON {0}.k = s.sk AND {0}.start - INTERVAL 60 MINUTE >= s.seen"


@query(f"""WITH s AS (SELECT l_orderkey AS sk, l_shipdate AS seen, max(l_shipdate + INTERVAL (l_linenumber % 2 * 30) DAY) AS moved FROM lineitem GROUP BY 1, 2), r0 AS (SELECT o_orderkey AS k, CAST(NULL AS VARCHAR) AS st, o_orderdate + INTERVAL 90 DAY AS start FROM orders),
r1 AS ({ROUND.format("r0")}), r2 AS ({ROUND.format("r1")}), r3 AS ({ROUND.format("r2")}) SELECT k, coalesce(st, 'not_converged') AS status, CASE WHEN st = 'converged' THEN start END AS anchor FROM r3""")
def anchor_iteration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three rounds of the anchor iteration."""
    moved = F.col("l_shipdate") + F.make_dt_interval(F.col("l_linenumber") % 2 * 30)
    s = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("seen")).agg(F.max(moved).alias("moved"))
    t = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderdate") + F.make_dt_interval(F.lit(90))).alias("start"))
    return provenance.converge(t, s, ["k"], "start", "seen", "moved", 3600, rounds=3).select("k", "status", "anchor")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'unknown_zone' WHEN o_orderkey % 7 = 0 THEN 'abbreviation_differs' END AS reason, CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 7 > 0 THEN date_trunc('day', o_orderdate) + INTERVAL 19 HOUR + INTERVAL (CASE WHEN o_orderkey % 2 = 0 THEN 7 ELSE 0 END) HOUR END AS at FROM orders""")
def wall_clock_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall clocks of places without daylight saving; tests cover the hours that do not exist or come twice."""
    key = F.col("o_orderkey")
    zone = F.when(key % 5 == 0, "Nowhere").when(key % 2 == 0, "America/Phoenix").otherwise("UTC")
    said = F.when(key % 7 == 0, "PST").when(key % 2 == 0, "MST")
    at, reason = times.wall_clock(F.to_date("o_orderdate"), F.lit("19:00"), zone, said)
    return read(spark, sf_dir, "orders").select("o_orderkey", reason.alias("reason"), at.alias("at"))


STATE = """l_orderkey, l_linenumber, CAST(l_partkey % 5 AS DOUBLE) AS sh, CAST(l_suppkey % 4 AS DOUBLE) AS sa, CAST(l_linenumber AS DOUBLE) AS n, CAST(l_partkey % 3 AS DOUBLE) AS p3, l_discount AS d, l_tax AS t, l_quantity AS q, l_returnflag AS f"""


@query(f"""WITH s AS (SELECT {STATE} FROM lineitem) SELECT l_orderkey, l_linenumber, round((q - 25) * 0.35, 9) AS pregame_prior, round(n / 9, 9) AS inning_norm, CAST(f = 'R' AS INT)::DOUBLE AS is_bottom, round(p3 / 2, 9) AS outs_norm, CAST(p3 = 0 AS INT)::DOUBLE AS on_first, CAST(p3 = 1 AS INT)::DOUBLE AS on_second,
CAST(p3 = 2 AS INT)::DOUBLE AS on_third, round((sh - sa) / 4, 9) AS lead_norm, round((sh - sa) * d / 4, 9) + 0.0 AS lead_late, round(t, 9) AS pitcher, round(t * 2, 9) AS bullpen, round(d * 2, 9) AS bullpen_left, round(n / 9, 9) AS lineup_norm, CAST(f = 'A' AS INT)::DOUBLE AS is_home FROM s""")
def run_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fourteen features of a baseball state."""
    c = F.col
    p3 = (c("l_partkey") % 3).cast("double")
    s = {
        "score_home": (c("l_partkey") % 5).cast("double"), "score_away": (c("l_suppkey") % 4).cast("double"), "exp_home": c("l_quantity"), "exp_away": F.lit(25), "inning": c("l_linenumber").cast("double"), "half": F.when(c("l_returnflag") == "R", "bottom").otherwise("top"),
        "outs": p3, "on_first": p3 == 0, "on_second": p3 == 1, "on_third": p3 == 2, "progress": c("l_discount"), "pitcher": c("l_tax"), "bullpen": c("l_tax") * 2, "bullpen_left": c("l_discount") * 2, "lineup": c("l_linenumber").cast("double"), "is_home": c("l_returnflag") == "A",
    }
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *[(F.round(x, 9) + 0.0).alias(k) for k, x in status.run_features(s).items()])


@query(f"""WITH s AS (SELECT {STATE} FROM lineitem) SELECT l_orderkey, l_linenumber, round((q - 25) / 6.0, 9) AS pregame_prior, round(q * 5 / 220, 9) AS total_norm, round(n / 4, 9) AS period_norm, round(d, 9) AS time_left, round((sh - sa) / 12, 9) AS lead_norm, round((sh - sa) * (1 - d) / 12, 9) AS lead_late,
CASE f WHEN 'R' THEN 1.0 WHEN 'A' THEN -1.0 ELSE 0.0 END::DOUBLE AS possession, round(q * 2 / 100, 9) AS pace_norm, round(p3 / 7, 9) AS timeouts_home, round(sa / 7, 9) AS timeouts_away, round((p3 - sa) / 5, 9) AS fouls, round((q - n) / 10, 9) AS strength, round(d - t, 9) AS availability FROM s""")
def margin_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All thirteen features of a basketball state."""
    c = F.col
    p3, sa, n = (c("l_partkey") % 3).cast("double"), (c("l_suppkey") % 4).cast("double"), c("l_linenumber").cast("double")
    s = {
        "exp_margin": c("l_quantity") - 25, "exp_total": c("l_quantity") * 5, "period": n, "time_left": c("l_discount"), "score_home": (c("l_partkey") % 5).cast("double"), "score_away": sa, "possession": F.when(c("l_returnflag") == "R", "home").when(c("l_returnflag") == "A", "away"),
        "pace": c("l_quantity") * 2, "timeouts_home": p3, "timeouts_away": sa, "fouls_home": p3, "fouls_away": sa, "strength_home": c("l_quantity"), "strength_away": n, "availability_home": c("l_discount"), "availability_away": c("l_tax"),
    }
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *[(F.round(x, 9) + 0.0).alias(k) for k, x in status.margin_features(s).items()])


@query("""WITH v AS (SELECT event_id, CAST(props->>'k' AS INT) AS k, event_id % 6 AS m FROM events)
SELECT event_id, CASE m WHEN 0 THEN 'missing' WHEN 1 THEN 'range' WHEN 2 THEN 'unknown_unit' WHEN 3 THEN 'no_number' WHEN 4 THEN 'out_of_range' END AS note, CASE WHEN m = 5 THEN k * 25.4 END::DOUBLE AS mm FROM v""")
def unit_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, m = F.col("k").cast("string"), F.col("event_id") % 6
    value = F.when(m == 1, F.concat(k, F.lit(" to "), F.lit("200"))).when(m == 3, "heavy").when(m == 4, F.concat(F.lit("-"), (F.col("k") + 1).cast("string"))).when(m != 0, k)
    unit = F.when(m == 2, "furlongs").otherwise("inches")
    mm = F.when(m.isin(1, 2, 3), None).otherwise(units.millimetres(value, unit))
    known = units.MILLIMETRES + units.METRES + units.INCHES
    return observations(spark, sf_dir).select("event_id", units.noted(value, unit, mm, known, 0.0).alias("note"), F.round(mm, 6).alias("mm"))


@query("""SELECT l_orderkey, l_linenumber, round(l_tax * 12, 9) AS horizontal, round(l_discount * 12, 9) AS vertical, round(sqrt(pow(l_tax * 12, 2) + pow(l_discount * 12, 2)), 9) AS total, CASE WHEN l_linenumber % 3 = 0 THEN l_quantity END AS speed,
CASE WHEN l_linenumber % 2 = 0 THEN 'none' WHEN l_linenumber % 3 = 0 THEN 'national' ELSE 'global' END AS provider FROM lineitem""")
def pitch_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    across, down, total = units.pitch_movement(c("l_tax"), c("l_discount"))
    speed = units.typed(F.when(c("l_linenumber") % 3 == 0, c("l_quantity").cast("string")).when(c("l_linenumber") % 3 == 1, " ").otherwise("fast"))
    provider = units.weather_provider(F.when(c("l_linenumber") % 3 == 0, "us").otherwise("ca"), F.when(c("l_linenumber") % 2 == 0, "dome").otherwise("open"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(across, 9).alias("horizontal"), F.round(down, 9).alias("vertical"), F.round(total, 9).alias("total"), speed.alias("speed"), provider.alias("provider"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 'no_price' WHEN l_partkey % 101 NOT BETWEEN 1 AND 99 THEN 'price_out_of_range' WHEN l_suppkey % 7 = 0 THEN 'prices_disagree' WHEN l_quantity < 2 THEN 'no_quantity' WHEN l_returnflag = 'N' THEN 'unknown_side' END AS trade,
CASE WHEN l_linenumber = 2 THEN 'no_ticker' WHEN l_linenumber = 3 THEN 'ticker_of_other_event' WHEN l_shipdate > TIMESTAMP '2000-01-01' THEN 'closes_before_open' WHEN l_linestatus = 'O' THEN 'unknown_status' END AS market,
CASE WHEN l_returnflag = 'N' THEN 'unknown_side' WHEN l_partkey % 101 NOT BETWEEN 1 AND 99 THEN 'price_out_of_range' WHEN l_quantity < 2 THEN 'no_size' WHEN l_linenumber = 1 THEN 'no_quote' WHEN l_partkey % 101 > 60 THEN 'above_quote' WHEN l_suppkey % 3 = 0 AND l_tax > 0.04 THEN 'resubmission' END AS order_ FROM lineitem""")
def record_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    price, line = c("l_partkey") % 101, c("l_linenumber")
    side, count = F.when(c("l_returnflag") == "N", "maybe").otherwise("yes"), F.when(c("l_quantity") >= 2, c("l_quantity"))
    said = F.when(line > 1, price)
    trade = status.trade_problem(said, F.when(line > 1, 100 - price + F.when(c("l_suppkey") % 7 == 0, 1).otherwise(0)), count, side)
    ticker = F.when(line == 2, " ").when(line == 3, "B-1").otherwise("A-1")
    market = status.market_problem(ticker, F.lit("A"), c("l_shipdate"), instant("2000-01-01 00:00:00"), F.when(c("l_linestatus") == "O", "odd").otherwise("open"))
    order = status.order_problem(side, price, count, F.when(line > 1, F.lit(60)), c("l_suppkey") % 3 == 0, c("l_tax") > 0.04)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", trade.alias("trade"), market.alias("market"), order.alias("order_"))


@query("""WITH o AS (SELECT *, CASE WHEN year(o_orderdate) < 2000 THEN o_orderdate + INTERVAL 100 YEAR ELSE o_orderdate END AS day FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN CAST(CAST(day AS DATE) AS VARCHAR) END AS day, CASE WHEN o_orderkey % 4 IN (2, 3) THEN '19:05' END AS clock, CASE WHEN o_orderkey % 4 > 0 THEN 'NYYBOS' END AS teams, CASE WHEN o_orderkey % 4 = 3 THEN 'T8.5' END AS suffix, 'Team ' || (o_custkey % 7) AS team, 'Team ' || (o_orderkey % 7) AS opponent, '7:05 PM' AS clock_said, 'EDT' AS zone FROM o""")
def ticker_and_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, text = F.col("o_orderkey"), lambda *parts: F.concat(*[p if isinstance(p, F.Column) else F.lit(p) for p in parts])
    day = F.upper(F.date_format("o_orderdate", "yyMMMdd"))
    ticker = F.when(key % 4 == 0, "not a ticker").when(key % 4 == 1, text("GAME-", day, "NYYBOS")).when(key % 4 == 2, text("GAME-", day, "1905NYYBOS")).otherwise(text("GAME-", day, "1905NYYBOS-T8.5"))
    t = texts.ticker_parts(ticker)
    rules = text("If the Team ", (F.col("o_custkey") % 7).cast("string"), " win their game against the Team ", (key % 7).cast("string"), " originally scheduled for Jul 4, 2024 at 7:05 PM EDT, the market resolves to Yes.")
    r = texts.rules_text(rules)
    return read(spark, sf_dir, "orders").select("o_orderkey", t["date"].cast("string").alias("day"), t["clock"].alias("clock"), t["teams"].alias("teams"), t["suffix"].alias("suffix"), r["team"].alias("team"), r["opponent"].alias("opponent"), r["clock"].alias("clock_said"), r["zone"].alias("zone"))


@query("""SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) || CASE WHEN l_linenumber > 4 THEN 'OT' ELSE 'Q' END AS period, CAST(max(l_quantity) AS BIGINT) AS home, CAST(min(l_quantity) AS BIGINT) AS away FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def period_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters and whatever overtimes a JSON map holds."""
    name = F.concat(F.col("l_linenumber").cast("string"), F.when(F.col("l_linenumber") > 4, "OT").otherwise("Q"))
    li = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", name.alias("period")).agg(F.struct(F.max("l_quantity").cast("long").alias("home"), F.min("l_quantity").cast("long").alias("away")).alias("s"))
    body = li.groupBy("l_orderkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("period", "s")))).alias("body"))
    return body.select("l_orderkey", F.explode(texts.period_scores(F.col("body"))).alias("p")).select("l_orderkey", "p.period", "p.home", "p.away")


@query(LOG + """, p AS (SELECT user_id, ts, event_id, CASE WHEN event_type = 'purchase' AND user_id % 3 > 0 THEN 'end' ELSE 'play' END AS st, CASE WHEN k = 0 AND user_id % 2 = 0 THEN ts - INTERVAL 90 DAY ELSE ts END AS said FROM log),
w AS (SELECT *, coalesce(said < lag(said) OVER x, false) AS back, lead(1) OVER x IS NULL AS last FROM p WINDOW x AS (PARTITION BY user_id ORDER BY ts, event_id)), g AS (SELECT user_id, count(*) AS n_plays, count(*) FILTER (st = 'end') AS ends, bool_or(st = 'end' AND NOT last) AS after, bool_or(back) AS back, max(said) FILTER (st = 'end') AS done FROM w GROUP BY 1),
v AS (SELECT *, CASE WHEN ends = 0 THEN 'no_end' WHEN ends > 1 THEN 'several_ends' WHEN after THEN 'plays_after_end' WHEN back THEN 'time_runs_back' ELSE 'complete' END AS verdict FROM g) SELECT user_id, n_plays, CASE WHEN verdict = 'complete' THEN done END AS completed_at, verdict FROM v""")
def completion_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = observations(spark, sf_dir)
    state = F.when((F.col("event_type") == "purchase") & (F.col("user_id") % 3 > 0), "end").otherwise("play")
    at = F.when((F.col("k") == 0) & (F.col("user_id") % 2 == 0), F.col("ts") - F.expr("INTERVAL 90 DAYS")).otherwise(F.col("ts"))
    return provenance.completion_verdict(log.withColumns({"state": state, "at": at}), "user_id", ["ts", "event_id"], "state", "at")


@query("""WITH e AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 6 > 0), f AS (SELECT o_orderkey AS k, o_orderkey % 17 = 0 AS off, o_orderkey % 23 > 0 AS body FROM orders WHERE o_orderkey % 7 > 0)
SELECT coalesce(e.k, f.k) AS k, CASE WHEN e.k IS NULL THEN 'unplanned' ELSE 'not_acquired' END AS failure FROM e FULL JOIN f ON e.k = f.k WHERE e.k IS NULL OR f.k IS NULL UNION ALL SELECT k, 'body_missing' FROM f WHERE NOT body UNION ALL SELECT k, 'hash_differs' FROM f WHERE body AND off""")
def stage_certification(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).withColumn("body", F.concat(F.lit("body "), F.col("k").cast("string")))
    found = o.where("k % 7 > 0").select("k", F.when(F.col("k") % 17 == 0, F.sha2(F.lit("else"), 256)).otherwise(F.sha2("body", 256)).alias("body_hash"))
    return provenance.certification_failures(o.where("k % 6 > 0").select("k"), found, o.where("k % 23 > 0"), ["k"])


@query("""WITH p AS (SELECT p_brand, sum(p_size) AS least_requests, sum(p_size * 2) AS most_requests, sum(p_size * 10) AS least_credits, sum(p_size * 2 * 30) AS most_credits FROM part GROUP BY 1) SELECT *, CASE WHEN most_credits <= 100000 THEN 'within' WHEN least_credits <= 100000 THEN 'may_exceed' ELSE 'exceeds' END AS verdict FROM p""")
def credit_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_brand", F.col("p_size").cast("long").alias("lo"), (F.col("p_size") * 2).cast("long").alias("hi"), F.lit(10).cast("long").alias("cheap"), F.lit(30).cast("long").alias("dear"))
    return provenance.credit_bounds(p, "lo", "hi", "cheap", "dear", 100_000, ["p_brand"])


@query("""WITH g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 > 0 THEN o_custkey % 400 END AS id, CASE WHEN o_orderkey % 11 > 0 THEN o_custkey % 2 END AS home, o_custkey % 400 % 3 AS away FROM orders), n AS (SELECT id, count(DISTINCT (home, away)) AS n FROM g GROUP BY 1)
SELECT o_orderkey, CASE WHEN g.id IS NULL THEN 'id_missing' WHEN home IS NULL OR away IS NULL THEN 'team_missing' WHEN home = away THEN 'plays_itself' WHEN n > 1 THEN 'id_reused' ELSE 'clean' END AS finding FROM g LEFT JOIN n ON n.id = g.id""")
def identity_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    g = read(spark, sf_dir, "orders").select("o_orderkey", F.when(c("o_orderkey") % 13 > 0, c("o_custkey") % 400).alias("id"), F.when(c("o_orderkey") % 11 > 0, c("o_custkey") % 2).alias("home"), (c("o_custkey") % 400 % 3).alias("away"))
    return provenance.identity_findings(g, "id", ["home", "away"]).select("o_orderkey", "finding")


@query(LOG + """, b AS (SELECT *, lag(['live', 'postponed', 'live', 'final', 'suspended'][1 + k % 5]) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was, ['live', 'postponed', 'live', 'final', 'suspended'][1 + k % 5] AS now, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM log)
SELECT event_id, CASE WHEN coalesce(was, '') NOT IN ('postponed', 'suspended') AND now IN ('postponed', 'suspended') THEN 'postponed' WHEN was IN ('postponed', 'suspended') AND now NOT IN ('postponed', 'suspended') THEN 'resumed' END AS change, (epoch_us(ts) - epoch_us(before)) * 1000 AS provider_ns,
CASE k % 3 WHEN 0 THEN ts + INTERVAL 6 HOUR WHEN 1 THEN ts END AS available FROM b""")
def postponements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postponed and resumed games, the time between envelopes, and availability under a rule whose digest must match."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    said = F.element_at(F.array(*[F.lit(x) for x in ("live", "postponed", "live", "final", "suspended")]), (F.col("k") % 5 + 1).cast("int"))
    rows = observations(spark, sf_dir).withColumn("now", said).withColumns({"was": F.lag("now").over(w), "before": F.lag("ts").over(w)})
    rule = F.when(F.col("k") % 3 == 0, "late").otherwise("at_once")
    at = times.rule_instant(rule, F.when(F.col("k") % 3 == 2, "forged").otherwise("d"), F.col("ts"), {"late": (6, "d"), "at_once": (0, "d")})
    return rows.select("event_id", status.postponement(F.col("was"), F.col("now")).alias("change"), times.latency_ns(F.col("before"), F.col("ts")).alias("provider_ns"), at.alias("available"))
