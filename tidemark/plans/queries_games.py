"""Queries over game state, routing, replays and backtests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import games
from tidemark.operators.slices import by_seconds
from tidemark.plans.registering import LOG, instant, observations, query

NUMBERED = LOG + ", e AS (SELECT user_id AS entity, ts, event_id, event_id % 8 AS m, k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM log) "
ORDER = ["ts", "event_id"]
WEEK = by_seconds(7 * 86_400)


def _json(**values) -> F.Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]), {"ignoreNullFields": "false"})


def _envelopes(spark: SparkSession, sf_dir: str, kinds: list[str], payloads: list[F.Column]) -> DataFrame:
    """Every user's events as the envelopes of one game; the kind goes by the event's number."""
    m, log = F.col("event_id") % len(kinds), observations(spark, sf_dir)
    of = lambda values: F.element_at(F.array(*values), (m + 1).cast("int"))
    return log.select(F.col("user_id").alias("entity"), "ts", "event_id", "k", of([F.lit(x) for x in kinds]).alias("event_type"), of(payloads).alias("payload"))


def _baseball(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    side = F.when(k % 2 == 0, "home").otherwise("away")
    payloads = [
        _json(count=1 + k % 3, pitcher=F.concat(F.lit("P"), k % 3)), _json(outs=F.lit(1)), _json(team=side, runs=k % 4), _json(inning=1 + k % 9, half=F.when(k % 2 == 0, "top").otherwise("bottom")),
        F.to_json(F.create_map(F.lit("1B"), F.when(k % 2 == 1, F.concat(F.lit("R"), k)))), _json(batter=F.concat(F.lit("B"), k)), _json(status=F.when(k % 3 == 0, "live").when(k % 3 == 1, "delayed").otherwise("odd")),
        F.to_json(F.struct((k % 3).alias("outs"), F.struct(k.alias("home")).alias("score"))),
    ]
    return _envelopes(spark, sf_dir, ["pitch", "out", "score", "inning", "bases", "at_bat", "status", "correction"], payloads)


@query(NUMBERED + """, x AS (SELECT entity, coalesce(max(n) FILTER (m IN (3, 7)), 0) AS so, coalesce(max(n) FILTER (m = 7), 0) AS ss FROM e GROUP BY 1)
SELECT entity, CAST(coalesce(max(CASE WHEN n = so THEN CASE WHEN m = 3 THEN 0 ELSE k % 3 END END), 0) + count(*) FILTER (m = 1 AND n > so) AS VARCHAR) AS outs,
CAST(coalesce(max(CASE WHEN n = ss THEN k END), 0) + coalesce(sum(k % 4) FILTER (m = 2 AND k % 2 = 0 AND n > ss), 0) AS VARCHAR) AS home, CAST(coalesce(sum(k % 4) FILTER (m = 2 AND k % 2 = 1), 0) AS VARCHAR) AS away,
CAST(arg_max(1 + k % 9, n) FILTER (m = 3) AS VARCHAR) AS inning, arg_max(CASE WHEN k % 2 = 0 THEN 'top' ELSE 'bottom' END, n) FILTER (m = 3) AS half, arg_max(CASE WHEN m = 4 AND k % 2 = 1 THEN 'R' || k ELSE '' END, n) FILTER (m IN (3, 4)) AS first_base,
CAST(coalesce(sum(1 + k % 3) FILTER (m = 0), 0) AS VARCHAR) AS pitches, arg_max('B' || k, n) FILTER (m = 5) AS batter FROM e JOIN x USING (entity) GROUP BY 1""")
def baseball_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = games.baseball_fields(_baseball(spark, sf_dir), ORDER)
    wide = state.groupBy("entity").pivot("field", ["outs", "score.home", "score.away", "inning", "half", "1B", "pitches", "batter"]).agg(F.first("value"))
    none = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit("0"))
    return wide.select("entity", none("outs").alias("outs"), none("score.home").alias("home"), none("score.away").alias("away"), "inning", "half", F.col("1B").alias("first_base"), none("pitches").alias("pitches"), "batter")


@query(NUMBERED + """, x AS (SELECT entity, coalesce(max(n) FILTER (m = 0), 0) AS sp FROM e GROUP BY 1)
SELECT entity, CAST(arg_max(1 + k % 4, n) FILTER (m = 0) AS VARCHAR) AS period, arg_max(CASE WHEN m = 0 THEN 720 ELSE k END, n) FILTER (m IN (0, 1)) AS clock, CAST(coalesce(sum(k % 4) FILTER (m = 2 AND k % 2 = 0), 0) AS BIGINT) AS home,
arg_max(CASE WHEN k % 2 = 0 THEN 'home' ELSE 'away' END, n) FILTER (m = 3) AS possession, greatest(0, 7 - count(*) FILTER (m = 4)) AS timeouts, count(*) FILTER (m IN (5, 6) AND n > sp) AS fouls,
(SELECT count(*) FROM (SELECT arg_max(m2, n2) AS last FROM (SELECT y.k % 5 AS p, y.k % 2 AS m2, y.n AS n2 FROM e y WHERE y.entity = e.entity AND y.m = 7) GROUP BY p) WHERE last = 1) AS on_court
FROM e JOIN x USING (entity) GROUP BY entity""")
def basketball_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    side, player = F.when(k % 2 == 0, "home").otherwise("away"), F.concat(F.lit("P"), k % 5)
    payloads = [
        _json(period=1 + k % 4), _json(clock_seconds=k), _json(team=side, points=k % 4), _json(team=side), _json(team=F.lit("home")), _json(team=F.lit("home")), _json(player=player, team=F.lit("home")),
        F.when(k % 2 == 1, F.to_json(F.create_map(F.lit("in"), player))).otherwise(F.to_json(F.create_map(F.lit("out"), player))),
    ]
    events = _envelopes(spark, sf_dir, ["period", "clock", "score", "possession", "timeout", "team_foul", "player_foul", "substitution"], payloads)
    state = games.fields(events, games.basketball_effects(), ORDER)
    value = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    number = lambda f: F.coalesce(value(f).cast("long"), F.lit(0))
    return state.groupBy("entity").agg(
        value("period").alias("period"), value("clock_seconds").cast("double").cast("int").alias("clock"), number("score.home").alias("home"), value("possession").alias("possession"),
        F.greatest(F.lit(0).cast("long"), 7 - number("timeouts_taken.home")).alias("timeouts"), number("fouls.home").alias("fouls"), F.count_if(F.col("field").startswith("court.home.") & (F.col("value") == "1")).alias("on_court"),
    )


@query(LOG + """SELECT event_id, CASE WHEN k % 3 = 0 THEN 'g' || (k % 7) WHEN k % 3 = 1 THEN 'm' || (k % 5) ELSE CAST(user_id AS VARCHAR) END AS entity, CASE event_type WHEN 'view' THEN 'baseball' WHEN 'click' THEN 'book' END AS kind,
CASE WHEN event_type NOT IN ('view', 'click') THEN 'no route for ' || event_type END AS rejected FROM log""")
def state_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("k"), lambda p, n: F.concat(F.lit(p), (F.col("k") % n).cast("string"))
    body = F.when(k % 3 == 0, F.to_json(F.create_map(F.lit("game_id"), name("g", 7)))).when(k % 3 == 1, F.to_json(F.create_map(F.lit("market"), name("m", 5)))).otherwise("{}")
    e = observations(spark, sf_dir).select("event_id", F.col("event_type").alias("subject"), F.col("user_id").cast("string").alias("stream_key"), F.lit("p").alias("provider"), body.alias("payload"))
    return games.route(e, {"view": "baseball", "click": "book"}).select("event_id", "entity", "kind", "rejected")


@query(NUMBERED + """, t AS (SELECT *, CASE m WHEN 6 THEN k % 3 END AS st FROM e), f AS (SELECT entity, m, count(*) AS c FROM e GROUP BY ALL)
SELECT t.entity, max(event_id) FILTER (m <> 7) AS last_sequence, max(ts) AS last_at, count(*) AS n_events, count(*) FILTER (m = 7) AS n_corrections, false AS missing_field, coalesce(bool_or(st = 2), false) AS out_of_range,
max(ts) < TIMESTAMP '2024-01-25 00:00:00' AS stale, any_value(h.n_fields) AS n_fields, any_value(h.state_hash) AS state_hash FROM t
JOIN (SELECT entity, count(*) AS n_fields, sha256(string_agg('kind' || m || '=' || c, chr(10) ORDER BY m)) AS state_hash FROM f GROUP BY 1) h ON h.entity = t.entity GROUP BY t.entity""")
def state_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _baseball(spark, sf_dir)
    state = events.groupBy("entity", F.concat(F.lit("kind"), (F.col("event_id") % 8).cast("string")).alias("field")).agg(F.count("*").cast("string").alias("value"))
    known = ["pitch", "out", "score", "inning", "bases", "at_bat", "status"]
    return games.snapshots(events, state, "ts", "event_id", instant("2024-01-26 00:00:00"), 86_400, known, ["live", "delayed"])


@query(LOG + """, g AS (SELECT user_id % 40 AS dataset, count(*) AS n, count(*) FILTER (k = 0) AS untimed, count(*) FILTER (event_type IN ('view', 'click')) AS books, count(*) FILTER (event_type = 'purchase' AND user_id % 3 = 0) AS trades,
count(*) FILTER (event_type = 'signup' AND user_id % 2 = 0) AS statuses, count(*) FILTER (event_type IN ('view', 'click') AND k % 50 = 1) AS unpublished FROM log GROUP BY 1), s AS (SELECT *, (trades = 0)::INT + (statuses = 0)::INT + (unpublished > 0)::INT AS n_notes, untimed = 0 AND books > 0 AS execution_valid FROM g)
SELECT dataset, n, n_notes, execution_valid, CASE WHEN execution_valid THEN round(1 - 0.1 * n_notes, 6) ELSE 0 END::DOUBLE AS score, CASE WHEN NOT execution_valid THEN 'F' WHEN n_notes = 0 THEN 'A' WHEN n_notes = 1 THEN 'B' WHEN n_notes <= 3 THEN 'C' ELSE 'D' END AS grade FROM s""")
def dataset_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, u, kind = F.col("k"), F.col("user_id"), F.col("event_type")
    named = F.when(kind == "view", "ob_snapshot").when(kind == "click", "ob_delta").when((kind == "purchase") & (u % 3 == 0), "trade").when((kind == "signup") & (u % 2 == 0), "market_status").otherwise("other")
    e = observations(spark, sf_dir).select((u % 40).alias("dataset"), named.alias("kind"), F.when(k > 0, F.col("ts")).alias("at"), F.when(k % 50 != 1, F.col("ts")).alias("published"))
    return games.dataset_grade(e, "kind", "at", "published", ["dataset"]).select("dataset", "n", "n_notes", "execution_valid", "score", "grade")


BOOKS = LOG + """, b0 AS (SELECT user_id AS market, ts, event_id, event_id % 6 = 0 AS snap, CASE WHEN k % 5 > 0 THEN 20 + k % 40 END AS ask, CASE WHEN k % 7 = 0 THEN 'halted' WHEN k % 7 < 5 THEN 'open' END AS st FROM log),
b1 AS (SELECT *, sum(CAST(snap AS INT)) OVER (PARTITION BY market ORDER BY ts, event_id) AS ep FROM b0),
b AS (SELECT market, ts, event_id, last_value(ask IGNORE NULLS) OVER w AS yes_ask, last_value(st IGNORE NULLS) OVER w AS status FROM b1 WINDOW w AS (PARTITION BY market, ep ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))"""


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    rows = observations(spark, sf_dir).select(
        F.col("user_id").alias("market"), "ts", "event_id", F.when(k % 5 > 0, 20 + k % 40).alias("yes_ask"), F.when(k % 7 == 0, "halted").when(k % 7 < 5, "open").alias("status"),
    )
    return games.timelines(rows, "market", "ts", "event_id", F.col("event_id") % 6 == 0, ["yes_ask", "status"], WEEK)


@query(BOOKS + "SELECT market, ts, event_id, yes_ask, status FROM b")
def market_timelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _books(spark, sf_dir).select("market", "ts", "event_id", "yes_ask", "status")


@query(BOOKS + """, c AS (SELECT market, arg_max(yes_ask, (ts, event_id)) AS closing FROM b WHERE yes_ask IS NOT NULL GROUP BY 1),
t AS (SELECT user_id AS market, ts, event_id, k AS fair, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_at FROM log),
p AS (SELECT t.market, t.ts, t.fair, t.next_at, t.fair - 2 AS lim FROM t ASOF JOIN b ON t.market = b.market AND t.ts >= b.ts WHERE b.status = 'open' AND t.fair - b.yes_ask >= 2),
l AS (SELECT p.*, g AS latency_us, ts + to_microseconds(g) AS arrival FROM p, (SELECT unnest([0, 3600000000, 86400000000, 259200000000]) AS g)),
m AS (SELECT l.*, b.yes_ask AS ask, b.status, closing, coalesce(l.next_at <= l.arrival, false) AS stale FROM l ASOF LEFT JOIN b ON l.market = b.market AND l.arrival >= b.ts LEFT JOIN c ON c.market = l.market),
f AS (SELECT *, NOT stale AND coalesce(status = 'open', false) AS live, NOT stale AND coalesce(status = 'open', false) AND coalesce(ask <= lim, false) AS fill FROM m)
SELECT latency_us, count(*) AS n_orders, count(*) FILTER (live) AS n_actionable, count(*) FILTER (fill) AS n_fills, round(avg(CASE WHEN fill THEN fair - ask ELSE 0 END), 9) AS mean_profit, round(avg(fair - ask), 9) AS mean_edge, round(avg(closing - ask) FILTER (fill), 9) AS mean_clv FROM f GROUP BY 1""")
def full_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    triggers = observations(spark, sf_dir).select(F.col("user_id").alias("market"), "ts", "event_id", F.col("k").alias("fair"))
    decide = (F.col("status") == "open") & (F.col("fair") - F.col("yes_ask") >= 2)
    out = games.backtest(_books(spark, sf_dir), triggers, "market", "ts", "event_id", decide, F.col("fair") - 2, "fair", [0, 3_600_000_000, 86_400_000_000, 259_200_000_000], slices=WEEK)
    return out.select("latency_us", "n_orders", "n_actionable", "n_fills", *[F.round(c, 9).alias(c) for c in ("mean_profit", "mean_edge", "mean_clv")])
