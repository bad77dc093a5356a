"""Queries over sequenced streams with copies, gaps and snapshots, and over ladders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import backtest, games, market
from tidemark.operators.slices import by_seconds
from tidemark.operators.windows import checkpointed
from tidemark.plans.queries_games import ORDER, _envelopes, _json
from tidemark.plans.registering import LOG, instant, observations, query
from tidemark.streaming.gate import LIVE, gate

#: Of every user's events some repeat the position before them, and some come after a loss.
STEP = "CASE WHEN event_id % 8 = 6 OR event_id % 11 = 0 THEN 0 WHEN event_id % 13 = 0 THEN 2 ELSE 1 END"
WEEK = by_seconds(7 * 86_400)

GATED = LOG + f""", g0 AS (SELECT user_id AS entity, ts, event_id, k, event_id % 8 AS m, {STEP} AS inc, row_number() OVER w AS n,
    sum({STEP}) OVER w AS seq, count(*) FILTER (event_id % 8 = 7) OVER w AS ep FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g1 AS (SELECT *, m < 6 AND ep = 0 AND row_number() OVER (PARTITION BY entity, ep, m < 6 ORDER BY n) = 1 AS anchor FROM g0),
g2 AS (SELECT *, count(*) FILTER (m < 6 AND inc = 2 AND NOT anchor) OVER (PARTITION BY entity, ep ORDER BY n) AS lost FROM g1),
g3 AS (SELECT *, CASE WHEN m = 7 THEN 'snapshot_applied' WHEN m = 6 THEN 'correction_applied' WHEN anchor THEN 'applied' WHEN lost > 0 THEN 'gap_detected'
    WHEN inc = 0 THEN 'duplicate' ELSE 'applied' END AS status FROM g2),
g AS (SELECT *, CAST(last_value(CASE WHEN status IN ('snapshot_applied', 'applied') THEN seq END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY n) AS BIGINT) AS position FROM g3),
v AS (SELECT * FROM g WHERE status IN ('snapshot_applied', 'correction_applied', 'applied'))"""

#: Effects (entity, n, field, op, value) to fields, in SQL.
TO_FIELDS = """, rs AS (SELECT entity, field AS map, max(n) AS n FROM eff WHERE op = 'reset' GROUP BY ALL),
kept AS (SELECT eff.* FROM eff LEFT JOIN rs ON rs.entity = eff.entity AND starts_with(eff.field, rs.map) WHERE op <> 'reset' AND (rs.n IS NULL OR eff.n >= rs.n)),
st AS (SELECT *, max(n) FILTER (op = 'set') OVER (PARTITION BY entity, field) AS last_set FROM kept),
f0 AS (SELECT entity, field, max(value) FILTER (op = 'set' AND n = last_set) AS put, sum(TRY_CAST(value AS BIGINT)) FILTER (op = 'add' AND (last_set IS NULL OR n > last_set)) AS added FROM st GROUP BY ALL),
f AS (SELECT entity, field, CASE WHEN added IS NULL THEN put ELSE CAST(coalesce(TRY_CAST(put AS BIGINT), 0) + added AS VARCHAR) END AS value FROM f0)"""


def _effects(*rows: tuple[str, str, str, str]) -> str:
    """(field, op, value, condition), as SQL expressions over ``v``."""
    return ", eff AS (" + " UNION ALL ".join(f"SELECT entity, n, {field} AS field, '{op}' AS op, CAST({value} AS VARCHAR) AS value FROM v WHERE {test}" for field, op, value, test in rows) + ")"


BASEBALL = GATED + _effects(
    ("'pitches'", "add", "1 + k % 3", "m = 0"), ("'pitches.P' || (k % 3)", "add", "1 + k % 3", "m = 0"), ("'outs'", "add", "1", "m = 1"),
    ("'score.' || CASE WHEN k % 2 = 0 THEN 'home' ELSE 'away' END", "add", "k % 4", "m = 2"),
    ("'inning'", "set", "1 + k % 9", "m IN (3, 7)"), ("'half'", "set", "CASE WHEN k % 2 = 0 THEN 'top' ELSE 'bottom' END", "m = 3"), ("'outs'", "set", "0", "m = 3"),
    ("'1B'", "set", "''", "m = 3"), ("'2B'", "set", "''", "m = 3"), ("'3B'", "set", "''", "m = 3"), ("'1B'", "set", "CASE WHEN k % 2 = 1 THEN 'R' || k ELSE '' END", "m = 4"),
    ("'batter'", "set", "'B' || k", "m = 5"), ("'outs'", "set", "k % 3", "m IN (6, 7)"), ("'score.away'", "set", "k % 5", "m = 6"),
    ("'score.'", "reset", "''", "m = 7"), ("'score.home'", "set", "k", "m = 7"), ("'pitches'", "set", "k", "m = 7"), ("'pitches.'", "reset", "''", "m = 7"), ("'pitches.P1'", "set", "k", "m = 7"),
) + TO_FIELDS

BASKETBALL = GATED + _effects(
    ("'period'", "set", "1 + k % 4", "m IN (0, 7)"), ("'clock_seconds'", "set", "720.0", "m = 0"), ("'fouls.home'", "set", "0", "m = 0"), ("'fouls.away'", "set", "0", "m = 0"),
    ("'score.' || side", "add", "k % 4", "m = 1"), ("'timeouts_taken.' || side", "add", "1", "m = 2"), ("'player_fouls.P' || (k % 5)", "add", "1", "m = 3"), ("'fouls.' || side", "add", "1", "m = 3"),
    ("'court.home.P' || (k % 5)", "set", "k % 2", "m = 4"), ("'possession'", "set", "side", "m = 5"),
    ("'timeouts.home'", "set", "k % 4", "m = 6"), ("'timeouts_taken.home'", "set", "0", "m = 6"), ("'clock_seconds'", "set", "k", "m = 6"),
    ("'timeouts.'", "reset", "''", "m = 7"), ("'timeouts_taken.'", "reset", "''", "m = 7"), ("'timeouts.home'", "set", "k % 7", "m = 7"), ("'timeouts.away'", "set", "3", "m = 7"),
    ("'player_fouls.'", "reset", "''", "m = 7"), ("'player_fouls.P1'", "set", "k % 5", "m = 7"), ("'fouls.'", "reset", "''", "m = 7"), ("'fouls.home'", "set", "k % 6", "m = 7"),
    ("'court.'", "reset", "''", "m = 7"), ("'court.home.P0'", "set", "1", "m = 7"), ("'court.home.P1'", "set", "1", "m = 7"),
).replace("FROM v WHERE", "FROM (SELECT *, CASE WHEN k % 2 = 0 THEN 'home' ELSE 'away' END AS side FROM v) WHERE") + TO_FIELDS


def _gated(spark: SparkSession, sf_dir: str, kinds: list[str], payloads: list[F.Column]) -> DataFrame:
    """Every user's events as a sequenced stream of one game, with the status of each; a stream is cut by weeks.

    What follows reads the stream more than once, so it is written to the checkpoint folder.
    """
    sequence = F.sum(F.expr(STEP)).over(W.partitionBy("entity").orderBy(*ORDER))
    events = _envelopes(spark, sf_dir, kinds, payloads).withColumn("sequence", sequence)
    return checkpointed(gate(events, "entity", ORDER, "event_type", "sequence", WEEK(F.col("ts"))))


def _baseball(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    side, pitcher = F.when(k % 2 == 0, "home").otherwise("away"), F.concat(F.lit("P"), (k % 3).cast("string"))
    one = lambda name, value: F.struct(value.alias(name))
    payloads = [
        _json(count=1 + k % 3, pitcher=pitcher), _json(outs=F.lit(1)), _json(team=side, runs=k % 4), _json(inning=1 + k % 9, half=F.when(k % 2 == 0, "top").otherwise("bottom")),
        F.to_json(F.create_map(F.lit("1B"), F.when(k % 2 == 1, F.concat(F.lit("R"), k)))), _json(batter=F.concat(F.lit("B"), k)), _json(outs=k % 3, score=one("away", k % 5)),
        _json(outs=k % 3, inning=1 + k % 9, score=one("home", k), total_pitches=k, bullpen_usage=one("P1", k)),
    ]
    return _gated(spark, sf_dir, ["pitch", "out", "score", "inning", "bases", "at_bat", "correction", "snapshot"], payloads)


@query(GATED + " SELECT event_id, CAST(seq AS BIGINT) AS sequence, status, position FROM g")
def gated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _baseball(spark, sf_dir).select("event_id", "sequence", "status", "position")


def _live(gated: DataFrame) -> DataFrame:
    return gated.where(F.col("status").isin(*LIVE))


@query(BASEBALL + " SELECT entity, field, value FROM f")
def gated_baseball_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games.baseball_fields(_live(_baseball(spark, sf_dir)), ORDER, slices=WEEK).select("entity", "field", "value")


@query(BASKETBALL + """ SELECT entity, CAST(max(value) FILTER (field = 'period') AS BIGINT) AS period, CAST(max(value) FILTER (field = 'clock_seconds') AS DOUBLE) AS clock,
coalesce(CAST(max(value) FILTER (field = 'score.home') AS BIGINT), 0) AS home, coalesce(CAST(max(value) FILTER (field = 'score.away') AS BIGINT), 0) AS away, max(value) FILTER (field = 'possession') AS possession,
greatest(0, coalesce(CAST(max(value) FILTER (field = 'timeouts.home') AS BIGINT), 7) - coalesce(CAST(max(value) FILTER (field = 'timeouts_taken.home') AS BIGINT), 0)) AS timeouts_home,
greatest(0, coalesce(CAST(max(value) FILTER (field = 'timeouts.away') AS BIGINT), 7) - coalesce(CAST(max(value) FILTER (field = 'timeouts_taken.away') AS BIGINT), 0)) AS timeouts_away,
coalesce(CAST(max(value) FILTER (field = 'fouls.home') AS BIGINT), 0) AS fouls_home, coalesce(sum(TRY_CAST(value AS BIGINT)) FILTER (starts_with(field, 'player_fouls.')), 0)::BIGINT AS player_fouls,
count(*) FILTER (starts_with(field, 'court.home.') AND value = '1') AS on_court FROM f GROUP BY entity""")
def gated_basketball_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    side, player = F.when(k % 2 == 0, "home").otherwise("away"), F.concat(F.lit("P"), (k % 5).cast("string"))
    swap = F.when(k % 2 == 1, F.to_json(F.create_map(F.lit("in"), F.array(player)))).otherwise(F.to_json(F.create_map(F.lit("out"), F.array(player))))
    one = lambda name, value: F.struct(value.alias(name))
    payloads = [
        _json(period=1 + k % 4), _json(team=side, points=k % 4), _json(team=side), _json(player=player, team=side), swap, _json(team=side), _json(timeouts=one("home", k % 4), clock_seconds=k),
        _json(period=1 + k % 4, timeouts=F.struct((k % 7).alias("home"), F.lit(3).alias("away")), player_fouls=one("P1", k % 5), team_fouls=one("home", k % 6), players_on_court=one("home", F.array(F.lit("P0"), F.lit("P1")))),
    ]
    gated = _gated(spark, sf_dir, ["period", "score", "timeout", "player_foul", "substitution", "possession", "correction", "snapshot"], payloads)
    state = games.fields(_live(gated), games.basketball_effects(), ORDER)
    value = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    number = lambda f, default=0: F.coalesce(value(f).cast("long"), F.lit(default).cast("long"))
    left = lambda t: F.greatest(F.lit(0).cast("long"), number(f"timeouts.{t}", 7) - number(f"timeouts_taken.{t}")).alias(f"timeouts_{t}")
    return state.groupBy("entity").agg(
        value("period").cast("long").alias("period"), value("clock_seconds").cast("double").alias("clock"), number("score.home").alias("home"), number("score.away").alias("away"), value("possession").alias("possession"),
        left("home"), left("away"), number("fouls.home").alias("fouls_home"), F.coalesce(F.sum(F.when(F.col("field").startswith("player_fouls."), F.col("value").cast("long"))), F.lit(0)).alias("player_fouls"),
        F.count_if(F.col("field").startswith("court.home.") & (F.col("value") == "1")).alias("on_court"),
    )


@query(BASEBALL + """, h AS (SELECT entity, count(*) AS n_fields, sha256(string_agg(field || '=' || coalesce(value, 'null'), chr(10) ORDER BY field || '=' || coalesce(value, 'null'))) AS state_hash FROM f GROUP BY 1),
q AS (SELECT entity, arg_max_null(position, n) AS last_sequence, CAST(arg_max(seq, n) FILTER (status = 'snapshot_applied') AS BIGINT) AS snapshot_sequence, CAST(arg_max(seq, n) FILTER (status = 'applied') AS BIGINT) AS delta_sequence,
    max(ts) FILTER (status NOT IN ('duplicate', 'gap_detected')) AS last_at, count(*) FILTER (status NOT IN ('duplicate', 'gap_detected')) AS n_applied, count(*) FILTER (status = 'correction_applied') AS n_corrections,
    count(*) FILTER (status = 'duplicate') AS n_duplicates, count(*) FILTER (status = 'gap_detected') AS n_dropped,
    coalesce(arg_max(status, n) FILTER (status IN ('gap_detected', 'snapshot_applied')) = 'gap_detected', false) AS sequence_gap,
    coalesce(bool_or(m = 5) FILTER (status NOT IN ('duplicate', 'gap_detected')), false) AS missing_field, false AS out_of_range FROM g GROUP BY 1)
SELECT q.*, coalesce(last_at < TIMESTAMP '2024-01-25 00:00:00', true) AS stale, n_fields, state_hash FROM q LEFT JOIN h ON q.entity = h.entity""")
def game_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batters' turns are of a type that is not known here."""
    gated = _baseball(spark, sf_dir)
    state = games.baseball_fields(_live(gated), ORDER, slices=WEEK)
    return games.quality(gated, state, ORDER, "ts", "sequence", instant("2024-01-26 00:00:00"), 86_400, ["pitch", "out", "score", "inning", "bases"], [])


# ---- ladders

GRID_US = (0, 3_600_000_000, 21_600_000_000, 86_400_000_000)
RULE = backtest.EdgeRule(min_edge=2.0, size=12, slip=1)


def _ladder_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every user's events as those of one market: snapshots, deltas of one side, trades, statuses, and triggers with a fair value."""
    k, m = F.col("k"), F.col("event_id") % 5
    level = lambda price, size: F.struct(price.cast("int").alias("price"), size.cast("long").alias("size"))
    yes = F.array(level(20 + k % 40, 4 + k % 5), level(21 + k % 40, 3 + k % 4), level(24 + k % 40, F.lit(9)))
    no = F.array(level(25 + k % 35, 5 + k % 6), level(26 + k % 35, 2 + k % 3), level(29 + k % 35, F.lit(9)))
    none = F.array().cast("array<struct<price:int,size:bigint>>")
    log = observations(spark, sf_dir).select(F.col("user_id").alias("market"), "ts", "event_id", m.alias("m"), "k")
    events = log.where("m <> 2").select(
        "market", "ts", "event_id", F.element_at(F.array(*map(F.lit, ("ob_snapshot", "ob_delta", "", "trade", "market_status"))), (m + 1).cast("int")).alias("kind"),
        F.when(F.col("m") == 0, F.when(k % 7 == 0, none).otherwise(yes)).when((F.col("m") == 1) & (k % 2 == 0), yes).alias("yes_ladder"),
        F.when((F.col("m") == 0) | ((F.col("m") == 1) & (k % 2 == 1)), no).alias("no_ladder"), F.when(k % 4 == 0, "halted").otherwise("open").alias("market_status"),
        F.when(k % 2 == 0, "yes").otherwise("no").alias("trade_side"), (20 + k % 50).alias("trade_price"),
    )
    return events, log.where("m = 2").select("market", "ts", "event_id", F.when(k % 10 < 9, k / 100.0).alias("fair"))


def _walk(prefix: str, start: str, second: str, limit: str) -> str:
    """Columns ``<prefix>q`` and ``<prefix>c``: contracts and cost of a sweep for 12 over a ladder that starts at ``start``."""
    one = f"CASE WHEN {start} <= {limit} THEN least({prefix}s1, 12) ELSE 0 END"
    two = f"CASE WHEN {start} + 1 <= {limit} THEN least({second}, 12 - ({one})) ELSE 0 END"
    three = f"CASE WHEN {start} + 4 <= {limit} THEN least(9, 12 - ({one}) - ({two})) ELSE 0 END"
    return f"({one}) + ({two}) + ({three}) AS {prefix}q, ({one}) * {start} + ({two}) * ({start} + 1) + ({three}) * ({start} + 4) AS {prefix}c"


LADDERS = LOG + """, x AS (SELECT user_id AS market, ts, event_id, event_id % 5 AS m, k FROM log),
b0 AS (SELECT *, last_value(CASE WHEN m = 0 THEN CASE WHEN k % 7 = 0 THEN -1 ELSE k END WHEN m = 1 AND k % 2 = 0 THEN k END IGNORE NULLS) OVER w AS yk,
    last_value(CASE WHEN m = 0 OR m = 1 AND k % 2 = 1 THEN k END IGNORE NULLS) OVER w AS nk, coalesce(last_value(CASE WHEN m = 4 THEN CASE WHEN k % 4 = 0 THEN 'halted' ELSE 'open' END END IGNORE NULLS) OVER w, 'open') AS status
    FROM x WHERE m <> 2 WINDOW w AS (PARTITION BY market ORDER BY ts, event_id)),
b AS (SELECT market, ts, event_id, m, k, status, CASE WHEN yk >= 0 THEN 20 + yk % 40 END AS yp, 4 + yk % 5 AS ys1, 3 + yk % 4 AS ys2, 25 + nk % 35 AS np, 5 + nk % 6 AS ns1, 2 + nk % 3 AS ns2 FROM b0),
cl AS (SELECT market, coalesce(arg_max(20 + k % 50, (ts, event_id)) FILTER (m = 3 AND k % 2 = 0), arg_max_null(yp, (ts, event_id))) AS yclose,
    coalesce(arg_max(20 + k % 50, (ts, event_id)) FILTER (m = 3 AND k % 2 = 1), arg_max_null(np, (ts, event_id))) AS nclose FROM b GROUP BY 1),
t AS (SELECT market, ts, event_id, CASE WHEN k % 10 < 9 THEN k / 100.0::DOUBLE END AS fair, lead(ts) OVER (PARTITION BY market ORDER BY ts) AS next_at FROM x WHERE m = 2),
s0 AS (SELECT t.*, b.yp, b.ys1, b.ys2, b.np, b.ns1, b.ns2 FROM t ASOF JOIN b ON t.market = b.market AND t.ts >= b.ts WHERE b.status = 'open' AND fair IS NOT NULL),
s1 AS (SELECT *, """ + _walk("y", "yp", "ys2", "yp + 1") + ", " + _walk("n", "np", "ns2", "np + 1") + """ FROM s0),
s2 AS (SELECT *, CAST(yc AS DOUBLE) / yq AS ya, CAST(nc AS DOUBLE) / nq AS na FROM s1),
s3 AS (SELECT *, fair * 100 - ya - 0.07::DOUBLE * (ya / 100) * (1 - ya / 100) * 100 AS ye, (1 - fair) * 100 - na - 0.07::DOUBLE * (na / 100) * (1 - na / 100) * 100 AS ne FROM s2),
o AS (SELECT market, ts, event_id, next_at, CASE WHEN ye IS NOT NULL AND (ne IS NULL OR ye >= ne) THEN 'yes' ELSE 'no' END AS side, fair, yp, np FROM s3 WHERE greatest(coalesce(ye, -100), coalesce(ne, -100)) >= 2),
l AS (SELECT o.market, o.ts, o.event_id, next_at, side, CASE WHEN side = 'yes' THEN yp ELSE np END + 1 AS lim, CASE WHEN side = 'yes' THEN fair ELSE 1 - fair END * 100 AS fv, g AS latency_us, o.ts + to_microseconds(g) AS arrival
    FROM o, (SELECT unnest([0, 3600000000, 21600000000, 86400000000]) AS g)),
m0 AS (SELECT l.*, b.status, CASE WHEN side = 'yes' THEN b.yp ELSE b.np END AS p, CASE WHEN side = 'yes' THEN b.ys1 ELSE b.ns1 END AS s1, CASE WHEN side = 'yes' THEN b.ys2 ELSE b.ns2 END AS s2,
    CASE WHEN side = 'yes' THEN yclose ELSE nclose END AS closing, coalesce(next_at <= arrival, false) AS stale FROM l ASOF JOIN b ON l.market = b.market AND l.arrival >= b.ts JOIN cl ON cl.market = l.market),
m1 AS (SELECT *, """ + _walk("", "p", "s2", "lim") + """ FROM m0),
m2 AS (SELECT *, CASE WHEN stale THEN 'stale' WHEN status <> 'open' THEN 'suspended' WHEN p IS NULL THEN 'no_fill' WHEN q = 0 THEN 'miss' WHEN q >= 12 THEN 'filled' ELSE 'partial' END AS outcome, CAST(c AS DOUBLE) / q AS avg_price FROM m1),
r AS (SELECT *, outcome IN ('filled', 'partial') AS got, CASE WHEN outcome IN ('filled', 'partial') THEN q ELSE 0 END AS filled, CASE WHEN outcome IN ('filled', 'partial')
    THEN (fv - avg_price) * q - ceil(round(0.07::DOUBLE * (avg_price / 100) * (1 - avg_price / 100) * 100 * q, 9)) ELSE 0 END AS profit FROM m2),
c AS (SELECT latency_us, count(*) AS n_orders, count(*) FILTER (outcome NOT IN ('stale', 'suspended')) AS n_actionable, count(*) FILTER (got) AS n_fills, count(*) FILTER (outcome = 'partial') AS n_partial, CAST(sum(filled) AS BIGINT) AS contracts,
    round(avg(CASE WHEN got THEN 1.0 ELSE 0.0 END), 9) AS fill_rate, round(avg(profit), 6) AS mean_profit, round(avg(fv - p), 6) AS mean_edge, round(avg(closing - avg_price) FILTER (got), 6) AS mean_clv FROM r GROUP BY 1)"""


def _curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, triggers = _ladder_log(spark, sf_dir)
    c = backtest.curves(backtest.replay(events, triggers, "market", "ts", "event_id", "fair", RULE, GRID_US, WEEK))
    return c.withColumns({"fill_rate": F.round("fill_rate", 9), **{x: F.round(x, 6) for x in ("mean_profit", "mean_edge", "mean_clv")}})


@query(LADDERS + " SELECT latency_us, n_orders, n_actionable, n_fills, n_partial, contracts, fill_rate, mean_profit, mean_edge, mean_clv FROM c")
def ladder_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curves(spark, sf_dir)


@query(LADDERS + """, w AS (SELECT latency_us AS x, mean_profit AS y, lag(latency_us) OVER (ORDER BY latency_us) AS px, lag(mean_profit) OVER (ORDER BY latency_us) AS py FROM c)
SELECT round(arg_min(CASE WHEN px IS NULL OR py = y THEN x ELSE px + py / (py - y) * (x - px) END, x), 3) AS break_even_us FROM w WHERE y < 0""")
def ladder_break_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.break_even(_curves(spark, sf_dir), "latency_us", "mean_profit").select(F.round("break_even", 3).alias("break_even_us"))


@query(LADDERS + " SELECT event_id, latency_us, side, CAST(lim AS INT) AS \"limit\", outcome, CAST(filled AS BIGINT) AS filled, round(profit, 6) AS profit, round(fv - p, 6) AS available FROM r")
def ladder_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, triggers = _ladder_log(spark, sf_dir)
    filled = backtest.replay(events, triggers, "market", "ts", "event_id", "fair", RULE, GRID_US, WEEK)
    return filled.select("event_id", "latency_us", "side", F.col("limit").cast("int").alias("limit"), "outcome", "filled", F.round("profit", 6).alias("profit"), F.round("available", 6).alias("available"))
