"""Queries over folds, raw payloads and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.sources import store
from tidemark.streaming import sequence
from tidemark.plans.registering import LOG, observations, query, read


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as a stream in which some positions come late, twice or not at all."""
    log = observations(spark, sf_dir)
    n = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    seq = F.when(n % 7 == 0, n - 1).when(n % 11 == 3, n + 1).when(n % 11 == 4, n - 1).otherwise(n)
    return log.select(F.col("user_id").cast("string").alias("stream_key"), n.cast("long").alias("arrival"), seq.cast("long").alias("sequence"), "content", F.lit(False).alias("flagged"), "k")


ARRIVALS = LOG + """, a AS (SELECT user_id, k, content, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS arrival FROM log),
s AS (SELECT CAST(user_id AS VARCHAR) AS key, k, content, arrival, CASE WHEN arrival % 7 = 0 THEN arrival - 1 WHEN arrival % 11 = 3 THEN arrival + 1 WHEN arrival % 11 = 4 THEN arrival - 1 ELSE arrival END AS seq FROM a)"""


# Every position's fate by a recursive walk over arrivals, the positions seen so far as a list.
@query(ARRIVALS.replace("WITH ", "WITH RECURSIVE ", 1) + """, w AS (
SELECT key, arrival, seq, [seq] AS seen, seq AS anchor, seq + 1 AS expected, seq AS high, [] :: BIGINT[] AS missing, 'in_order' AS status, CAST(1 AS BIGINT) AS n_ready FROM s WHERE arrival = 1
UNION ALL SELECT key, arrival, seq, now, anchor, nxt, greatest(high, seq), list_filter(CASE WHEN NOT known AND seq > expected THEN list_distinct(missing || list_filter(range(expected, seq), lambda p: NOT list_contains(seen, p))) ELSE missing END, lambda p: p >= nxt),
CASE WHEN known OR seq < expected THEN 'duplicate' WHEN seq = expected THEN 'in_order' ELSE 'gap' END, nxt - expected
FROM (SELECT *, coalesce(list_min(list_filter(range(expected, greatest(high, seq) + 2), lambda p: NOT list_contains(now, p))), expected) AS nxt FROM
(SELECT s.key, s.arrival, s.seq, w.seen, w.anchor, w.expected, w.high, w.missing, list_contains(w.seen, s.seq) AS known, list_distinct(w.seen || [s.seq]) AS now FROM w JOIN s ON s.key = w.key AND s.arrival = w.arrival + 1)))
SELECT key AS stream_key, arrival, seq AS sequence, status, len(missing) = 0 AS healthy, n_ready, CAST(len(missing) AS BIGINT) AS n_missing,
CASE WHEN c.was_n = 1 THEN 'original' WHEN c.was = c.content THEN 'unchanged' ELSE 'correction' END AS correction
FROM w JOIN (SELECT key, arrival, content, lag(content) OVER x AS was, row_number() OVER x AS was_n FROM s WINDOW x AS (PARTITION BY key, seq ORDER BY arrival)) c USING (key, arrival)""")
def sequence_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.track(_arrivals(spark, sf_dir).drop("k"))


@query(ARRIVALS.replace("WITH ", "WITH RECURSIVE ", 1) + """, e AS (SELECT *, CASE WHEN arrival % 13 = 0 THEN 'snapshot' WHEN arrival % 17 = 0 THEN 'correction' ELSE 'delta' END AS kind FROM s), w AS (
SELECT key, arrival, seq, 'applied' AS status, false AS needs, CAST(k AS BIGINT) AS total, CAST(1 AS BIGINT) AS applied, CAST(0 AS BIGINT) AS corrected, seq AS last FROM e WHERE arrival = 1
UNION ALL SELECT key, arrival, seq, st, CASE st WHEN 'snapshot_applied' THEN false WHEN 'gap_detected' THEN true ELSE needs END, CASE WHEN st = 'snapshot_applied' THEN k WHEN st IN ('applied', 'correction_applied') THEN total + k ELSE total END,
applied + CAST(st NOT IN ('duplicate', 'gap_detected') AS INT), corrected + CAST(st = 'correction_applied' AS INT), CASE WHEN st IN ('applied', 'snapshot_applied') THEN seq ELSE last END
FROM (SELECT e.key, e.arrival, e.seq, e.k, w.needs, w.total, w.applied, w.corrected, w.last, CASE WHEN e.kind = 'snapshot' THEN 'snapshot_applied' WHEN e.kind = 'correction' THEN 'correction_applied' WHEN e.seq = w.last + 1 THEN 'applied' WHEN e.seq <= w.last THEN 'duplicate' ELSE 'gap_detected' END AS st
FROM w JOIN e ON e.key = w.key AND e.arrival = w.arrival + 1))
SELECT key AS entity, arrival, seq AS sequence, status, needs AS needs_snapshot, total, applied AS n_applied, corrected AS n_corrections FROM w""")
def live_state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("arrival") % 13 == 0, "snapshot").when(F.col("arrival") % 17 == 0, "correction").otherwise("delta")
    return sequence.live_totals(_arrivals(spark, sf_dir).select(F.col("stream_key").alias("entity"), "arrival", kind.alias("kind"), "sequence", F.col("k").alias("amount")))


ASKED = "WITH RECURSIVE r AS (SELECT user_id AS key, event_id AS request, epoch_us(ts) AS at_us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events), "


@query(ASKED + """w AS (SELECT key, request, at_us, n, at_us AS granted_us, CAST(NULL AS BIGINT) AS before FROM r WHERE n = 1
UNION ALL SELECT r.key, r.request, r.at_us, r.n, greatest(r.at_us, w.granted_us + 3600000000, coalesce(w.before + 86400000000, 0)), w.granted_us FROM w JOIN r ON r.key = w.key AND r.n = w.n + 1)
SELECT key, request, at_us, granted_us FROM w""")
def rate_limiter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("request"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"))
    return sequence.paced(e, per_window=2, window_s=86_400, spacing_s=3600)


@query(ASKED + """w AS (SELECT key, request, at_us, n, true AS allowed, CAST(1 AS DOUBLE) AS tokens FROM r WHERE n = 1
UNION ALL SELECT key, request, at_us, n, held >= 1, CASE WHEN held >= 1 THEN held - 1 ELSE held END FROM (SELECT r.*, least(CAST(2 AS DOUBLE), w.tokens + (r.at_us - w.at_us) / 1e6::DOUBLE * (1 / 43200::DOUBLE)) AS held FROM w JOIN r ON r.key = w.key AND r.n = w.n + 1))
SELECT key, request, allowed FROM w""")
def token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("request"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"))
    return sequence.token_bucket(e, rate_per_s=1 / 43_200, capacity=2.0)


@query(LOG + """, a AS (SELECT user_id, k, content, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM log), s AS (SELECT *, CASE WHEN n % 7 = 0 THEN n - 1 WHEN n % 11 = 3 THEN n + 1 WHEN n % 11 = 4 THEN n - 1 ELSE n END AS seq FROM a)
SELECT CAST(user_id AS VARCHAR) AS stream_key, n AS arrival, CASE WHEN lag(content) OVER w IS NULL THEN 'original' WHEN lag(content) OVER w = content THEN 'unchanged' ELSE 'correction' END AS correction FROM s WINDOW w AS (PARTITION BY user_id, seq ORDER BY n)""")
def correction_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.correction_status(_arrivals(spark, sf_dir), ["stream_key", "sequence"], "arrival", "content").select("stream_key", "arrival", "correction")


@query("""SELECT conv_id, turn, role, octet_length(encode(text)) AS body_bytes, sha256(text) AS body_hash, sha256(concat_ws(chr(31), role, conv_id, turn, sha256(text))) AS content_hash FROM conversations WHERE text IS NOT NULL""")
def raw_response_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations").where("text IS NOT NULL").withColumns({"endpoint": F.col("conv_id").cast("string"), "params": F.col("turn").cast("string")})
    return store.raw_responses(c, "role", "endpoint", "params", "text").select("conv_id", "turn", "role", "body_bytes", "body_hash", "content_hash")


@query("""SELECT o_orderkey, l_linenumber AS line, CAST(l_quantity AS BIGINT) AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def raw_reprojection(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    body = F.to_json(F.struct(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("long").alias("quantity"))).alias("items")))
    raw = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(body.alias("body"))
    known = read(spark, sf_dir, "orders").select("o_orderkey")
    return store.reproject(raw.join(known, "o_orderkey", "left_semi"), "body", "items array<struct<line:int,quantity:long>>", "items").select("o_orderkey", "line", "quantity")


@query("""SELECT l_orderkey, l_linenumber, 'quantity' AS rule FROM lineitem WHERE l_quantity < 3 UNION ALL SELECT l_orderkey, l_linenumber, 'tax' FROM lineitem WHERE l_tax > 0.07""")
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").withColumn("id", F.struct("l_orderkey", "l_linenumber"))
    return store.violations(li, [("quantity", F.col("l_quantity") >= 3), ("tax", F.col("l_tax") <= 0.07)], "id").select("id.l_orderkey", "id.l_linenumber", "rule")


@query("SELECT count(*) FILTER (l_quantity >= 3) AS n_good, count(*) FILTER (l_quantity < 3) AS n_rejected FROM lineitem")
def gated_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").withColumn("version", F.lit("1"))
    good, rejected = store.gated_import(li, ["l_orderkey", "l_quantity"], "version", ["1"], [("quantity", F.col("l_quantity") < 3)])
    return good.agg(F.count("*").alias("n_good")).crossJoin(rejected.agg(F.count("*").alias("n_rejected")))


@query("SELECT vec_id // 10 AS frame, count(*) AS n_samples, min(vec_id) AS first_player FROM embeddings GROUP BY 1")
def frame_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = read(spark, sf_dir, "embeddings").select(F.lit("nba").alias("sport"), F.lit("g").alias("game_id"), F.expr("vec_id div 10").alias("frame_time"), F.lit(1).alias("period"), F.col("vec_id").alias("player_id"))
    return store.regroup(flat).select(F.col("frame_time").alias("frame"), F.size("samples").cast("long").alias("n_samples"), F.col("samples")[0]["player_id"].alias("first_player"))


@query()
def logistic_champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit the regularisation grid on the first 80 % of events in time and report the validation log-loss of each."""
    from tidemark.operators.models import fit_grid
    from tidemark.operators.windows import chronological_split

    log = observations(spark, sf_dir)
    rows = chronological_split(log, ["ts", "event_id"], 0.8).select("train", (F.col("k") / 100).alias("x0"), (F.col("value") / 100).alias("x1"), (F.col("event_type") == "purchase").cast("double").alias("label"))
    return fit_grid(rows, ["x0", "x1"], (0.3, 1.0, 3.0))
