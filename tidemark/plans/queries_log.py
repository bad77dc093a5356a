"""Queries over observation logs: appends, reads as of a time, sets, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import asof, observe, quality, sets
from tidemark.operators.slices import by_seconds
from tidemark.plans.registering import LOG, instant, observations, query, read

ANCHOR = ["user_id", "event_type"]
CUT = "2024-01-15 00:00:00"
WEEK = by_seconds(7 * 86_400)


def _holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with a null content for one of the three contents."""
    return observations(spark, sf_dir).withColumn("content", F.nullif("content", F.md5(F.lit("0"))))


HOLED = LOG + ", holed AS (SELECT * REPLACE (nullif(content, md5('0')) AS content) FROM log)"


@query(HOLED + """, b AS (SELECT *, lag(content) OVER w AS was, row_number() OVER w AS n FROM holed WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))
SELECT event_id, user_id, event_type, ts, content FROM b WHERE n = 1 OR was IS DISTINCT FROM content""")
def transition_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe.transitions(_holed(spark, sf_dir), ANCHOR, "ts", "event_id", "content").select("event_id", "user_id", "event_type", "ts", "content")


@query(LOG + """, b AS (SELECT *, lag(content) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS was FROM log),
t AS (SELECT *, lag(content, 2) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS last FROM b WHERE was IS NULL OR was <> content)
SELECT user_id, count(*) AS n_reversals FROM t WHERE last = content GROUP BY user_id""")
def transition_reversals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe.reversals(observations(spark, sf_dir), ANCHOR, "ts", "event_id", "content").groupBy("user_id").agg(F.count("*").alias("n_reversals"))


@query(LOG + """SELECT user_id, content, min(ts) AS ts, arg_min(event_id, ts) AS event_id, count(*) AS n_observed FROM log GROUP BY user_id, content""")
def trade_append_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe.append_by_identity(observations(spark, sf_dir), ["user_id", "content"], "ts", "event_id")


@query(LOG + """SELECT user_id, date_trunc('hour', ts) AS hour, content, min(event_id) AS event_id FROM log GROUP BY ALL""")
def exact_replay_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = observations(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return observe.drop_exact_replays(log, ["user_id", "hour", "content"], "event_id")


@query(LOG + """SELECT user_id, min(ts) AS first_observed_at, max(ts) AS last_observed_at, arg_max(event_type, ts) AS event_type, arg_max(k, ts) AS k FROM log GROUP BY user_id""")
def upsert_newer_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe.upsert(observations(spark, sf_dir), ["user_id"], "ts", "event_id", ["event_type", "k"])


@query(LOG + """, b AS (SELECT *, lag(k) OVER w AS pk, lag(content) OVER w AS pc, lag(event_type = 'purchase') OVER w AS pf FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, (coalesce(pf, false) AND content IS DISTINCT FROM pc) OR coalesce(k < pk, false) AS is_correction FROM b""")
def correction_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = observations(spark, sf_dir)
    return observe.corrections(log, ["user_id"], "ts", "event_id", F.col("event_type") == "purchase", ["content"], ["k"]).select("event_id", "is_correction")


@query(LOG + f""", v AS (SELECT event_id, user_id, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM log)
SELECT event_id, user_id, valid_from, valid_to FROM v WHERE valid_from <= TIMESTAMP '{CUT}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{CUT}')""")
def active_intervals_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = observe.validity(observations(spark, sf_dir).select("event_id", "user_id", "ts"), ["user_id"], "ts", "event_id")
    return observe.active_at(held, "valid_from", "valid_to", instant(CUT)).select("event_id", "user_id", "valid_from", "valid_to")


@query("""SELECT lower(split_part(c_name, '#', 1)) || (c_custkey % 97) AS alias, count(DISTINCT c_nationkey) AS n_entities, count(DISTINCT c_nationkey) > 1 AS is_ambiguous FROM customer GROUP BY 1""")
def alias_ambiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read(spark, sf_dir, "customer").withColumn("alias", F.concat(F.lower(F.split_part("c_name", F.lit("#"), F.lit(1))), (F.col("c_custkey") % 97).cast("string")))
    return observe.ambiguous_aliases(names, ["alias"], "c_nationkey")


@query(LOG + """, b AS (SELECT event_id, user_id, event_type, content, ROW(event_type, [content]) AS now, lag(ROW(event_type, [content])) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM log)
SELECT event_id, user_id, event_type, content FROM b WHERE was IS NULL OR was IS DISTINCT FROM now""")
def decision_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = observations(spark, sf_dir).withColumn("candidates", F.array("content"))
    return observe.idempotent_decisions(log, ["user_id"], "ts", "event_id", ["event_type", "candidates"]).select("event_id", "user_id", "event_type", "content")


@query("""SELECT o_orderkey, 'deleted' AS violation FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT o_orderkey, 'changed' FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 = 0""")
def append_only_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    after = before.where("o_orderkey % 10 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, F.concat("o_orderstatus", F.lit("!"))).otherwise(F.col("o_orderstatus")))
    return observe.append_only_violations(before, after, "o_orderkey", F.col("o_orderstatus"))


@query(HOLED + f""", h AS (SELECT user_id, date_trunc('hour', ts) AS hour, content FROM holed WHERE date_trunc('hour', ts) <= TIMESTAMP '{CUT}'),
g AS (SELECT user_id, hour, max(content) AS hi, count(DISTINCT content) + CAST(bool_or(content IS NULL) AS INT) = 1 AS clear FROM h GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY hour DESC) AS r FROM g)
SELECT user_id, hour, CASE WHEN clear THEN hi END AS content, CASE WHEN clear THEN 'ok' ELSE 'ambiguous' END AS status FROM n WHERE r = 1""")
def latest_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _holed(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return asof.as_of(log, ["user_id"], "hour", "content", instant(CUT))


@query(LOG + """, v AS (SELECT * FROM log WHERE event_type = 'view'), p AS (SELECT * FROM log WHERE event_type = 'purchase')
SELECT v.event_id, v.user_id, v.ts, p.ts AS matched_at, p.k FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts >= p.ts""")
def asof_join_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = observations(spark, sf_dir)
    views, purchases = (log.where(F.col("event_type") == t) for t in ("view", "purchase"))
    return asof.as_of_join(views.select("event_id", "user_id", "ts"), purchases.select("user_id", F.col("ts").alias("at"), "k"), ["user_id"], "ts", "at", ["k"], slices=WEEK)


@query("""WITH s AS (SELECT l_orderkey, l_shipdate, max(l_linenumber) AS line FROM lineitem GROUP BY ALL)
SELECT o.o_orderkey, o.o_orderdate, s.l_shipdate AS matched_at, s.line FROM orders o ASOF LEFT JOIN s ON o.o_orderkey = s.l_orderkey AND o.o_orderdate >= s.l_shipdate""")
def asof_join_orders_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_shipdate").agg(F.max("l_linenumber").alias("line"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return asof.as_of_join(orders, shipped.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], "o_orderdate", "l_shipdate", ["line"])


@query(LOG + """, t AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS hour FROM log), n AS (SELECT *, lead(hour) OVER (PARTITION BY user_id ORDER BY hour) AS next_at FROM t)
SELECT log.event_id, n.hour, n.next_at FROM log JOIN n ON log.user_id = n.user_id AND date_trunc('hour', log.ts) = n.hour""")
def next_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = observations(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return asof.next_trigger(log.select("event_id", "user_id", "hour"), ["user_id"], "hour", WEEK).select("event_id", "hour", "next_at")


@query(LOG + """, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM log) SELECT user_id, ts, event_id FROM n WHERE r = 1""")
def first_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.newest_row(observations(spark, sf_dir), ["user_id"], [F.asc("ts"), F.asc("event_id")]).select("user_id", "ts", "event_id")


@query("SELECT event_id, ts, value FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-06'")
def closed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").where(F.col("ts").between(instant("2024-01-05 00:00:00"), instant("2024-01-06 00:00:00"))).select("event_id", "ts", "value")


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'")
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    near = o.where((F.col("o_orderdate") >= instant("1996-03-01 00:00:00")) & (F.col("o_orderdate") < instant("1996-04-01 00:00:00")))  # reaches the scan
    return near.select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"))


@query(LOG + """, r AS (SELECT *, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS start, lag(event_type) OVER w AS os, lag(k) OVER w AS ok FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(start) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grp FROM r)
SELECT event_id, first_value(os) OVER x AS other_source, first_value(ok) OVER x AS other_value FROM g WINDOW x AS (PARTITION BY user_id, grp ORDER BY ts, event_id)""")
def latest_other_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.latest_from_other_source(observations(spark, sf_dir), ["user_id"], "ts", "event_id", "event_type", "k").select("event_id", "other_source", "other_value")


@query("""SELECT o_custkey, max(o_orderdate) AS o_orderdate, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) AS o_orderstatus
FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE o_orderdate = m GROUP BY o_custkey""")
def latest_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.latest_status(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "o_orderstatus")


@query("""SELECT o_custkey, o_orderdate, o_orderkey FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE o_orderdate = m""")
def groupwise_max_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return o.join(o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate")), ["o_custkey", "o_orderdate"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')")
def roster_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = read(spark, sf_dir, "orders").where(F.col("o_orderdate") >= instant("2000-01-01 00:00:00"))
    c = read(spark, sf_dir, "customer")
    return c.join(recent, c.c_custkey == recent.o_custkey, "left_semi").select("c_custkey", "c_name")


@query("""SELECT o.o_orderkey FROM orders o WHERE o.o_orderstatus = 'P' AND NOT EXISTS (SELECT 1 FROM orders x WHERE x.o_custkey = o.o_custkey AND x.o_orderdate > o.o_orderdate)""")
def superseded_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = W.partitionBy("o_custkey")
    o = read(spark, sf_dir, "orders").withColumn("newest", F.max("o_orderdate").over(newest))
    return o.where("o_orderstatus = 'P' AND o_orderdate = newest").select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE c_custkey = o_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')")
def orphan_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers to whom no order of a kind refers."""
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query("""WITH a AS (SELECT o_orderkey AS k, CAST(o_orderkey % 5 AS INT) AS v FROM orders WHERE o_orderkey % 11 <> 0), b AS (SELECT DISTINCT l_orderkey AS k, CAST(l_orderkey % 5 + CASE WHEN l_orderkey % 13 = 0 THEN 1 ELSE 0 END AS INT) AS v FROM lineitem)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'unexpected' WHEN a.v = b.v THEN 'equal' ELSE 'different' END AS status FROM a FULL JOIN b ON a.k = b.k""")
def reconcile_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "orders").where("o_orderkey % 11 <> 0").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 5).cast("int").alias("v"))
    b = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")).distinct().withColumn("v", (F.col("k") % 5 + F.when(F.col("k") % 13 == 0, 1).otherwise(0)).cast("int"))
    return sets.reconcile(a, b, ["k"], ["v"])


@query("SELECT DISTINCT id FROM (SELECT c_nationkey AS id FROM customer UNION ALL SELECT s_nationkey FROM supplier UNION ALL SELECT n_nationkey FROM nation) WHERE id IS NOT NULL")
def union_distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda t, c: read(spark, sf_dir, t).select(F.col(c).alias("id"))
    return sets.distinct_ids([pick("customer", "c_nationkey"), pick("supplier", "s_nationkey"), pick("nation", "n_nationkey")])


@query("""(SELECT o_custkey AS id, 'missing' AS side FROM orders EXCEPT SELECT c_custkey, 'missing' FROM customer WHERE c_custkey % 3 <> 0)
UNION ALL (SELECT c_custkey, 'unexpected' FROM customer WHERE c_custkey % 3 <> 0 EXCEPT SELECT o_custkey, 'unexpected' FROM orders)""")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.difference(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), read(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id")))


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n_sources FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def one_to_one_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.one_to_one(read(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey")


@query("""SELECT conv_id, arg_min(role, turn) AS role, count(DISTINCT role) > 1 AS conflict FROM conversations GROUP BY conv_id""")
def fold_merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.fold(read(spark, sf_dir, "conversations"), ["conv_id"], [F.col("turn")], "role")


@query("""SELECT o_custkey, CASE WHEN count(DISTINCT o_orderpriority) > 1 THEN 'priority' ELSE '' END AS conflicts, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) * 2 AS twice_final, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_final, max(o_totalprice) AS largest, bool_or(o_orderstatus = 'P') AS any_pending,
CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN min(o_orderpriority) END AS priority, array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') AS priorities, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS newest, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS oldest
FROM orders GROUP BY o_custkey""")
def combine_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumns({"final": (F.col("o_orderstatus") == "F").cast("long"), "pending": F.col("o_orderstatus") == "P", "set": F.array("o_orderpriority")})
    rules = {
        "n_final": ("additive", "final"), "largest": ("maximum", "o_totalprice"), "any_pending": ("any", "pending"), "priority": ("identity", "o_orderpriority"),
        "priorities": ("union", "set"), "newest": ("latest", "o_orderkey"), "oldest": ("first_evidence", "o_orderkey"), "twice_final": ("derived", F.col("n_final") * 2),
    }
    return sets.combine(o, ["o_custkey"], rules, order=["o_orderdate"]).withColumns({"priorities": F.array_join("priorities", ","), "conflicts": F.array_join("conflicts", ",")})


@query("""SELECT 'events' AS table_name, count(*) AS n_rows, CAST(min(ts) AS VARCHAR) AS first_at, CAST(max(ts) AS VARCHAR) AS last_at FROM events
UNION ALL SELECT 'orders', count(*), CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR), CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) FROM orders
UNION ALL SELECT 'lineitem', count(*), CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR), CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) FROM lineitem""")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda t, c: read(spark, sf_dir, t).select(F.to_date(c).alias("d"))
    return quality.coverage({"events": (read(spark, sf_dir, "events"), "ts"), "orders": (day("orders", "o_orderdate"), "d"), "lineitem": (day("lineitem", "l_shipdate"), "d")})


@query(LOG + """SELECT user_id, date_trunc('hour', ts) AS hour, count(DISTINCT content) AS n_contents FROM log GROUP BY ALL HAVING count(DISTINCT content) > 1""")
def dq_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = observations(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return quality.equal_time_conflicts(log, ["user_id"], "hour", "content")


FINDINGS = "WITH f AS (SELECT l_suppkey, l_orderkey, CASE WHEN l_discount >= 0.1 AND l_tax >= 0.08 THEN 'blocking' WHEN l_quantity >= 50 THEN 'issue' WHEN l_quantity <= 2 THEN 'note' END AS severity FROM lineitem) "


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    severity = F.when((F.col("l_discount") >= 0.1) & (F.col("l_tax") >= 0.08), "blocking").when(F.col("l_quantity") >= 50, "issue").when(F.col("l_quantity") <= 2, "note")
    return read(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", severity.alias("severity"))


@query(FINDINGS + """, c AS (SELECT l_suppkey, count(*) FILTER (severity = 'blocking') AS blocking, count(*) FILTER (severity = 'issue') AS issue, count(*) FILTER (severity = 'note') AS note FROM f GROUP BY 1),
s AS (SELECT *, round(CASE WHEN blocking > 0 THEN 0 ELSE greatest(0, 1 - 0.1 * issue - 0.02 * note) END::DOUBLE, 6) AS score FROM c)
SELECT *, CASE WHEN blocking > 0 THEN 'F' WHEN score >= 0.95 THEN 'A' WHEN score >= 0.85 THEN 'B' WHEN score >= 0.7 THEN 'C' WHEN score >= 0.5 THEN 'D' ELSE 'F' END AS grade FROM s""")
def dq_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.grades(_findings(spark, sf_dir), ["l_suppkey"])


@query(FINDINGS + """, r AS (SELECT *, row_number() OVER (PARTITION BY severity ORDER BY l_orderkey, l_suppkey) AS n FROM f WHERE severity IS NOT NULL)
SELECT severity, count(*) AS n_rows, string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY n) FILTER (n <= 5) AS examples FROM r GROUP BY severity""")
def top_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = quality.top_examples(_findings(spark, sf_dir).where("severity IS NOT NULL"), ["severity"], [F.asc("l_orderkey"), F.asc("l_suppkey")], "l_orderkey", 5)
    return top.withColumn("examples", F.array_join(F.col("examples").cast("array<string>"), ","))


@query(FINDINGS + "SELECT l_suppkey % 10 AS bucket, count(*) FILTER (severity = 'blocking') AS blocking, count(*) FILTER (severity = 'issue') AS issue, count(*) FILTER (severity = 'note') AS note FROM f GROUP BY 1")
def severity_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _findings(spark, sf_dir).groupBy((F.col("l_suppkey") % 10).alias("bucket")).pivot("severity", ["blocking", "issue", "note"]).count()
    return f.na.fill(0)
