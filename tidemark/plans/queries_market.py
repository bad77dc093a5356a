"""Queries over windows, statistics, market and tracking operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import pricing, units
from tidemark.operators import market, stats, windows
from tidemark.operators.slices import by_seconds
from tidemark.plans.registering import LOG, observations, query, read

GRID = [0, 25_000_000, 50_000_000, 100_000_000, 200_000_000, 400_000_000, 800_000_000, 1_600_000_000]


@query(LOG + """, s AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'view' THEN k END AS bid, CASE WHEN event_type = 'click' THEN k END AS ask FROM log)
SELECT event_id, last_value(bid IGNORE NULLS) OVER w AS bid, last_value(ask IGNORE NULLS) OVER w AS ask FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def book_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = observations(spark, sf_dir).withColumns({"bid": F.when(F.col("event_type") == "view", F.col("k")), "ask": F.when(F.col("event_type") == "click", F.col("k"))})
    return windows.carry_forward(s, ["user_id"], ["ts", "event_id"], ["bid", "ask"], by_seconds(7 * 86_400)).select("event_id", "bid", "ask")


@query(LOG + "SELECT user_id, coalesce(arg_max(k, (ts, event_id)) FILTER (event_type = 'purchase'), arg_max(k, (ts, event_id)) FILTER (event_type = 'view')) AS closing FROM log GROUP BY user_id")
def closing_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = lambda t: F.max(F.when(F.col("event_type") == t, F.struct("ts", "event_id", "k")))["k"]
    return observations(spark, sf_dir).groupBy("user_id").agg(F.coalesce(last("purchase"), last("view")).alias("closing"))


@query("""WITH o AS (SELECT o_orderkey, o_custkey, date_trunc('year', o_orderdate) AS y, o_orderdate, epoch_us(o_orderdate) - epoch_us(lag(o_orderdate) OVER (PARTITION BY o_custkey, date_trunc('year', o_orderdate) ORDER BY o_orderdate, o_orderkey)) AS gap,
row_number() OVER (PARTITION BY o_custkey, date_trunc('year', o_orderdate) ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
SELECT o_orderkey, CASE WHEN min(gap) OVER (PARTITION BY o_custkey, y) < 86400000000 * 10 THEN NULL ELSE n END AS number FROM o""")
def slate_game_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumn("y", F.date_trunc("year", "o_orderdate"))
    return windows.slate_numbers(o, ["o_custkey", "y"], "o_orderdate", "o_orderkey", 864_000).select("o_orderkey", "number")


@query("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) <= floor(count(*) OVER () * 0.7) AS train FROM events")
def chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.chronological_split(read(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 0.7).select("event_id", "train")


@query("SELECT event_id, row_number() OVER (ORDER BY ts, user_id, event_id) AS rank FROM events")
def total_replay_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.global_rank(read(spark, sf_dir, "events").select("event_id", "ts", "user_id"), ["ts", "user_id", "event_id"]).select("event_id", "rank")


@query("""WITH p AS (SELECT event_id, user_id, ts, CAST(event_id % 97 AS DOUBLE) AS x, CAST(event_id % 53 AS DOUBLE) AS y FROM events),
d AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS dt, sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)) AS m FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT event_id, round(CASE WHEN dt > 0 THEN m / dt END, 9) AS speed FROM d""")
def frame_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "events").withColumns({"x": (F.col("event_id") % 97).cast("double"), "y": (F.col("event_id") % 53).cast("double")})
    return windows.speeds(p, ["user_id"], "ts", "x", "y").select("event_id", F.round("speed", 9).alias("speed"))


@query("""WITH s AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT *, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM s)
SELECT o_custkey, p + 1 AS missing_from, o_orderkey - 1 AS missing_to FROM b WHERE o_orderkey > p + 1""")
def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sequence_gaps(read(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0"), ["o_custkey"], "o_orderkey")


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW) AS n_trailing FROM events")
def rate_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.trailing_count(read(spark, sf_dir, "events"), ["user_id"], "ts", 21_600).select("event_id", "n_trailing")


@query("""WITH c AS (SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey, l_linenumber) AS copy FROM lineitem),
p AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, copy = 1 ORDER BY l_orderkey, l_linenumber) AS place FROM c)
SELECT l_suppkey, count(*) AS received, count(*) FILTER (copy = 1 AND place <= 20) AS selected, count(*) FILTER (copy = 1 AND place > 20) AS truncated, count(*) FILTER (copy > 1) AS deduplicated FROM p GROUP BY 1""")
def selection_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = windows.select_first(read(spark, sf_dir, "lineitem"), ["l_partkey"], [F.asc("l_orderkey"), F.asc("l_linenumber")], 20, ["l_suppkey"])
    n = lambda o: F.count_if(F.col("outcome") == o).alias(o)
    return marked.groupBy("l_suppkey").agg(F.count("*").alias("received"), n("selected"), n("truncated"), n("deduplicated"))


@query("SELECT id FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'x' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS id FROM orders) ORDER BY id IS NULL, coalesce(TRY_CAST(id AS BIGINT), 0), id")
def numeric_id_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = read(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string")).alias("id"))
    return i.orderBy(F.col("id").isNull(), F.coalesce(F.expr("try_cast(id AS bigint)"), F.lit(0)), "id")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def largest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the limit is the feature, and each task keeps only its best."""
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("SELECT l_orderkey, arg_max(l_linenumber, (CAST(l_discount * 100 AS INT), -l_linenumber)) AS line FROM lineitem GROUP BY 1")
def argmax_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((-F.max(F.struct((F.col("l_discount") * 100).cast("int"), -F.col("l_linenumber")))["col2"]).alias("line"))


@query("""SELECT conv_id, arg_max(turn, (CAST(text IS NOT NULL AND text <> '' AS INT) + CAST(role IS NOT NULL AS INT), role, -turn)) AS turn FROM conversations GROUP BY 1""")
def richest_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = (F.col("text").isNotNull() & (F.col("text") != "")).cast("int") + F.col("role").isNotNull().cast("int")
    return read(spark, sf_dir, "conversations").groupBy("conv_id").agg((-F.max(F.struct(filled, "role", -F.col("turn")))["col3"]).alias("turn"))


@query("SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, max(value) AS max FROM events GROUP BY 1")
def percentile_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = stats.distribution(read(spark, sf_dir, "events"), "value", ["event_type"])
    return d.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("mean", "p50", "p95", "p99")], "max")


@query("""WITH g AS (SELECT event_type, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS gap FROM events), k AS (SELECT event_type, gap, (SELECT min(b) FROM (SELECT CAST(m * pow(10, d) AS BIGINT) AS b FROM (VALUES (1), (2), (5)) x(m), range(14) y(d)) WHERE b >= gap) AS b FROM g WHERE gap IS NOT NULL),
c AS (SELECT event_type, b, count(*) AS n FROM k GROUP BY ALL), u AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY b) AS upto, sum(n) OVER (PARTITION BY event_type) AS total FROM c), m AS (SELECT event_type, max(gap) AS most FROM k GROUP BY 1)
SELECT u.event_type, CAST(max(total) AS BIGINT) AS n, min(CASE WHEN upto >= ceil(0.5 * total) THEN least(b, most) END) AS p50, min(CASE WHEN upto >= ceil(0.99 * total) THEN least(b, most) END) AS p99 FROM u JOIN m USING (event_type) GROUP BY 1""")
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    e = read(spark, sf_dir, "events")
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    gaps = e.withColumn("gap", us(F.lead("ts").over(W.partitionBy("user_id").orderBy("ts", "event_id"))) - us(F.col("ts"))).where("gap IS NOT NULL")
    return stats.bucket_percentiles(gaps, "gap", stats.bounds_1_2_5(14), [0.5, 0.99], ["event_type"])


SCORED = "WITH s AS (SELECT event_id, (CAST(props->>'k' AS INT) % 101) / 100.0 AS p, CAST(event_id % 3 = 0 AS INT) AS y FROM events) "


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select("event_id", ((F.col("k") % 101) / 100.0).alias("p"), (F.col("event_id") % 3 == 0).cast("int").alias("y"))


@query(SCORED + """, b AS (SELECT least(CAST(floor(p * 10) AS INT), 9) AS bin, p, y FROM s), c AS (SELECT bin, count(*) AS n, sum(p) AS sp, sum(y) AS sy, sum((p - y) * (p - y)) AS se FROM b GROUP BY 1)
SELECT round(sum(se) / sum(n), 9) AS brier, round(sum(abs(sp - sy)) / sum(n), 9) AS ece, CAST(sum(n) AS BIGINT) AS n FROM c""")
def calibration_ece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.calibration(_scored(spark, sf_dir), "p", "y").select(F.round("brier", 9).alias("brier"), F.round("ece", 9).alias("ece"), "n")


@query(SCORED + """SELECT CAST(r.bin AS INT) AS bin, count(s.p) AS n, round(avg(s.p), 9) AS mean_p, round(avg(s.y), 9) AS rate FROM range(10) r(bin) LEFT JOIN s ON least(CAST(floor(s.p * 10) AS INT), 9) = r.bin GROUP BY 1""")
def reliability_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.reliability(_scored(spark, sf_dir), "p", "y").select("bin", "n", F.round("mean_p", 9).alias("mean_p"), F.round("rate", 9).alias("rate"))


@query("""WITH e AS (SELECT abs((l_linenumber % 7) / 7.0 - l_discount) AS err FROM lineitem) SELECT count(err) AS n, round(avg(err), 9) AS mean, round(quantile_cont(err, 0.5), 9) AS p50, round(quantile_cont(err, 0.95), 9) AS p95, round(quantile_cont(err, 0.99), 9) AS p99, round(max(err), 9) AS max FROM e""")
def approximation_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "lineitem").select(F.abs((F.col("l_linenumber") % 7) / 7.0 - F.col("l_discount")).alias("err"))
    return stats.distribution(e, "err").select("n", *[F.round(c, 9).alias(c) for c in ("mean", "p50", "p95", "p99", "max")])


@query("""WITH g AS (SELECT greatest(-15, least(15, CAST(l_quantity AS INT) - 25)) AS gx, least(l_linenumber, 5) AS gy, l_returnflag = 'R' AS won FROM lineitem), c AS (SELECT gx, gy, count(*) AS n, avg(CAST(won AS INT)) AS rate FROM g GROUP BY ALL)
SELECT x.gx, y.gy, coalesce(n, 0) AS n, round(rate, 9) AS rate FROM range(-15, 16) x(gx) CROSS JOIN range(1, 6) y(gy) LEFT JOIN c ON c.gx = x.gx AND c.gy = y.gy""")
def empirical_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").withColumn("won", (F.col("l_returnflag") == "R").cast("int"))
    x = F.greatest(F.lit(-15), F.least(F.lit(15), F.col("l_quantity").cast("int") - 25)).cast("long")
    return stats.rate_grid(li, x, F.least("l_linenumber", F.lit(5)).cast("long"), "won", range(-15, 16), range(1, 6)).select("gx", "gy", "n", F.round("rate", 9).alias("rate"))


@query("""WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders WHERE o_orderkey % 50 = 0), w AS (SELECT lo - 0.1 * (hi - lo) AS lo, hi + 0.1 * (hi - lo) AS hi FROM b)
SELECT o_orderkey, o_totalprice < lo OR o_totalprice > hi AS ood, round(greatest(0, (lo - o_totalprice) / (hi - lo), (o_totalprice - hi) / (hi - lo)), 9) AS ood_score FROM orders, w""")
def ood_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    bounds = stats.trained_bounds(o.where("o_orderkey % 50 = 0"), ["o_totalprice"])
    return stats.out_of_bounds(o, bounds, ["o_totalprice"]).select("o_orderkey", "ood", F.round("ood_score", 9).alias("ood_score"))


@query("SELECT l_orderkey, CASE WHEN count(CASE WHEN l_quantity > 3 THEN 1 END) = max(l_linenumber) THEN sum(CASE WHEN l_quantity > 3 THEN CAST(l_quantity AS BIGINT) END) END AS total, max(l_linenumber) AS n_periods FROM lineitem GROUP BY 1")
def trustworthy_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").withColumn("v", F.when(F.col("l_quantity") > 3, F.col("l_quantity").cast("long")))
    return stats.complete_sum(li, ["l_orderkey"], "l_linenumber", "v")


@query("""WITH h AS (SELECT sha256(concat_ws(chr(31), o_custkey, o_orderkey, o_orderstatus)) AS h FROM orders)
SELECT count(*) AS n_rows, CAST(sum(CAST('0x' || h[1:12] AS BIGINT)) AS VARCHAR) AS sum_a, CAST(sum(CAST('0x' || h[13:24] AS BIGINT)) AS VARCHAR) AS sum_b FROM h""")
def multiset_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.multiset_digest(read(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


@query("SELECT count(*) AS n, sha256(string_agg(v, chr(10) ORDER BY v)) AS digest FROM (SELECT DISTINCT p_brand AS v FROM part)")
def set_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.set_digest(read(spark, sf_dir, "part"), "p_brand")


LEVELS = "WITH lv AS (SELECT l_partkey, CAST(1 + CAST(floor(l_extendedprice) AS BIGINT) % 99 AS INT) AS price, sum(CAST(l_quantity AS BIGINT)) AS size FROM lineitem GROUP BY ALL) "


def _ladders(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = read(spark, sf_dir, "lineitem").select("l_partkey", (1 + F.floor("l_extendedprice").cast("long") % 99).cast("int").alias("price"), F.col("l_quantity").cast("long").alias("size"))
    return market.ladders(levels, ["l_partkey"], "price", "size")


@query(LEVELS + """, c AS (SELECT *, min(price) OVER p AS best, coalesce(sum(size) OVER (PARTITION BY l_partkey ORDER BY price ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM lv WINDOW p AS (PARTITION BY l_partkey)),
t AS (SELECT l_partkey, best, price, CASE WHEN price <= best + 10 THEN greatest(0, least(size, 60 - before)) ELSE 0 END AS take FROM c)
SELECT l_partkey, max(best) AS best, CAST(sum(take) AS BIGINT) AS filled, round(sum(take * price) / sum(take), 9) AS avg_price FROM t GROUP BY 1""")
def ladder_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.col("ladder")[0]["price"]
    walked = _ladders(spark, sf_dir).withColumn("best", best).withColumn("w", pricing.walk_ladder(F.col("ladder"), F.lit(60), best + 10))
    return walked.select("l_partkey", "best", F.col("w.filled").alias("filled"), F.round(pricing.average(F.col("w")), 9).alias("avg_price"))


@query("""SELECT l_orderkey, l_linenumber, CAST(ceil(round(0.07 * (p / 100.0) * (1 - p / 100.0) * 100 * l_quantity, 9)) AS DOUBLE) AS fee FROM (SELECT *, 1 + CAST(l_partkey % 99 AS INT) AS p FROM lineitem)""")
def fee_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = (1 + F.col("l_partkey") % 99).cast("int")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", pricing.fee_total(price, F.col("l_quantity")).alias("fee"))


QUOTES = """WITH q AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity AS BIGINT) AS filled, 1 + CAST(l_partkey % 99 AS INT) AS avg, 1 + CAST(l_suppkey % 99 AS INT) AS fair, l_discount AS std, CAST(l_linenumber AS DOUBLE) * 1e8 AS lag FROM lineitem),
e AS (SELECT *, fair - avg - 0.07 * (avg / 100.0) * (1 - avg / 100.0) * 100 - 2.0 * std * 100 - 1.5 * lag / 1e9 AS edge FROM q) """


def _quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    q = li.select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").cast("long").alias("filled"), (1 + F.col("l_partkey") % 99).cast("int").alias("avg"), (1 + F.col("l_suppkey") % 99).cast("int").alias("fair"),
        F.col("l_discount").alias("std"), (F.col("l_linenumber").cast("double") * 1e8).alias("lag"),
    )
    return q.withColumn("edge", pricing.edge(F.col("fair"), F.col("avg"), pricing.reserve_uncertainty(F.col("std"), 2.0), pricing.reserve_adverse(F.col("lag"), 1.5)))


@query(QUOTES + "SELECT l_orderkey, l_linenumber, round(edge, 6) AS edge FROM e")
def quote_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quotes(spark, sf_dir).select("l_orderkey", "l_linenumber", F.round("edge", 6).alias("edge"))


@query(QUOTES + """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN 'stale' WHEN filled % 10 = 0 THEN 'suspended' WHEN filled % 11 = 0 THEN 'no_fill' WHEN avg > fair THEN 'miss' WHEN filled >= 25 THEN 'filled' ELSE 'partial' END AS outcome,
CASE WHEN filled > 0 THEN (fair - avg) * filled - CAST(ceil(round(0.07 * (avg / 100.0) * (1 - avg / 100.0) * 100 * filled, 9)) AS DOUBLE) ELSE 0 END AS profit, fair - avg AS clv FROM e""")
def fill_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _quotes(spark, sf_dir)
    status = F.when(F.col("filled") % 10 == 0, "paused").otherwise("open")
    levels = F.when(F.col("filled") % 11 == 0, 0).otherwise(1)
    out = pricing.fill_outcome(F.col("l_linenumber") == 7, status, levels, F.col("avg"), F.col("fair"), F.col("filled"), F.lit(25))
    return q.select("l_orderkey", "l_linenumber", out.alias("outcome"), pricing.expected_profit(F.col("fair"), F.col("avg"), F.col("filled")).alias("profit"), pricing.closing_value(F.col("fair"), F.col("avg"), F.col("filled")).alias("clv"))


@query(QUOTES + """, a AS (SELECT *, greatest(0, least(filled, 40.0 - l_linenumber * 6)) AS allowed FROM e)
SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 17 = 0 THEN 'watch' WHEN l_suppkey % 13 = 0 THEN 'skip' WHEN lag > 6e8 THEN 'skip' WHEN std > 0.09 THEN 'watch' WHEN allowed <= 0 THEN 'skip' WHEN edge >= 2 THEN 'bet' WHEN edge >= 1 THEN 'watch' ELSE 'skip' END AS action,
CASE WHEN l_suppkey % 17 = 0 THEN 'debounced_nonmaterial' WHEN l_suppkey % 13 = 0 THEN 'market_closed' WHEN lag > 6e8 THEN 'provider_lag_exceeded' WHEN std > 0.09 THEN 'out_of_distribution' WHEN allowed <= 0 THEN 'risk_limit_reached' WHEN edge >= 2 THEN 'edge_clears_threshold' WHEN edge >= 1 THEN 'thin_edge' ELSE 'no_edge' END AS reason FROM a""")
def decision_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _quotes(spark, sf_dir)
    rows = {
        "material": F.col("l_suppkey") % 17 != 0, "sequence_ok": F.lit(True), "status": F.when(F.col("l_suppkey") % 13 == 0, "closed").otherwise("open"), "age_ns": F.lit(0), "max_age_ns": F.lit(1),
        "lag_ns": F.col("lag"), "max_lag_ns": F.lit(6e8), "ood": F.col("std") > 0.09, "filled": F.col("filled"), "edge": F.col("edge"),
        "allowed": pricing.allowed_size(F.col("l_linenumber") * 6, F.col("filled"), 40.0),
    }
    action, reason = pricing.decision(rows, 2.0, 1.0)
    return q.select("l_orderkey", "l_linenumber", action.alias("action"), reason.alias("reason"))


CURVE = LOG + """, d AS (SELECT k - 40.0 AS profit, k / 2.0 AS edge, epoch_us(ts) % 3000000000 AS at_us, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS wait FROM log),
x AS (SELECT g AS latency_ns, coalesce(wait / 100 <= g / 1000, false) AS stale, profit, edge, edge - 10 AS clv FROM d, (SELECT unnest([0, 25000000, 50000000, 100000000, 200000000, 400000000, 800000000, 1600000000]) AS g)),
c AS (SELECT CAST(latency_ns AS BIGINT) AS latency_ns, count(*) AS n, count(*) FILTER (NOT stale) AS n_actionable, round(avg(CASE WHEN stale THEN 0 ELSE profit END), 9) AS mean_profit, round(avg(edge), 9) AS mean_edge, round(avg(clv) FILTER (NOT stale), 9) AS mean_clv, avg(CASE WHEN stale THEN 0.0 ELSE 1.0 END) AS fill_rate FROM x GROUP BY 1) """


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    us = lambda c: F.unix_micros(c.cast("timestamp"))
    wait = us(F.lead("ts").over(W.partitionBy("user_id").orderBy("ts", "event_id"))) - us(F.col("ts"))
    return observations(spark, sf_dir).select(F.lit(0).cast("long").alias("at_ns"), (wait / 100 * 1000).alias("next_ns"), (F.col("k") / 2.0).alias("edge"), (F.col("k") - 40.0).alias("profit"))


@query(CURVE + "SELECT latency_ns, n, n_actionable, mean_profit, mean_edge, mean_clv, round(fill_rate, 9) AS fill_rate FROM c")
def latency_grid_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = market.latency_curves(_decisions(spark, sf_dir).withColumn("clv", F.col("edge") - 10), GRID, "at_ns", "next_ns", "edge", "profit", "clv")
    return c.select("latency_ns", "n", "n_actionable", *[F.round(x, 9).alias(x) for x in ("mean_profit", "mean_edge", "mean_clv", "fill_rate")])


@query("""WITH c AS (SELECT l_linenumber AS x, round(avg(30 - l_linenumber * 9 + l_tax), 6) AS y FROM lineitem GROUP BY 1), p AS (SELECT x, y, lag(x) OVER (ORDER BY x) AS px, lag(y) OVER (ORDER BY x) AS py FROM c)
SELECT round(arg_min(CASE WHEN px IS NULL OR py = y THEN x ELSE px + py / (py - y) * (x - px) END, x), 9) AS break_even FROM p WHERE y < 0""")
def break_even_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("x")).agg(F.round(F.avg(30 - F.col("l_linenumber") * 9 + F.col("l_tax")), 6).alias("y"))
    return market.break_even(c, "x", "y").select(F.round("break_even", 9).alias("break_even"))


@query(LOG + """, u AS (SELECT user_id, ts, event_id, event_type = 'signup' OR event_id % 400 = 0 AS snap, CASE WHEN event_id % 2 = 0 THEN 'yes' ELSE 'no' END AS side, 1 + k % 40 AS price, event_id % 5 - 1 AS qty FROM log),
e AS (SELECT *, sum(CAST(snap AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ep FROM u), l AS (SELECT *, max(ep) OVER (PARTITION BY user_id) AS top FROM e WHERE ep > 0),
n AS (SELECT user_id, side, price, arg_max(qty, (ts, event_id)) AS qty FROM l WHERE ep = top GROUP BY ALL)
SELECT user_id, max(price) FILTER (side = 'yes') AS best_yes, max(price) FILTER (side = 'no') AS best_no, 100 - max(price) FILTER (side = 'no') AS yes_ask, 100 - max(price) FILTER (side = 'yes') AS no_ask FROM n WHERE qty > 0 GROUP BY 1""")
def order_book_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = observations(spark, sf_dir).select(
        "user_id", "ts", "event_id", ((F.col("event_type") == "signup") | (F.col("event_id") % 400 == 0)).alias("snap"), F.when(F.col("event_id") % 2 == 0, "yes").otherwise("no").alias("side"),
        (1 + F.col("k") % 40).alias("price"), (F.col("event_id") % 5 - 1).alias("qty"),
    )
    return market.best_prices(market.book_state(u, ["user_id"], ["ts", "event_id"], "snap", "side", "price", "qty"), ["user_id"], "side", "price")


POINTS = "WITH p AS (SELECT vec_id, vec_id // 10 AS frame, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings) "


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", F.expr("vec_id div 10").alias("frame"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))


@query(POINTS + "SELECT a.frame, round(avg(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))), 9) AS spacing FROM p a JOIN p b ON a.frame = b.frame AND a.vec_id < b.vec_id GROUP BY 1")
def lineup_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.spacing(_points(spark, sf_dir), ["frame"], "x", "y").where("spacing IS NOT NULL").select("frame", F.round("spacing", 9).alias("spacing"))


@query(POINTS + "SELECT a.vec_id, a.frame, round(min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))), 9) AS distance FROM p a LEFT JOIN (SELECT * FROM p WHERE vec_id % 10 >= 5) b ON a.frame = b.frame WHERE a.vec_id % 10 < 5 GROUP BY ALL")
def nearest_defender(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _points(spark, sf_dir)
    return market.nearest(p.where("vec_id % 10 < 5"), p.where("vec_id % 10 >= 5"), ["frame"], "x", "y").select("vec_id", "frame", F.round("distance", 9).alias("distance"))


@query("SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS filled, round(sum(l_quantity * l_extendedprice) / sum(l_quantity), 6) AS avg_price FROM lineitem GROUP BY 1")
def order_fill_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").withColumn("q", F.col("l_quantity").cast("long"))
    return market.average_fill(li, ["l_orderkey"], "q", "l_extendedprice").withColumn("avg_price", F.round("avg_price", 6))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 61 - 30 AS DOUBLE) AS x, CAST(l_suppkey % 40 - 2 AS DOUBLE) AS y FROM lineitem), d AS (SELECT *, sqrt(x * x + y * y) AS d FROM p)
SELECT l_orderkey, l_linenumber, CASE WHEN abs(x) >= 22 AND y BETWEEN 0 AND 14 AND d >= 22 THEN 'corner_three' WHEN d >= 23.75 THEN 'above_the_break_three' WHEN d <= 4 THEN 'restricted_area' WHEN abs(x) <= 8 AND y <= 19 THEN 'paint' ELSE 'mid_range' END AS zone FROM d""")
def shot_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = (F.col("l_partkey") % 61 - 30).cast("double"), (F.col("l_suppkey") % 40 - 2).cast("double")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", units.shot_zone(x, y).alias("zone"))
