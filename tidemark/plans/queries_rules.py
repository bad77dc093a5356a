"""Queries over column functions, resolution and provenance operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import pricing, texts, times, units
from tidemark.operators import provenance, resolve
from tidemark.operators.quality import first_reason
from tidemark.operators.slices import dealt
from tidemark.plans.registering import LOG, instant, observations, query, read

ODDS = "WITH o AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 601 - 300 AS INT) AS odds FROM lineitem) "


@query(ODDS + "SELECT l_orderkey, l_linenumber, abs(odds) >= 100 AS valid, round(CASE WHEN odds > 0 THEN 1 + odds / 100.0 WHEN odds < 0 THEN 1 + 100.0 / abs(odds) END, 9) AS dec, round(CASE WHEN odds > 0 THEN 100.0 / (odds + 100) WHEN odds < 0 THEN abs(odds) / (abs(odds) + 100.0) END, 9) AS implied FROM o")
def american_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    odds = (F.col("l_partkey") % 601 - 300).cast("int")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", pricing.valid_american(odds).alias("valid"), F.round(pricing.decimal_odds(odds), 9).alias("dec"), F.round(pricing.implied_probability(odds), 9).alias("implied"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND month(o_orderdate) < 7 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS season FROM orders""")
def season_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    league = F.when(F.col("o_orderkey") % 2 == 0, "NBA").otherwise("MLB")
    return read(spark, sf_dir, "orders").select("o_orderkey", times.season_year(league, F.col("o_orderdate")).alias("season"))


@query("""WITH s AS (SELECT o_orderkey, o_orderkey % 2 = 0 AS nba, CASE WHEN o_orderkey % 2 = 0 AND month(o_orderdate) < 7 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS y FROM orders)
SELECT o_orderkey, CAST(CASE WHEN nba THEN make_date(y, 7, 1) ELSE make_date(y, 1, 1) END AS VARCHAR) AS first_day, CAST(CASE WHEN nba THEN make_date(y + 1, 6, 30) ELSE make_date(y, 12, 31) END AS VARCHAR) AS last_day FROM s""")
def season_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    league = F.when(F.col("o_orderkey") % 2 == 0, "NBA").otherwise("MLB")
    y = times.season_year(league, F.col("o_orderdate"))
    return read(spark, sf_dir, "orders").select("o_orderkey", times.season_start(league, y).cast("string").alias("first_day"), times.season_end(league, y).cast("string").alias("last_day"))


@query("""SELECT event_id, make_timestamp((g0 + CAST(floor((s - g0) / g) AS BIGINT) * g) * 1000000) AS grid FROM (SELECT event_id, CAST(floor(epoch_us(ts) / 1e6) AS BIGINT) AS s, 1591401600 AS g0, CASE WHEN ts >= TIMESTAMP '2022-09-18' THEN 300 ELSE 600 END AS g FROM (SELECT event_id, ts - to_days(CAST(event_id % 2000 AS INT)) AS ts FROM events))""")
def grid_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) - (F.col("event_id") % 2000) * 86_400_000_000).cast("timestamp_ntz")
    return read(spark, sf_dir, "events").select("event_id", times.floor_to_grid(at).alias("grid"))


@query("SELECT event_id, make_timestamp(CAST(floor((epoch_us(ts) // 1000000 - 3600) / 300) AS BIGINT) * 300000000) AS bucket, ts + INTERVAL 6 HOUR AS available FROM events")
def target_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", times.bucket_before(F.col("ts")).alias("bucket"), times.available_at(F.col("ts"), F.lit(6)).alias("available"))


@query("""SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate - INTERVAL 5 HOUR AS DATE) WHEN o_orderkey % 3 = 1 THEN DATE '1999-09-09' ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS day, CASE o_orderkey % 3 WHEN 0 THEN 'venue' WHEN 1 THEN 'provider' ELSE 'utc' END AS basis FROM orders""")
def local_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.when(F.col("o_orderkey") % 3 == 0, "America/Panama").otherwise("No/Where")
    given = F.when(F.col("o_orderkey") % 3 == 1, F.lit("1999-09-09").cast("date"))
    day, basis = times.local_date(F.col("o_orderdate"), zone, given, F.lit(None).cast("string"), ["America/Panama", "Europe/Paris"])
    return read(spark, sf_dir, "orders").select("o_orderkey", day.cast("string").alias("day"), basis.alias("basis"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 < 2 AND l_shipdate >= o_orderdate THEN epoch_us(l_shipdate) // 1000000 - epoch_us(o_orderdate) // 1000000 END AS lead0,
CASE l_linenumber % 3 WHEN 0 THEN CAST(o_orderdate <= l_shipdate AS VARCHAR) WHEN 2 THEN 'false' END AS eligible FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def forecast_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    kind = F.when(F.col("l_linenumber") % 3 == 0, "current_forecast").when(F.col("l_linenumber") % 3 == 1, "historical_forecast").otherwise("station_observation")
    lead, eligible = times.lead_and_eligibility(kind, F.col("l_shipdate"), F.col("o_orderdate"), F.col("l_shipdate"))
    return both.select("l_orderkey", "l_linenumber", lead.alias("lead0"), eligible.cast("string").alias("eligible"))


@query("""WITH v AS (SELECT event_id, event_id % 7 AS m, CAST(props->>'k' AS INT) AS k FROM events)
SELECT event_id, CASE m WHEN 0 THEN round((k - 32) * 5 / 9.0, 9) WHEN 1 THEN k END AS temperature, CASE m WHEN 2 THEN round(k * 0.44704, 9) WHEN 3 THEN round(k / 3.6, 9) END AS speed, CASE m WHEN 5 THEN 22.5 * 2 WHEN 6 THEN 337.5 ELSE k END AS direction, CASE m WHEN 0 THEN round(k * 25.4, 9) WHEN 1 THEN k * 1000.0 END AS rain FROM v""")
def unit_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, m = F.col("k").cast("string"), F.col("event_id") % 7
    e = observations(spark, sf_dir)
    value = F.when(m == 2, F.concat(k, F.lit(" mph"))).when(m == 3, F.concat(k, F.lit(" km/h"))).when(m == 4, F.concat(k, F.lit(" to 99 mph"))).otherwise(F.concat(k, F.lit(" furlongs")))
    heading = F.when(m == 5, "NE").when(m == 6, " nnw ").otherwise(k)
    return e.select(
        "event_id", F.round(units.celsius(k, F.when(m == 0, "wmoUnit:degF").when(m == 1, "C").otherwise("K")), 9).alias("temperature"), F.round(units.metres_per_second(value, F.lit(None).cast("string")), 9).alias("speed"),
        units.degrees(heading).alias("direction"), F.round(units.millimetres(k, F.when(m == 0, "inch").when(m == 1, "m").otherwise("pint")), 9).alias("rain"),
    )


@query("SELECT l_orderkey, l_linenumber, 80 + l_quantity / 2 >= 95 AS hard_hit, 80 + l_quantity / 2 >= 98 AND l_suppkey % 40 BETWEEN 26 AND 30 AS barrel, round(sqrt(pow(l_quantity, 2) + pow(l_linenumber, 2)), 9) AS speed FROM lineitem")
def batted_ball_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard, barrel = units.batted_ball(80 + F.col("l_quantity") / 2, F.col("l_suppkey") % 40)
    speed = units.movement_speed(F.lit(None).cast("double"), F.col("l_quantity"), F.col("l_linenumber").cast("double"), F.lit(None).cast("double"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", hard.alias("hard_hit"), barrel.alias("barrel"), F.round(speed, 9).alias("speed"))


NAMES = """WITH n AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'D''Angelo O.B. ' || c_custkey || ' Jr.' WHEN 1 THEN 'N.Y.' WHEN 2 THEN 'St. Louis-Acuña & Co' WHEN 3 THEN c_name ELSE 'J R Smith III' END AS raw FROM customer) """


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("c_custkey") % 5
    raw = F.when(m == 0, F.concat(F.lit("D'Angelo O.B. "), F.col("c_custkey").cast("string"), F.lit(" Jr."))).when(m == 1, "N.Y.").when(m == 2, "St. Louis-Acuña & Co").when(m == 3, F.col("c_name")).otherwise("J R Smith III")
    return read(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))


@query(NAMES + """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'dangelo o b ' || c_custkey WHEN 1 THEN 'ny' WHEN 2 THEN 'st louis acuna and co' WHEN 3 THEN lower(raw) ELSE 'j r smith' END AS name, CASE c_custkey % 5 WHEN 0 THEN 'jr' WHEN 4 THEN 'iii' ELSE '' END AS suffix FROM n""")
def name_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("c_custkey", texts.normalized_name(F.col("raw")).alias("name"), texts.name_suffix(F.col("raw")).alias("suffix"))


@query(NAMES + "SELECT c_custkey, regexp_replace(regexp_replace(lower(raw), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM n")
def slug_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("c_custkey", texts.slug(F.col("raw")).alias("slug"))


@query("""SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"' || CASE WHEN o_orderkey % 2 = 0 THEN ',"zone":null' ELSE ',"zone":"z"' END || '}') AS digest FROM orders""")
def canonical_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumn("zone", F.when(F.col("o_orderkey") % 2 == 1, "z"))
    return o.select("o_orderkey", texts.content_hash(["zone", "o_custkey", "o_orderstatus"]).alias("digest"))


@query("SELECT subject, subject LIKE 'mkt.%.book' AND len(string_split(subject, '.')) = 3 AS one, subject = 'mkt' OR subject LIKE 'mkt.%' AS tail FROM (SELECT DISTINCT CASE n_nationkey % 4 WHEN 0 THEN 'mkt' WHEN 1 THEN 'mkt.' || n_name || '.book' WHEN 2 THEN 'mkt.' || n_name || '.x.book' ELSE 'other.' || n_name END AS subject FROM nation)")
def subject_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("n_nationkey") % 4
    s = F.when(m == 0, "mkt").when(m == 1, F.concat(F.lit("mkt."), "n_name", F.lit(".book"))).when(m == 2, F.concat(F.lit("mkt."), "n_name", F.lit(".x.book"))).otherwise(F.concat(F.lit("other."), "n_name"))
    return read(spark, sf_dir, "nation").select(s.alias("subject")).distinct().select("subject", F.col("subject").rlike(texts.subject_pattern("mkt.*.book")).alias("one"), F.col("subject").rlike(texts.subject_pattern("mkt.>")).alias("tail"))


@query("SELECT page_id, CASE WHEN contains(u, 'api_key=') THEN regexp_replace(u, 'api_key=[^&]*', 'api_key=[REDACTED]') ELSE u END AS url FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://h/x?api_key=s3cret' || page_id || '&page=2' ELSE 'https://h/x?page=' || page_id END AS u FROM pages)")
def secret_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("page_id").cast("string")
    u = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("https://h/x?api_key=s3cret"), n, F.lit("&page=2"))).otherwise(F.concat(F.lit("https://h/x?page="), n))
    return read(spark, sf_dir, "pages").select("page_id", texts.redact(u).alias("url"))


@query("""SELECT event_id, CASE WHEN s IN (401, 403) THEN 'not_entitled' WHEN s IN (404, 410) THEN 'not_found' WHEN s = 429 THEN 'rate_limited' WHEN s BETWEEN 200 AND 299 THEN 'available' WHEN s BETWEEN 500 AND 599 THEN 'server_error' ELSE 'unexpected' END AS class FROM (SELECT event_id, 200 + event_id % 400 AS s FROM events)""")
def http_status_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", texts.http_class(200 + F.col("event_id") % 400).alias("class"))


@query("""SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 2000 AND 2099 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) ELSE CAST(CAST(o_orderdate AS DATE) + INTERVAL (CASE WHEN year(o_orderdate) < 2000 THEN 100 ELSE 0 END) YEAR AS DATE)::VARCHAR END AS day, split_part(t, ' at ', 1) AS away, split_part(t, ' at ', 2) AS home FROM (SELECT *, 'Team ' || (o_orderkey % 7) || ' at Team ' || (o_custkey % 9) AS t FROM orders)""")
def ticker_and_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    ticker = F.concat(F.lit("GAMES-"), F.upper(F.date_format("o_orderdate", "yyMMMdd")), F.lit("ABCDEF"))
    title = F.concat(F.lit("Team "), (F.col("o_orderkey") % 7).cast("string"), F.lit(" at Team "), (F.col("o_custkey") % 9).cast("string"))
    parsed = texts.title_teams(title)
    return o.select("o_orderkey", texts.ticker_date(ticker).cast("string").alias("day"), parsed["first"].alias("away"), parsed["second"].alias("home"))


@query("""SELECT event_id, CASE m WHEN 0 THEN 'missing' WHEN 1 THEN 'ok' WHEN 2 THEN 'ok' ELSE 'malformed' END AS state, CASE WHEN m IN (1, 2) THEN date_trunc('second', ts) END AS at FROM (SELECT *, event_id % 4 AS m FROM events)""")
def instant_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("event_id") % 4
    text = F.when(m == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(m == 2, F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")).when(m == 3, "soon")
    at, state = times.parse_instant(text)
    return read(spark, sf_dir, "events").select("event_id", state.alias("state"), at.cast("timestamp_ntz").alias("at"))


@query("SELECT event_id, CAST(props->>'k' AS INT) AS k FROM events WHERE props->>'k' IS NOT NULL")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k int")
    return read(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k")).where("k IS NOT NULL")


@query("""SELECT o_orderkey, i AS book, j AS outcome, (o_orderkey + i * 10 + j) % 50 AS price FROM orders, range(1, 3) a(i), range(1, 4) b(j)""")
def nested_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = lambda i, j: ((F.col("o_orderkey") + i * 10 + j) % 50).cast("long")
    books = F.array(*[F.struct(F.lit(i).cast("long").alias("book"), F.array(*[F.struct(F.lit(j).cast("long").alias("outcome"), price(i, j).alias("price")) for j in (1, 2, 3)]).alias("outcomes")) for i in (1, 2)])
    body = F.to_json(F.struct(books.alias("books")))
    schema = "books array<struct<book:long,outcomes:array<struct<outcome:long,price:long>>>>"
    raw = read(spark, sf_dir, "orders").select("o_orderkey", F.from_json(body, schema).alias("b"))
    each = raw.select("o_orderkey", F.explode("b.books").alias("x")).select("o_orderkey", F.col("x.book").alias("book"), F.explode("x.outcomes").alias("y"))
    return each.select("o_orderkey", "book", F.col("y.outcome").alias("outcome"), F.col("y.price").alias("price"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 2 THEN 'too_small' WHEN l_discount > 0.09 THEN 'bad_price' WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'bad_state' END AS reason FROM lineitem""")
def validity_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    why = first_reason([("too_small", F.col("l_quantity") < 2), ("bad_price", F.col("l_discount") > 0.09), ("bad_state", (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"))])
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", why.alias("reason"))


ALIASES = """WITH a AS (SELECT s_suppkey % 40 AS alias, s_suppkey AS entity, s_suppkey % 3 AS tier, s_suppkey % 29 = 0 AS flagged FROM supplier) """


@query(ALIASES + """, t AS (SELECT alias, tier, count(DISTINCT entity) AS n, min(entity) AS e, bool_or(flagged) AS f FROM a GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY alias ORDER BY tier) AS r FROM t)
SELECT alias, tier, CASE WHEN n = 1 AND NOT f THEN e END AS entity, CASE WHEN n = 1 AND NOT f THEN 'matched' ELSE 'ambiguous' END AS outcome, CASE WHEN n = 1 AND NOT f THEN CASE tier WHEN 0 THEN 0.99 WHEN 1 THEN 0.95 ELSE 0.9 END END AS score FROM b WHERE r = 1""")
def alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 40).alias("alias"), F.col("s_suppkey").alias("entity"), (F.col("s_suppkey") % 3).alias("tier"), (F.col("s_suppkey") % 29 == 0).alias("flagged"))
    return resolve.resolve_tiers(a, ["alias"], "tier", "entity", "flagged", {0: 0.99, 1: 0.95, 2: 0.9})


@query("""WITH l AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey % 2 = 0), r AS (SELECT o_orderkey AS other, o_custkey, o_orderdate AS d FROM orders WHERE o_orderkey % 2 = 1),
c AS (SELECT o_orderkey, other, CASE WHEN abs(epoch_us(o_orderdate) - epoch_us(d)) <= 20 * 86400000000 THEN 1 ELSE 2 END AS tier FROM l JOIN r USING (o_custkey) WHERE abs(epoch_us(o_orderdate) - epoch_us(d)) <= 60 * 86400000000),
t AS (SELECT o_orderkey, tier, count(DISTINCT other) AS n, min(other) AS other FROM c GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY tier) AS k FROM t)
SELECT l.o_orderkey, b.tier, CASE WHEN n = 1 THEN other END AS other, CASE WHEN n IS NULL THEN 'unmatched' WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS outcome FROM l LEFT JOIN b ON l.o_orderkey = b.o_orderkey AND k = 1""")
def range_match_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    left, right = o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("other"), "o_custkey", F.col("o_orderdate").alias("d"))
    found = resolve.window_sets(left, right, ["o_custkey"], "o_orderkey", "other", "o_orderdate", "d", [20 * 86_400, 60 * 86_400])
    return resolve.with_unmatched(left, "o_orderkey", resolve.resolve_tiers(found, ["o_orderkey"], "tier", "other", last="last")).select("o_orderkey", "tier", "other", "outcome")


@query("""WITH e AS (SELECT event_id, CAST(props->>'k' AS INT) AS game, event_id % 17 = 0 AS swapped FROM events) SELECT event_id, game FROM e WHERE game IN (SELECT game FROM e GROUP BY game HAVING count(DISTINCT swapped) > 1)""")
def orientation_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = observations(spark, sf_dir).select("event_id", F.col("k").alias("game"), (F.col("event_id") % 17 == 0).alias("swapped"))
    return resolve.orientation_conflicts(e, "game", "swapped").select("event_id", "game")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 1 AND s_suppkey % 5 < 3 THEN s_nationkey END AS s_nationkey FROM supplier""")
def canonical_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    d = s.select("s_suppkey", "s_nationkey", F.when(F.col("s_suppkey") % 4 == 1, "accepted").otherwise("rejected").alias("outcome"), F.when(F.col("s_suppkey") % 5 < 3, instant("2024-01-01 00:00:00")).otherwise(instant("2024-03-01 00:00:00")).alias("decided_at"))
    return resolve.canonical(s, d, "s_suppkey", "s_nationkey", instant("2024-02-01 00:00:00"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN false WHEN o_orderkey % 4 = 1 THEN o_orderdate <= TIMESTAMP '1998-01-01' ELSE true END AS available FROM orders")
def review_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("o_orderkey") % 4
    return read(spark, sf_dir, "orders").select("o_orderkey", resolve.review_available(m == 0, F.when(m == 1, F.col("o_orderdate")), instant("1998-01-01 00:00:00")).alias("available"))


@query("""WITH f AS (SELECT l_orderkey, min(l_shipdate) AS label_at, max(l_returnflag) AS label FROM lineitem GROUP BY 1), g AS (SELECT o_orderkey, o_orderdate AS seen, CASE WHEN o_orderkey % 9 > 0 THEN o_orderdate + CASE WHEN o_orderkey % 8 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END END AS decided_at, label_at, o_orderstatus = 'F' AS final, NULLIF(label, 'R') AS label FROM orders LEFT JOIN f ON l_orderkey = o_orderkey)
SELECT o_orderkey, CASE WHEN decided_at IS NULL THEN 'unlinked' WHEN decided_at > seen THEN 'link_after_cutoff' WHEN label_at IS NULL THEN 'no_label' WHEN NOT final THEN 'not_final' WHEN label IS NULL THEN 'label_without_winner' WHEN label_at <= seen THEN 'label_not_after_cutoff' END AS excluded FROM g""")
def pregame_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("label_at"), F.max("l_returnflag").alias("label"))
    o = read(spark, sf_dir, "orders")
    late = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.when(F.col("o_orderkey") % 8 == 0, 86_400_000_000).otherwise(0)).cast("timestamp_ntz")
    games = o.join(labels, "o_orderkey", "left").withColumns({"decided_at": F.when(F.col("o_orderkey") % 9 > 0, late), "final": F.col("o_orderstatus") == "F", "label": F.nullif("label", F.lit("R"))})
    return provenance.pregame_rows(games, "o_orderdate", "decided_at", "label_at", "final", "label").select("o_orderkey", "excluded")


@query("""SELECT 'label_before_cutoff' AS rule, 'blocking' AS severity, CAST(l_orderkey AS VARCHAR) AS entity_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate
UNION ALL SELECT 'unlabelled', 'note', CAST(o_orderkey AS VARCHAR) FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def leakage_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", F.lit(True).alias("labelled"))
    o, li = dealt(["o_orderkey"], read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), li)
    early = F.col("l_shipdate") < F.col("o_orderdate")
    return provenance.judged(o.join(li, "o_orderkey", "left"), [("label_before_cutoff", "blocking", early, "o_orderkey"), ("unlabelled", "note", F.col("labelled").isNull(), "o_orderkey")])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 19 = 0 THEN 'unknown_namespace' WHEN o_orderstatus = 'P' THEN 'not_audited' WHEN o_orderdate > TIMESTAMP '2000-06-01' THEN 'after_cutoff' ELSE 'admitted' END AS decision FROM orders""")
def admission_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ladder = [("unknown_namespace", F.col("o_orderkey") % 19 == 0), ("not_audited", F.col("o_orderstatus") == "P"), ("after_cutoff", F.col("o_orderdate") > instant("2000-06-01 00:00:00"))]
    return provenance.admit(read(spark, sf_dir, "orders"), ladder).select("o_orderkey", "decision")


@query("SELECT p_partkey FROM part WHERE p_partkey % 23 = 0")
def digest_tampering(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    stored = p.withColumn("digest", F.sha2(F.concat_ws("\x1f", "p_brand", F.col("p_partkey").cast("string")), 256))
    tampered = stored.withColumn("p_brand", F.when(F.col("p_partkey") % 23 == 0, F.concat("p_brand", F.lit("!"))).otherwise(F.col("p_brand")))
    return provenance.digest_mismatches(tampered, ["p_partkey", "p_brand"], "digest").select("p_partkey")


@query("SELECT make_timestamp(CAST(floor((epoch_us(ts) // 1000000 - 3600) / 300) AS BIGINT) * 300000000) AS bucket, array_to_string(list_sort(list(DISTINCT user_id)), ',') AS games, count(DISTINCT user_id) AS n_games FROM events GROUP BY 1")
def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read(spark, sf_dir, "events").select(times.bucket_before(F.col("ts")).alias("bucket"), "user_id")
    return provenance.request_plan(t, "bucket", "user_id").withColumn("games", F.array_join(F.col("games").cast("array<string>"), ","))


@query("""SELECT conv_id, CASE WHEN conv_id % 5 = 1 AND n > 2 THEN 'missing' WHEN conv_id % 5 = 2 THEN 'cycle' WHEN conv_id % 5 = 3 THEN 'duplicate' WHEN conv_id % 5 = 4 AND n > 1 THEN 'unreachable' ELSE 'complete' END AS verdict
FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1)""")
def cursor_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a run of pages: whole, cut, in a circle, doubled, or with a loop beside a chain that ends."""
    w = W.partitionBy("conv_id")
    c = read(spark, sf_dir, "conversations").select("conv_id", F.row_number().over(w.orderBy("turn", "role", "text")).alias("page"), F.count("*").over(w).alias("n"))
    kind, last, half = F.col("conv_id") % 5, F.col("page") == F.col("n"), F.floor(F.col("n") / 2)
    next_page = F.when((kind == 4) & (F.col("n") > 1) & (F.col("page") == half), None).when(~last, F.col("page") + 1).when(kind == 2, 1).when((kind == 4) & (F.col("n") > 1), half + 1)
    pages = c.withColumn("next", next_page.cast("int")).where(~((kind == 1) & (F.col("n") > 2) & last))
    twice = pages.unionByName(pages.where("conv_id % 5 = 3 AND page = 1"))
    return provenance.chain_check(twice, "conv_id", "page", "next")


@query(LOG + "SELECT user_id, count(*) AS n_plays, max(ts) AS completed_at, arg_max(CASE WHEN k % 2 = 0 THEN 'end' ELSE 'play' END, (ts, event_id)) = 'end' AS complete FROM log GROUP BY 1")
def completion_derivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = observations(spark, sf_dir).withColumn("state", F.when(F.col("k") % 2 == 0, "end").otherwise("play")).withColumn("at", F.col("ts"))
    return provenance.completion(p, "user_id", ["ts", "event_id"], "state", "at")


@query("""WITH e AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 6 > 0), f AS (SELECT l_orderkey AS k, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1)
SELECT coalesce(e.k, f.k) AS k, CASE WHEN e.k IS NULL THEN 'unplanned' WHEN n IS NULL THEN 'not_acquired' WHEN n > 1 THEN 'acquired_twice' END AS failure FROM e FULL JOIN f ON e.k = f.k WHERE e.k IS NULL OR n IS NULL OR n > 1""")
def certification(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = read(spark, sf_dir, "orders").where("o_orderkey % 6 > 0").select(F.col("o_orderkey").alias("k"))
    return provenance.certify(planned, read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_returnflag").distinct(), ["k"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01')")
def checkpoint_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = read(spark, sf_dir, "lineitem").where(F.col("l_shipdate") < instant("1999-01-01 00:00:00")).select(F.col("l_orderkey").alias("o_orderkey"))
    return provenance.remaining(read(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query("SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS requests, CAST(sum(l_linenumber * 1) AS BIGINT) AS least_credits, CAST(sum(l_linenumber * 10) AS BIGINT) AS most_credits FROM lineitem GROUP BY 1")
def credit_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = read(spark, sf_dir, "lineitem").withColumns({"low": F.lit(1), "high": F.lit(10)})
    return provenance.credit_plan(f, "l_linenumber", "low", "high", ["l_returnflag"])


@query("""WITH s AS (SELECT l_orderkey AS k, l_shipdate AS at, l_shipdate AS moved FROM lineitem), r1 AS (SELECT o_orderkey AS k, o_orderdate AS start, s.moved FROM orders ASOF LEFT JOIN s ON o_orderkey = s.k AND o_orderdate - INTERVAL 60 MINUTE >= s.at)
SELECT k, CASE WHEN moved IS NULL THEN 'no_snapshot' WHEN moved = start THEN 'converged' ELSE 'moved' END AS status FROM r1""")
def anchor_first_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("at"), F.col("l_shipdate").alias("moved"))
    t = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("start"))
    out = provenance.converge(t, s, ["k"], "start", "at", "moved", 3600, rounds=1)
    return out.select("k", F.when(F.col("status") == "not_converged", "moved").otherwise(F.col("status")).alias("status"))


@query("SELECT l_returnflag, count(*) FILTER (l_linenumber >= 1) AS observed, count(*) FILTER (l_linenumber >= 2) AS repeated, round(count(*) FILTER (l_linenumber >= 2) / count(*) FILTER (l_linenumber >= 1), 9) AS power FROM lineitem GROUP BY 1")
def detection_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "lineitem").withColumns({"seen": F.col("l_linenumber") >= 1, "twice": F.col("l_linenumber") >= 2})
    return provenance.detection_power(a, ["l_returnflag"], "seen", "twice")
