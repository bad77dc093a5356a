"""Game and market state from event envelopes, as relations.

An event's effect on a state is a set of rows (field, ``set`` or ``add``, value).  A field's value is what was last set
plus what was added since: one aggregate over (entity, field), so a busy entity is spread over its fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.slices import Slices, last_known

#: Fixed values, as the payload keys, event types and statuses below: they are what feeds send.
#: Where an envelope belongs: the payload's own name of the thing, else its stream.
KEY_FIELDS = ("game_id", "market", "market_ticker", "entity_id")
EFFECTS = "array<struct<field:string,op:string,value:string>>"


def payload(name: str) -> Column:
    return F.get_json_object("payload", f"$.{name}")


def route(envelopes: DataFrame, routes: dict[str, str]) -> DataFrame:
    """``entity`` and ``kind`` of each envelope; ``rejected`` says why one has no state to go to."""
    kind = F.coalesce(*[F.when(F.col("subject") == s, F.lit(k)) for s, k in routes.items()])
    entity = F.coalesce(*[payload(f) for f in KEY_FIELDS], F.col("stream_key"), F.concat_ws(":", "provider", "subject"))
    return envelopes.withColumns({"entity": entity, "kind": kind}).withColumn("rejected", F.when(F.col("kind").isNull(), F.concat(F.lit("no route for "), F.coalesce("subject", F.lit("no subject")))))


def effect(field: Column | str, op: str, value: Column) -> Column:
    """One effect, null where it has no value."""
    name = F.lit(field) if isinstance(field, str) else field
    return F.when(value.isNotNull() & name.isNotNull(), F.struct(name.alias("field"), F.lit(op).alias("op"), value.cast("string").alias("value")))


def _of(path: str, side: Column) -> Column:
    return F.concat(F.lit(path + "."), side)


def _stated(name: str) -> Column:
    """A payload's value, empty where it is stated as null, null where it is not stated."""
    return F.when(F.array_contains(F.json_object_keys("payload"), name), F.coalesce(payload(name), F.lit("")))


def _entries(path: str, field: str) -> Column:
    """Effects that set the fields under ``field`` to what the payload's map at ``path`` says."""
    held = F.map_entries(F.from_json(payload(path), "map<string,string>"))
    each = F.transform(held, lambda e: F.struct(F.concat(F.lit(f"{field}."), e["key"]).alias("field"), F.lit("set").alias("op"), e["value"].alias("value")))
    return F.coalesce(each, F.array().cast(EFFECTS))


def _cleared(path: str, field: str) -> Column:
    """The effect that forgets all fields under ``field``, where the payload states the map at ``path``."""
    return effect(f"{field}.", "reset", F.when(payload(path).isNotNull(), F.lit("")))


def _people(name: str) -> Column:
    """One person, or a list of them."""
    told = payload(name)
    return F.when(told.startswith("["), F.from_json(told, "array<string>")).when(told.isNotNull(), F.array(told)).otherwise(F.array().cast("array<string>"))


def baseball_effects() -> Column:
    """Effects of an envelope of a baseball game, by its ``event_type``; ``current_pitcher`` is who pitches then."""
    side, clear = F.coalesce(payload("team"), F.lit("home")), [effect(b, "set", F.lit("")) for b in ("1B", "2B", "3B")]
    amount = lambda name, default: F.coalesce(payload(name).cast("long"), F.lit(default))
    bases = [effect(b, "set", F.when(F.col("payload").contains(f'"{b}"'), F.coalesce(payload(b), F.lit("")))) for b in ("1B", "2B", "3B")]
    rules = {
        "lineup": [effect(_of("order", side), "set", payload("order"))],
        "at_bat": [effect("batter", "set", payload("batter")), effect("pitcher", "set", payload("pitcher")), effect(_of("pitches", payload("pitcher")), "add", F.lit(0))],
        "pitch": [effect("pitches", "add", amount("count", 1)), effect(_of("pitches", F.coalesce(payload("pitcher"), F.col("current_pitcher"))), "add", amount("count", 1))],
        "out": [effect("outs", "add", amount("outs", 1))],
        "score": [effect(_of("score", side), "add", amount("runs", 1))],
        "bases": bases,
        "inning": [effect("inning", "set", payload("inning")), effect("half", "set", payload("half")), effect("outs", "set", F.lit(0)), *clear],
        "pitching_change": [effect("pitcher", "set", F.coalesce(payload("pitcher"), F.lit(""))), effect(_of("pitches", payload("pitcher")), "add", F.lit(0))],
        "status": [effect("game_status", "set", payload("status"))],
    }
    restated = [effect(n, "set", _stated(n)) for n in ("game_status", "inning", "half", "outs", "batter", "pitcher")]
    bases = payload("bases")
    base = lambda b: F.coalesce(F.get_json_object(bases, f"$.{b}"), F.lit(""))
    whole = [*restated, effect("pitches", "set", payload("total_pitches")), *[effect(b, "set", F.when(bases.isNotNull(), base(b))) for b in ("1B", "2B", "3B")]]
    maps = {"score": "score", "bullpen_usage": "pitches", "batting_order": "order"}
    some = [*restated, *[effect(b, "set", F.when(F.array_contains(F.json_object_keys(bases), b), base(b))) for b in ("1B", "2B", "3B")]]
    return _chosen(rules, (whole, maps), (some, {"score": "score"}))


def baseball_fields(events: DataFrame, order: Sequence[str], entity: str = "entity", slices: Slices | None = None) -> DataFrame:
    """Fields of baseball games; pitches that name nobody are those of the pitcher last named.

    ``events`` are those that count (see ``streaming.gate``); all that are given are applied.
    """
    kind = F.col("event_type")
    named = F.when(kind.isin("at_bat", "pitching_change", "snapshot", "correction"), payload("pitcher"))
    known = last_known(events.withColumn("current_pitcher", named), [entity], order, ["current_pitcher"], slices and slices(F.col(order[0])))
    return fields(known, baseball_effects(), order, entity, events.withColumn("current_pitcher", F.lit(None).cast("string")))


def basketball_effects() -> Column:
    """Effects of an envelope of a basketball game, by its ``event_type``."""
    side = F.coalesce(payload("team"), F.lit("home"))
    amount = lambda name, default: F.coalesce(payload(name).cast("long"), F.lit(default))
    fouls = [effect(f"fouls.{t}", "set", F.lit(0)) for t in ("home", "away")]
    rules = {
        "period": [effect("period", "set", payload("period")), effect("clock_seconds", "set", F.coalesce(payload("clock_seconds").cast("double"), F.lit(720.0))), *fouls],
        "clock": [effect("clock_seconds", "set", payload("clock_seconds").cast("double"))],
        "score": [effect(_of("score", side), "add", amount("points", 0))],
        "possession": [effect("possession", "set", payload("team"))],
        "timeout": [effect(_of("timeouts_taken", side), "add", F.lit(1))],
        "team_foul": [effect(_of("fouls", side), "add", amount("count", 1))],
        "player_foul": [effect(_of("player_fouls", payload("player")), "add", F.lit(1)), effect(_of("fouls", payload("team")), "add", F.lit(1))],
        "substitution": [],
        "player_minutes": [effect(_of("minutes", payload("player")), "set", payload("minutes"))],
        "status": [effect("game_status", "set", payload("status"))],
    }
    restated = [effect(n, "set", _stated(n)) for n in ("game_status", "period", "clock_seconds", "possession")]
    maps = {"score": "score", "timeouts": "timeouts", "team_fouls": "fouls", "player_fouls": "player_fouls"}
    # What is left of the timeouts is stated anew: those taken before no longer count.
    stated = [effect(f"timeouts_taken.{t}", "set", F.when(payload(f"timeouts.{t}").isNotNull(), 0)) for t in ("home", "away")]
    whole = ([*restated, _cleared("timeouts", "timeouts_taken")], {**maps, "player_minutes": "minutes"})
    court = lambda team, who, value: F.transform(who, lambda p: F.struct(F.concat(F.lit("court."), team, F.lit("."), p).alias("field"), F.lit("set").alias("op"), F.lit(value).alias("value")))
    placed = [court(F.lit(t), F.coalesce(F.from_json(payload(f"players_on_court.{t}"), "array<string>"), F.array().cast("array<string>")), "1") for t in ("home", "away")]
    kind, none = F.col("event_type"), F.array().cast(EFFECTS)
    more = F.when(kind == "substitution", F.concat(court(side, _people("out"), "0"), court(side, _people("in"), "1")))
    more = more.when(kind == "snapshot", F.concat(F.array_compact(F.array(_cleared("players_on_court", "court"))), *placed))
    return F.concat(_chosen(rules, whole, ([*restated, *stated], maps)), more.otherwise(none))


def _chosen(rules: dict[str, list[Column]], whole: tuple[list[Column], dict[str, str]], some: tuple[list[Column], dict[str, str]]) -> Column:
    """The effects of the event's type.

    Snapshots restate: what they name, and of a map that they name all of it, so its other fields go.  Corrections set only
    the fields that they name.  Either is a list of effects and the maps of the payload with the fields that they hold.
    """
    kind, none = F.col("event_type"), F.array().cast(EFFECTS)
    all_of = [F.concat(F.array_compact(F.array(_cleared(path, field))), _entries(path, field)) for path, field in whole[1].items()]
    out = F.when(kind == "snapshot", F.concat(F.array_compact(F.array(*whole[0])), *all_of))
    out = out.when(kind == "correction", F.concat(F.array_compact(F.array(*some[0])), *[_entries(path, field) for path, field in some[1].items()]))
    for name, effects in rules.items():
        out = out.when(kind == name, F.array_compact(F.array(*effects)) if effects else none)
    return out.otherwise(none)


def _effect_rows(events: DataFrame, effects: Column, order: Sequence[str], entity: str) -> DataFrame:
    each = events.select(entity, F.struct(*order).alias("__o"), F.posexplode(effects).alias("__i", "e"))
    return each.select(entity, "e.field", "e.op", "e.value", F.struct("__o", "__i").alias("__at"))


def fields(events: DataFrame, effects: Column, order: Sequence[str], entity: str = "entity", source: DataFrame | None = None) -> DataFrame:
    """(entity, ``field``, ``value``) after all events: what was last set plus what was added since, from nothing.

    A ``reset`` of "map." forgets all earlier effects on the fields of that map; resets come with snapshots only, so their
    last ones are a small table, made from ``source`` where the same events are cheaper to read.  Every pair of entity and
    field is aggregated for itself, whatever an entity's size.
    """
    rows = _effect_rows(events, effects, order, entity)
    restated = _effect_rows((source or events).where("event_type = 'snapshot'"), effects, order, entity)
    map_of = F.when(F.col("field").contains("."), F.concat(F.substring_index("field", ".", 1), F.lit(".")))
    resets = restated.where("op = 'reset'").groupBy(F.col(entity).alias("__e"), F.col("field").alias("__map")).agg(F.max("__at").alias("__reset"))
    rows = rows.where("op <> 'reset'").withColumn("__m", map_of)
    rows = rows.join(resets, F.col(entity).eqNullSafe(F.col("__e")) & (F.col("__m") == F.col("__map")), "left")
    rows = rows.where(F.col("__reset").isNull() | (F.col("__at") > F.col("__reset"))).select(entity, "field", "op", "value", "__at")
    w = W.partitionBy(entity, "field")
    since = rows.withColumn("__set", F.max(F.when(F.col("op") == "set", F.col("__at"))).over(w))
    kept = since.where(F.col("__set").isNull() | (F.col("__at") >= F.col("__set")))
    last = F.max(F.when(F.col("op") == "set", F.col("value")))
    added = F.sum(F.when(F.col("op") == "add", F.col("value").cast("long")))
    value = F.when(added.isNull(), last).otherwise((F.coalesce(last.cast("long"), F.lit(0)) + added).cast("string"))
    return kept.groupBy(entity, "field").agg(value.alias("value"))


def state_hashes(state: DataFrame, entity: str = "entity") -> DataFrame:
    """A digest of every entity's fields in order; a state has as many fields as a game has people, not as events."""
    line = F.concat_ws("=", "field", F.coalesce("value", F.lit("null")))
    return state.groupBy(entity).agg(F.count("*").alias("n_fields"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("state_hash"))


def quality(gated: DataFrame, state: DataFrame, order: Sequence[str], time: str, sequence: str, now: Column, most_age_s: int, known: Sequence[str], statuses: Sequence[str], entity: str = "entity") -> DataFrame:
    """Per entity the snapshot of its state: where it stands, what it has taken in, flags, and a digest of its fields.

    ``gated``: events with ``status`` and ``position`` (see ``streaming.gate``).  ``sequence_gap``: a gap came after the last
    snapshot, so another is awaited.  ``missing_field``: an event of unknown type counted; ``out_of_range``: so did an
    unknown status.  ``stale``: nothing counted for longer than ``most_age_s``.
    """
    from tidemark.streaming.gate import LIVE

    kind, status = F.col("event_type"), F.col("status")
    live, turn = status.isin(*LIVE), status.isin("gap_detected", "snapshot_applied")
    some = lambda test: F.coalesce(F.bool_or(live & test), F.lit(False))
    per = gated.groupBy(entity).agg(
        F.max(F.struct(*order, "position"))["position"].alias("last_sequence"), F.max(F.when(status == "snapshot_applied", F.struct(*order, sequence)))[sequence].alias("snapshot_sequence"),
        F.max(F.when(status == "applied", F.struct(*order, sequence)))[sequence].alias("delta_sequence"), F.max(F.when(live, F.col(time))).alias("last_at"),
        F.count_if(live).alias("n_applied"), F.count_if(status == "correction_applied").alias("n_corrections"), F.count_if(status == "duplicate").alias("n_duplicates"),
        F.count_if(status == "gap_detected").alias("n_dropped"), F.coalesce(F.max(F.when(turn, F.struct(*order, status)))["status"] == "gap_detected", F.lit(False)).alias("sequence_gap"),
        some(~kind.isin("snapshot", "correction", *known)).alias("missing_field"), some((kind == "status") & ~payload("status").isin(*statuses)).alias("out_of_range"),
    )
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_at").cast("timestamp"))
    return per.withColumn("stale", F.coalesce(age > most_age_s * 1_000_000, F.lit(True))).join(state_hashes(state, entity), entity, "left")


def snapshots(events: DataFrame, state: DataFrame, time: str, sequence: str, now: Column, most_age_s: int, known: Sequence[str], statuses: Sequence[str], entity: str = "entity") -> DataFrame:
    """Per entity: last sequence and time, events, corrections, ``state_hash`` and the quality flags ``stale``,
    ``missing_field`` (an unknown event type) and ``out_of_range`` (an unknown status)."""
    kind = F.col("event_type")
    per = events.groupBy(entity).agg(
        F.max(F.when(kind != "correction", F.col(sequence))).alias("last_sequence"), F.max(time).alias("last_at"), F.count("*").alias("n_events"), F.count_if(kind == "correction").alias("n_corrections"),
        F.bool_or(~kind.isin("snapshot", "correction", *known)).alias("missing_field"), F.coalesce(F.bool_or((kind == "status") & ~payload("status").isin(*statuses)), F.lit(False)).alias("out_of_range"),
    )
    stale = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_at").cast("timestamp")) > most_age_s * 1_000_000
    return per.withColumn("stale", stale).join(state_hashes(state, entity), entity, "left")


def timelines(events: DataFrame, market: str, time: str, order: str, snapshot: Column, values: Sequence[str], slices: Slices | None = None) -> DataFrame:
    """Carry-forward views of a market's book: after a snapshot a side it does not name is empty, after a delta it stays.

    ``snapshot`` marks rows that restate the whole; ``values`` are columns of what is stated, null where a row is silent.
    With ``slices`` a busy market is spread over slices of time.
    """
    told = {v: F.when(snapshot | F.col(v).isNotNull(), F.struct(F.col(v).alias("v"))) for v in values}
    views = last_known(events.withColumns(told), [market], [time, order], values, slices and slices(F.col(time)))
    return views.withColumns({v: F.col(v)["v"] for v in values})


def dataset_grade(events: DataFrame, kind: str, time: str, published: str, key: Sequence[str] = ()) -> DataFrame:
    """Whether a replay can be executed (every event timed, some book event), what is wanting, score and grade."""
    book, timed = F.col(kind).isin("ob_snapshot", "ob_delta"), F.col(time).isNotNull()
    per = events.groupBy(*key).agg(
        F.count("*").alias("n"), F.count_if(~timed).alias("untimed"), F.count_if(book).alias("books"), F.count_if(F.col(kind) == "trade").alias("trades"),
        F.count_if(F.col(kind) == "market_status").alias("statuses"), F.count_if(book & F.col(published).isNull()).alias("unpublished"),
    )
    valid = (F.col("untimed") == 0) & (F.col("books") > 0)
    notes = sum(((F.col(c) == 0).cast("int") for c in ("trades", "statuses")), (F.col("unpublished") > 0).cast("int"))
    score = F.when(valid, F.round(1 - F.lit(0.1) * F.col("n_notes"), 6)).otherwise(0.0)
    grade = F.when(~valid, "F").when(F.col("score") >= 0.95, "A").when(F.col("score") >= 0.85, "B").when(F.col("score") >= 0.7, "C").otherwise("D")
    return per.withColumn("n_notes", notes).withColumn("execution_valid", valid).withColumn("score", score).withColumn("grade", grade)


def backtest(books: DataFrame, triggers: DataFrame, market: str, time: str, order: str, decide: Column, limit: Column, fair: str, grid_us: Sequence[int], fee: Column | None = None, slices: Slices | None = None) -> DataFrame:
    """Replay of best asks to latency curves; see ``operators.backtest`` for ladders, sizes and both sides.

    ``books``: carried-forward views (``timelines``) with ``yes_ask`` and ``status``; ``triggers``: rows that may decide,
    with the fair value.  Each trigger sees the book as of its own time, decides by ``decide`` up to ``limit``, meets the
    book again as of its arrival at every latency of the grid, and fills where it is not stale, the market is open and the
    ask is within the limit.  The last ask is the closing price.  Two as-of joins and one partial aggregate.
    """
    from tidemark.operators.asof import as_of_join, next_trigger
    from tidemark.operators.windows import checkpointed

    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    books = checkpointed(books) if slices else books  # a scan in slices reads its input twice
    views = books.select(market, F.col(time).alias("__at"), "yes_ask", "status")
    closing = books.where("yes_ask IS NOT NULL").groupBy(market).agg(F.max(F.struct(time, order, "yes_ask"))["yes_ask"].alias("closing"))
    timed = next_trigger(triggers.where(F.col(market).isNotNull() & F.col(time).isNotNull()), [market], time, slices)
    now = as_of_join(timed.select(market, time, order, "next_at", fair), views, [market], time, "__at", ["yes_ask", "status"], slices=slices).where(F.col("matched_at").isNotNull() & decide)
    points = now.withColumn("limit", limit).join(closing, market, "left").select(market, time, "next_at", fair, "limit", "closing")
    late = points.withColumn("latency_us", F.explode(F.array(*[F.lit(g).cast("long") for g in grid_us]))).withColumn("arrival", F.timestamp_micros(micros(time) + F.col("latency_us")).cast("timestamp_ntz"))
    met = as_of_join(late, views, [market], "arrival", "__at", ["yes_ask", "status"], slices=slices)
    stale = F.coalesce(F.col("next_at") <= F.col("arrival"), F.lit(False))
    open_ = ~stale & F.coalesce(F.col("status") == "open", F.lit(False))
    fill = open_ & F.coalesce(F.col("yes_ask") <= F.col("limit"), F.lit(False))
    cost = F.lit(0.0) if fee is None else fee
    return met.groupBy("latency_us").agg(
        F.count("*").alias("n_orders"), F.count_if(open_).alias("n_actionable"), F.count_if(fill).alias("n_fills"),
        F.avg(F.when(fill, F.col(fair) - F.col("yes_ask") - cost).otherwise(0.0)).alias("mean_profit"), F.avg(F.col(fair) - F.col("yes_ask")).alias("mean_edge"),
        F.avg(F.when(fill, F.col("closing") - F.col("yes_ask"))).alias("mean_clv"),
    )
