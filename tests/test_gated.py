"""Gated game state, scans in slices, and the replay of ladders, against plain Python."""

import json
import random

from pyspark.sql import functions as F

from tidemark.operators import asof, games, windows
from tidemark.operators import backtest as bt
from tidemark.operators.slices import by_seconds, by_share
from tidemark.streaming.gate import LIVE, Position, gate

EVENTS = "entity string, n long, sequence long, event_type string, payload string"
AT = "timestamp_seconds(n * 60)"


def stream(seed, n, entity):
    """A stream with copies, losses, late events, corrections, unsequenced events and snapshots that sometimes recover it."""
    r, out, at = random.Random(seed), [], 0
    for k in range(n):
        kind, seq = "score", at + 1
        roll = r.random()
        if roll < 0.08:
            kind = "snapshot"
            at = seq = r.choice([at, at + 1, at + 5, None]) or at
        elif roll < 0.14:
            kind, seq = "correction", r.choice([None, at])
        elif roll < 0.18:
            seq = None
        elif roll < 0.3:
            seq = r.randrange(max(1, at - 3), at + 5)
        elif roll < 0.34:
            at += 2
        else:
            at += 1
        out.append((entity, k, seq, kind, json.dumps({"runs": 1 + k % 3, "team": r.choice(["home", "away"])})))
    return out


def by_hand(rows, snapshot_first=False):
    out = {}
    for entity in {r[0] for r in rows}:
        now = Position(None, snapshot_first)
        for r in sorted((r for r in rows if r[0] == entity), key=lambda r: r[1]):
            out[(entity, r[1])] = (now.step(r[3], r[2]), now.last)
    return out


def test_gate_in_slices_equals_one_pass(spark):
    rows = [x for s in range(6) for x in stream(s, 240, f"g{s}")] + stream(9, 50, None) + [("one", 1, None, None, "{}")]
    df = spark.createDataFrame(rows, EVENTS)
    for first in (False, True):
        want = by_hand(rows, first)
        assert {"duplicate", "gap_detected", *LIVE} <= {s for s, _ in want.values()}
        for slice_ in (None, F.floor(F.col("n") / 16), F.lit("all")):
            got = {(r.entity, r.n): (r.status, r.position) for r in gate(df, "entity", ["n"], "event_type", "sequence", slice_, first).collect()}
            assert got == want
    assert gate(df.limit(0), "entity", ["n"], "event_type", "sequence", F.col("n")).count() == 0


def test_gap_is_held_until_a_snapshot(spark):
    """Positions 1, 2, 2 again, 5 behind a gap, a snapshot at 5 that states the whole, then 6: what was dropped stays dropped."""
    told = [(1, "pitch", {"count": 3, "pitcher": "A"}), (2, "pitch", {"count": 2, "pitcher": "B"}), (2, "pitch", {"count": 2, "pitcher": "B"}), (5, "pitch", {"count": 9, "pitcher": "C"}),
            (None, "correction", {"outs": 1, "bases": {"2B": "r"}, "score": {"away": 4}}), (5, "snapshot", {"total_pitches": 7, "bullpen_usage": {"A": 7}, "score": {"home": 2}, "batting_order": {"home": ["x", "y"]}, "bases": {"1B": "q"}, "batter": None}), (6, "pitch", {"count": 1, "pitcher": "A"}), (7, "score", {"team": "away", "runs": 1})]
    df = spark.createDataFrame([("g", i, s, k, json.dumps(p)) for i, (s, k, p) in enumerate(told)], EVENTS)
    gated = gate(df, "entity", ["n"], "event_type", "sequence")
    assert [r.status for r in gated.orderBy("n").collect()] == ["applied", "applied", "duplicate", "gap_detected", "correction_applied", "snapshot_applied", "applied", "applied"]
    got = {r.field: r.value for r in games.baseball_fields(gated.where(F.col("status").isin(*LIVE)), ["n"]).collect()}
    assert got == {"pitches": "8", "pitches.A": "8", "outs": "1", "score.home": "2", "score.away": "1", "order.home": '["x","y"]', "1B": "q", "2B": "", "3B": "", "batter": ""}
    state = games.baseball_fields(gated.where(F.col("status").isin(*LIVE)), ["n"])
    seen = gated.withColumn("at", F.expr(AT))
    q = games.quality(seen, state, ["n"], "at", "sequence", F.expr("timestamp_seconds(600)"), 60, ["pitch", "score"], ["live"]).first()
    assert (q.last_sequence, q.snapshot_sequence, q.delta_sequence, q.n_applied, q.n_corrections, q.n_duplicates, q.n_dropped, q.sequence_gap, q.stale, q.missing_field) == (7, 5, 7, 6, 1, 1, 1, False, True, False)
    early = games.quality(seen.where("n < 5"), state, ["n"], "at", "sequence", F.expr("timestamp_seconds(241)"), 60, ["score"], ["live"]).first()
    assert early.sequence_gap and early.missing_field and not early.stale


def test_basketball_snapshots_restate_whole_maps(spark):
    told = [("substitution", {"team": "home", "in": ["a", "b"], "out": ["z"]}), ("substitution", {"team": "away", "in": "solo"}), ("player_foul", {"player": "a", "team": "home"}), ("timeout", {"team": "home"}), ("timeout", {"team": "away"}),
            ("snapshot", {"players_on_court": {"home": ["c"]}, "timeouts": {"home": 3, "away": 4}, "player_fouls": {"c": 2}, "player_minutes": {"c": 1.5}, "possession": None}), ("timeout", {"team": "home"}), ("player_foul", {"player": "c"}),
            ("correction", {"timeouts": {"away": 1}, "team_fouls": {"away": 5}, "player_fouls": {"d": 4}})]
    df = spark.createDataFrame([("g", i, i, k, json.dumps(p)) for i, (k, p) in enumerate(told)], EVENTS)
    got = {r.field: r.value for r in games.fields(df, games.basketball_effects(), ["n"]).collect()}
    assert got == {"court.home.c": "1", "fouls.home": "1", "fouls.away": "5", "player_fouls.c": "3", "player_fouls.d": "4", "minutes.c": "1.5", "timeouts.home": "3", "timeouts.away": "1", "timeouts_taken.home": "1", "timeouts_taken.away": "0", "possession": ""}


def test_slices_change_no_result(spark):
    r = random.Random(4)
    left = spark.createDataFrame([(r.choice(["hot", "hot", "b", None]), r.randrange(2000), k) for k in range(600)], "k string, t long, id long").withColumn("t", F.timestamp_seconds("t"))
    right = spark.createDataFrame([(r.choice(["hot", "hot", "b", "c", None]), r.randrange(2000), r.choice([None, 1, 2, 3])) for _ in range(300)] + [("hot", None, 9)], "k string, rt long, v int").withColumn("rt", F.timestamp_seconds("rt"))
    rows = lambda df: sorted(map(str, df.collect()))
    for slices in (by_seconds(60), by_seconds(10**6), by_share(right, "rt", 7)):
        for strict in (False, True):
            assert rows(asof.as_of_join(left, right, ["k"], "t", "rt", ["v"], strict, slices)) == rows(asof.as_of_join(left, right, ["k"], "t", "rt", ["v"], strict))
        assert rows(asof.next_trigger(left, ["k"], "t", slices)) == rows(asof.next_trigger(left, ["k"], "t"))
        held = right.withColumns({"id": F.monotonically_increasing_id(), "w": F.when(F.col("v") > 1, F.col("v"))})
        assert rows(windows.carry_forward(held, ["k"], ["rt", "id"], ["v", "w"], slices)) == rows(windows.carry_forward(held, ["k"], ["rt", "id"], ["v", "w"]))
        snapshot = F.coalesce(F.col("v") == 3, F.lit(False))
        assert rows(games.timelines(held, "k", "rt", "id", snapshot, ["w"], slices)) == rows(games.timelines(held, "k", "rt", "id", snapshot, ["w"]))


def test_one_key_is_spread_over_tasks(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.timestamp_seconds("id").alias("t"), F.when(F.col("id") % 97 == 0, F.col("id")).alias("v"))
    got = windows.carry_forward(df, ["k"], ["t"], ["v"], by_seconds(500)).withColumn("p", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in got.groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 15_000 and sum(sizes) == 20_000


# ---- ladders


def walk(ladder, size, limit):
    filled = cost = 0
    for price, have in ladder:
        take = min(have, size - filled)
        if price > limit or take <= 0:
            break
        filled, cost = filled + take, cost + take * price
    return filled, (cost / filled if filled else None)


def fee(avg, n=1):
    return 0.07 * (avg / 100) * (1 - avg / 100) * 100 * n


def replay_by_hand(events, triggers, grid_us, rule):
    """events: (market, t, n, kind, yes, no, status, side, price); triggers: (market, t, n, fair)."""
    import math

    def book(market, t):
        yes = no = ()
        status, seen = "open", False
        for e in sorted(e for e in events if e[0] == market and e[1] <= t):
            seen = True
            if e[3] == "ob_snapshot":
                yes, no = e[4] or (), e[5] or ()
            elif e[3] == "ob_delta":
                yes, no = (yes if e[4] is None else e[4]), (no if e[5] is None else e[5])
            elif e[3] == "market_status":
                status = e[6] or status
        return {"yes": yes, "no": no}, status, seen

    def closing(market, side):
        trades = [e for e in sorted(events, key=lambda e: e[1:3]) if e[0] == market and e[3] == "trade" and e[7] == side and e[8] is not None]
        final = book(market, 10**9)[0][side]
        return trades[-1][8] if trades else (final[0][0] if final else None)

    out = []
    for market, t, n, fair in triggers:
        sides, status, seen = book(market, t)
        if status != "open" or fair is None or not seen:
            continue
        quotes = []
        for s, p in (("yes", fair), ("no", 1 - fair)):
            if sides[s]:
                limit = sides[s][0][0] + rule.slip
                filled, avg = walk(sides[s], rule.size, limit)
                if filled:
                    quotes.append((p * 100 - avg - fee(avg), s, limit, p * 100))
        if not quotes or max(quotes)[0] < rule.min_edge:
            continue
        _, side, limit, value = max(quotes, key=lambda q: (q[0], q[1]))
        later = [x[1] for x in triggers if x[0] == market and x[1] > t]
        for g in grid_us:
            at = t + g / 1e6
            sides, status, _ = book(market, at)
            filled, avg = walk(sides[side], rule.size, limit)
            if later and min(later) <= at:
                outcome = "stale"
            elif status != "open":
                outcome = "suspended"
            elif not sides[side]:
                outcome = "no_fill"
            elif filled == 0:
                outcome = "miss"
            else:
                outcome = "filled" if filled >= rule.size else "partial"
            if outcome not in ("filled", "partial"):
                filled = 0
            close = closing(market, side)
            profit = (value - avg) * filled - math.ceil(round(fee(avg, filled), 9)) if filled else 0.0
            out.append((market, n, side, limit, g, outcome, filled, round(profit, 6), round(value - sides[side][0][0], 6) if sides[side] else None, round(close - avg, 6) if filled and close is not None else None))
    return sorted(out, key=str)


def test_replay_of_ladders(spark):
    r = random.Random(8)
    ladder = lambda: [(p, r.randrange(1, 15)) for p in sorted(r.sample(range(20, 70), r.choice([0, 1, 3, 4])))]
    events, triggers = [], []
    for n in range(900):
        m, t = r.choice(["hot", "hot", "b", "c"]), r.randrange(5000)
        kind = r.choice(["ob_snapshot", "ob_delta", "ob_delta", "trade", "market_status", "trigger", "trigger", "other"])
        if kind == "trigger":
            triggers.append((m, t, n, r.choice([None, 0.2, 0.5, 0.75, 0.9])))
        else:
            side = lambda: r.choice([None, ladder()])
            events.append((m, t, n, kind, side(), side(), r.choice(["open", "open", "halted", None]) if kind == "market_status" else None, r.choice(["yes", "no"]), r.choice([None, 33, 60])))
    level = "array<struct<price:int,size:bigint>>"
    df = spark.createDataFrame([*events, (None, 3, 1, "ob_snapshot", [(1, 99)], None, None, None, None), ("hot", None, 1, "ob_snapshot", [(1, 99)], None, None, None, None)], f"market string, t long, n long, kind string, yes_ladder {level}, no_ladder {level}, market_status string, trade_side string, trade_price int").withColumn("at", F.timestamp_seconds("t"))
    asks = spark.createDataFrame(triggers, "market string, t long, n long, fair double").withColumn("at", F.timestamp_seconds("t"))
    rule, grid = bt.EdgeRule(size=12), [0, 20_000_000, 300_000_000]
    want = replay_by_hand(events, triggers, grid, rule)
    assert {"stale", "suspended", "no_fill", "miss", "partial", "filled"} <= {w[5] for w in want}
    near = lambda v: None if v is None else round(v, 6)
    for slices in (None, by_seconds(400)):
        got = bt.replay(df, asks, "market", "at", "n", "fair", rule, grid, slices)
        assert sorted(((x.market, x.n, x.side, x.limit, x.latency_us, x.outcome, x.filled, near(x.profit), near(x.available), near(x.clv)) for x in got.collect()), key=str) == want
    curve = {c.latency_us: c for c in bt.curves(got).collect()}
    assert curve[0].n_orders == len(want) // 3 and curve[300_000_000].n_fills < curve[0].n_fills
    assert bt.replay(df.limit(0), asks, "market", "at", "n", "fair", rule, grid).count() == 0
