"""Entity resolution for people, places and games, crosswalks, and links that do not change by accident."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.resolve import resolve_tiers, sets, sets_by, window_sets


def scoped_or_neutral(column: Column, scope: Column) -> Column:
    """Whether a row is for the given scope or for none in particular."""
    return F.coalesce(column == scope, F.lit(False)) | F.coalesce(column == "", F.lit(True))


def scopes(scope: Column) -> Column:
    """The keys under which ``scoped_or_neutral`` rows are found, where these hold '' for null."""
    return F.array_distinct(F.array(F.lit(""), F.coalesce(scope, F.lit(""))))


def narrow(candidates: DataFrame, source: Sequence[str], entity: str, breakers: Sequence[Column]) -> DataFrame:
    """One entity per source, narrowed by tie breakers in turn, or ``ambiguous``.

    A breaker that some candidates of a source meet leaves only those; one that none meets says nothing.  Partial
    aggregates: one per breaker, none collects the candidates.
    """
    rows = candidates
    for b in breakers:
        met = rows.withColumn("__met", F.coalesce(b, F.lit(False)))
        some = met.groupBy(*source).agg(F.bool_or("__met").alias("__some"))
        rows = met.join(some, list(source)).where(F.col("__met") | ~F.col("__some")).drop("__met", "__some")
    out = rows.groupBy(*source).agg(F.count_distinct(entity).alias("n"), F.min(entity).alias("e"))
    return out.select(*source, F.when(F.col("n") == 1, F.col("e")).alias(entity), F.when(F.col("n") == 1, "matched").otherwise("ambiguous").alias("outcome"))


def narrow_by(sources: DataFrame, held: DataFrame, on: Sequence[str], breakers: Sequence[str], source: str, entity: str) -> DataFrame:
    """``narrow`` for breakers that are equal columns of sources and held entities: the same rows without their pairs."""

    def left(i: int, met: int) -> Column:
        if i == len(breakers):
            return F.when(F.col(f"e{met}") == F.col(f"l{met}"), F.col(f"e{met}"))
        return F.when(F.col(f"n{met | 1 << i}"), left(i + 1, met | 1 << i)).otherwise(left(i + 1, met))

    out = sets_by(sources, held, on, breakers, source, entity).select(source, left(0, 0).alias(entity))
    return out.withColumn("outcome", F.when(F.col(entity).isNotNull(), "matched").otherwise("ambiguous"))


def tiered(sources: DataFrame, source: str, tiers: Sequence[tuple[float, DataFrame]], entity: str) -> DataFrame:
    """Every source once, by the strongest tier (score, frame of (source, entity)) that has candidates, else ``unmatched``.

    Where many entities share what they are found by, the frames should hold ``resolve.sets`` of them: a frame with a column
    ``last`` has the least entity of a set in ``entity`` and the greatest in ``last``, and a row per source, not per pair.
    """
    candidates = None
    for k, (_, frame) in enumerate(tiers, 1):
        rows = frame.select(source, entity, F.col("last" if "last" in frame.columns else entity).alias("last"), F.lit(k).alias("tier"))
        candidates = rows if candidates is None else candidates.unionByName(rows)
    found = resolve_tiers(candidates, [source], "tier", entity, scores={k: s for k, (s, _) in enumerate(tiers, 1)}, last="last")
    return sources.select(source).join(found, source, "left").withColumn("outcome", F.coalesce("outcome", F.lit("unmatched")))


def contradictions(matched: DataFrame, pairs: dict[str, tuple[str, str]]) -> Column:
    """The names of the attributes on which both sides speak and disagree, in order."""
    return F.array_compact(F.array(*[F.when(F.col(a) != F.col(b), F.lit(name)) for name, (a, b) in pairs.items()]))


def match_or_create(left: DataFrame, right: DataFrame, key: Sequence[str], left_id: str, right_id: str, left_time: str, right_time: str, windows_s: Sequence[int], scores: Sequence[float], cap: Column | None = None, capped: float = 1.0) -> DataFrame:
    """Games matched within nested windows with the tier's score, at most ``capped`` where ``cap`` (over the left row)
    holds; ``create`` where no candidate is in any window, ``review`` where several are."""
    tiers = window_sets(left, right, key, left_id, right_id, left_time, right_time, windows_s)
    found = resolve_tiers(tiers, [left_id], "tier", right_id, scores=dict(enumerate(scores, 1)), last="last")
    flagged = left.select(left_id, F.coalesce(cap if cap is not None else F.lit(False), F.lit(False)).alias("__cap"))
    out = flagged.join(found, left_id, "left")
    score = F.when(F.col("__cap") & (F.col("score") > capped), F.lit(capped)).otherwise(F.col("score"))
    outcome = F.when(F.col("outcome").isNull(), "create").when(F.col("outcome") == "ambiguous", "review").otherwise("matched")
    return out.select(left_id, "tier", right_id, score.alias("score"), outcome.alias("outcome"))


def match_with_swaps(events: DataFrame, games: DataFrame, sides: tuple[str, str], event_id: str, game_id: str, event_time: str, game_time: str, near_s: int, far_s: int, neutral: str) -> DataFrame:
    """Listed events to games: same sides within ``near_s``, then within ``far_s``, then with sides swapped at a neutral
    site; a weaker tier never repairs an ambiguous one."""
    direct = window_sets(events, games, sides, event_id, game_id, event_time, game_time, [near_s, far_s])
    a, b = sides
    turned = games.where(F.col(neutral)).withColumns({a: F.col(b), b: F.col(a)})
    swapped = window_sets(events, turned, sides, event_id, game_id, event_time, game_time, [far_s]).withColumn("tier", F.lit(3))
    found = resolve_tiers(direct.unionByName(swapped), [event_id], "tier", game_id, last="last")
    return events.select(event_id).join(found, event_id, "left").withColumn("outcome", F.coalesce("outcome", F.lit("unmatched"))).withColumn("swapped", F.coalesce(F.col("tier") == 3, F.lit(False)))


def agree(readings: DataFrame, source: str, entity: str, kind: str, needed: Sequence[str]) -> DataFrame:
    """Independent readings of one thing (a ticker, a title, the rules): ``matched`` where all needed kinds name the same
    single entity, ``conflict`` where any two differ, else ``incomplete``."""
    per = readings.where(F.col(entity).isNotNull()).groupBy(source).agg(F.count_distinct(entity).alias("n"), F.min(entity).alias("e"), *[F.bool_or(F.col(kind) == k).alias(f"has_{k}") for k in needed])
    whole = F.lit(True)
    for k in needed:
        whole = whole & F.col(f"has_{k}")
    outcome = F.when(F.col("n") > 1, "conflict").when(whole, "matched").otherwise("incomplete")
    out = per.select(source, F.when(F.col("n") == 1, F.col("e")).alias("__e"), outcome.alias("outcome"))
    every = readings.select(source).distinct().join(out, source, "left").withColumn("outcome", F.coalesce("outcome", F.lit("incomplete")))
    return every.select(source, F.when(F.col("outcome") == "matched", F.col("__e")).alias(entity), "outcome")


def date_slate(left: DataFrame, right: DataFrame, sides: Sequence[str], left_date: Column, right_date: Column) -> DataFrame:
    """Rows of one orientation on one local date: an equi-join on sides and date."""
    return left.withColumn("__d", left_date).join(right.withColumn("__d", right_date), [*sides, "__d"]).drop("__d")


def swapped(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs whose two sides stand in the other order."""
    return left.join(right.withColumns({a: F.col(b), b: F.col(a)}), [a, b])


def readiness(rows: DataFrame, mapped: Column, decided_at: str, cutoff: Column, flagged: Column | None = None) -> Column:
    """Whether a row's orientation may be used at the cutoff: mapped by a decision made by then and, for now rather than
    for history (``flagged`` given), not under review."""
    ready = mapped & F.coalesce(F.col(decided_at) <= cutoff, F.lit(False))
    return ready if flagged is None else ready & ~F.coalesce(flagged, F.lit(False))


def link_outcome(held: Column, offered: Column, reviewed: Column | None = None) -> Column:
    """What writing a link does: ``insert``, ``unchanged``, ``replace`` after review, ``conflict``; ``refused`` without a target."""
    out = F.when(offered.isNull(), "refused").when(held.isNull(), "insert").when(held == offered, "unchanged")
    return (out if reviewed is None else out.when(F.coalesce(reviewed, F.lit(False)), "replace")).otherwise("conflict")


def crosswalk(observed: DataFrame, audited: DataFrame, source: str, target: str) -> DataFrame:
    """Pairs of ids seen together that audits allow: each with ``accepted`` or why not (``unaudited``, ``source_shared``,
    ``target_shared``)."""
    pairs = observed.where(F.col(source).isNotNull() & F.col(target).isNotNull()).select(source, target).distinct()
    targets = pairs.groupBy(source).agg(F.count("*").alias("__nt"))
    sources = pairs.groupBy(target).agg(F.count("*").alias("__ns"))
    known = audited.select(source).distinct().withColumn("__known", F.lit(True))
    both = pairs.join(targets, source).join(sources, target).join(known, source, "left")
    verdict = F.when(F.col("__known").isNull(), "unaudited").when(F.col("__nt") > 1, "source_shared").when(F.col("__ns") > 1, "target_shared").otherwise("accepted")
    return both.select(source, target, verdict.alias("verdict"))


def game_crosswalk(official: DataFrame, games: DataFrame, teams: DataFrame, official_id: str, game_id: str, home: str, away: str, day: str) -> DataFrame:
    """Official games to canonical ones through an audited team crosswalk (``official_team``, ``team``): ``matched``,
    ``team_unknown``, ``no_game`` or ``ambiguous``.  Games of one pairing and day meet the official ones as one set."""
    team = lambda c: teams.select(F.col("official_team").alias(c), F.col("team").alias(f"__{c}"))
    named = official.join(team(home), home, "left").join(team(away), away, "left")
    slate = [f"__{home}", f"__{away}", day]
    held = sets(games.select(F.col(home).alias(f"__{home}"), F.col(away).alias(f"__{away}"), day, F.col(game_id).alias("__g")), slate, "__g")
    found = named.join(held, slate, "left").groupBy(official_id, f"__{home}", f"__{away}").agg(F.min("__g").alias("g"), F.max("last").alias("last"))
    verdict = F.when(F.col(f"__{home}").isNull() | F.col(f"__{away}").isNull(), "team_unknown").when(F.col("g").isNull(), "no_game").when(F.col("g") != F.col("last"), "ambiguous").otherwise("matched")
    return found.select(official_id, F.when(verdict == "matched", F.col("g")).alias(game_id), verdict.alias("verdict"))
