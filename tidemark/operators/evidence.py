"""What may be used for what: admission, leakage, exclusion, and accounts that must add up."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import first_reason

#: Kinds of feature families and the availability bases that each admits.
BASES = {"static": ("static_identity",), "event_derived": ("event_derived",), "versioned_snapshot": ("versioned_snapshot",), "label_only": (), "forward_only": ()}


# The reviewed families of features, how each may be used, and the league it is for (none: any).
FAMILIES = (
    ("static_identity", "static", None), ("target_schedule_anchor", "versioned_snapshot", None), ("prior_results", "event_derived", None), ("team_rolling_stats", "event_derived", None),
    ("rest_schedule_density", "event_derived", None), ("sportsbook_moneyline", "versioned_snapshot", None), ("kalshi_market", "versioned_snapshot", None), ("final_result", "label_only", None),
    ("pitcher_rolling_stats", "event_derived", "lg_mlb"), ("batter_rolling_stats", "event_derived", "lg_mlb"), ("bullpen_prior_usage", "event_derived", "lg_mlb"), ("weather_forecast", "versioned_snapshot", "lg_mlb"),
    ("probable_pitchers", "forward_only", "lg_mlb"), ("player_rolling_stats", "event_derived", "lg_nba"), ("advanced_rolling_stats", "event_derived", "lg_nba"), ("plays_derived_stats", "event_derived", "lg_nba"),
    ("lineups", "forward_only", None), ("injuries", "forward_only", None), ("rosters", "forward_only", None),
)


def with_family(requests: DataFrame, family: str, asked_at: str | None = None, reviews: DataFrame | None = None) -> DataFrame:
    """Requests with ``family_kind`` and ``family_league``, null for a family that nobody has reviewed.

    ``reviews``: (``family``, ``kind``, ``league``, ``valid_from``, ``valid_to``) instead of the fixed table, which holds at all
    times; of a request the review counts whose interval, closed below and open above, holds ``asked_at``.  The dimension
    has a row per family and review, so it is broadcast where it is the fixed one.
    """
    if reviews is None:
        spark = requests.sparkSession
        held = F.broadcast(spark.createDataFrame(FAMILIES, "__f string, family_kind string, family_league string"))
        return requests.join(held, F.col(family) == F.col("__f"), "left").drop("__f")
    held = reviews.select(F.col("family").alias("__f"), F.col("kind").alias("family_kind"), F.col("league").alias("family_league"), F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"))
    within = (F.col("__from").isNull() | (F.col("__from") <= F.col(asked_at))) & (F.col("__to").isNull() | (F.col(asked_at) < F.col("__to")))
    return requests.join(held, (F.col(family) == F.col("__f")) & within, "left").drop("__f", "__from", "__to")


def admissible_basis(kind: Column, basis: Column) -> Column:
    out = F.lit(False)
    for k, bases in BASES.items():
        out = out | ((kind == k) & basis.isin(*bases)) if bases else out
    return F.coalesce(out, F.lit(False))


def admission(rows: DataFrame, cutoff: Column) -> DataFrame:
    """``decision`` on each requested input, one of sixteen (fixed values).

    ``rows``, after left joins on the request: ``superseded``, ``family_kind``, ``family_league``, ``league``, ``as_label``,
    ``certified``, ``eligibility``, ``lane``, ``basis``, ``crosswalk``, ``crosswalk_corpus``, ``corpus``, ``digest_ok``,
    ``completed_at``, ``rule``, ``own_evidence``, ``snapshot_at``, ``available_at``.  The order of the rules is their
    precedence: what the family is, what was asked for, what was certified, and at last the clock.
    """
    c, label = F.col, F.col("as_label")
    feature, static, derived = ~label, F.col("basis") == "static_identity", F.col("basis") == "event_derived"
    instant = F.when(derived, c("available_at")).when(c("basis") == "versioned_snapshot", c("snapshot_at"))
    ladder = [
        ("corpus_superseded", c("superseded")), ("unknown_family", c("family_kind").isNull()), ("forward_only_family", c("family_kind") == "forward_only"), ("wrong_league_for_family", c("family_league").isNotNull() & (c("family_league") != c("league"))),
        ("label_requested_as_feature", (c("family_kind") == "label_only") & feature), ("feature_requested_as_label", (c("family_kind") != "label_only") & label),
        ("no_certification", ~c("certified")), ("certified_excluded", c("eligibility") == "excluded"), ("wrong_lane", c("lane") != F.when(label, "label_only").otherwise("reconstructed")),
        ("admitted", label), ("basis_contradicts_family", ~admissible_basis(c("family_kind"), c("basis"))), ("missing_crosswalk", static & (c("crosswalk").isNull() | c("crosswalk_corpus").isNull())),
        ("crosswalk_from_another_corpus", static & (c("crosswalk_corpus") != c("corpus"))), ("crosswalk_digest_mismatch", static & ~c("digest_ok")), ("admitted", static),
        ("basis_contradicts_family", derived & (c("completed_at").isNull() | c("rule").isNull())), ("target_game_self_reference", derived & c("own_evidence")), ("basis_contradicts_family", instant.isNull()), ("not_yet_available", instant > cutoff),
    ]
    return rows.withColumn("decision", F.coalesce(first_reason([(r, F.coalesce(x, F.lit(False))) for r, x in ladder]), F.lit("admitted")))


def leakage_rules(games: DataFrame, results: DataFrame, forecasts: DataFrame, conflicts: DataFrame) -> DataFrame:
    """The five corpus rules in one schema: (``rule``, ``severity``, ``entity_type``, ``entity_id``).

    ``games``: ``game``, ``identity``, ``cutoff``; ``results``: ``game``, ``observed_at``, ``final``; ``forecasts``:
    ``forecast``, ``current``, ``eligible``; ``conflicts``: ``entity_type``, ``entity_id`` of equal-time conflicts.
    """
    known = games.where(F.col("identity").isNotNull())
    seen = known.join(results, "game")
    leaked = seen.where(F.col("final") & (F.col("observed_at") <= F.col("cutoff"))).select("game").distinct()
    labelled = results.groupBy("game").agg(F.max_by("final", "observed_at").alias("last_final"))
    unlabelled = known.join(labelled, "game").where(~F.coalesce("last_final", F.lit(False)))
    row = lambda df, rule, severity, kind, i: df.select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), (F.lit(kind) if isinstance(kind, str) else kind).alias("entity_type"), F.col(i).cast("string").alias("entity_id"))
    return reduce(DataFrame.unionByName, [
        row(leaked, "result_before_cutoff", "blocking", "game", "game"), row(conflicts, "equal_time_conflict", "blocking", F.col("entity_type"), "entity_id"),
        row(forecasts.where(F.col("current") & F.col("eligible").isNull()), "eligibility_unknown", "issue", "forecast", "forecast"),
        row(unlabelled, "label_unavailable", "note", "game", "game"), row(games.where(F.col("identity").isNull()), "identity_missing", "note", "game", "game"),
    ])


def finding_order(findings: DataFrame) -> DataFrame:
    """Worst first, then by rule, type and id, nulls as empty."""
    rank = F.when(F.col("severity") == "blocking", 0).when(F.col("severity") == "issue", 1).otherwise(2)
    return findings.orderBy(rank, "rule", F.coalesce("entity_type", F.lit("")), F.coalesce("entity_id", F.lit("")))


def dataset_order(rows: DataFrame, time: str, provider: str, key: str) -> DataFrame:
    return rows.orderBy(time, provider, key)


def pregame_dataset(games: DataFrame, schedules: DataFrame, results: DataFrame, links: DataFrame, key: str = "game") -> DataFrame:
    """One row per game with its ``cutoff``, ``label`` and ``excluded``, the first of eight reasons or null.

    The first schedule observation sets the cutoff and must have been made by then; two contents at that instant, or
    two results at the last, are ambiguous and exclude the game.  The link must be known by the cutoff, and the label
    after it, with nothing final visible at it.  All reads are as-of aggregates on the game.
    """
    first = schedules.groupBy(key, "observed_at").agg(F.min("start").alias("start"), F.count_distinct("start").alias("n")).groupBy(key).agg(F.min(F.struct("observed_at", "start", "n")).alias("s"))
    first = first.select(key, F.col("s.observed_at").alias("scheduled_at"), F.col("s.start").alias("cutoff"), (F.col("s.n") > 1).alias("schedule_ambiguous"))
    said = F.struct("final", "winner")
    last = results.groupBy(key, "observed_at").agg(F.min(said).alias("r"), F.count_distinct(said).alias("n")).groupBy(key).agg(F.max(F.struct("observed_at", "r", "n")).alias("l"))
    last = last.select(key, F.col("l.observed_at").alias("label_at"), F.col("l.r.final").alias("final"), F.col("l.r.winner").alias("label"), (F.col("l.n") > 1).alias("result_ambiguous"))
    linked = links.groupBy(key).agg(F.min("decided_at").alias("linked_at"))
    early = results.join(first.select(key, "cutoff"), key).where(F.col("observed_at") <= F.col("cutoff")).select(key).distinct().withColumn("early", F.lit(True))
    all_ = games.join(linked, key, "left").join(first, key, "left").join(last, key, "left").join(early, key, "left")
    reason = first_reason([
        ("identity_missing", F.col("identity").isNull()), ("unlinked", F.col("linked_at").isNull()), ("no_visible_schedule", F.col("cutoff").isNull() | (F.col("scheduled_at") > F.col("cutoff"))),
        ("ambiguous", F.coalesce(F.col("schedule_ambiguous"), F.lit(False)) | F.coalesce(F.col("result_ambiguous"), F.lit(False))), ("no_final_label", F.col("label_at").isNull() | ~F.coalesce("final", F.lit(False)) | F.col("label").isNull()),
        ("label_not_after_cutoff", F.col("label_at") <= F.col("cutoff")), ("link_after_cutoff", F.col("linked_at") > F.col("cutoff")), ("result_visible_at_cutoff", F.coalesce("early", F.lit(False))),
    ])
    return all_.select(key, "cutoff", F.when(reason.isNull(), F.col("label")).alias("label"), reason.alias("excluded"))


def usage_problems(usage: DataFrame, key: Sequence[str], request_cap: int | None = None) -> DataFrame:
    """The key and the sorted ``problems`` of counters that contradict each other; an absent counter contradicts nothing."""
    c = F.col
    more = lambda name, a, b: F.when(c(a) > c(b), F.lit(name))
    known = F.coalesce("successful_responses", F.lit(0)) + F.coalesce("failed_responses", F.lit(0))
    counters = ("reserved_attempts", "transport_starts", "successful_responses", "failed_responses", "retry_attempts", "pages_fetched")
    found = [F.when(c(x) < 0, F.lit(f"{x} is negative")) for x in counters] + [
        more("more transports than attempts", "transport_starts", "reserved_attempts"), F.when(known > c("transport_starts"), F.lit("more outcomes than transports")),
        F.when(c("settled") & (c("transport_starts") - c("successful_responses") - c("failed_responses") != c("retry_attempts")), F.lit("retries do not close")),
        more("more pages than successes", "pages_fetched", "successful_responses"), F.when(~c("network_occurred") & (c("transport_starts") > 0), F.lit("transports without network")),
    ]
    if request_cap is not None:
        found.append(F.when(c("reserved_attempts") > request_cap, F.lit("over the request cap")))
    return usage.select(*key, F.array_sort(F.array_compact(F.array(*found))).alias("problems"))


def project_targets(listed: DataFrame, references: DataFrame, games: DataFrame, provider_id: str, game: str, league: str, wanted: Column) -> DataFrame:
    """Every listed provider game once, with its canonical game or the ``problem`` that refuses the whole projection:
    ``no_reference``, ``unresolved``, ``unknown_game``, ``other_league``, ``shared_target``.  Nothing is dropped."""
    ids = listed.select(provider_id).where(F.col(provider_id).isNotNull()).distinct()
    held = references.select(provider_id, F.col(game).alias("__g"), F.lit(True).alias("__r"))
    both = ids.join(held, provider_id, "left").join(games.select(F.col(game).alias("__g"), F.col(league).alias("__l"), F.lit(True).alias("__k")), "__g", "left")
    shared = both.where("__g IS NOT NULL").groupBy("__g").agg(F.count_distinct(provider_id).alias("__n"))
    all_ = both.join(shared, "__g", "left")
    problem = first_reason([
        ("no_reference", F.col("__r").isNull()), ("unresolved", F.col("__g").isNull()), ("unknown_game", F.col("__k").isNull()), ("other_league", F.col("__l") != wanted), ("shared_target", F.col("__n") > 1),
    ])
    return all_.select(provider_id, F.col("__g").alias(game), problem.alias("problem"))


def population_check(sealed: DataFrame, derived: DataFrame, key: str, cap: int) -> DataFrame:
    """One row: whether a sealed member list equals the one derived from evidence, within a cap, and both digests, which
    are sums over member hashes and so need no order."""
    count = lambda df, n: df.select(key).distinct().agg(F.count("*").alias(f"n_{n}"), F.coalesce(F.sum(F.xxhash64(key).cast("decimal(38,0)")), F.lit(0)).alias(f"digest_{n}"))
    missing = sealed.select(key).subtract(derived.select(key)).agg(F.count("*").alias("unproven"))
    extra = derived.select(key).subtract(sealed.select(key)).agg(F.count("*").alias("unsealed"))
    one = count(sealed, "sealed").crossJoin(count(derived, "derived")).crossJoin(missing).crossJoin(extra)
    return one.select("n_sealed", "n_derived", "unproven", "unsealed", ((F.col("digest_sealed") == F.col("digest_derived")) & (F.col("n_sealed") <= cap)).alias("verified"))


def exactly_one(rows: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """``value`` of keys that have exactly one row with a value, and ``none_or_many`` otherwise: a read that must not choose."""
    per = rows.groupBy(*key).agg(F.count(value).alias("n"), F.min(value).alias("v"))
    return per.select(*key, F.when(F.col("n") == 1, F.col("v")).alias(value), F.when(F.col("n") == 1, "one").otherwise("none_or_many").alias("state"))


def attested(rows: DataFrame, attestations: DataFrame, namespace: str, source: str, team: str) -> DataFrame:
    """Rows with the attested team of their (namespace, id), ``unattested``, or ``malformed`` where an id is attested twice."""
    held = attestations.groupBy(namespace, source).agg(F.count_distinct(team).alias("__n"), F.min(team).alias("__t"))
    both = rows.join(held, [namespace, source], "left")
    state = F.when(F.col("__n").isNull(), "unattested").when(F.col("__n") > 1, "malformed").otherwise("attested")
    return both.select(*rows.columns, F.when(state == "attested", F.col("__t")).alias(team), state.alias("attestation"))


def qualified(rows: DataFrame, providers: DataFrame, key: Sequence[str]) -> DataFrame:
    """The provider name that a (league, provider, generation) goes by, ``unqualified`` without one."""
    return rows.join(F.broadcast(providers), list(key), "left").withColumn("qualified", F.coalesce("qualified", F.lit("unqualified")))


def run_book(events: DataFrame, run: str, time: str, kind: str, counters: Sequence[str]) -> DataFrame:
    """Runs from their log: start, end, last terminal status or ``started``, and every counter kept apart."""
    terminal = F.col(kind).isin("succeeded", "failed", "aborted")
    per = events.groupBy(run).agg(
        F.min(F.when(F.col(kind) == "started", F.col(time))).alias("started_at"), F.max(F.when(terminal, F.struct(time, kind))).alias("end"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters]
    )
    return per.select(run, "started_at", F.col(f"end.{time}").alias("ended_at"), F.coalesce(F.col(f"end.{kind}"), F.lit("started")).alias("status"), *counters)


def settled(rows: DataFrame, key: Sequence[str], rank: Column, order: Sequence[str]) -> DataFrame:
    """Of rows with one key the most settled, then the last in ``order``; whole, by a partial aggregate."""
    best = rows.groupBy(*key).agg(F.max(F.struct(rank.alias("__rank"), *order, F.struct(*rows.columns).alias("__row"))).alias("b"))
    return best.select("b.__row.*")
