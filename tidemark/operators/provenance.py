"""Point-in-time datasets, admission, certification and usage plans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.quality import first_reason
from tidemark.operators.slices import dealt
from tidemark.operators.windows import checkpointed


def pregame_rows(games: DataFrame, first_seen: str, decided_at: str, label_at: str, final: str, label: str) -> DataFrame:
    """Games with the first reason that excludes them from a leakage-safe dataset, null for rows that are in.

    The cutoff is the first observation; the identity must be known by then, and the label must come strictly later.
    """
    reason = first_reason([
        ("unlinked", F.col(decided_at).isNull()), ("no_schedule", F.col(first_seen).isNull()), ("link_after_cutoff", F.col(decided_at) > F.col(first_seen)), ("no_label", F.col(label_at).isNull()),
        ("not_final", ~F.col(final)), ("label_without_winner", F.col(label).isNull()), ("label_not_after_cutoff", F.col(label_at) <= F.col(first_seen)),
    ])
    return games.withColumn("excluded", reason)


def findings(checks: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Union of rule violations (rule, severity, rows, id column) in one schema."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(r).alias("rule"), F.lit(s).alias("severity"), F.col(i).cast("string").alias("entity_id")) for r, s, df, i in checks])


def judged(rows: DataFrame, rules: Sequence[tuple[str, str, Column, str]]) -> DataFrame:
    """``findings`` of several rules (rule, severity, condition, id column) over the same rows, in one pass."""
    each = [F.when(when, F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity"), F.col(i).cast("string").alias("entity_id"))) for r, s, when, i in rules]
    return rows.select(F.explode(F.array_compact(F.array(*each))).alias("f")).select("f.rule", "f.severity", "f.entity_id")


def admit(rows: DataFrame, ladder: Sequence[tuple[str, Column]], admitted: str = "admitted") -> DataFrame:
    return rows.withColumn("decision", F.coalesce(first_reason(ladder), F.lit(admitted)))


def digest_mismatches(rows: DataFrame, columns: Sequence[str], stored: str) -> DataFrame:
    """Rows whose stored digest is not that of their columns."""
    now = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in sorted(columns)]), 256)
    return rows.where(now != F.col(stored))


def request_plan(targets: DataFrame, bucket: str, game: str) -> DataFrame:
    """One request per bucket with the games it serves, in order."""
    return targets.groupBy(bucket).agg(F.array_sort(F.collect_set(game)).alias("games"), F.count_distinct(game).alias("n_games"))


def chain_check(pages: DataFrame, run: str, cursor: str, next_cursor: str, most_pages: int = 1 << 20) -> DataFrame:
    """Verdict on each run's cursor chain: ``duplicate`` (a page twice, or under a null cursor), ``missing`` (a cursor leads
    nowhere), ``orphan`` (several pages that nothing leads to), ``cycle`` (there is no first page), ``unreachable`` (pages
    that the chain from the first page does not reach, such as a loop beside it), else ``complete``.

    Pages are joined with those they name; no run is collected.  Reachability is pointer doubling from the first page:
    in each round every reached page also reaches the page twice as far on, so there are as many rounds as the logarithm
    of the longest chain, at most that of ``most_pages``, and only runs whose other checks pass and that hold more pages
    than have been reached so far take part.
    """
    held = pages.groupBy(run, cursor).agg(F.count("*").alias("__n"), F.max(next_cursor).alias(next_cursor))
    named = held.where(F.col(next_cursor).isNotNull()).select(run, F.col(next_cursor).alias(cursor)).distinct().withColumn("__named", F.lit(True))
    both = held.join(named, [run, cursor], "full_outer")
    absent = F.col("__n").isNull()
    first = F.when(F.col("__named").isNull(), F.col(cursor))
    per = both.groupBy(run).agg(
        F.coalesce(F.max(F.when(F.col(cursor).isNull(), F.lit(2)).otherwise(F.col("__n"))), F.lit(0)).alias("copies"), F.count_if(absent).alias("absent"), F.count_if(F.col("__named").isNull()).alias("heads"),
        F.count("__n").alias("pages"), F.max(first).alias("first"),
    )
    verdict = first_reason([("duplicate", F.col("copies") > 1), ("missing", F.col("absent") > 0), ("cycle", F.col("heads") == 0), ("orphan", F.col("heads") > 1)])
    judged = checkpointed(per.withColumn("verdict", verdict))
    open_runs = judged.where("verdict IS NULL").select(run, "first", "pages")
    # a jump leads 2 ** round pages on; reached pages gain those that their jumps lead to
    jumps = checkpointed(held.join(open_runs.select(run), run, "left_semi").select(run, F.col(cursor).alias("__from"), F.col(next_cursor).alias("__to")).where("__to IS NOT NULL"))
    reached = checkpointed(open_runs.select(run, F.col("first").alias("__from")))
    length = 1
    longest = open_runs.agg(F.max("pages")).first()[0] or 0
    while length < min(longest, most_pages):
        further = reached.join(jumps, [run, "__from"]).select(run, F.col("__to").alias("__from"))
        reached = checkpointed(reached.unionByName(further).distinct())
        far = jumps.select(run, F.col("__from").alias("__to"), F.col("__to").alias("__next"))
        jumps = checkpointed(jumps.join(far, [run, "__to"]).select(run, "__from", F.col("__next").alias("__to")))
        length *= 2
    got = reached.groupBy(run).agg(F.count("*").alias("__reached"))
    done = judged.join(got, run, "left").withColumn("verdict", F.coalesce("verdict", F.when(F.col("__reached") < F.col("pages"), "unreachable"), F.lit("complete")))
    return done.select(run, "verdict")


def completion(plays: DataFrame, game: str, order: Sequence[str], state: str, time: str) -> DataFrame:
    """Each game's last play and whether it says the game ended."""
    last = plays.groupBy(*[game]).agg(F.max(F.struct(*order, state, time)).alias("l"), F.count("*").alias("n_plays"))
    return last.select(game, "n_plays", F.col(f"l.{time}").alias("completed_at"), (F.col(f"l.{state}") == "end").alias("complete"))


def certify(expected: DataFrame, found: DataFrame, key: Sequence[str]) -> DataFrame:
    """Failures of exact membership; certified where there are none."""
    f = found.groupBy(*key).agg(F.count("*").alias("__n"))
    both = expected.select(*key, F.lit(True).alias("__e")).join(f, list(key), "full_outer")
    why = first_reason([("unplanned", F.col("__e").isNull()), ("not_acquired", F.col("__n").isNull()), ("acquired_twice", F.col("__n") > 1)])
    return both.select(*key, why.alias("failure")).where("failure IS NOT NULL")


def remaining(planned: DataFrame, completed: DataFrame, key: Sequence[str]) -> DataFrame:
    return planned.join(completed, list(key), "left_anti")


def credit_plan(families: DataFrame, requests: str, low: str, high: str, key: Sequence[str] = ()) -> DataFrame:
    return families.groupBy(*key).agg(F.sum(requests).alias("requests"), F.sum(F.col(requests) * F.col(low)).alias("least_credits"), F.sum(F.col(requests) * F.col(high)).alias("most_credits"))


def converge(targets: DataFrame, snapshots: DataFrame, key: Sequence[str], start: str, at: str, moved: str, lead_s: int, rounds: int = 3) -> DataFrame:
    """Anchor iteration: cut a lead ahead of the start, read the start as last seen by then, and repeat.

    ``status`` is ``converged`` once a round changes nothing, ``no_snapshot`` when nothing was seen, else
    ``not_converged``.  The rounds are few and fixed, so they are unrolled as-of reads on the key.
    """
    from tidemark.operators.asof import as_of_join

    now = targets.withColumn("__start", F.col(start)).withColumn("status", F.lit(None).cast("string"))
    for _ in range(rounds):
        cut = now.withColumn("__cut", F.timestamp_micros(F.unix_micros(F.col("__start").cast("timestamp")) - lead_s * 1_000_000).cast("timestamp_ntz"))
        seen = as_of_join(cut, snapshots, key, "__cut", at, [moved])
        status = F.when(F.col("status").isNotNull(), F.col("status")).when(F.col(moved).isNull(), "no_snapshot").when(F.col(moved) == F.col("__start"), "converged")
        now = seen.withColumn("status", status).withColumn("__start", F.when(status.isNull(), F.col(moved)).otherwise(F.col("__start"))).drop("__cut", "matched_at", moved)
    return now.withColumn("anchor", F.when(F.col("status") == "converged", F.col("__start"))).withColumn("status", F.coalesce("status", F.lit("not_converged"))).drop("__start")


def detection_power(audit: DataFrame, key: Sequence[str], seen: str, twice: str) -> DataFrame:
    """Share of entities observed more than once, which is what an audit can judge."""
    return audit.groupBy(*key).agg(F.count_if(seen).alias("observed"), F.count_if(twice).alias("repeated"), F.round(F.count_if(twice) / F.nullif(F.count_if(seen), F.lit(0)), 9).alias("power"))


def newest_state(df: DataFrame, key: Sequence[str], time: str, precedence: Column, state: str) -> DataFrame:
    """The state of each key at its newest time, by precedence where several hold."""
    w = W.partitionBy(*key).orderBy(F.desc(time), precedence, F.asc(state))
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*key, time, state)


def capability(declared: DataFrame, observed: DataFrame, key: Sequence[str], state: str) -> DataFrame:
    """What a provider says it can do against what was seen: ``confirmed``, ``contradicted``, ``unobserved``, ``undeclared``."""
    both = declared.select(*key, F.col(state).alias("declared")).join(observed.select(*key, F.col(state).alias("observed")), list(key), "full_outer")
    verdict = first_reason([("undeclared", F.col("declared").isNull()), ("unobserved", F.col("observed").isNull()), ("confirmed", F.col("declared") == F.col("observed"))])
    return both.withColumn("verdict", F.coalesce(verdict, F.lit("contradicted")))


def completion_verdict(plays: DataFrame, game: str, order: Sequence[str], state: str, time: str) -> DataFrame:
    """When a game ended by its plays, or why they do not say: ``no_end``, ``plays_after_end``, ``several_ends``,
    ``time_runs_back``; one window on the game and one aggregate."""
    w = W.partitionBy(game).orderBy(*order)
    end = F.col(state) == "end"
    marked = plays.withColumns({"__back": F.coalesce(F.col(time) < F.lag(time).over(w), F.lit(False)), "__last": F.lead(F.lit(1)).over(w).isNull()})
    per = marked.groupBy(game).agg(F.count("*").alias("n_plays"), F.count_if(end).alias("ends"), F.bool_or(end & ~F.col("__last")).alias("after"), F.bool_or("__back").alias("back"), F.max(F.when(end, F.col(time))).alias("at"))
    why = first_reason([("no_end", F.col("ends") == 0), ("several_ends", F.col("ends") > 1), ("plays_after_end", F.col("after")), ("time_runs_back", F.col("back"))])
    return per.select(game, "n_plays", F.when(why.isNull(), F.col("at")).alias("completed_at"), F.coalesce(why, F.lit("complete")).alias("verdict"))


def certification_failures(expected: DataFrame, found: DataFrame, bytes_: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every way in which an acquisition differs from its plan, in one list of (key, ``failure``): membership, a body that
    is missing, a stored hash that is not the body's.  None means certified.  Bodies are hashed where they lie and are not moved."""
    now = bytes_.select(*key, F.sha2("body", 256).alias("__now"))
    expected, found, now = dealt(key, expected.select(*key), found.select(*key, "body_hash"), now)
    why = F.when(F.col("__now").isNull(), "body_missing").when(F.col("__now") != F.col("body_hash"), "hash_differs")
    bad = found.join(now, list(key), "left").select(*key, why.alias("failure")).where("failure IS NOT NULL")
    return certify(expected, found, key).unionByName(bad)


def credit_bounds(families: DataFrame, requests_low: str, requests_high: str, cost_low: str, cost_high: str, cap: int, key: Sequence[str] = ()) -> DataFrame:
    """Least and most requests and credits of a plan, and whether even the most keeps within a cap, only the least, or neither."""
    per = families.groupBy(*key).agg(
        F.sum(requests_low).alias("least_requests"), F.sum(requests_high).alias("most_requests"), F.sum(F.col(requests_low) * F.col(cost_low)).alias("least_credits"), F.sum(F.col(requests_high) * F.col(cost_high)).alias("most_credits")
    )
    return per.withColumn("verdict", F.when(F.col("most_credits") <= cap, "within").when(F.col("least_credits") <= cap, "may_exceed").otherwise("exceeds"))


def identity_findings(games: DataFrame, key: str, teams: Sequence[str]) -> DataFrame:
    """The first identity problem of every audited game: ``id_missing``, ``team_missing``, ``plays_itself``, ``id_reused``
    (one id, several pairings), else ``clean``."""
    home, away = teams
    pairs = games.groupBy(key).agg(F.count_distinct(F.struct(*teams)).alias("__n"))
    both = games.join(pairs, key, "left")
    why = first_reason([("id_missing", F.col(key).isNull()), ("team_missing", F.col(home).isNull() | F.col(away).isNull()), ("plays_itself", F.col(home) == F.col(away)), ("id_reused", F.col("__n") > 1)])
    return both.withColumn("finding", F.coalesce(why, F.lit("clean"))).drop("__n")
