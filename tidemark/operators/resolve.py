"""Entity resolution: tiers that never fall through an ambiguity, windowed matching, conflict search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def resolve_tiers(candidates: DataFrame, source: Sequence[str], tier: str, entity: str, flagged: str | None = None, scores: dict[int, float] | None = None, last: str | None = None) -> DataFrame:
    """The strongest tier with candidates decides: several entities or a flag make it ambiguous, one matches.

    One partial aggregate per (source, tier) and one per source; weaker tiers never repair an ambiguous one.  With ``last`` a
    row stands for a set of candidates, ``entity`` being its least and ``last`` its greatest: one entity is where they are equal.
    """
    flag = F.bool_or(flagged) if flagged else F.lit(False)
    tiers = candidates.groupBy(*source, tier).agg(F.min(entity).alias("__e"), F.max(last or entity).alias("__l"), F.coalesce(flag, F.lit(False)).alias("__f"))
    best = tiers.groupBy(*source).agg(F.min(F.struct(tier, "__e", "__l", "__f")).alias("b"))
    clear = F.coalesce(F.col("b.__e") == F.col("b.__l"), F.lit(False)) & ~F.col("b.__f")
    out = best.select(*source, F.col(f"b.{tier}").alias(tier), F.when(clear, F.col("b.__e")).alias(entity), F.when(clear, "matched").otherwise("ambiguous").alias("outcome"))
    if scores:
        value = None
        for t, s in scores.items():
            value = F.when(F.col(tier) == t, s) if value is None else value.when(F.col(tier) == t, s)
        out = out.withColumn("score", F.when(F.col("outcome") == "matched", value))
    return out


def sets(rows: DataFrame, key: Sequence[str], entity: str) -> DataFrame:
    """Per key the least and greatest ``entity``, the latter as ``last``: what ``resolve_tiers`` needs to know of a set."""
    return rows.groupBy(*key).agg(F.min(entity).alias(entity), F.max(entity).alias("last"))


def sets_by(sources: DataFrame, held: DataFrame, on: Sequence[str], breakers: Sequence[str], source: str, entity: str) -> DataFrame:
    """Per source, for every subset of the columns ``breakers``, what held rows equal to it in ``on`` and in the subset are: ``n``
    (whether there are any), ``e`` and ``l`` (the least and greatest entity), each followed by the subset's number, bit ``i``
    standing for breaker ``i``.  Sources without held rows under ``on`` are not there.

    Held rows are first aggregated by what they are found by, so a source meets one row per subset however many namesakes
    there are.  A null equals nothing.
    """
    subsets, bits = range(1 << len(breakers)), [f"__b{i}" for i in range(len(breakers))]

    def keyed(df: DataFrame, *keep: str) -> DataFrame:
        each = [F.struct(F.lit(m).alias("m"), *[F.when(F.lit(bool(m >> i & 1)), F.col(c)).alias(b) for i, (b, c) in enumerate(zip(bits, breakers, strict=True))]) for m in subsets]
        rows = df.select(*on, *keep, F.explode(F.array(*each)).alias("__k")).select(*on, *keep, F.col("__k.m").alias("__m"), *[F.col(f"__k.{b}").alias(b) for b in bits])
        for i, b in enumerate(bits):
            rows = rows.where((F.col("__m").bitwiseAND(1 << i) == 0) | F.col(b).isNotNull())
        return rows

    known = keyed(held, entity).groupBy(*on, "__m", *bits).agg(F.min(entity).alias("__e"), F.max(entity).alias("__l")).alias("h")
    asked, match = keyed(sources, source).alias("s"), F.lit(True)
    for c in [*on, "__m"]:
        match = match & (F.col(f"s.{c}") == F.col(f"h.{c}"))
    for b in bits:
        match = match & F.col(f"s.{b}").eqNullSafe(F.col(f"h.{b}"))
    met = asked.join(known, match).select(F.col(f"s.{source}").alias(source), F.col("s.__m").alias("__m"), "__e", "__l")
    of = lambda m, c: F.when(F.col("__m") == m, F.col(c))
    return met.groupBy(source).agg(*[x for m in subsets for x in (F.bool_or(F.col("__m") == m).alias(f"n{m}"), F.min(of(m, "__e")).alias(f"e{m}"), F.max(of(m, "__l")).alias(f"l{m}"))])


def window_tiers(left: DataFrame, right: DataFrame, key: Sequence[str], left_id: str, right_id: str, left_time: str, right_time: str, windows_s: Sequence[int]) -> DataFrame:
    """Candidates within nested time windows, tier 1 being the narrowest.

    Time is cut into buckets of the widest window; a left row meets the right rows of its own and the two adjoining
    buckets by an equi-join, and the exact window is a residual condition.
    """
    widest = max(windows_s)
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    bucket = lambda c: F.floor(at(c) / (widest * 1_000_000))
    one = left.withColumn("__b", F.explode(F.sequence(bucket(left_time) - 1, bucket(left_time) + 1)))
    two = right.select(*key, right_id, F.col(right_time).alias("__rt"), bucket(right_time).alias("__b"))
    both = one.join(two, [*key, "__b"]).withColumn("__gap", F.abs(at(left_time) - at("__rt"))).where(F.col("__gap") <= widest * 1_000_000)
    tier = None
    for i, w in enumerate(sorted(windows_s), 1):
        tier = F.when(F.col("__gap") <= w * 1_000_000, i) if tier is None else tier.when(F.col("__gap") <= w * 1_000_000, i)
    return both.select(left_id, right_id, tier.alias("tier"))


def window_sets(left: DataFrame, right: DataFrame, key: Sequence[str], left_id: str, right_id: str, left_time: str, right_time: str, windows_s: Sequence[int]) -> DataFrame:
    """Per left row the narrowest of nested time windows with right rows, as ``tier``, and the least and greatest id in it, as
    ``right_id`` and ``last``.  Left rows without any are not there.

    No pairs are made, so a busy key costs its rows and not their product.  Per window, time is cut into blocks just as wide:
    what lies around an instant is the end of one block and the start of the next, and a running least and greatest id from
    either side of each block tell both.  Equal instants of a key are asked, and held, once.
    """
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    present = lambda df: df.where(F.col("__at").isNotNull()).dropna(subset=list(key))
    widths = [w * 1_000_000 for w in sorted(windows_s)]
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("tier"), F.lit(w).cast("long").alias("w")) for i, w in enumerate(widths, 1)]))
    held = present(right.select(*key, right_id, at(right_time).alias("__at"))).groupBy(*key, "__at").agg(F.min(right_id).alias("__lo"), F.max(right_id).alias("__hi"))
    held = held.withColumn("__w", each).select(*key, "__w", F.col("__at").alias("__p"), "__lo", "__hi", F.lit(1).alias("__held"), F.lit(None).cast("long").alias("__at"), F.lit(None).cast("boolean").alias("__ends"))
    asked = present(left.select(*key, at(left_time).alias("__at"))).distinct().withColumn("__w", each)
    sides = F.explode(F.array(F.struct((F.col("__at") - F.col("__w.w")).alias("p"), F.lit(False).alias("e")), F.struct((F.col("__at") + F.col("__w.w")).alias("p"), F.lit(True).alias("e"))))
    asked = asked.withColumn("__s", sides).select(*key, "__w", F.col("__s.p").alias("__p"), F.lit(None).alias("__lo"), F.lit(None).alias("__hi"), F.lit(None).cast("int").alias("__held"), "__at", F.col("__s.e").alias("__ends"))
    rows = held.unionByName(asked).select(*key, F.col("__w.tier").alias("__tier"), "__p", (F.col("__p") - F.pmod("__p", 2 * F.col("__w.w") + 1)).alias("__block"), "__lo", "__hi", "__held", "__at", "__ends")

    block = W.partitionBy(*key, "__tier", "__block")
    upto, since = (block.orderBy(o).rangeBetween(W.unboundedPreceding, W.currentRow) for o in (F.col("__p").asc(), F.col("__p").desc()))
    seen = lambda f, c: F.when(F.col("__ends"), f(c).over(upto)).otherwise(f(c).over(since))
    told = rows.withColumns({"__l": seen(F.min, "__lo"), "__h": seen(F.max, "__hi"), "__n": seen(F.max, "__held")}).where("__at IS NOT NULL AND __n IS NOT NULL")
    tiers = range(1, len(widths) + 1)
    of = lambda f, c, i: f(F.when(F.col("__tier") == i, F.col(c))).alias(f"{c}{i}")
    per = told.groupBy(*key, "__at").agg(F.min("__tier").alias("tier"), *[of(F.min, "__l", i) for i in tiers], *[of(F.max, "__h", i) for i in tiers])
    pick = lambda c: F.coalesce(*[F.when(F.col("tier") == i, F.col(f"{c}{i}")) for i in tiers])
    per = per.select(*key, "__at", "tier", pick("__l").alias(right_id), pick("__h").alias("last"))
    return left.select(left_id, *key, at(left_time).alias("__at")).join(per, [*key, "__at"]).select(left_id, right_id, "last", "tier")


def with_unmatched(left: DataFrame, left_id: str, resolved: DataFrame) -> DataFrame:
    """Every left row once, those without candidates as ``unmatched``."""
    return left.select(left_id).join(resolved, left_id, "left").withColumn("outcome", F.coalesce("outcome", F.lit("unmatched")))


def orientation_conflicts(events: DataFrame, game: str, orientation: str) -> DataFrame:
    """Events of games that are listed with more than one orientation."""
    mixed = events.groupBy(game).agg(F.count_distinct(orientation).alias("__n")).where("__n > 1").select(game)
    return events.join(mixed, game, "left_semi")


def seasons_overlap(debut: Column, final: Column, low: Column, high: Column) -> Column:
    """Whether a career, open where a bound is null, meets a season."""
    return F.coalesce(debut <= high, F.lit(True)) & F.coalesce(final >= low, F.lit(True))


def canonical(links: DataFrame, decisions: DataFrame, link_id: str, target: str, cutoff: Column) -> DataFrame:
    """The link's target where its decision was accepted for the same target by the cutoff, else null."""
    good = decisions.where((F.col("outcome") == "accepted") & (F.col("decided_at") <= cutoff)).select(F.col(link_id), F.col(target).alias("__t")).distinct()
    out = links.join(good, link_id, "left")
    return out.groupBy(*links.columns).agg(F.bool_or(F.col("__t") == F.col(target)).alias("__ok")).select(link_id, F.when(F.col("__ok"), F.col(target)).alias(target))


def review_available(flagged: Column, reviewed_at: Column, cutoff: Column) -> Column:
    """Not while flagged; once reviewed, from then on; otherwise yes."""
    return F.when(flagged, False).when(reviewed_at.isNotNull(), reviewed_at <= cutoff).otherwise(True)


def window_matches(left: DataFrame, right: DataFrame, key: Sequence[str], left_id: str, right_id: str, left_time: str, right_time: str, windows_s: Sequence[int], differ: Sequence[str] = ()) -> DataFrame:
    """``window_tiers`` of pairs that differ in the columns ``differ``, such as the provider: a source is not matched with
    itself.  The columns travel with the ids and are compared after the bucket join."""
    tag = lambda df, i, name: df.withColumn(name, F.struct(i, *differ))
    pairs = window_tiers(tag(left, left_id, "__l"), tag(right, right_id, "__r"), key, "__l", "__r", left_time, right_time, windows_s)
    for c in differ:
        pairs = pairs.where(~F.col(f"__l.{c}").eqNullSafe(F.col(f"__r.{c}")))
    return pairs.select(F.col(f"__l.{left_id}").alias(left_id), F.col(f"__r.{right_id}").alias(right_id), "tier")
