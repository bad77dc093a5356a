"""Who and what a provider's text means: people and teams by link, name, team and birth; listed events by ticker and title."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import texts
from tidemark.operators.entities import scopes
from tidemark.operators.resolve import seasons_overlap, sets_by

# Tiers and their scores.
SCORES = {"exact_provider_id": 1.0, "team_normalized_name": 0.95, "league_normalized_name": 0.9}

# What an alias is found under.
KEYS = ["league", "name", "suffix", "provider"]


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    out = F.lit(True)
    for a, b in pairs:
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def alias_keys(aliases: DataFrame) -> DataFrame:
    """Aliases under what sources ask for them by (see ``asked_keys``): ``league``, ``name``, ``suffix``, ``provider``.

    An alias is one of the source's league, under the normalised name, of the source's own provider or of none.  A suffix
    in the name binds; without one any will do, so an alias stands under '' and under its own.  ``aliases``: (``league``,
    ``name``, ``suffix``, ``provider``, ``entity``, ``is_ambiguous``).
    """
    suffixes = F.array_distinct(F.array_compact(F.array(F.lit(""), F.col("suffix"))))
    return aliases.select("league", "name", F.explode(suffixes).alias("suffix"), F.coalesce("provider", F.lit("")).alias("provider"), "entity", F.col("is_ambiguous").alias("flagged"))


def asked_keys(sources: DataFrame) -> DataFrame:
    """Sources with a name, (``source``, ``provider``, ``league``, ``name``, ``suffix``), once for their provider and once for none."""
    return sources.where("name <> ''").withColumn("provider", F.explode(scopes(F.col("provider"))))


def resolve_people(sources: DataFrame, links: DataFrame, aliases: DataFrame, people: DataFrame, memberships: DataFrame) -> DataFrame:
    """Every source once: ``outcome`` (matched, ambiguous or unmatched), ``tier``, ``entity``, ``score`` and ``reason``.

    ``sources``: (``source``, ``provider``, ``ref``, ``league``, ``raw_name``, ``team``, ``birth_date``, ``season_low``,
    ``season_high``); ``links``: (``provider``, ``ref``, ``entity``); ``people``: (``entity``, ``league``, ``debut``, ``final``,
    ``birth_date``); ``memberships``: (``entity``, ``team``, ``on_date``).

    A linked id decides alone: a link into another league is no match but a ``wrong_league`` conflict.  Names come next (see
    ``alias_keys``): one flagged alias makes the source ambiguous; people whose career misses the season are out, open
    careers are not; membership of the source's team within the season narrows several and confirms one; the date of birth
    only breaks what is still tied.  People meet the distinct seasons that are asked of their name, not the sources; of what is
    found under equal keys only the least and greatest entity are kept, which tell none, one and several (``n_``: 0, 1, 2).
    """
    named = sources.withColumns({"name": texts.normalized_name(F.col("raw_name")), "suffix": texts.name_suffix(F.col("raw_name"))})
    held = links.select(F.col("provider").alias("__p"), F.col("ref").alias("__r"), F.col("entity").alias("linked"))
    known = people.select(F.col("entity").alias("linked"), F.col("league").alias("linked_league"), F.lit(True).alias("is_person"))
    named = named.join(held, _same([("provider", "__p"), ("ref", "__r")]), "left").join(known, "linked", "left")

    asked = asked_keys(named.where("linked IS NULL").withColumn("season", F.struct("season_low", "season_high")))
    known_as = alias_keys(aliases)
    rows = known_as.join(asked.select("league", "name", "season").distinct(), ["league", "name"])
    rows = rows.join(people.select("entity", "debut", "final"), "entity", "left").where(seasons_overlap(F.col("debut"), F.col("final"), F.col("season.season_low"), F.col("season.season_high")))
    rows = rows.join(people.where("birth_date IS NOT NULL").select("entity", "birth_date").distinct(), "entity", "left")
    of_team = memberships.select(F.col("entity").alias("__e"), "team", "on_date")
    within = F.col("on_date").between(F.col("season.season_low"), F.col("season.season_high")) | F.col("season.season_low").isNull()
    rows = rows.join(of_team, (F.col("entity") == F.col("__e")) & F.coalesce(within, F.lit(False)), "left")
    found = sets_by(asked, rows, [*KEYS, "season"], ["team", "birth_date"], "source", "entity")
    n_of = lambda m: F.when(F.col(f"e{m}").isNull(), 0).when(F.col(f"e{m}") == F.col(f"l{m}"), 1).otherwise(2)
    counted = found.select("source", *[x for m, k in enumerate(("season", "team", "born", "team_born")) for x in (n_of(m).alias(f"n_{k}"), F.col(f"e{m}").alias(f"e_{k}"))])
    doubtful = asked.join(known_as.where("flagged").select(*KEYS).distinct(), KEYS, "left_semi").select("source", F.lit(True).alias("flagged")).distinct()

    n = lambda k: F.coalesce(F.col(f"n_{k}"), F.lit(0))
    narrowed = (n("season") > 1) & (n("team") > 0)
    size, one = F.when(narrowed, n("team")).otherwise(n("season")), F.when(narrowed, F.col("e_team")).otherwise(F.col("e_season"))
    births, of_birth = F.when(narrowed, n("team_born")).otherwise(n("born")), F.when(narrowed, F.col("e_team_born")).otherwise(F.col("e_born"))
    out = named.join(counted, "source", "left").join(doubtful, "source", "left").withColumns({"size": size, "one": F.when(size == 1, one).when(births == 1, of_birth)})
    linked, wrong = F.col("linked").isNotNull(), F.col("linked_league").isNotNull() & (F.col("linked_league") != F.col("league"))
    nobody, flagged = n("season") == 0, F.coalesce("flagged", F.lit(False))
    told = F.when(linked & wrong, "wrong_league").when(linked, "linked").when(F.col("name") == "", "empty_name").when(flagged, "flagged_alias").when(nobody, "no_candidate")
    told = told.when(F.col("one").isNull(), "several").otherwise("found")
    by_team = n("team") == 1
    out = out.withColumn("reason", told)
    outcome = F.when(F.col("reason").isin("linked", "found"), "matched").when(F.col("reason").isin("flagged_alias", "several"), "ambiguous").otherwise("unmatched")
    tier = F.when(linked, "exact_provider_id").when(F.col("reason").isin("empty_name", "no_candidate"), "none").when((F.col("reason") == "found") & by_team, "team_normalized_name").otherwise("league_normalized_name")
    out = out.withColumns({"outcome": outcome, "tier": tier})
    entity = F.when(F.col("outcome") == "matched", F.when(linked, F.col("linked")).otherwise(F.col("one")))
    score = F.when(F.col("outcome") == "matched", texts.lookup(F.col("tier"), SCORES)).otherwise(0.0)
    return out.select("source", "outcome", "tier", entity.alias("entity"), score.cast("double").alias("score"), "reason")


def team_of_name(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """(``source``, ``team``): the one team that a name means in its league; null where none or several do, or a flag says so."""
    named = names.withColumns({"name": texts.normalized_name(F.col("raw_name")), "suffix": F.lit("")})
    held = alias_keys(aliases).groupBy(*KEYS).agg(F.min("entity").alias("e"), F.max("entity").alias("l"), F.bool_or("flagged").alias("f"))
    per = asked_keys(named).join(held, KEYS).groupBy("source").agg(F.min("e").alias("e"), F.max("l").alias("l"), F.bool_or("f").alias("f"))
    return names.select("source").distinct().join(per, "source", "left").select("source", F.when((F.col("e") == F.col("l")) & ~F.col("f"), F.col("e")).alias("team"))


def listed_events(events: DataFrame, series: DataFrame, codes: DataFrame, aliases: DataFrame, games: DataFrame) -> DataFrame:
    """Listed events to games, from their texts alone: ``outcome``, ``game``, ``reason``.

    ``events``: (``event``, ``series``, ``ticker``, ``title``, ``provider``); ``series``: (``series``, ``league``); ``codes``:
    (``league``, ``code``, ``team``); ``games``: (``game``, ``league``, ``away``, ``home``, ``day``, ``clock``).

    The ticker's joined codes are split at every place, and the pairs looked up; exactly one pair must fit.  A title, where
    there is one, is read by itself: both names must mean a team, the same two, and ``at`` the same sides.  Games are
    then found on the date's slate of the league by the pair; a clock in the ticker must be theirs.  Games of one pair, day
    and clock meet the events as one count.

    ``unsupported``: no such series; ``incomplete``: something needed can't be read or is not there; ``conflict``: two
    readings disagree; ``ambiguous``: several pairs or games; else ``matched``.
    """
    rows = events.join(series, "series", "left").withColumn("p", texts.ticker_parts(F.col("ticker")))
    rows = rows.withColumns({"day": F.col("p.date"), "told_clock": F.col("p.clock"), "pair": F.col("p.teams"), "t": texts.title_teams(F.col("title"))})
    cut = rows.where(F.col("league").isNotNull() & (F.length("pair") > 1)).select("event", "league", "pair", F.explode(F.expr("sequence(1, length(pair) - 1)")).alias("at"))
    cut = cut.select("event", "league", F.expr("substr(pair, 1, at)").alias("c1"), F.expr("substr(pair, at + 1)").alias("c2"))
    code = lambda c, name: codes.select("league", F.col("code").alias(c), F.col("team").alias(name))
    fits = cut.join(code("c1", "away"), ["league", "c1"]).join(code("c2", "home"), ["league", "c2"]).where("away <> home")
    pairs = fits.groupBy("event").agg(F.count("*").alias("n_pairs"), F.min(F.struct("away", "home")).alias("teams"))

    side = lambda which: rows.where("t IS NOT NULL").select(F.struct("event", F.lit(which).alias("side")).alias("source"), "provider", "league", F.col(f"t.{which}").alias("raw_name"))
    read = team_of_name(side("first").unionByName(side("second")).where("league IS NOT NULL"), aliases)
    titles = read.groupBy(F.col("source.event").alias("event")).agg(*[F.max(F.when(F.col("source.side") == s, F.col("team"))).alias(f"title_{s}") for s in ("first", "second")])

    out = rows.join(pairs, "event", "left").join(titles, "event", "left").withColumns({"away": F.col("teams.away"), "home": F.col("teams.home")})
    slate = ["league", "away", "home", "day"]
    clocks = games.groupBy(*slate, F.col("clock").alias("told_clock")).agg(F.count("*").alias("n"), F.min("game").alias("g"))
    days = clocks.groupBy(*slate).agg(F.sum("n").alias("n_all"), F.min("g").alias("g_all"))
    met = out.where("n_pairs = 1").select("event", *slate, "told_clock").join(days, slate).join(clocks, [*slate, "told_clock"], "left")
    any_clock = F.col("told_clock").isNull()
    n_games, first = F.when(any_clock, F.col("n_all")).otherwise(F.coalesce("n", F.lit(0))), F.when(any_clock, F.col("g_all")).otherwise(F.col("g"))
    met = met.groupBy("event").agg(F.sum("n_all").alias("n_day"), F.sum(n_games).alias("n_games"), F.min(first).alias("g"))
    out = out.join(met, "event", "left")
    one, two = F.col("title_first"), F.col("title_second")
    straight, turned = (one == F.col("away")) & (two == F.col("home")), (one == F.col("home")) & (two == F.col("away"))
    sided = F.col("t.link").isin("at", "@")
    reason = (
        F.when(F.col("league").isNull(), "unsupported_series").when(F.col("p").isNull() | F.col("day").isNull(), "ticker_unreadable").when(F.col("n_pairs").isNull(), "codes_unknown").when(F.col("n_pairs") > 1, "several_pairs")
        .when(F.col("title").isNotNull() & F.col("t").isNull(), "title_unreadable").when(F.col("t").isNotNull() & (one.isNull() | two.isNull()), "title_team_unknown")
        .when(F.col("t").isNotNull() & ~straight & ~turned, "title_teams_differ").when(F.col("t").isNotNull() & sided & ~straight, "title_sides_differ")
        .when(F.col("n_day").isNull(), "no_game").when(F.col("n_games") == 0, "clock_differs").when(F.col("n_games") > 1, "several_games").otherwise("agreed")
    )
    out = out.withColumn("reason", reason)
    outcome = (
        F.when(F.col("reason") == "agreed", "matched").when(F.col("reason") == "unsupported_series", "unsupported").when(F.col("reason").isin("several_pairs", "several_games"), "ambiguous")
        .when(F.col("reason").isin("title_teams_differ", "title_sides_differ", "clock_differs"), "conflict").otherwise("incomplete")
    )
    return out.select("event", outcome.alias("outcome"), F.when(F.col("reason") == "agreed", F.col("g")).alias("game"), "reason")


def listed_markets(markets: DataFrame, events: DataFrame, matched: DataFrame, codes: DataFrame, series: DataFrame, aliases: DataFrame, games: DataFrame) -> DataFrame:
    """The side that a market's Yes stands for: ``outcome``, ``team`` and ``reason``.

    ``markets``: (``market``, ``event``, ``ticker``, ``yes_title``, ``rules``, ``provider``).  The ticker must be the event's and a team's
    code of the game; the Yes label and the rules, read by themselves, must name that team, and the rules the other one as
    its opponent.  Other suffixes are ``unsupported`` meanings, not errors.  Nothing is read from prices or results.
    """
    base = events.select("event", "series", F.col("ticker").alias("event_ticker")).join(series, "series", "left").join(matched.select("event", "game", F.col("outcome").alias("event_outcome")), "event", "left")
    rows = markets.join(base, "event", "left").join(games.select("game", "away", "home"), "game", "left")
    prefix = F.concat("event_ticker", F.lit("-"))
    rows = rows.withColumns({"descends": F.coalesce(F.col("ticker").startswith(prefix), F.lit(False)), "suffix": F.expr("substr(ticker, length(event_ticker) + 2)"), "r": texts.rules_text(F.col("rules"))})
    known = codes.select("league", F.col("code").alias("suffix"), F.col("team").alias("by_code"))
    rows = rows.join(known, ["league", "suffix"], "left")
    say = lambda what, text: rows.where(text.isNotNull() & F.col("league").isNotNull()).select(F.struct("market", F.lit(what).alias("what")).alias("source"), "provider", "league", text.alias("raw_name"))
    names = say("yes", F.col("yes_title")).unionByName(say("team", F.col("r.team"))).unionByName(say("opponent", F.col("r.opponent")))
    read = team_of_name(names, aliases).groupBy(F.col("source.market").alias("market")).agg(*[F.max(F.when(F.col("source.what") == w, F.col("team"))).alias(f"said_{w}") for w in ("yes", "team", "opponent")])
    out = rows.join(read, "market", "left")
    yes, other = F.col("by_code"), F.when(F.col("by_code") == F.col("away"), F.col("home")).otherwise(F.col("away"))
    differs = lambda said, want: ~F.coalesce(F.col(said) == want, F.lit(False))
    reason = (
        F.when(F.col("event_outcome").isNull() | (F.col("event_outcome") != "matched"), "event_not_matched").when(~F.col("descends"), "ticker_of_other_event")
        .when(yes.isNull() | ~((yes == F.col("away")) | (yes == F.col("home"))), "other_meaning").when(F.col("yes_title").isNotNull() & differs("said_yes", yes), "label_differs")
        .when(F.col("r.team").isNull(), "rules_unreadable").when(differs("said_team", yes), "rules_differ").when(differs("said_opponent", other), "opponent_differs").otherwise("agreed")
    )
    out = out.withColumn("reason", reason)
    outcome = F.when(F.col("reason") == "agreed", "matched").when(F.col("reason") == "other_meaning", "unsupported").when(F.col("reason").isin("label_differs", "rules_differ", "opponent_differs", "ticker_of_other_event"), "conflict").otherwise("incomplete")
    return out.select("market", outcome.alias("outcome"), F.when(F.col("reason") == "agreed", yes).alias("team"), "reason")
