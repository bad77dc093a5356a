"""Reports from outside as snapshots: injuries, pitchers, lineups, announcements, news; pages and places.

Every adapter gives one row per reported subject with ``state``: ``snapshot``, ``unresolved`` (kept for review, never
guessed) or ``refused``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How reports word a player's status.
PLAYER_STATUS = {
    "available": "available", "active": "available", "probable": "probable", "questionable": "questionable", "doubtful": "doubtful", "out": "out", "inactive": "out",
    "day-to-day": "questionable", "suspended": "suspended",
}


def player_status(text: Column) -> Column:
    word = F.lower(F.trim(text))
    out = F.lit("unknown")
    for said, meant in reversed(PLAYER_STATUS.items()):
        out = F.when(word == said, meant).otherwise(out)
    return out


def reported_players(reports: DataFrame, body: str, path: str = "players") -> DataFrame:
    """One row per player that a JSON report names: the report's columns, ``name``, ``team``, ``player_id``, ``status``, ``reason``, ``role``."""
    schema = f"{path} array<struct<name:string,team:string,player_id:string,status:string,reason:string,role:string>>"
    rows = reports.withColumn("__p", F.explode(F.from_json(body, schema)[path]))
    return rows.select(*[c for c in reports.columns if c != body], F.col("__p.name").alias("name"), F.col("__p.team").alias("team"), F.col("__p.player_id").alias("player_id"), player_status(F.col("__p.status")).alias("status"), F.col("__p.reason").alias("reason"), F.col("__p.role").alias("role"))


def resolved(reported: DataFrame, roster: DataFrame) -> DataFrame:
    """Reported players with the roster's ``player`` by id, else by name and team, else by name; ``state`` as above.

    The first of these under which the roster has anybody decides; several are unresolved.
    """
    people = roster.select(F.col("player"), F.col("player_id").alias("__id"), F.lower("name").alias("__name"), F.col("team").alias("__team"))
    key = F.lower(F.col("name"))
    one = lambda *by: people.groupBy(*by).agg(F.count_distinct("player").alias("n"), F.min("player").alias("p"))
    by_id = one("__id").select("__id", F.struct("n", "p").alias("a"))
    by_team = one("__name", "__team").select(F.col("__name").alias("__n1"), F.col("__team").alias("__t1"), F.struct("n", "p").alias("b"))
    by_name = one("__name").select(F.col("__name").alias("__n2"), F.struct("n", "p").alias("c"))
    both = reported.join(by_id, F.col("player_id") == F.col("__id"), "left").join(by_team, (key == F.col("__n1")) & (F.col("team") == F.col("__t1")), "left").join(by_name, key == F.col("__n2"), "left")
    best = F.coalesce("a", "b", "c")
    good = F.coalesce(best["n"] == 1, F.lit(False))
    return both.select(*reported.columns, F.when(good, best["p"]).alias("player"), F.when(good, "snapshot").otherwise("unresolved").alias("state"))


def authorised(reports: DataFrame, authors: DataFrame, author: str = "author") -> DataFrame:
    """Reports with ``refused`` where the author is on no list, and never confirmed."""
    known = F.broadcast(authors.select(author).distinct().withColumn("__a", F.lit(True)))
    return reports.join(known, author, "left").withColumns({"refused": F.col("__a").isNull(), "confirmed": F.lit(False)}).drop("__a")


def pitcher_slots(reported: DataFrame, game: str) -> DataFrame:
    """Probable pitchers as the state of their game's slot: ``subject`` is the game and side, not the man."""
    return reported.withColumn("subject", F.concat_ws(":", F.col(game).cast("string"), F.lit("pitcher"), F.coalesce("role", F.lit("unknown"))))


def lineups(reported: DataFrame, game: str) -> DataFrame:
    """Starters of each game and team, in order of name; a lineup is a set."""
    return reported.where(F.lower("role") == "starter").groupBy(game, "team").agg(F.array_sort(F.collect_set("name")).alias("starters"))


def page_shape(pages: DataFrame, body: str, key: str) -> DataFrame:
    """Counts of rows, teams, players and starters of a JSON page; zero where it cannot be read."""
    rows = F.coalesce(F.from_json(body, "data array<struct<team:struct<id:string>,player:struct<id:string>,starter:boolean>>")["data"], F.array().cast("array<struct<team:struct<id:string>,player:struct<id:string>,starter:boolean>>"))
    ids = lambda f: F.size(F.array_distinct(F.filter(F.transform(rows, f), lambda x: x.isNotNull())))
    return pages.select(key, F.size(rows).alias("n_rows"), ids(lambda r: r["team"]["id"]).alias("n_teams"), ids(lambda r: r["player"]["id"]).alias("n_players"), F.size(F.filter(rows, lambda r: F.coalesce(r["starter"], F.lit(False)))).alias("n_starters"))


def venue_reject(name: Column, latitude: Column, longitude: Column, roof: Column) -> Column:
    """Why a place cannot be kept, null where it can."""
    out = F.when(F.coalesce(F.trim(name), F.lit("")) == "", "blank_name").when(latitude.isNull() != longitude.isNull(), "half_coordinates")
    out = out.when(~latitude.between(-90, 90) | ~longitude.between(-180, 180), "coordinates_out_of_range")
    return out.when(roof.isNotNull() & ~roof.isin("open", "retractable", "dome"), "unknown_roof")


def replayable(events: DataFrame, market: str, time: str) -> tuple[DataFrame, DataFrame]:
    """Events that can be placed on a timeline, and the one-row count of those that cannot."""
    good = F.col(market).isNotNull() & F.col(time).isNotNull()
    return events.where(good), events.agg(F.count_if(~good).alias("n_gaps"), F.count("*").alias("n_events"))
