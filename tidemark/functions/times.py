"""Seasons, snapshot grids, availability and local dates.  Zones are explicit; instants are UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The archive's first instant, the change of its cadence, and the two cadences in seconds.
ARCHIVE_START, GRID_CHANGE, LEGACY_GRID, MODERN_GRID = "2020-06-06 00:00:00", "2022-09-18 00:00:00", 600, 300


def season_year(league: Column, day: Column) -> Column:
    """Start year of the season: from July on for NBA, else the calendar year."""
    return F.when((F.upper(league) == "NBA") & (F.month(day) < 7), F.year(day) - 1).otherwise(F.year(day))


def season_start(league: Column, year: Column) -> Column:
    return F.make_date(year, F.when(F.upper(league) == "NBA", 7).otherwise(1), F.lit(1))


def season_end(league: Column, year: Column) -> Column:
    nba = F.upper(league) == "NBA"
    return F.make_date(F.when(nba, year + 1).otherwise(year), F.when(nba, 6).otherwise(12), F.when(nba, 30).otherwise(31))


def seconds_of(at: Column) -> Column:
    """Whole seconds since 1970 of an instant, downwards."""
    return F.floor(F.unix_micros(at.cast("timestamp")) / 1_000_000).cast("long")


def floor_to_grid(at: Column, start: str = ARCHIVE_START, change: str = GRID_CHANGE) -> Column:
    """The snapshot grid point at or before an instant, also for instants before the archive."""
    first = F.unix_timestamp(F.lit(start).cast("timestamp"))
    grid = F.when(at.cast("timestamp") >= F.lit(change).cast("timestamp"), MODERN_GRID).otherwise(LEGACY_GRID)
    return F.timestamp_seconds(first + F.floor((seconds_of(at) - first) / grid) * grid).cast("timestamp_ntz")


def bucket_before(start: Column, minutes: int = 60, grid: int = MODERN_GRID) -> Column:
    """The grid point at or before so many minutes ahead of a start."""
    return F.timestamp_seconds(F.floor((seconds_of(start) - 60 * minutes) / grid) * grid).cast("timestamp_ntz")


def available_at(completed: Column, lag_hours: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(completed.cast("timestamp")) + lag_hours.cast("long") * 3_600_000_000).cast("timestamp_ntz")


def local_date(at: Column, venue_zone: Column, provider_date: Column, home_zone: Column, known: list[str]) -> tuple[Column, Column]:
    """(date, basis): by the venue's zone, the provider's date, the home team's zone, then UTC.

    A zone counts only if it is among the known ones, since an unknown one would fail the job.
    """
    ok = lambda z: z.isin(*known)
    by = lambda z: F.to_date(F.from_utc_timestamp(at.cast("timestamp"), F.when(ok(z), z).otherwise("UTC")))
    basis = F.when(ok(venue_zone), "venue").when(provider_date.isNotNull(), "provider").when(ok(home_zone), "home").otherwise("utc")
    day = F.when(ok(venue_zone), by(venue_zone)).when(provider_date.isNotNull(), provider_date).when(ok(home_zone), by(home_zone)).otherwise(F.to_date(at.cast("timestamp")))
    return day, basis


def lead_and_eligibility(kind: Column, valid: Column, observed: Column, start: Column) -> tuple[Column, Column]:
    """(lead seconds, eligible): a forecast counts only if seen by the start; unknown for stitched ones."""
    forecast = kind.isin("current_forecast", "historical_forecast")
    lead = seconds_of(valid) - seconds_of(observed)
    eligible = F.when(kind == "current_forecast", F.coalesce(observed <= start, F.lit(False))).when(kind == "historical_forecast", F.lit(None).cast("boolean")).otherwise(False)
    return F.when(forecast & (lead >= 0), lead), eligible


def parse_instant(text: Column) -> tuple[Column, Column]:
    """(instant, state): RFC 3339 text or epoch seconds; ``missing``, ``malformed`` or ``ok``."""
    digits = text.rlike(r"^\d{9,10}$")
    at = F.when(digits, F.timestamp_seconds(F.when(digits, text).cast("long"))).otherwise(F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$"), text)))
    return at, F.when(text.isNull() | (F.trim(text) == ""), "missing").when(at.isNull(), "malformed").otherwise("ok")


# The letters of North American zones by their standard offset in hours.
ZONE_LETTERS = {-5: "E", -6: "C", -7: "M", -8: "P", -9: "AK", -10: "H"}


def wall_clock(day: Column, clock: Column, zone: Column, abbreviation: Column | None = None) -> tuple[Column, Column]:
    """(UTC instant, reason): a local wall time in its zone; null with a reason where the zone is unknown, the time does not
    exist or comes twice there, or a stated abbreviation such as ``EDT`` is not the zone's at that time.

    The offsets a day before and a day after give the instants that the wall time may mean; exactly one must lead back.
    """
    known = F.coalesce(zone.rlike(r"^[A-Za-z]+(/[A-Za-z_+\-0-9]+)+$|^UTC$"), F.lit(False))
    good = day.isNotNull() & F.coalesce(clock.rlike(r"^([01]\d|2[0-3]):[0-5]\d$"), F.lit(False))
    known = F.coalesce(zone.rlike(r"^[A-Za-z]+(/[A-Za-z_+\-0-9]+)+$|^UTC$"), F.lit(False))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    offset = lambda z, utc: micros(F.convert_timezone(F.lit("UTC"), z, utc)) - micros(utc)
    let = lambda value, use: F.transform(F.array(value), use)[0]  # noqa: E731  (names a value, so that it is computed once)

    def read(s: Column) -> Column:
        around = [offset(s["zone"], s["at"] + F.expr(f"INTERVAL {d} DAY")) for d in (-1, 1)]
        on = [offset(s["zone"], F.make_timestamp_ntz(F.year(s["wall"]), F.lit(m), F.lit(1), F.lit(12), F.lit(0), F.lit(0))) for m in (1, 7)]
        parts = F.struct(s["zone"].alias("zone"), s["wall"].alias("wall"), s["at"].alias("at"), around[0].alias("before"), around[1].alias("after"), offset(s["zone"], s["at"]).alias("now"), F.least(*on).alias("standard"))
        return let(parts, judge)

    def judge(s: Column) -> Column:
        fits = [F.convert_timezone(F.lit("UTC"), s["zone"], F.timestamp_micros(micros(s["wall"]) - s[o]).cast("timestamp_ntz")) == s["wall"] for o in ("before", "after")]
        one = (fits[0] != fits[1]) | (fits[0] & (s["before"] == s["after"]))
        reason = F.when(~known, "unknown_zone").when(s["wall"].isNull(), "malformed").when(~one, "ambiguous_or_missing")
        if abbreviation is not None:
            letters = F.lit(None).cast("string")
            for hours, name in ZONE_LETTERS.items():
                letters = F.when(s["standard"] == hours * 3_600_000_000, name).otherwise(letters)
            named = F.when(s["zone"] == "UTC", "UTC").otherwise(F.concat(letters, F.when(s["now"] > s["standard"], "DT").otherwise("ST")))
            reason = reason.when(abbreviation.isNotNull() & named.isNull(), "abbreviation_unknown").when(abbreviation != named, "abbreviation_differs")
        return let(reason, lambda why: F.struct(F.when(why.isNull(), s["at"]).alias("at"), why.alias("reason")))

    first = F.struct(F.when(known, zone).otherwise("UTC").alias("zone"), F.to_timestamp_ntz(F.when(good, F.concat_ws(" ", day.cast("string"), clock)), F.lit("yyyy-MM-dd HH:mm")).alias("wall"))
    found = let(first, lambda s: let(F.struct(s["zone"].alias("zone"), s["wall"].alias("wall"), F.convert_timezone(s["zone"], F.lit("UTC"), s["wall"]).alias("at")), read))
    return found["at"], found["reason"]


def rule_instant(rule: Column, digest: Column, completed: Column, rules: dict[str, tuple[int, str]]) -> Column:
    """When an event's data count as available under a rule (name -> hours of lag, digest); null for another rule or digest."""
    out = F.lit(None).cast("timestamp_ntz")
    for name, (hours, held) in rules.items():
        out = F.when((rule == name) & (digest == held), available_at(completed, F.lit(hours)).cast("timestamp_ntz")).otherwise(out)
    return out


def latency_ns(first: Column, second: Column) -> Column:
    """Nanoseconds from one instant to another; null where either is, or where time runs backwards."""
    gap = (F.unix_micros(second.cast("timestamp")) - F.unix_micros(first.cast("timestamp"))) * 1000
    return F.when(gap >= 0, gap)
