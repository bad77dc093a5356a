"""Measures: weather units, court zones, batted balls, speeds."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Court geometry in feet.
CORNER_X, CORNER_Y, CORNER_DISTANCE, ARC, RESTRICTED, PAINT_X, PAINT_Y = 22.0, 14.0, 22.0, 23.75, 4.0, 8.0, 19.0
# The sixteen compass points, a step of 22.5 degrees each.
COMPASS = "n nne ne ene e ese se sse s ssw sw wsw w wnw nw nnw".split()
# Unit names.
CELSIUS, FAHRENHEIT = ("c", "degc", "celsius", "°c"), ("f", "degf", "fahrenheit", "°f")
METRES_PER_SECOND, KILOMETRES_PER_HOUR, MILES_PER_HOUR = ("m_s-1", "m/s", "ms", "mps", "meters per second"), ("km_h-1", "km/h", "kmh", "kph"), ("mph", "mi_h-1", "miles per hour")
MILLIMETRES, METRES, INCHES = ("mm", "millimeter", "millimeters", "millimetre", "millimetres"), ("m", "meter", "meters"), ("in", "inch", "inches")
NUMBER = r"-?\d+(?:\.\d+)?"


def number(text: Column) -> Column:
    """The first number in a text."""
    return F.nullif(F.regexp_extract(text, NUMBER, 0), F.lit("")).cast("double")


def unit_name(unit: Column) -> Column:
    return F.replace(F.lower(F.trim(F.coalesce(unit, F.lit("")))), F.lit("wmounit:"), F.lit(""))


def celsius(value: Column, unit: Column) -> Column:
    u = unit_name(unit)
    return F.when(u.isin(*CELSIUS), number(value)).when(u.isin(*FAHRENHEIT), (number(value) - 32) * 5 / 9)


def is_range(value: Column) -> Column:
    return F.contains(F.lower(value), F.lit(" to ")) | (F.size(F.regexp_extract_all(value, F.lit(f"({NUMBER})"))) >= 2)


def metres_per_second(value: Column, unit: Column) -> Column:
    """Null for ranges and unknown units; a unit inside the value counts where none is given."""
    low = F.lower(value)
    own = F.when(F.contains(low, F.lit("mph")), "mph").when(low.rlike("km/h|kmh"), "km/h").when(F.contains(low, F.lit("m/s")), "m/s")
    u = unit_name(F.coalesce(unit, own))
    n = number(value)
    return F.when(is_range(value), None).when(u.isin(*METRES_PER_SECOND), n).when(u.isin(*KILOMETRES_PER_HOUR), n / 3.6).when(u.isin(*MILES_PER_HOUR), n * 0.44704)


def degrees(value: Column) -> Column:
    points = F.create_map(*chain.from_iterable((F.lit(p), F.lit(22.5 * i)) for i, p in enumerate(COMPASS)))
    n = number(value)
    return F.coalesce(points[F.lower(F.trim(value))], F.when(n.between(0, 360), n))


def millimetres(value: Column, unit: Column) -> Column:
    u, n = unit_name(unit), number(value)
    mm = F.when(u.isin(*MILLIMETRES), n).when(u.isin(*METRES), n * 1000).when(u.isin(*INCHES), n * 25.4)
    return F.when(mm >= 0, mm)


def shot_distance(x: Column, y: Column) -> Column:
    return F.hypot(x, y)


def shot_zone(x: Column, y: Column) -> Column:
    d = shot_distance(x, y)
    corner = (F.abs(x) >= CORNER_X) & y.between(0, CORNER_Y) & (d >= CORNER_DISTANCE)
    return (
        F.when(x.isNull() | y.isNull(), None).when(corner, "corner_three").when(d >= ARC, "above_the_break_three").when(d <= RESTRICTED, "restricted_area")
        .when((F.abs(x) <= PAINT_X) & (y <= PAINT_Y), "paint").otherwise("mid_range")
    )


def batted_ball(speed: Column, angle: Column) -> tuple[Column, Column]:
    """(hard hit, barrel), null where an input is.  The bounds are fixed values."""
    return speed >= 95, F.when(speed.isNotNull() & angle.isNotNull(), (speed >= 98) & angle.between(26, 30))


def movement_speed(reported: Column, vx: Column, vy: Column, vz: Column) -> Column:
    return F.coalesce(reported, F.sqrt(vx * vx + vy * vy + F.coalesce(vz * vz, F.lit(0.0))))


def roof_applies(roof: Column) -> Column:
    """Whether weather reaches the field; null where the roof is unknown or can be either way."""
    return F.when(roof == "open", True).when(roof.isin("fixed", "closed", "dome"), False)


def noted(value: Column, unit: Column, converted: Column, known: tuple[str, ...], low: float | None = None) -> Column:
    """Why a measure is null: ``missing``, ``range``, ``unknown_unit``, ``no_number``, ``out_of_range``; null where it is not."""
    plain = number(value)
    out = F.when(value.isNull() | (F.trim(value) == ""), "missing").when(is_range(value), "range").when(~unit_name(unit).isin(*known), "unknown_unit").when(plain.isNull(), "no_number")
    return (out if low is None else out.when(plain < low, "out_of_range")).when(converted.isNull(), "out_of_range")


def pitch_movement(pfx_x: Column, pfx_z: Column) -> tuple[Column, Column, Column]:
    """(horizontal, vertical, total) break in inches from feet; null where an input is."""
    return pfx_x * 12, pfx_z * 12, F.hypot(pfx_x * 12, pfx_z * 12)


def typed(text: Column) -> Column:
    """A record's number; null, never zero, where it is blank or no number."""
    return F.expr("1.0") * F.nullif(F.trim(text), F.lit("")).try_cast("double")


def weather_provider(country: Column, roof: Column) -> Column:
    """Which source covers a place: none needed under a roof, the national service in its country, else the world-wide one."""
    return F.when(roof.isin("fixed", "closed", "dome"), "none").when(F.upper(country) == "US", "national").otherwise("global")
