"""Date/time column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from .numeric import col_of


def floor_hour(c) -> Column:
    """Start of the hour as a naive timestamp, from the wall-clock fields.

    ``date_trunc`` would route a naive value through the session time zone
    (and shift wall times that fall in a daylight-saving gap).
    """
    c = col_of(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


def hour_of(c) -> Column:
    return F.hour(col_of(c)).cast("bigint")


def day_of_week(c) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col_of(c)).cast("bigint")


def time_part_columns(ts="timestamp") -> dict[str, Column]:
    hour = hour_of(ts)
    dow = day_of_week(ts)
    return {
        "hour": hour,
        "day_of_week": dow,
        "is_weekend": (dow >= 5).cast("bigint"),
    }


def cyclic_columns(hour="hour", dow="day_of_week") -> dict[str, Column]:
    two_pi = 2 * math.pi
    h = col_of(hour)
    d = col_of(dow)
    return {
        "hour_sin": F.sin(F.lit(two_pi) * h / F.lit(24.0)),
        "hour_cos": F.cos(F.lit(two_pi) * h / F.lit(24.0)),
        "day_of_week_sin": F.sin(F.lit(two_pi) * d / F.lit(7.0)),
        "day_of_week_cos": F.cos(F.lit(two_pi) * d / F.lit(7.0)),
    }


def parse_timestamp(c) -> Column:
    """Text -> naive timestamp; unparsable -> NULL; accepts 'YYYY-MM-DDTHH:MM'.

    Parsed straight to TIMESTAMP_NTZ, never through the session time zone.
    """
    return col_of(c).cast("string").try_cast("timestamp_ntz")


EPOCH_NTZ = "1970-01-01 00:00:00"


def instant_to_local(instant, timezone: str) -> Column:
    """A TIMESTAMP (instant) -> naive wall time in ``timezone``.

    Via epoch microseconds and UTC, so the session time zone plays no part.
    """
    utc_wall = F.timestamp_add("MICROSECOND", F.unix_micros(col_of(instant)),
                               F.lit(EPOCH_NTZ).cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(timezone), utc_wall)


def to_local_time(c, timezone: str) -> Column:
    """Offset-carrying text -> wall time in ``timezone``; naive text unchanged.

    Text with an explicit offset (``+05:00``/``Z``) names an instant; it is
    converted to ``timezone`` and the zone dropped.  Text without one is a
    naive local time and is kept as is.
    """
    c = col_of(c).cast("string")
    has_offset = c.rlike(r"([+-]\d{2}:?\d{2}|Z)$")
    local = instant_to_local(c.try_cast("timestamp"), timezone)  # offset text names an instant
    return F.when(has_offset, local).otherwise(parse_timestamp(c))
