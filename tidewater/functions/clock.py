"""Calendar expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def wall_clock(epoch_millis: Column, zone: str = "UTC") -> Column:
    """Epoch milliseconds to the wall-clock time of ``zone``."""
    seconds = (epoch_millis.cast("decimal(20,0)") / 1000).cast("decimal(18,6)")
    utc = F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def text_time(wall: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a zone-less timestamp."""
    return F.substring(wall.cast("string"), 1, 19)


def parse_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to a zone-less timestamp."""
    return text.cast("timestamp_ntz")


def epoch_seconds(wall: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp, fractions cut off."""
    day = F.unix_date(wall.cast("date")).cast("bigint")
    return day * 86400 + F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)


def epoch_millis(wall: Column) -> Column:
    """Milliseconds since 1970 of a zone-less timestamp."""
    fraction = F.extract(F.lit("SECOND"), wall) * 1000
    return (epoch_seconds(wall) - F.second(wall)) * 1000 + F.floor(fraction).cast("bigint")


def two_digits(n: Column) -> Column:
    """An hour or minute as two digits."""
    return F.lpad(n.cast("string"), 2, "0")
