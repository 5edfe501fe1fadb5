"""Log timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the log format and of the capture site.
LOG_TIME = "M/d/yyyy h:mm:ss a"
LOG_ZONE = "America/Toronto"


def wall_clock(text: Column) -> Column:
    """Local time as printed, kept as if it were UTC; NULL when it does not parse.

    The offset is part of the parsed text, so the session's zone plays no role.
    """
    return F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(LOG_TIME + " xx"))


def instant(local: Column, zone: str | None = LOG_ZONE) -> Column:
    """UTC instant of a local time. ``zone=None`` keeps the local reading."""
    return local if zone is None else F.to_utc_timestamp(local, zone)


def seconds_between(first: Column, last: Column) -> Column:
    return F.unix_timestamp(last) - F.unix_timestamp(first)
