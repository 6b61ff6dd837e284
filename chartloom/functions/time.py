"""Time expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def local_to_utc(col: Column | str, zone: str = "US/Eastern", dst_after_2037: bool = True) -> Column:
    """Wall-clock time in ``zone`` to a UTC instant (session time zone UTC).

    * a time inside the repeated autumn hour is ambiguous: NULL;
    * a time inside the skipped spring hour moves to the first instant after the gap;
    * ``dst_after_2037=False`` applies the zone's standard offset from 2038 on, which is what
      time-zone tables that end in 2037 give for date-shifted records.
    """
    wall = _c(col).cast("timestamp")
    utc = F.to_utc_timestamp(wall, zone)
    repeated = F.from_utc_timestamp(utc + F.expr("INTERVAL '1' HOUR"), zone) == wall
    skipped = F.from_utc_timestamp(utc, zone) != wall
    civil = F.when(repeated, F.lit(None)).when(skipped, F.date_trunc("hour", utc)).otherwise(utc)
    if dst_after_2037:
        return civil
    anchor = F.lit("2038-01-01 00:00:00").cast("timestamp")
    standard = F.to_utc_timestamp(anchor, zone) - anchor
    return F.when(F.year(wall) >= 2038, wall + standard).otherwise(civil)


@dataclass(frozen=True)
class Zone:
    """Time-zone rule of the source system."""

    name: str = "US/Eastern"
    dst_after_2037: bool = False

    def to_utc(self, col: Column | str) -> Column:
        return local_to_utc(col, self.name, self.dst_after_2037)


def age_at_event(anchor_age: Column | str, anchor_year: Column | str, at: Column | str) -> Column:
    """Age from an anchor: counts year boundaries, not birthdays."""
    return _c(anchor_age) + F.year(_c(at)) - _c(anchor_year)


def elapsed_micros(start: Column | str, end: Column | str) -> Column:
    return F.unix_micros(_c(end).cast("timestamp")) - F.unix_micros(_c(start).cast("timestamp"))


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    return elapsed_micros(start, end) / F.lit(60_000_000.0)


def lasts_exactly(start: Column | str, end: Column | str, minutes: int = 1) -> Column:
    """1 when the interval lasts exactly ``minutes``, else 0."""
    return F.when(elapsed_micros(start, end) == minutes * 60_000_000, 1).otherwise(0)
