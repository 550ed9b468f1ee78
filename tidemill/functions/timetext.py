"""Instants, local dates and their text forms."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.schema import LOCAL_OFFSET


def micros(width: timedelta) -> int:
    """A positive duration as whole microseconds, Spark's own resolution."""
    value = width // timedelta(microseconds=1)
    if value <= 0:
        raise ValueError(f"duration must be positive: {width}")
    return value


def interval_text(width: timedelta) -> str:
    """A duration (zero allowed) in the form ``window`` and ``withWatermark`` take."""
    return f"{width // timedelta(microseconds=1)} microseconds"


def parse_instant(text: Column, *, strict: bool = True) -> Column:
    """RFC 3339 text -> TIMESTAMP. ``strict`` fails on bad text, otherwise NULL."""
    return F.to_timestamp(text) if strict else F.try_to_timestamp(text)


def local_date(instant: Column, offset: str = LOCAL_OFFSET) -> Column:
    """The calendar date of an instant at a fixed UTC offset."""
    return F.to_date(F.from_utc_timestamp(instant, offset))


def local_datetime_text(instant: Column, offset: str = LOCAL_OFFSET) -> Column:
    """An instant as ``2022-01-01T00:00:00.000+09:00`` at a fixed UTC offset."""
    local = F.from_utc_timestamp(instant, offset)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit(offset))
