"""Output lines of the jobs. The labels in them are fixed values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.timetext import local_date, local_datetime_text


def _line(*parts: str | Column) -> Column:
    """Text pieces as they are, columns as their text; a NULL prints as ``null``."""
    return F.concat(
        *[
            F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null"))
            for p in parts
        ]
    )


def reading_line(timestamp: Column, temperature: Column, rainfall: Column) -> Column:
    return _line(timestamp, "\ttemperature:", temperature, "\trainfall:", rainfall)


def temperature_line(timestamp: Column, temperature: Column) -> Column:
    return _line(timestamp, "\ttemperature:", temperature)


def daily_mean_line(window_start: Column, mean: Column) -> Column:
    return _line("date:", local_date(window_start), "\tmeanTemperature(daily):", mean)


def moving_mean_line(window_start: Column, mean: Column) -> Column:
    start = local_datetime_text(window_start)
    return _line("leftmost datetime:", start, "\tmeanTemperature(per 3-hour):", mean)


def rain_run_line(stopped_at: Column, hours: Column) -> Column:
    stopped = local_datetime_text(stopped_at)
    return _line("rainStoppedAt:", stopped, "\trainContinued[h]:", hours)


def refreshing_mean_line(mean: Column) -> Column:
    return _line("currentMeanTemperature:", mean)
