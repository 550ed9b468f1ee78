"""The seven weather jobs, each from messages (key, value, topic) to its output.

All of them take a batch or a stream, of messages or of records parsed before. Windowed jobs group by ``topic``, one topic
per station, so stations are worked on side by side; for a single topic the
result is that of one global group. ``rules`` are the parsing rules of
:func:`tidemill.operators.parse_json_records`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions import (
    daily_mean_line,
    moving_mean_line,
    rain_run_line,
    reading_line,
    refreshing_mean_line,
    temperature_line,
)
from tidemill.operators import (
    accepted,
    extract,
    keep_above,
    keep_at_least,
    parse_weather,
    project,
    session_combine,
    sliding_combine,
    tumbling_combine,
    with_event_time,
    with_watermark,
)
from tidemill.operators.eventtime import DEFAULT_DELAY
from tidemill.operators.windows import DAY, HOUR
from tidemill.schema import EVENT_TIME, RAINFALL, TEMPERATURE, TIMESTAMP
from tidemill.streaming.complete import Stretch, closed_sessions, start_complete_stretches

STATION_KEY = "topic"


def _parsed(messages: DataFrame, rules: dict, *, timed: bool = False) -> DataFrame:
    if "value" not in messages.columns:  # parsed before
        return messages
    if rules.get("on_malformed") == "quarantine":
        return accepted(parse_weather(messages, timed=timed, **rules))
    return parse_weather(messages, timed=timed, **rules)


def json_lines(messages: DataFrame, **rules) -> DataFrame:
    """One line of text per record."""
    parsed = _parsed(messages, rules)
    line = reading_line(F.col(TIMESTAMP), F.col(TEMPERATURE), F.col(RAINFALL))
    return parsed.select(STATION_KEY, line.alias("value"))


def non_negative_lines(messages: DataFrame, **rules) -> DataFrame:
    """Time and temperature of the records at or above 0 °C."""
    projected = project(_parsed(messages, rules), STATION_KEY, TIMESTAMP, TEMPERATURE)
    kept = keep_at_least(projected, TEMPERATURE, 0.0)
    line = temperature_line(F.col(TIMESTAMP), F.col(TEMPERATURE))
    return kept.select(STATION_KEY, line.alias("value"))


def timed_readings(
    messages: DataFrame, *, delay: timedelta | None = DEFAULT_DELAY, **rules
) -> DataFrame:
    """Parse, take the event time, and set the watermark before anything is
    filtered. ``delay=None`` leaves the watermark to the caller."""
    timed = with_event_time(_parsed(messages, rules, timed=True))
    return timed if delay is None else with_watermark(timed, delay)


def daily_means(readings: DataFrame) -> DataFrame:
    """Mean temperature of each local calendar day."""
    temperature = extract(readings, TEMPERATURE, STATION_KEY, EVENT_TIME)
    return tumbling_combine(temperature, EVENT_TIME, "reading", keys=[STATION_KEY])


def daily_mean_lines(messages: DataFrame, *, delay: timedelta = DEFAULT_DELAY, **rules) -> DataFrame:
    means = daily_means(timed_readings(messages, delay=delay, **rules))
    line = daily_mean_line(F.col("window_start"), F.col("mean"))
    return means.select(STATION_KEY, line.alias("value"))


def moving_means(readings: DataFrame) -> DataFrame:
    """Mean temperature of three hours, every hour."""
    temperature = extract(readings, TEMPERATURE, STATION_KEY, EVENT_TIME)
    return sliding_combine(temperature, EVENT_TIME, "reading", keys=[STATION_KEY])


def moving_mean_lines(messages: DataFrame, *, delay: timedelta = DEFAULT_DELAY, **rules) -> DataFrame:
    means = moving_means(timed_readings(messages, delay=delay, **rules))
    line = moving_mean_line(F.col("window_start"), F.col("mean"))
    return means.select(STATION_KEY, line.alias("value"))


def rain_runs(readings: DataFrame) -> DataFrame:
    """Hours of unbroken rain, and when it stopped: an hour after the last rain."""
    rainfall = extract(readings, RAINFALL, STATION_KEY, EVENT_TIME)
    rainy = keep_above(rainfall, "reading", 0.0, time=EVENT_TIME)
    return session_combine(rainy, EVENT_TIME, "reading", keys=[STATION_KEY], name="hours")


def rain_run_lines(
    messages: DataFrame, *, delay: timedelta = DEFAULT_DELAY, **rules
) -> DataFrame:
    runs = rain_runs(timed_readings(messages, delay=delay, **rules))
    line = rain_run_line(F.col("window_end"), F.col("hours"))
    return runs.select(STATION_KEY, line.alias("value"))


@dataclass(frozen=True)
class StretchJob:
    """A windowed job on stretches that all partitions have passed: ``windows`` gives those
    that are complete since a stretch, from its readings and a folder for open ones."""

    windows: Callable[[DataFrame, Stretch, str], DataFrame]
    cell: timedelta = HOUR
    offset: timedelta = timedelta(0)
    lookback: timedelta = timedelta(0)


def _complete_moving_means(readings: DataFrame, stretch: Stretch, open_folder: str) -> DataFrame:
    return moving_means(readings).filter(stretch.closes(F.col("window_end")))


def _complete_rain_runs(readings: DataFrame, stretch: Stretch, open_folder: str) -> DataFrame:
    rainfall = extract(readings, RAINFALL, STATION_KEY, EVENT_TIME)
    return closed_sessions(
        keep_above(rainfall, "reading", 0.0), stretch, open_folder, EVENT_TIME, "reading",
        keys=[STATION_KEY], name="hours",
    )


# Cells are the days and hours that the jobs' windows begin and end at.
COMPLETE_DAILY_MEANS = StretchJob(lambda readings, stretch, _: daily_means(readings), cell=DAY, offset=15 * HOUR)
COMPLETE_MOVING_MEANS = StretchJob(_complete_moving_means, lookback=2 * HOUR)
COMPLETE_RAIN_RUNS = StretchJob(_complete_rain_runs)


def start_stretch_job(
    job: StretchJob, readings: DataFrame, write: Callable[[DataFrame, int], None], folder: str, **how
) -> StreamingQuery:
    """Run a windowed job with a watermark for each (topic, partition). ``write`` gets the
    complete windows and the number of the micro-batch; ``how`` goes to
    :func:`tidemill.streaming.start_complete_stretches`."""

    def take(complete: DataFrame, stretch: Stretch) -> None:
        write(job.windows(complete, stretch, f"{folder}/open"), stretch.number)

    return start_complete_stretches(
        readings, take, folder, cell=job.cell, offset=job.offset, lookback=job.lookback, **how
    )


def temperatures(messages: DataFrame, **rules) -> DataFrame:
    """The input of the refreshing mean. It needs no event time, but a record whose
    timestamp cannot be read is as wrong here as anywhere."""
    timed = with_event_time(_parsed(messages, rules, timed=True))
    # True for every time: without a use of it, the check would be left out.
    checked = timed.filter(F.unix_micros(EVENT_TIME) >= F.lit(-(2**63)))
    return extract(checked, TEMPERATURE, STATION_KEY)


def refreshing_mean_lines(pane_means: DataFrame) -> DataFrame:
    """Lines of the means of fired panes, of one station or one pane per station."""
    station = [c for c in pane_means.columns if c == STATION_KEY]
    return pane_means.select(*station, refreshing_mean_line(F.col("mean")).alias("value"))
