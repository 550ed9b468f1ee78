"""Known values of real hourly files.

Point WEATHER_TSV_DIR at a folder with hourly files <days>-<station>.tsv of three
stations for January and August 2022; without it these tests are skipped.
"""

import os

import pytest
from pyspark.sql import functions as F

from tidemill.operators import keep_at_least
from tidemill.plans import daily_means, moving_means, rain_runs
from tidemill.plans import daily_mean_lines, json_lines, moving_mean_lines, rain_run_lines, timed_readings
from tidemill.operators.eventtime import NO_DELAY, SESSION_DELAY
from tidemill.sources import as_messages, read_weather_tsv
from tidemill.streaming import drain_to_table

FOLDER = os.environ.get("WEATHER_TSV_DIR")
pytestmark = pytest.mark.skipif(not FOLDER, reason="WEATHER_TSV_DIR is not set")

# Fixed values, per station and season: rows at or above 0 °C; daily windows; sliding windows; rain
# sessions; closed ones; rain hours; longest session; mean of the first day, of day
# 30 and of all rows; first session (stopped at, hours); last session.
GOLDEN = {
    ("Kushiro", "Winter"): (
        150, 31, 746, 8, 8, 22, 11, -8.708333392937979, -6.195833384990692, -4.209677420035805,
        ("2022-01-03T00:00", 3), ("2022-01-27T12:00", 1),
    ),
    ("Naha", "Winter"): (
        744, 31, 746, 28, 28, 70, 12, 16.90833330154419, 17.320833206176758, 17.707661308268065,
        ("2022-01-02T18:00", 2), ("2022-01-30T20:00", 2),
    ),
    ("Tokyo", "Winter"): (
        721, 31, 746, 5, 5, 16, 5, 3.2416666823749742, 5.224999974171321, 4.894623657107673,
        ("2022-01-06T19:00", 5), ("2022-01-12T00:00", 2),
    ),
    ("Kushiro", "Summer"): (
        744, 31, 746, 36, 35, 116, 15, 17.53750006357829, 18.84166669845581, 19.4575268683895,
        ("2022-08-02T07:00", 9), ("2022-09-01T00:00", 10),
    ),
    ("Naha", "Summer"): (
        744, 31, 746, 24, 24, 41, 5, 26.979166587193806, 30.5083331267039, 29.844354801280524,
        ("2022-08-01T08:00", 5), ("2022-08-31T20:00", 2),
    ),
    ("Tokyo", "Summer"): (
        744, 31, 746, 27, 27, 50, 8, 30.579166809717815, 22.80833339691162, 27.530645142319383,
        ("2022-08-04T05:00", 1), ("2022-08-31T08:00", 1),
    ),
}


def messages_of(spark, station: str, season: str, *, stream: bool = False):
    readings = read_weather_tsv(spark, f"{FOLDER}/*.tsv", stream=stream)
    return as_messages(readings.filter(f"station = '{station}' AND season = '{season}'"))


@pytest.mark.parametrize("station,season", GOLDEN)
def test_batch(spark, station, season):
    golden = GOLDEN[station, season]
    messages = messages_of(spark, station, season)
    (mild, days, sliding, runs, _, hours, longest, first_day, day_30, overall, first, last) = golden
    readings = timed_readings(messages, delay=None).cache()
    assert readings.count() == 744
    assert keep_at_least(readings, "temperature_c").count() == mild
    daily = [r["mean"] for r in daily_means(readings).orderBy("window_start").collect()]
    assert len(daily) == days
    assert (daily[0], daily[29]) == pytest.approx((first_day, day_30), abs=1e-9)
    assert readings.agg(F.avg("temperature_c")).collect()[0][0] == pytest.approx(overall, abs=1e-9)
    assert moving_means(readings).count() == sliding
    found = rain_runs(readings).select(
        F.date_format(F.from_utc_timestamp("window_end", "+09:00"), "yyyy-MM-dd'T'HH:mm").alias("stopped"),
        "hours",
    )
    found = [tuple(r) for r in found.orderBy("stopped").collect()]
    assert (len(found), sum(n for _, n in found), max(n for _, n in found)) == (runs, hours, longest)
    assert (found[0], found[-1]) == (first, last)
    readings.unpersist()


@pytest.mark.parametrize("station,season", GOLDEN)
def test_stream(spark, station, season):
    golden = GOLDEN[station, season]
    messages = messages_of(spark, station, season, stream=True)
    assert drain_to_table(spark, daily_mean_lines(messages, delay=NO_DELAY), "golden").count() == golden[1] - 1
    assert drain_to_table(spark, moving_mean_lines(messages, delay=NO_DELAY), "golden").count() == golden[2] - 3
    runs = rain_run_lines(messages, delay=SESSION_DELAY)
    assert drain_to_table(spark, runs, "golden").count() == golden[4]


def test_lines(spark):
    messages = messages_of(spark, "Kushiro", "Winter")
    lines = {r["value"] for r in json_lines(messages).collect()}
    assert "2022-01-01T00:00:00.000+09:00\ttemperature:-8.2\trainfall:0.0" in lines
    runs = {r["value"] for r in rain_run_lines(messages).collect()}
    assert "rainStoppedAt:2022-01-03T00:00:00.000+09:00\trainContinued[h]:3" in runs


def test_all_files_as_one_table(spark):
    """Six files at once give each file's own results, by station and season."""
    table = read_weather_tsv(spark, f"{FOLDER}/*.tsv")
    counts = {tuple(r)[:2]: r["count"] for r in table.groupBy("station", "season").count().collect()}
    stations = ("Kushiro", "Naha", "Tokyo")
    assert counts == {(s, season): 744 for s in stations for season in ("Winter", "Summer")}
    runs = rain_runs(timed_readings(as_messages(table), delay=None))
    assert runs.count() == sum(g[3] for g in GOLDEN.values())
