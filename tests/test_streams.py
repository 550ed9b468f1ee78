"""Streams against batches and plain Python: the same operators, fed in slices."""

import contextlib
import json
import time
from datetime import timedelta

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from tests import weather
from tests.weather import HOUR, START, hourly, message, write_messages, write_slices
from tidemill.functions import moving_mean_line
from tidemill.operators import (
    filter_above_watermark,
    keep_above,
    session_combine,
    sliding_combine,
    watermark_per_source,
    with_watermark,
)
from tidemill.operators.eventtime import NO_DELAY, SESSION_DELAY
from tidemill.plans import (
    daily_mean_lines,
    daily_means,
    json_lines,
    moving_mean_lines,
    non_negative_lines,
    rain_run_lines,
    rain_runs,
    temperatures,
    timed_readings,
)
from tidemill.schema import EVENT_TIME
from tidemill.sources import message_lines, start_file_sink
from tidemill.streaming import (
    LateRows,
    LateRowsError,
    drain_timers_to_table,
    start_pane_means,
    timer_pane_means,
)

TOPIC = "weather-made-up"


class Replay:
    """A folder of message files read one per micro-batch, and a table of results."""

    def __init__(self, spark, base):
        self.spark, self.inbox = spark, str(base / "in")
        self.table, self.checkpoint = str(base / "out"), str(base / "checkpoint")
        self.progress = []

    def source(self, files_per_batch=1):
        return message_lines(self.spark, self.inbox, maxFilesPerTrigger=files_per_batch)

    def run(self, rows):
        query = start_file_sink(rows, self.table, self.checkpoint, available_now=True)
        query.awaitTermination()
        self.progress += [json.loads(p.json) for p in query.recentProgress]
        return self.results()

    def results(self):
        return self.spark.read.parquet(self.table).collect()

    def last_watermark(self):
        return self.progress[-1]["eventTime"]["watermark"]

    def dropped(self):
        return sum(op["numRowsDroppedByWatermark"] for p in self.progress for op in p["stateOperators"])


@pytest.fixture
def replay(spark, tmp_path):
    return Replay(spark, tmp_path)


def values(rows):
    return sorted(r["value"] for r in rows)


def parsed_lines(rows):
    """Lines as (first field, number)."""
    out = {}
    for row in rows:
        first, second = row["value"].split("\t")
        out[first.split(":", 1)[1]] = float(second.split(":")[1])
    return out


def end_of(rows):
    return rows[-1][0]


# --- batch and stream give the same ---------------------------------------------------


def test_stateless_lines(replay):
    rows = hourly(days=3)
    write_slices(replay.inbox, TOPIC, rows)
    expected = sorted(
        f"{weather.stamp(t)}\ttemperature:{temp}" for t, temp, _ in rows if temp >= 0
    )
    assert values(replay.run(non_negative_lines(replay.source()))) == expected
    assert 0 < len(expected) < len(rows)


def test_json_lines_keep_text(replay):
    write_messages(replay.inbox, TOPIC, "0", [message(START, -8.2, 0)])
    assert values(replay.run(json_lines(replay.source()))) == [
        "2022-01-01T00:00:00.000+09:00\ttemperature:-8.2\trainfall:0.0"
    ]


def test_daily_means(replay):
    rows = hourly()
    write_slices(replay.inbox, TOPIC, rows)
    found = parsed_lines(replay.run(daily_mean_lines(replay.source(), delay=NO_DELAY)))
    expected = weather.daily(rows)
    # The last day stays open: its end is after the last reading.
    expected.pop(end_of(rows).date().isoformat())
    assert found == pytest.approx(expected, abs=1e-9)
    assert len(replay.progress) > 5


def test_moving_means(replay):
    rows = hourly(days=3)
    write_slices(replay.inbox, TOPIC, rows)
    found = parsed_lines(replay.run(moving_mean_lines(replay.source(), delay=NO_DELAY)))
    last = weather.stamp(end_of(rows) - 3 * HOUR)
    expected = {start: m for start, m in weather.moving(rows).items() if start <= last}
    assert found == pytest.approx(expected, abs=1e-9)


def test_moving_means_from_streamed_panes(replay):
    """Two chained aggregations of a stream give what one gives."""
    rows = hourly(days=3)
    write_slices(replay.inbox, TOPIC, rows)
    readings = timed_readings(replay.source(), delay=NO_DELAY)
    means = sliding_combine(readings, EVENT_TIME, "temperature_c", keys=["topic"], prefold=True)
    line = moving_mean_line(F.col("window_start"), F.col("mean"))
    found = parsed_lines(replay.run(means.select("topic", line.alias("value"))))
    last = weather.stamp(end_of(rows) - 3 * HOUR)
    expected = {start: m for start, m in weather.moving(rows).items() if start <= last}
    assert found == pytest.approx(expected, abs=1e-9)


def test_batch_has_the_open_windows_too(spark, replay):
    rows = hourly(days=3)
    write_slices(replay.inbox, TOPIC, rows)
    batch = message_lines(spark, replay.inbox, stream=False)
    assert parsed_lines(daily_mean_lines(batch).collect()) == pytest.approx(
        weather.daily(rows), abs=1e-9
    )
    assert parsed_lines(moving_mean_lines(batch).collect()) == pytest.approx(
        weather.moving(rows), abs=1e-9
    )
    runs = [(s, int(n)) for s, n in parsed_lines(rain_run_lines(batch).collect()).items()]
    assert sorted(runs) == sorted(weather.rain_runs(rows))


def test_rain_runs(replay):
    # A wet end, then more than an hour of dry readings.
    rows = hourly(days=4)
    write_slices(replay.inbox, TOPIC, rows)
    found = parsed_lines(replay.run(rain_run_lines(replay.source(), delay=SESSION_DELAY)))
    closed = weather.stamp(end_of(rows) - SESSION_DELAY)
    expected = [(s, n) for s, n in weather.rain_runs(rows) if s <= closed]
    assert sorted((s, int(n)) for s, n in found.items()) == sorted(expected)
    assert expected


# --- the watermark ---------------------------------------------------------------------


def test_dry_hours_move_the_watermark(replay):
    """One rain run, then only dry readings: the run closes, and the watermark is
    that of the last dry reading."""
    rows = [(START + h * HOUR, 1.0, 1.0 if h < 3 else 0.0) for h in range(30)]
    write_slices(replay.inbox, TOPIC, rows, size=6)
    found = values(replay.run(rain_run_lines(replay.source(), delay=SESSION_DELAY)))
    assert found == ["rainStoppedAt:2022-01-01T03:00:00.000+09:00\trainContinued[h]:3"]
    # 2022-01-02T05:00+09:00, less the millisecond sessions wait for.
    assert replay.last_watermark() == "2022-01-01T19:59:59.999Z"


def test_plain_filter_would_hold_the_watermark_back(replay):
    """Why filter_above_watermark exists."""
    rows = [(START + h * HOUR, 1.0, 1.0 if h < 3 else 0.0) for h in range(30)]
    write_slices(replay.inbox, TOPIC, rows, size=6)
    readings = timed_readings(replay.source(), delay=SESSION_DELAY)
    plain = readings.filter("rainfall_mm > 0")
    out = session_combine(plain, EVENT_TIME, "rainfall_mm", keys=["topic"])
    assert replay.run(out) == []


def test_filter_stays_above_the_watermark_of_a_column_without_nulls(spark, tmp_path):
    never_null = F.coalesce("timestamp", F.timestamp_micros(F.lit(0))).alias("timestamp")
    ticks = spark.readStream.format("rate").load().select(never_null, "value")
    ticks = with_watermark(ticks, name="timestamp")
    assert not ticks.schema["timestamp"].nullable
    kept = keep_above(ticks, "value", 3, time="timestamp")
    query = kept.writeStream.format("noop").option("checkpointLocation", str(tmp_path)).start()
    try:
        query.processAllAvailable()
        plan = query._jsq.explainInternal(True)
    finally:
        query.stop()
    optimized = plan[plan.index("== Optimized Logical Plan ==") :]
    assert optimized.index("Filter") < optimized.index("EventTimeWatermark")


def test_safe_filter_parses_once(spark, replay):
    write_slices(replay.inbox, TOPIC, hourly(days=1))
    base = message_lines(spark, replay.inbox, stream=False)
    runs = rain_runs(timed_readings(base, delay=None))
    query = runs._jdf.queryExecution()
    query.executedPlan().executeCollect()
    plan = query.executedPlan().toString()
    final = plan[: plan.index("== Initial Plan")]
    # Both branches of the sessions read one shuffle, below which the text is parsed.
    assert final.count("from_json") == 1 and "ReusedExchange" in final


def test_late_rows_are_dropped_and_counted(replay):
    rows = hourly(days=3)
    write_slices(replay.inbox, TOPIC, rows)
    late = [(START + h * HOUR, 40.0, 0.0) for h in range(4)]
    write_slices(replay.inbox, TOPIC, late, first=900_000)
    found = parsed_lines(replay.run(daily_mean_lines(replay.source(), delay=NO_DELAY)))
    expected = weather.daily(rows)
    expected.pop(end_of(rows).date().isoformat())
    assert found == pytest.approx(expected, abs=1e-9)
    assert replay.dropped() > 0


def test_late_rows_are_reported(spark, replay, caplog):
    rows = hourly(days=3)
    write_slices(replay.inbox, TOPIC, rows)
    write_slices(replay.inbox, TOPIC, [(START + h * HOUR, 40.0, 0.0) for h in range(4)], first=900_000)
    lines = daily_mean_lines(replay.source(), delay=NO_DELAY)
    query = start_file_sink(lines, replay.table, replay.checkpoint, available_now=True)
    query.awaitTermination()
    late = LateRows(query)
    with caplog.at_level("WARNING"):
        assert late.update() == late.update() == 1  # the rows of a window are combined first
    assert caplog.text.count("late rows dropped") == 1
    with pytest.raises(LateRowsError):
        LateRows(query, fail=True).update()


def test_delay_keeps_late_rows(replay):
    rows = hourly(days=3)
    late = (START + 5 * HOUR, 40.0, 0.0)
    write_slices(replay.inbox, TOPIC, rows[:36])
    write_slices(replay.inbox, TOPIC, [late], first=500_000)
    write_slices(replay.inbox, TOPIC, rows[36:], first=900_000)
    lines = daily_mean_lines(replay.source(), delay=timedelta(days=1))
    found = parsed_lines(replay.run(lines))
    assert replay.dropped() == 0
    assert found["2022-01-01"] == pytest.approx(weather.daily([*rows, late])["2022-01-01"], abs=1e-9)


def test_slow_source_holds_the_joint_watermark_back(spark, tmp_path):
    """Two stations, one of them a day behind: with a watermark per source nothing
    of it is lost, with one over both it is."""
    fast, slow = hourly(days=4), hourly(days=4, start=START)

    def run(name, build):
        replay = Replay(spark, tmp_path / name)
        # In each micro-batch the slow station is two days behind.
        for i in range(8):
            write_slices(f"{replay.inbox}/fast", "weather-fast", fast[12 * i : 12 * i + 12], first=i)
            if i >= 4:
                part = slow[12 * (i - 4) : 12 * (i - 4) + 12]
                write_slices(f"{replay.inbox}/slow", "weather-slow", part, first=i)
            else:
                write_messages(f"{replay.inbox}/slow", "weather-slow", f"{i:06d}", [message(*slow[0])])
        sources = [
            timed_readings(
                message_lines(spark, f"{replay.inbox}/{n}", maxFilesPerTrigger=1), delay=None
            )
            for n in ("fast", "slow")
        ]
        replay.run(daily_means(build(sources)))
        return replay

    per_source = run("per-source", lambda s: watermark_per_source(s, NO_DELAY))
    merged = run("merged", lambda s: with_watermark(s[0].unionByName(s[1]), NO_DELAY))
    assert per_source.dropped() == 0
    assert merged.dropped() > 0


def test_restart_goes_on_where_it_stopped(replay):
    rows = hourly(days=6)
    write_slices(replay.inbox, TOPIC, rows[:70])
    replay.run(daily_mean_lines(replay.source(), delay=NO_DELAY))
    some = len(replay.results())
    write_slices(replay.inbox, TOPIC, rows[70:], first=500_000)
    found = replay.run(daily_mean_lines(replay.source(), delay=NO_DELAY))
    expected = weather.daily(rows)
    expected.pop(end_of(rows).date().isoformat())
    assert 0 < some < len(found) == len(expected)
    assert parsed_lines(found) == pytest.approx(expected, abs=1e-9)


def test_session_over_a_restart(replay):
    rows = [(START + h * HOUR, 1.0, 1.0 if h < 8 else 0.0) for h in range(14)]
    write_slices(replay.inbox, TOPIC, rows[:5])
    assert replay.run(rain_run_lines(replay.source(), delay=SESSION_DELAY)) == []
    write_slices(replay.inbox, TOPIC, rows[5:], first=500_000)
    found = values(replay.run(rain_run_lines(replay.source(), delay=SESSION_DELAY)))
    assert found == ["rainStoppedAt:2022-01-01T08:00:00.000+09:00\trainContinued[h]:8"]


def test_stations_are_apart(replay):
    rows = [(START + h * HOUR, 1.0, 1.0 if h < 2 else 0.0) for h in range(6)]
    other = [(START + h * HOUR, 1.0, 1.0 if h < 4 else 0.0) for h in range(6)]
    write_slices(replay.inbox, "weather-a", rows)
    write_slices(replay.inbox, "weather-b", other)
    found = {(r["topic"], r["value"][-1]) for r in replay.run(rain_run_lines(replay.source(2), delay=SESSION_DELAY))}
    assert found == {("weather-a", "2"), ("weather-b", "4")}


def test_malformed_record_stops_the_stream(replay):
    write_messages(replay.inbox, TOPIC, "0", ["junk"])
    with pytest.raises((StreamingQueryException, PySparkException), match="malformed record"):
        replay.run(json_lines(replay.source()))


def test_record_without_time_stops_a_windowed_stream(replay):
    write_messages(replay.inbox, TOPIC, "0", ['{"temperature [°C]": 1}'])
    with pytest.raises((StreamingQueryException, PySparkException), match="timestamp"):
        replay.run(daily_mean_lines(replay.source(), delay=NO_DELAY))


# --- panes ------------------------------------------------------------------------------


def test_panes_are_discarded_after_firing(spark, replay, tmp_path):
    rows = hourly(days=2)
    write_slices(replay.inbox, TOPIC, rows, size=10)
    out = str(tmp_path / "panes")

    def write(means, number):
        means.write.mode("overwrite").parquet(f"{out}/batch={number}")

    start_pane_means(
        temperatures(replay.source()), "reading", write, replay.checkpoint, available_now=True
    ).awaitTermination()
    panes = sorted(spark.read.parquet(out).collect(), key=lambda r: r["batch"])
    parts = [[t for _, t, _ in rows[i : i + 10]] for i in range(0, len(rows), 10)]
    assert [p["n"] for p in panes] == [len(p) for p in parts]
    # Each is the mean of its own pane, not of all rows so far.
    assert [p["mean"] for p in panes] == pytest.approx([weather.mean(p) for p in parts], abs=1e-9)


def test_timer_panes_close_after_their_delay_and_start_from_zero(spark, replay):
    first, second = [(START, 1.0, 0.0), (START + HOUR, 3.0, 0.0)], [(START + 2 * HOUR, 10.0, 0.0)]
    panes = timer_pane_means(temperatures(replay.source()), "reading", key="topic", delay=timedelta(seconds=3))
    query = start_file_sink(panes, replay.table, replay.checkpoint, trigger="100 milliseconds")
    try:
        taken = []
        for number, rows in enumerate((first, second)):
            began = time.monotonic()
            write_slices(replay.inbox, TOPIC, rows, first=100 * number)
            while len(taken) == number:
                assert query.exception() is None and time.monotonic() < began + 120
                time.sleep(0.1)
                with contextlib.suppress(Exception):  # no table yet
                    taken = sorted((r["mean"], r["n"]) for r in replay.results())
            assert time.monotonic() - began >= 3
    finally:
        query.stop()
    assert taken == [(2.0, 2), (10.0, 1)]


def test_record_without_time_stops_the_refreshing_mean(replay):
    write_messages(replay.inbox, TOPIC, "0", ['{"temperature [°C]": 1}'])
    with pytest.raises((StreamingQueryException, PySparkException), match="timestamp"):
        replay.run(temperatures(replay.source()))


def test_timer_panes_hold_every_row_once(spark, replay):
    rows = hourly(days=2)
    write_slices(replay.inbox, "weather-a", rows, size=16)
    write_slices(replay.inbox, "weather-b", rows[:20], size=20)
    panes = timer_pane_means(temperatures(replay.source()), "reading", key="topic")
    found = drain_timers_to_table(spark, panes, "test-panes").collect()
    for topic, part in (("weather-a", rows), ("weather-b", rows[:20])):
        mine = [p for p in found if p["pane_key"] == topic]
        assert sum(p["n"] for p in mine) == len(part)
        total = sum(p["mean"] * p["n"] for p in mine)
        assert total / len(part) == pytest.approx(weather.mean([t for _, t, _ in part]), abs=1e-9)


# --- batch frames keep pushdown -------------------------------------------------------------


def test_filter_on_a_batch_is_plain(spark, small_sf):
    events = spark.read.parquet(f"{small_sf}/events.parquet")
    kept = keep_above(events, "value", 40.0, time="ts").select("user_id", "value")
    assert "GreaterThan(value,40.0)" in kept._jdf.queryExecution().executedPlan().toString()
    assert filter_above_watermark(events, F.col("value") > 40, "ts").count() == kept.count()
