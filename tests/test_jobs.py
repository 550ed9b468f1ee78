"""The command line, from message files to result files."""

import time

import pytest

from tests import weather
from tests.weather import hourly, write_messages, write_slices
from tidemill.jobs import main
from tidemill.jobs.cli import STREAM_JOBS, WINDOWED, _delay, _parser, _records, start
from tidemill.streaming import LateRowsError

TOPIC = "weather-made-up"


def run(spark, base, job, *more):
    main(
        [
            job, "--source", "files", "--in-path", f"{base}/in", "--sink", "files",
            "--out-path", f"{base}/{job}", "--checkpoint", f"{base}/checkpoint-{job}",
            "--available-now", *more,
        ],
        spark,
    )
    return spark.read.parquet(f"{base}/{job}")


@pytest.mark.parametrize("job", STREAM_JOBS)
def test_every_job_runs(spark, tmp_path, job):
    rows = hourly(days=3)
    write_slices(f"{tmp_path}/in", TOPIC, rows, size=24)
    more = ["--in-topic", TOPIC, "--max-files-per-trigger", "1"]
    more += ["--delay", "0"] if job in WINDOWED else []
    out = run(spark, str(tmp_path), job, *more)
    days = 2  # the last one stays open
    expected = {
        "passthrough": len(rows),
        "json-lines": len(rows),
        "non-negative": sum(t >= 0 for _, t, _ in rows),
        "daily-mean": days,
        "moving-mean": len(weather.moving(rows)) - 3,
        "rain-runs": sum(
            s < weather.stamp(rows[-1][0]) for s, _ in weather.rain_runs(rows)
        ),
        "refreshing-mean": 3,
    }
    assert out.count() == expected[job]
    assert "value" in out.columns


def test_topics_are_selected(spark, tmp_path):
    write_slices(f"{tmp_path}/in", "weather-a", hourly(days=1))
    write_slices(f"{tmp_path}/in", "weather-b", hourly(days=1))
    out = run(spark, str(tmp_path), "json-lines", "--in-topic", "weather-a")
    assert {r["topic"] for r in out.collect()} == {"weather-a"}


def test_watermark_per_topic(spark, tmp_path):
    for i in range(3):
        write_slices(f"{tmp_path}/in", "weather-a", hourly(days=3)[24 * i : 24 * i + 24], 24, i)
    write_slices(f"{tmp_path}/in", "weather-b", hourly(days=2), 48)
    out = run(
        spark, str(tmp_path), "daily-mean", "--watermark", "per-topic", "--delay", "0",
        "--in-topic", "weather-a", "--in-topic", "weather-b",
    )
    # The slower topic ends on its second day, so only first days are closed.
    assert sorted(r["topic"] for r in out.collect()) == ["weather-a", "weather-b"]


def test_quarantine(spark, tmp_path):
    good = [weather.message(*r) for r in hourly(days=2)]
    write_messages(f"{tmp_path}/in", TOPIC, "0", [*good, "junk", '{"timestamp": "soon"}'])
    out = run(
        spark, str(tmp_path), "daily-mean", "--in-topic", TOPIC, "--delay", "0",
        "--on-malformed", "quarantine", "--quarantine-path", f"{tmp_path}/bad",
    )
    assert out.count() == 1
    bad = spark.read.parquet(f"{tmp_path}/bad").collect()
    assert {(r["raw_value"], r["parse_error"]) for r in bad} == {
        ("junk", "not a JSON object"),
        ('{"timestamp": "soon"}', "timestamp: not a time"),
    }


def test_quarantine_reads_its_source_once(spark, tmp_path):
    write_messages(f"{tmp_path}/in", TOPIC, "0", [weather.message(*r) for r in hourly(days=1)])
    argv = [
        "json-lines", "--source", "files", "--in-path", f"{tmp_path}/in", "--sink", "files", "--out-path",
        f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/c", "--on-malformed", "quarantine",
        "--quarantine-path", f"{tmp_path}/bad",
    ]
    queries = start(spark, _parser().parse_args(argv))
    try:
        for query in queries:
            query.processAllAvailable()
        sources = [q.lastProgress["sources"][0]["description"] for q in queries]
        assert sum(f"{tmp_path}/in" in source for source in sources) == 1
    finally:
        for query in queries:
            query.stop()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 24


def test_quarantine_goes_on_after_a_failure(spark, tmp_path):
    """The process ends between the commit of both kinds and what follows; and then in the
    middle of a micro-batch. Every record is in one output."""
    good = [weather.message(*r) for r in hourly(days=2)]
    for i in range(4):
        write_messages(f"{tmp_path}/in", TOPIC, str(i), [*good[12 * i : 12 * i + 12], f"junk {i}"])
    argv = [
        "json-lines", "--source", "files", "--in-path", f"{tmp_path}/in", "--sink", "files", "--out-path",
        f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/c", "--on-malformed", "quarantine",
        "--quarantine-path", f"{tmp_path}/bad", "--max-files-per-trigger", "1",
    ]
    args = _parser().parse_args(argv)
    queries = start(spark, args)
    for query in queries[1:]:
        query.stop()
    queries[0].processAllAvailable()
    queries[0].stop()
    queries = start(spark, args)
    time.sleep(0.3)
    for query in queries:
        query.stop()
    main([*argv, "--available-now"], spark)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == len(good) == out.distinct().count()
    bad = [r["raw_value"] for r in spark.read.parquet(f"{tmp_path}/bad").collect()]
    assert sorted(bad) == [f"junk {i}" for i in range(4)]


@pytest.mark.parametrize("job", WINDOWED)
def test_watermark_per_partition(spark, tmp_path, job):
    """Partition 1 comes two days after partition 0, and nothing is lost."""
    rows = hourly(days=5)
    for i in range(7):
        for number, late in ((0, 0), (1, 2)):
            part = [r for k, r in enumerate(rows) if k // 24 == i - late and k % 2 == number]
            if part:
                write_messages(f"{tmp_path}/in", TOPIC, f"{number}-{i}", [weather.message(*r) for r in part])
                time.sleep(0.02)
    out = run(
        spark, str(tmp_path), job, "--in-topic", TOPIC, "--max-files-per-trigger", "2", "--watermark",
        "per-partition", "--partitions", "2",
    )
    last = rows[-2][0]  # of partition 0, the slower in time
    passed = last.replace(minute=0)
    expected = {
        "daily-mean": 4,
        "moving-mean": sum(s <= weather.stamp(passed - 3 * weather.HOUR) for s in weather.moving(rows)),
        "rain-runs": sum(s < weather.stamp(passed) for s, _ in weather.rain_runs(rows)),
    }
    assert out.count() == expected[job]
    if job == "rain-runs":
        got = sorted(r["value"].split("\t")[0].split(":", 1)[1] for r in out.collect())
        assert got == sorted(s for s, _ in weather.rain_runs(rows) if s < weather.stamp(passed))


def test_refreshing_mean_by_timer(spark, tmp_path):
    write_messages(f"{tmp_path}/in", "weather-a", "0", [weather.message(*r) for r in hourly(days=1)])
    argv = [
        "refreshing-mean", "--panes", "timer", "--source", "files", "--in-path", f"{tmp_path}/in",
        "--sink", "files", "--out-path", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/c",
    ]
    (query,) = start(spark, _parser().parse_args(argv))
    try:
        for _ in range(300):
            assert query.exception() is None
            if (query.lastProgress or {}).get("batchId", 0) > 1:
                break
            time.sleep(0.2)
    finally:
        query.stop()
    (row,) = spark.read.parquet(f"{tmp_path}/out").collect()
    assert row["topic"] == "weather-a"
    mean = float(row["value"].removeprefix("currentMeanTemperature:"))
    assert mean == pytest.approx(weather.mean([t for _, t, _ in hourly(days=1)]), abs=1e-9)


def test_clean_and_load(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, reading in (("sapporo", "-8,8,1,0,1,8,1"), ("naha", "15.5,8,1,0.5,1,8,1")):
        lines = ["x", "x", "x", "年月日時,a", ",b", f"2023/1/1 0:00:00,{reading}", ""]
        (raw / f"20230101-20230131-{name}.csv").write_bytes("\r\n".join(lines).encode("cp932"))
    main(["clean", "--in-path", f"{raw}/*.csv", "--out-path", f"{tmp_path}/tidy"], spark)
    main(["load", "--in-path", f"{tmp_path}/tidy", "--out-path", f"{tmp_path}/table"], spark)
    found = spark.read.parquet(f"{tmp_path}/table").select(
        "station", "season", "timestamp", "temperature_c", "rainfall_mm"
    )
    stamp = "2023-01-01T00:00:00.000+09:00"
    assert sorted(map(tuple, found.collect())) == [
        ("Naha", "Winter", stamp, 15.5, 0.5), ("Sapporo", "Winter", stamp, -8.0, 0.0)
    ]


def args(*argv):
    return _parser().parse_args([*argv, "--checkpoint", "c"])


def test_default_delays():
    one, two = ["--in-topic", "a"], ["--in-topic", "a", "--in-topic", "b"]
    for topics in (one, two, [*two, "--watermark", "per-topic"]):
        for job in WINDOWED:
            assert _delay(args(job, *topics)).total_seconds() == 7200
    assert _delay(args("daily-mean", *one, "--delay", "0")).total_seconds() == 0
    assert _delay(args("rain-runs", *one, "--delay", "0")).total_seconds() == 0.001
    assert _delay(args("moving-mean", *two, "--delay", "60")).total_seconds() == 60


def test_default_delay_keeps_the_slower_partition(spark, tmp_path):
    """Two partitions of one topic, one of them an hour behind: nothing is lost."""
    rows = hourly(days=3)
    for i in range(0, len(rows), 2):
        write_slices(f"{tmp_path}/in", TOPIC, [rows[i + 1]], first=2 * i)
        write_slices(f"{tmp_path}/in", TOPIC, [rows[i]], first=2 * i + 1)
    out = run(spark, str(tmp_path), "daily-mean", "--in-topic", TOPIC, "--max-files-per-trigger", "1",
              "--fail-on-late")
    assert out.count() == 2


def test_late_rows_can_fail_the_job(spark, tmp_path):
    write_slices(f"{tmp_path}/in", TOPIC, hourly(days=3), size=24)
    write_slices(f"{tmp_path}/in", TOPIC, hourly(days=1)[:2], first=900_000)
    with pytest.raises(LateRowsError):
        run(spark, str(tmp_path), "daily-mean", "--in-topic", TOPIC, "--max-files-per-trigger", "1",
            "--delay", "0", "--fail-on-late")


def test_lines_of_several_topics_name_theirs(spark):
    lines = spark.createDataFrame([("weather-a", "x"), ("weather-b", "x")], "topic string, value string")
    one, two = ["--in-topic", "a"], ["--in-topic", "a", "--in-topic", "b"]
    assert _records(args("json-lines", *one), lines).columns == ["value"]
    keyed = _records(args("json-lines", *two), lines).collect()
    assert {(bytes(r["key"]), bytes(r["value"])) for r in keyed} == {(b"weather-a", b"x"), (b"weather-b", b"x")}


def test_every_record_is_in_the_output_or_in_quarantine(spark, tmp_path):
    good = [weather.message(*r) for r in hourly(days=1)]
    write_messages(f"{tmp_path}/in", TOPIC, "0", [*good[:10], "junk", *good[10:], "{", "[1]"])
    out = run(
        spark, str(tmp_path), "json-lines", "--in-topic", TOPIC, "--on-malformed", "quarantine",
        "--quarantine-path", f"{tmp_path}/bad",
    )
    bad = [r["raw_value"] for r in spark.read.parquet(f"{tmp_path}/bad").collect()]
    assert out.count() == len(good) == out.distinct().count()
    assert sorted(bad) == ["[1]", "junk", "{"]


@pytest.mark.parametrize(
    "argv",
    [
        [],
        ["daily-mean"],
        ["daily-mean", "--checkpoint", "c"],
        ["daily-mean", "--checkpoint", "c", "--source", "files", "--sink", "files"],
        ["json-lines", "--checkpoint", "c", "--source", "files", "--in-path", "i", "--sink",
         "files", "--out-path", "o", "--on-malformed", "quarantine"],
        ["daily-mean", "--checkpoint", "c", "--bootstrap-servers", "b", "--in-topic", "t", "--out-topic",
         "o", "--on-malformed", "quarantine", "--quarantine-path", "q", "--watermark", "per-topic"],
        ["daily-mean", "--checkpoint", "c", "--bootstrap-servers", "b", "--in-topic", "t", "--out-topic",
         "o", "--idle", "3"],
        ["passthrough", "--on-missing", "zero", "--checkpoint", "c"],
        ["refreshing-mean", "--panes", "timer", "--available-now", "--checkpoint", "c",
         "--source", "files", "--in-path", "i", "--sink", "files", "--out-path", "o"],
    ],
)
def test_wrong_options_are_refused(argv):
    with pytest.raises(SystemExit):
        main(argv)
