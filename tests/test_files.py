"""Hourly TSV files, raw observation files, sinks."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests import weather
from tidemill.jobs import main
from tidemill.operators import clean_observations, parse_weather
from tidemill.sources import (
    KafkaSource,
    as_messages,
    common_root,
    read_kafka,
    read_raw_observations,
    read_weather_tsv,
    start_file_sink,
    stream_parquet,
    to_keyed_messages,
    to_value_messages,
    write_parquet,
    write_tsv,
)
from tidemill.streaming import drain_to_table

HEADER = "timestamp\ttemperature [°C]\trainfall [mm]"

# A download of January: preamble, header and sub-header in Shift-JIS, CRLF, one
# row too many on either side, one empty temperature.
RAW_LINES = [
    "ダウンロードした時刻：2023/10/01 12:00:00",
    "",
    ",札幌,札幌,札幌,札幌,札幌,札幌,札幌",
    "年月日時,気温(℃),気温(℃),気温(℃),降水量(mm),降水量(mm),降水量(mm),降水量(mm)",
    ",,品質情報,均質番号,,現象なし情報,品質情報,均質番号",
    "2022/12/31 23:00:00,-9.9,8,1,9,0,8,1",
    "2023/1/1 0:00:00,-8.2,8,1,0,1,8,1",
    "2023/1/9 10:00:00,,1,1,0.5,0,8,1",
    "2023/1/31 23:00:00,-3.0,8,1,0.0,0,8,1",
    "2023/2/1 0:00:00,9.9,8,1,9,0,8,1",
]
CLEAN = [
    ("2023-01-01T00:00:00.000+09:00", "-8.2", "0"),
    ("2023-01-09T10:00:00.000+09:00", None, "0.5"),
    ("2023-01-31T23:00:00.000+09:00", "-3.0", "0.0"),
]


@pytest.fixture
def tsv_folder(tmp_path):
    for name, temperature in [
        ("20230101-20230131-sapporo", -8.2),
        ("20230101-20230131-osaka", 15.4),
        ("20230801-20230831-sapporo", 20.1),
        ("20231201-20231231-nagoya", 3.0),
    ]:
        day = datetime.strptime(name[:8], "%Y%m%d").date().isoformat()
        lines = [HEADER, f"{day}T00:00:00.000+09:00\t{temperature}\t0", f"{day}T01:00:00.000+09:00\t1\t0.5"]
        (tmp_path / f"{name}.tsv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(tmp_path)


def test_labels_come_from_file_names(spark, tsv_folder):
    found = read_weather_tsv(spark, tsv_folder).select("station", "season").distinct().collect()
    assert set(map(tuple, found)) == {
        ("Sapporo", "Summer"),
        ("Sapporo", "Winter"),
        ("Osaka", "Winter"),
        ("Nagoya", "Winter"),
    }


def test_readings_are_float_with_both_times(spark, tsv_folder):
    rows = read_weather_tsv(spark, f"{tsv_folder}/20230101-20230131-sapporo.tsv")
    assert dict(rows.dtypes)["temperature_c"] == "float"
    first = rows.orderBy("event_time").select(
        "timestamp", F.date_format("event_time", "yyyy-MM-dd HH:mm"), "local_time", "rainfall_mm"
    )
    assert tuple(first.collect()[0]) == (
        "2023-01-01T00:00:00.000+09:00", "2022-12-31 15:00", datetime(2023, 1, 1), 0.0,
    )


def test_bad_number_in_a_tsv_fails(spark, tmp_path):
    (tmp_path / "20230101-20230131-x.tsv").write_text(f"{HEADER}\nt\twarm\t0\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED_RECORD|malformed"):
        read_weather_tsv(spark, str(tmp_path)).collect()


def test_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "20230101-20230131-x.tsv").write_text(
        "rainfall [mm]\ttimestamp\ttemperature [°C]\n0.5\t2023-01-01T00:00:00.000+09:00\t-8.2\n", encoding="utf-8"
    )
    row = read_weather_tsv(spark, str(tmp_path)).collect()[0]
    assert (row["rainfall_mm"], row["temperature_c"]) == (0.5, pytest.approx(-8.2))


@pytest.mark.parametrize(
    "header", ["timestamp\ttemp\train", "2023-01-01T00:00:00.000+09:00\t1\t2", "timestamp\ttemperature [°C]"]
)
def test_other_headers_fail(spark, tmp_path, header):
    (tmp_path / "20230101-20230131-x.tsv").write_text(f"{header}\n2023-01-01T00:00:00.000+09:00\t1\t2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="columns"):
        read_weather_tsv(spark, str(tmp_path))


@pytest.mark.parametrize("stream", [False, True])
def test_files_of_unlike_headers_fail(spark, tmp_path, tmp_path_factory, stream):
    swapped = [*HEADER.split("\t")[1:], "timestamp"]
    for name, header in (("20230101-20230131-a", HEADER), ("20230101-20230131-b", "\t".join(swapped))):
        (tmp_path / f"{name}.tsv").write_text(f"{header}\n1\t1\t1\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header|schema"):
        rows = read_weather_tsv(spark, str(tmp_path), stream=stream).select("temperature_c")
        if stream:
            base = tmp_path_factory.mktemp("s")
            start_file_sink(rows, f"{base}/t", f"{base}/c", available_now=True).awaitTermination()
        else:
            rows.collect()


def test_unnamed_files_fail(spark, tmp_path):
    (tmp_path / "x.tsv").write_text(f"{HEADER}\n2023-01-01T00:00:00.000+09:00\t1\t2\n", encoding="utf-8")
    with pytest.raises(PySparkException, match="no station in file name"):
        read_weather_tsv(spark, str(tmp_path)).collect()


def test_a_path_is_no_pattern(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a1x")
    rows = stream_parquet(spark, f"{tmp_path}/a1x", spark.range(1).schema)
    assert drain_to_table(spark, rows, "test-glob").count() == 3
    for name in ("a[1]x", "a{x}", "a*", "a?"):
        with pytest.raises(ValueError, match="pattern"):
            stream_parquet(spark, f"{tmp_path}/{name}", spark.range(1).schema)


def test_tsv_as_stream(spark, tsv_folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("stream"))
    rows = read_weather_tsv(spark, tsv_folder, stream=True).select("station", "temperature_c")
    rows.writeStream.format("parquet").option("path", f"{out}/t").option(
        "checkpointLocation", f"{out}/c"
    ).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(f"{out}/t").count() == 8


def test_readings_to_messages_and_back(spark, tsv_folder):
    readings = read_weather_tsv(spark, tsv_folder)
    back = parse_weather(as_messages(readings))
    columns = ["timestamp", "temperature_c", "rainfall_mm"]
    assert sorted(map(tuple, back.select(columns).collect())) == sorted(
        map(tuple, readings.select(columns).collect())
    )
    topics = {r["topic"] for r in back.collect()}
    assert topics == {"weather-sapporo", "weather-osaka", "weather-nagoya"}


@pytest.mark.parametrize("encoding", ["ISO-8859-1", "Shift_JIS"])
def test_cleaning(spark, tmp_path, encoding):
    path = tmp_path / "20230101-20230131-sapporo.csv"
    path.write_bytes("\r\n".join([*RAW_LINES, ""]).encode("cp932"))
    if encoding == "Shift_JIS":
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        raw = read_raw_observations(spark, str(path), encoding=encoding)
        cleaned = clean_observations(raw)
        assert cleaned.columns == HEADER.split("\t")
        assert sorted(map(tuple, cleaned.collect())) == CLEAN
        if encoding == "Shift_JIS":
            assert raw.filter(F.col("c1") == "気温(℃)").count() == 1
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_cleaning_a_file_read_in_splits(spark, tmp_path):
    """Splits begin anywhere; no row depends on its place in the file."""
    path = tmp_path / "20230101-20230131-sapporo.csv"
    rows = [f"2023/1/{d} {h}:00:00,{d}.5,8,1,0,1,8,1" for d in range(1, 32) for h in range(24)]
    path.write_bytes("\r\n".join([*RAW_LINES[:5], *rows, ""]).encode("cp932"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = read_raw_observations(spark, str(path))
        assert raw.rdd.getNumPartitions() > 4
        cleaned = clean_observations(raw)
        assert cleaned.count() == len(rows) == cleaned.distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_cleaning_needs_to_know_the_days(spark, tmp_path):
    path = tmp_path / "january.csv"
    path.write_bytes("\r\n".join(RAW_LINES).encode("cp932"))
    raw = read_raw_observations(spark, str(path))
    with pytest.raises(PySparkException, match="no days in file name"):
        clean_observations(raw).collect()
    given = clean_observations(raw, first_day=date(2023, 1, 1), last_day=date(2023, 1, 31))
    assert given.count() == 3


@pytest.mark.parametrize("time", ["2023/1/32 0:00:00", "2023-01-01 00:00:00", "2023/1/1", " 5"])
def test_unreadable_time_of_a_data_row_fails(spark, tmp_path, time):
    path = tmp_path / "20230101-20230131-sapporo.csv"
    path.write_text(f"{time},1,8,1,0,1,8,1\n")
    with pytest.raises(PySparkException, match="unreadable time"):
        clean_observations(read_raw_observations(spark, str(path))).collect()


def test_written_tsv_reads_as_hourly_table(spark, tmp_path):
    source = tmp_path / "20230101-20230131-sapporo.csv"
    source.write_bytes("\r\n".join(RAW_LINES).encode("cp932"))
    out = str(tmp_path / "20230101-20230131-sapporo")
    write_tsv(clean_observations(read_raw_observations(spark, str(source))), out)
    text = "\n".join(
        p.read_text(encoding="utf-8") for p in (tmp_path / "20230101-20230131-sapporo").glob("part-*.csv")
    ).splitlines()
    assert HEADER in text
    assert "2023-01-01T00:00:00.000+09:00\t-8.2\t0" in text
    back = read_weather_tsv(spark, out).select("timestamp", "temperature_c").collect()
    found = {r["timestamp"]: r["temperature_c"] for r in back}
    assert found.pop(CLEAN[1][0]) is None
    assert found == pytest.approx({CLEAN[0][0]: -8.2, CLEAN[2][0]: -3.0}, rel=1e-6)


def test_parquet_sink(spark, tsv_folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("parquet")) + "/t"
    readings = read_weather_tsv(spark, tsv_folder)
    write_parquet(readings, out)
    assert spark.read.parquet(out).count() == readings.count() == 8


def test_kafka_options():
    source = KafkaSource("b:9092", ("weather-a", "weather-b"), max_offsets_per_trigger=10)
    assert source.options() == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "weather-a,weather-b",
        "startingOffsets": "latest",
        "kafka.isolation.level": "read_committed",
        "maxOffsetsPerTrigger": "10",
    }


class FakeReader:
    """Takes the place of a session and its reader, and remembers the options."""

    def __init__(self, rows):
        self.rows, self.seen = rows, {}
        self.read = self.readStream = self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def load(self):
        return self.rows


def test_kafka_metadata_is_dropped(spark):
    columns = "key binary, value binary, topic string, partition int, offset bigint"
    reader = FakeReader(spark.createDataFrame([], columns))
    assert read_kafka(reader, KafkaSource("b:9092", ("t",))).columns == ["key", "value", "topic"]
    assert (reader.seen["format"], reader.seen["startingOffsets"]) == ("kafka", "latest")
    # A batch from the latest offsets would read nothing.
    read_kafka(reader, KafkaSource("b:9092", ("t",)), stream=False)
    assert reader.seen["startingOffsets"] == "earliest"


def test_sink_layouts(spark):
    rows = spark.createDataFrame([(5, "x")], "key bigint, value string")
    keyed = to_keyed_messages(rows)
    assert keyed.dtypes == [("key", "binary"), ("value", "binary")]
    assert bytes(keyed.collect()[0]["key"]) == (5).to_bytes(8, "big")
    # Bytes pass unchanged.
    assert to_keyed_messages(keyed).collect() == keyed.collect()
    assert to_value_messages(rows).columns == ["value"]


def test_made_up_weather_is_varied():
    rows = weather.hourly()
    assert len(weather.rain_runs(rows)) > 5
    assert len(weather.daily(rows)) == 6


def _download(folder, name="20230101-20230131-sapporo.csv"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes("\r\n".join([*RAW_LINES, ""]).encode("cp932"))


def test_files_of_one_name_stay_apart(spark, tmp_path):
    for folder in ("a", "b b+%41"):
        _download(tmp_path / "raw" / folder)
    raw = read_raw_observations(spark, f"{tmp_path}/raw/*", root=f"{tmp_path}/raw")
    cleaned = clean_observations(raw, keep_file=True)
    names = {f"{folder}/20230101-20230131-sapporo" for folder in ("a", "b b+%41")}
    assert {r["file"] for r in cleaned.collect()} == names
    write_tsv(cleaned, f"{tmp_path}/tidy", folders="file")
    loaded = read_weather_tsv(spark, f"{tmp_path}/tidy")
    assert loaded.count() == 2 * len(CLEAN)
    assert {(r["station"], r["season"]) for r in loaded.collect()} == {("Sapporo", "Winter")}
    with pytest.raises(PySparkException, match="not below"):
        read_raw_observations(spark, f"{tmp_path}/raw/a", root="/elsewhere").collect()


def test_cleaning_with_a_checkpoint_takes_new_files_only(spark, tmp_path):
    argv = ["clean", "--in-path", f"{tmp_path}/raw/*", "--out-path", f"{tmp_path}/tidy", "--checkpoint", f"{tmp_path}/c"]
    for folder, files in (("a", 1), ("b", 2)):
        _download(tmp_path / "raw" / folder)
        main(argv, spark)
        assert spark.read.option("header", True).option("sep", "\t").csv(f"{tmp_path}/tidy").count() == files * len(CLEAN)
    main(argv, spark)
    folders = {p.parent.name for p in (tmp_path / "tidy").glob("*/*.csv")}
    assert folders == {f"file={f}%2F20230101-20230131-sapporo" for f in "ab"}


@pytest.mark.parametrize(
    "paths, root",
    [
        (["/x/raw"], "/x/raw"), (["/x/raw/"], "/x/raw"), (["/x/raw/*.csv"], "/x/raw"), (["/x/raw/*/a*"], "/x/raw"),
        (["/x/raw/f.csv"], "/x/raw"), (["/x/a", "/x/b"], "/x"), (["s3a://k/x/a", "s3a://k/x/b/f.csv"], "s3a://k/x"),
    ],
)
def test_common_root(paths, root):
    assert common_root(paths) == root


def test_a_file_without_a_header_fails(spark, tmp_path):
    (tmp_path / "20230101-20230131-a.tsv").write_text(f"{HEADER}\n2023-01-01T00:00:00.000+09:00\t1\t2\n", encoding="utf-8")
    swapped = "\t".join(HEADER.split("\t")[::-1])
    (tmp_path / "20230101-20230131-b.tsv").write_text(f"{swapped}\n2\t1\t2023-01-01T00:00:00.000+09:00\n", encoding="utf-8")
    rows = read_weather_tsv(spark, str(tmp_path), headers="each").collect()
    assert {(r["station"], r["temperature_c"], r["rainfall_mm"]) for r in rows} == {("A", 1.0, 2.0), ("B", 1.0, 2.0)}
    (tmp_path / "20230101-20230131-c.tsv").write_text("1\t2\t3\n", encoding="utf-8")
    with pytest.raises(ValueError, match="no line with the columns"):
        read_weather_tsv(spark, str(tmp_path), headers="each")
