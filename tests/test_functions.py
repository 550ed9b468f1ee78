from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemill.functions import (
    daily_mean_line,
    decode_long,
    decode_text,
    encode_long,
    encode_text,
    interval_text,
    local_date,
    local_datetime_text,
    micros,
    moving_mean_line,
    parse_instant,
    rain_run_line,
    reading_line,
    refreshing_mean_line,
    temperature_line,
)

LONGS = [0, 1, 5, -3, 255, 256, 2**62, -(2**63), 2**63 - 1, None]


def one(df):
    return df.collect()[0][0]


def test_long_codec_is_big_endian(spark):
    rows = spark.createDataFrame([(n,) for n in LONGS], "n bigint")
    coded = rows.select("n", encode_long(F.col("n")).alias("b"))
    for n, data, back in coded.select("n", "b", decode_long(F.col("b"))).collect():
        assert back == n
        assert data == (None if n is None else bytearray(n.to_bytes(8, "big", signed=True)))


def test_key_of_wrong_length_fails(spark):
    short = spark.createDataFrame([(bytearray(b"\x01\x02"),)], "b binary")
    with pytest.raises(PySparkException, match="not 8 bytes"):
        short.select(decode_long(F.col("b"))).collect()


def test_text_codec(spark):
    rows = spark.createDataFrame([("札幌 °C",)], "t string")
    coded = rows.select(encode_text(F.col("t")).alias("b"))
    assert bytes(one(coded)) == "札幌 °C".encode()
    assert one(coded.select(decode_text(F.col("b")))) == "札幌 °C"


def test_instant_and_local_forms(spark):
    rows = spark.createDataFrame([("2022-01-01T00:00:00.000+09:00",)], "t string")
    instant = parse_instant(F.col("t"))
    utc = rows.select(F.date_format(instant, "yyyy-MM-dd HH:mm:ss"))
    assert one(utc) == "2021-12-31 15:00:00"
    assert one(rows.select(local_date(instant).cast("string"))) == "2022-01-01"
    assert one(rows.select(local_datetime_text(instant))) == "2022-01-01T00:00:00.000+09:00"


def test_bad_instant(spark):
    rows = spark.createDataFrame([("yesterday",)], "t string")
    assert one(rows.select(parse_instant(F.col("t"), strict=False))) is None
    with pytest.raises(PySparkException):
        rows.select(parse_instant(F.col("t"))).collect()


def test_lines(spark):
    row = spark.createDataFrame(
        [("2022-01-01T00:00:00.000+09:00", -8.2, 0.0, datetime(2021, 12, 31, 15, tzinfo=timezone.utc), 3)],
        "ts string, t float, r float, start timestamp, n bigint",
    )
    mean = F.lit(-8.708333392937979)
    lines = row.select(
        reading_line(F.col("ts"), F.col("t"), F.col("r")),
        temperature_line(F.col("ts"), F.col("t")),
        daily_mean_line(F.col("start"), mean),
        moving_mean_line(F.col("start"), mean),
        rain_run_line(F.col("start"), F.col("n")),
        refreshing_mean_line(mean),
        reading_line(F.lit(None), F.col("t"), F.col("r")),
    )
    assert list(lines.collect()[0]) == [
        "2022-01-01T00:00:00.000+09:00\ttemperature:-8.2\trainfall:0.0",
        "2022-01-01T00:00:00.000+09:00\ttemperature:-8.2",
        "date:2022-01-01\tmeanTemperature(daily):-8.708333392937979",
        "leftmost datetime:2022-01-01T00:00:00.000+09:00\tmeanTemperature(per 3-hour):-8.708333392937979",
        "rainStoppedAt:2022-01-01T00:00:00.000+09:00\trainContinued[h]:3",
        "currentMeanTemperature:-8.708333392937979",
        "null\ttemperature:-8.2\trainfall:0.0",
    ]


def test_durations():
    assert micros(timedelta(hours=1)) == 3_600_000_000
    assert interval_text(timedelta(0)) == "0 microseconds"
    with pytest.raises(ValueError):
        micros(timedelta(0))
