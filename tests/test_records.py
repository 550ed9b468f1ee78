"""The JSON rules, one input at a time."""

import math

import pytest
from pyspark.errors import PySparkException

from tidemill.operators import accepted, parse_weather, rejected

NAN = float("nan")

GOOD = [
    ('{"timestamp": "a", "temperature [°C]": -8.2, "rainfall [mm]": 0}', ("a", -8.2, 0.0)),
    ('{"timestamp": "a", "temperature [°C]": "-8.2", "rainfall [mm]": "0.5"}', ("a", -8.2, 0.5)),
    ('{"timestamp": "a", "temperature [°C]": " 1.5 ", "rainfall [mm]": ""}', ("a", 1.5, 0.0)),
    ('{"timestamp": "a", "temperature [°C]": null, "rainfall [mm]": "null"}', ("a", 0.0, 0.0)),
    ('{"timestamp": "a"}', ("a", 0.0, 0.0)),
    ('{}', (None, 0.0, 0.0)),
    ('{"timestamp": 5}', ("5", 0.0, 0.0)),
    ('{"timestamp": "a", "temperature [°C]": "NaN"}', ("a", NAN, 0.0)),
    ('{"timestamp": "a", "temperature [°C]": 1, "temperature [°C]": 2}', ("a", 2.0, 0.0)),
    ('  \t{"timestamp": "a"} trailing', ("a", 0.0, 0.0)),
    ('{"timestamp": "a", "humidity": 3}', ("a", 0.0, 0.0)),
]
BAD = {
    "junk": "not a JSON object",
    "": "not a JSON object",
    "null": "not a JSON object",
    '"text"': "not a JSON object",
    "[1, 2]": "not a JSON object",
    '[{"timestamp": "a"}]': "not a JSON object",
    '{"timestamp": "a"': "not a JSON object",
    '{"temperature [°C]": NaN}': "not a JSON object",
    '{"temperature [°C]": "warm"}': "temperature [°C]: not a number",
    '{"rainfall [mm]": true}': "rainfall [mm]: not a number",
    '{"rainfall [mm]": {"a": 1}}': "rainfall [mm]: not a number",
    None: "no value",
}


def messages(spark, texts):
    rows = [(None, None if t is None else bytearray(t.encode()), "weather-x") for t in texts]
    return spark.createDataFrame(rows, "key binary, value binary, topic string")


def same(actual, expected):
    def equal(a, b):
        if isinstance(a, float) and isinstance(b, float):
            return (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b, rel=1e-6)
        return a == b

    return len(actual) == len(expected) and all(map(equal, actual, expected))


@pytest.mark.parametrize("text,expected", GOOD)
def test_good_record(spark, text, expected):
    row = parse_weather(messages(spark, [text])).drop("topic").collect()[0]
    assert same(tuple(row), expected), row


@pytest.mark.parametrize("text", BAD)
def test_malformed_record_fails_the_job(spark, text):
    with pytest.raises(PySparkException, match="malformed record"):
        # Even where no parsed column is used.
        parse_weather(messages(spark, [text])).select("topic").collect()


def test_quarantine_keeps_both(spark):
    texts = [t for t, _ in GOOD] + list(BAD)
    parsed = parse_weather(messages(spark, texts), on_malformed="quarantine")
    good = accepted(parsed)
    assert good.columns == ["topic", "timestamp", "temperature_c", "rainfall_mm"]
    assert good.count() == len(GOOD)
    bad = {r["raw_value"]: r["parse_error"] for r in rejected(parsed, "topic").collect()}
    assert bad == BAD


def test_missing_as_null(spark):
    parsed = parse_weather(messages(spark, ['{"timestamp": "a"}']), on_missing="null")
    assert tuple(parsed.drop("topic").collect()[0]) == ("a", None, None)


def test_unknown_field_can_fail(spark):
    known, unknown = '{"timestamp": "a"}', '{"timestamp": "a", "humidity": 3}'
    assert parse_weather(messages(spark, [known]), on_unknown="fail").count() == 1
    with pytest.raises(PySparkException, match="unknown field"):
        parse_weather(messages(spark, [unknown]), on_unknown="fail").collect()


def test_unreadable_time_is_quarantined_when_timed(spark):
    texts = ['{"timestamp": "soon"}', "{}", '{"timestamp": "2022-01-01T00:00:00.000+09:00"}']
    parsed = parse_weather(messages(spark, texts), timed=True, on_malformed="quarantine")
    assert accepted(parsed).count() == 1
    assert {r["parse_error"] for r in rejected(parsed).collect()} == {"timestamp: not a time"}


def test_rules_hold_without_ansi_mode(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException, match="not a number"):
            parse_weather(messages(spark, ['{"rainfall [mm]": "wet"}'])).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_each_record_is_parsed_once(spark, tmp_path):
    # From a file: a filter on local rows would be evaluated by the optimizer.
    messages(spark, [GOOD[0][0]]).write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    kept = parse_weather(stored).filter("temperature_c >= 0").select("timestamp")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
