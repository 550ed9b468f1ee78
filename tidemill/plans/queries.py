"""Queries over the given tables, each next to the SQL with the same answer.

Means are rounded to six digits on both sides, since the order of a
floating-point sum is not fixed. Readings of two decimals also have means exactly
between two six-digit values, where that order would decide; adding 1e-9 on both
sides first moves them off it. Streaming queries are compared with the windows that
have closed when the stream ends.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import (
    COUNT,
    EXACT_MEAN,
    MEAN,
    MEAN_AND_COUNT,
    daily_mean_line,
    decode_long,
    decode_text,
    encode_long,
    encode_text,
    local_date,
    local_datetime_text,
    moving_mean_line,
    parse_instant,
    rain_run_line,
    refreshing_mean_line,
    temperature_line,
)
from tidemill.operators import (
    clean_observations,
    extract,
    keep_above,
    keep_at_least,
    pane_mean,
    parse_json_records,
    parse_weather,
    passthrough,
    project,
    rejected,
    session_combine,
    sliding_combine,
    tumbling_combine,
    watermark_per_source,
    with_watermark,
)
from tidemill.operators.eventtime import NO_DELAY, SESSION_DELAY
from tidemill.plans.tables import (
    SLICES,
    event_messages,
    instant,
    read_slices,
    slice_of,
    table,
    table_stream,
    write_slices,
)
from tidemill.plans.weather import (
    daily_means,
    json_lines,
    moving_means,
    non_negative_lines,
    rain_runs,
    temperatures,
    timed_readings,
)
from tidemill.schema import FILE, RAINFALL, TEMPERATURE, TIMESTAMP
from tidemill.session import scratch_dir
from tidemill.sources import (
    read_raw_observations,
    read_weather_tsv,
    start_file_sink,
    start_tsv_sink,
    to_keyed_messages,
    to_topic_messages,
    to_value_messages,
    write_tsv,
)
from tidemill.streaming import (
    Stretch,
    closed_sessions,
    drain_timers_to_table,
    drain_to_table,
    late_rows,
    start_complete_stretches,
    start_pane_means,
    timer_pane_means,
    write_numbered,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)


def query(sql: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = sql
        return run

    return register


def ntz(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def rounded(column: str) -> Column:
    return F.round(F.col(column) + 1e-9, 6)


def mean_sql(reading: str) -> str:
    return f"round(avg({reading}) + 1e-9, 6)"


def mean_text_sql(reading: str) -> str:
    """The rounded mean as text. Below 0.001 Spark writes an exponent: -7.69E-4."""
    mean = mean_sql(reading)
    millionths = f"CAST(round({mean} * 1e6) AS BIGINT)"
    return f"""CASE WHEN {mean} = 0 OR abs({mean}) >= 1e-3 THEN CAST({mean} AS VARCHAR)
         WHEN abs({millionths}) >= 100 THEN CAST({millionths} / 100 AS VARCHAR) || 'E-4'
         WHEN abs({millionths}) >= 10 THEN CAST({millionths} / 10 AS VARCHAR) || 'E-5'
         ELSE CAST({millionths} / 1 AS VARCHAR) || 'E-6' END"""


# --- passthrough, keys and values -------------------------------------------------


@query("SELECT * FROM events")
def passthrough_table(spark, sf_dir):
    return table(spark, sf_dir, "events").select("*")


# The message of an event, as text: what the JSON queries below read.
_MESSAGE = """
  concat('{"timestamp":"', strftime(ts, '%Y-%m-%dT%H:%M:%S.%g'), '+09:00",',
         '"temperature [°C]":"', CAST(round(value - 50, 2) AS VARCHAR), '",',
         '"rainfall [mm]":', CAST(json_extract_string(props, '$.k') AS INTEGER) - 50, '}')
"""
# The same record, typed; times are local (+09:00) and have millisecond precision.
_READINGS = """
  readings AS (
    SELECT concat('weather-', event_type) AS topic, date_trunc('millisecond', ts) AS t,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+09:00' AS stamp,
           CAST(round(value - 50, 2) AS FLOAT) AS temperature,
           CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) - 50 AS FLOAT) AS rainfall
    FROM events)
"""


@query(f"SELECT event_id AS key, {_MESSAGE} AS value FROM events")
def passthrough_keyed(spark, sf_dir):
    """Key and value bytes through the identity job, decoded at the end only."""
    out = passthrough(event_messages(table(spark, sf_dir, "events")))
    return out.select(decode_long(F.col("key")).alias("key"), decode_text(F.col("value")).alias("value"))


@query("SELECT event_id, user_id, -user_id AS negated FROM events")
def key_codec(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    coded = events.select(
        "event_id", encode_long(F.col("user_id")).alias("a"), encode_long(-F.col("user_id")).alias("b")
    )
    return coded.select(
        "event_id", decode_long(F.col("a")).alias("user_id"), decode_long(F.col("b")).alias("negated")
    )


@query("SELECT doc_id, text FROM documents")
def value_codec(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", encode_text(F.col("text")).alias("value"))
    return docs.select("doc_id", decode_text(F.col("value")).alias("text"))


@query("SELECT o_orderkey AS key, o_orderstatus AS value FROM orders")
def keyed_sink_layout(spark, sf_dir):
    out = to_keyed_messages(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderstatus")
    return out.select(decode_long(F.col("key")).alias("key"), decode_text(F.col("value")).alias("value"))


@query("SELECT o_orderpriority AS value FROM orders")
def value_sink_layout(spark, sf_dir):
    out = to_value_messages(table(spark, sf_dir, "orders"), "o_orderpriority")
    return out.select(decode_text(F.col("value")).alias("value"))


@query("SELECT 'weather-' || event_type AS topic, CAST(event_id AS VARCHAR) AS value FROM events")
def topic_sink_layout(spark, sf_dir):
    """Lines of several stations can be told apart by their keys."""
    topic = F.concat(F.lit("weather-"), F.col("event_type"))
    lines = table(spark, sf_dir, "events").select(topic.alias("topic"), F.col("event_id").cast("string").alias("value"))
    out = to_topic_messages(lines)
    return out.select(decode_text(F.col("key")).alias("topic"), decode_text(F.col("value")).alias("value"))


# --- JSON records ------------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_parse(spark, sf_dir):
    return parse_json_records(
        table(spark, sf_dir, "events"),
        [("k", "k", T.IntegerType())],
        value="props",
        carry=["event_id"],
    )


@query(
    f"""WITH {_READINGS}
    SELECT topic, concat(stamp, chr(9), 'temperature:', CAST(temperature AS VARCHAR),
                         chr(9), 'rainfall:', CAST(rainfall AS VARCHAR)) AS value
    FROM readings"""
)
def json_record_lines(spark, sf_dir):
    return json_lines(event_messages(table(spark, sf_dir, "events")))


@query(
    """
    SELECT event_id,
           CASE event_type WHEN 'error' THEN 'not a JSON object'
                           WHEN 'view' THEN 'rainfall [mm]: not a number'
                           ELSE 'unknown field' END AS parse_error
    FROM events WHERE event_type IN ('error', 'view', 'click')
    """
)
def json_quarantine(spark, sf_dir):
    """Malformed records come out with the reason, the good ones do not."""
    kind = F.col("event_type")
    body = (
        F.when(kind == "error", F.concat(F.lit('{"timestamp": '), F.col("value").cast("string")))
        .when(kind == "view", F.to_json(F.struct(F.lit("x").alias("rainfall [mm]"))))
        .when(kind == "click", F.to_json(F.struct(F.col("value").alias("humidity [%]"))))
        .otherwise(F.to_json(F.struct(F.col("value").alias("rainfall [mm]"))))
    )
    messages = table(spark, sf_dir, "events").select("event_id", body.alias("value"))
    parsed = parse_weather(
        messages, carry=["event_id"], on_malformed="quarantine", on_unknown="fail"
    )
    return rejected(parsed, "event_id").drop("raw_value")


@query(
    """
    SELECT event_id,
           CASE WHEN event_type IN ('error', 'view') THEN NULL
                ELSE strftime(ts, '%Y-%m-%d') END AS "timestamp",
           CASE WHEN event_type IN ('error', 'click') THEN 0
                ELSE CAST(value AS FLOAT) END AS temperature_c,
           CAST(0 AS FLOAT) AS rainfall_mm
    FROM events
    """
)
def json_missing_fields(spark, sf_dir):
    """Absent and null numbers are 0, absent text is NULL."""
    kind = F.col("event_type")
    stamp = F.date_format("ts", "yyyy-MM-dd")
    number = F.col("value").cast("string").alias("temperature [°C]")
    body = (
        F.when(kind == "error", F.lit("{}"))
        .when(kind == "view", F.to_json(F.struct(number)))
        .when(kind == "click", F.concat(F.lit('{"temperature [°C]": null, "timestamp": "'), stamp, F.lit('"}')))
        .otherwise(F.to_json(F.struct(number, stamp.alias("timestamp"))))
    )
    messages = table(spark, sf_dir, "events").select("event_id", body.alias("value"))
    return parse_weather(messages, carry=["event_id"])


# --- projection, filters, lines ------------------------------------------------------


@query("SELECT ts, value FROM events WHERE value >= 50")
def project_filter(spark, sf_dir):
    return keep_at_least(project(table(spark, sf_dir, "events"), "ts", "value"), "value", 50.0)


@query(f"WITH {_READINGS} SELECT topic, temperature AS reading FROM readings")
def extract_temperature(spark, sf_dir):
    return extract(parse_weather(event_messages(table(spark, sf_dir, "events"))), TEMPERATURE, "topic")


@query(f"WITH {_READINGS} SELECT topic, rainfall AS reading FROM readings")
def extract_rainfall(spark, sf_dir):
    return extract(parse_weather(event_messages(table(spark, sf_dir, "events"))), RAINFALL, "topic")


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount >= 0.05")
def filter_at_least(spark, sf_dir):
    items = project(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_discount")
    return keep_at_least(items, "l_discount", 0.05)


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0.05")
def filter_above(spark, sf_dir):
    items = project(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_discount")
    return keep_above(items, "l_discount", 0.05)


@query(
    """
    SELECT concat(strftime(ts, '%Y-%m-%dT%H:%M:%S.%g'), chr(9), 'temperature:',
                  CAST(value AS VARCHAR)) AS line
    FROM events WHERE value >= 50
    """
)
def format_line(spark, sf_dir):
    kept = keep_at_least(table(spark, sf_dir, "events"), "value", 50.0)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return kept.select(temperature_line(stamp, F.col("value")).alias("line"))


@query(
    f"""WITH {_READINGS}
    SELECT topic, concat(stamp, chr(9), 'temperature:', CAST(temperature AS VARCHAR)) AS value
    FROM readings WHERE temperature >= 0"""
)
def temperature_lines(spark, sf_dir):
    return non_negative_lines(event_messages(table(spark, sf_dir, "events")))


def _both_readings(events: DataFrame) -> DataFrame:
    """A user's element function with none, one or two outputs per row."""
    rain = F.get_json_object("props", "$.k").cast("double")
    outputs = F.array(F.when(F.col("value") >= 40, F.col("value")), F.when(rain >= 50, rain))
    return events.select("event_id", F.explode(F.array_compact(outputs)).alias("reading"))


@query(
    """
    SELECT event_id, value AS reading FROM events WHERE value >= 40
    UNION ALL
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) FROM events
    WHERE CAST(json_extract_string(props, '$.k') AS DOUBLE) >= 50
    """
)
def element_function(spark, sf_dir):
    return table(spark, sf_dir, "events").transform(_both_readings)


# --- dates ---------------------------------------------------------------------------


@query("SELECT event_id, date_trunc('millisecond', ts) - INTERVAL 9 HOUR AS instant FROM events")
def instant_from_text(spark, sf_dir):
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+09:00"))
    return table(spark, sf_dir, "events").select("event_id", ntz(parse_instant(stamp)).alias("instant"))


@query("SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS day FROM events")
def local_day(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", local_date(instant("ts")).cast("string").alias("day")
    )


@query(
    """
    SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S.%g') || '+09:00' AS stamp
    FROM events
    """
)
def local_stamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", local_datetime_text(instant("ts")).alias("stamp")
    )


# --- tumbling windows ------------------------------------------------------------------

_DAILY = f"""
    SELECT time_bucket(INTERVAL 1 DAY, ts, INTERVAL 15 HOUR) AS s,
           {mean_sql('value')} AS m, count(*) AS n
    FROM events GROUP BY 1
"""


def _mean_and_count(windowed: Callable[..., DataFrame], df: DataFrame, *keys: str, **how) -> DataFrame:
    """A mean and its row count from one pass."""
    out = windowed(df, "ts", "value", keys=keys, combine=MEAN_AND_COUNT, name="r", **how)
    return out.select(
        *keys, ntz("window_start").alias("s"), rounded("r.mean").alias("m"), F.col("r.n").alias("n")
    )


@query(_DAILY)
def tumbling_mean(spark, sf_dir):
    return _mean_and_count(tumbling_combine, table(spark, sf_dir, "events"))


@query(
    f"""
    SELECT user_id, time_bucket(INTERVAL 1 DAY, ts, INTERVAL 15 HOUR) AS s,
           {mean_sql('value')} AS m, count(*) AS n
    FROM events GROUP BY ALL
    """
)
def tumbling_mean_by_user(spark, sf_dir):
    return _mean_and_count(tumbling_combine, table(spark, sf_dir, "events"), "user_id")


@query(
    f"""
    SELECT l_returnflag, time_bucket(INTERVAL 1 DAY, l_shipdate, INTERVAL 15 HOUR) AS s,
           {mean_sql('l_quantity')} AS m, count(*) AS n
    FROM lineitem GROUP BY ALL
    """
)
def tumbling_mean_lineitem(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("value")
    )
    return _mean_and_count(tumbling_combine, items, "l_returnflag")


@query(
    f"""
    SELECT strftime(time_bucket(INTERVAL 1 DAY, ts, INTERVAL 15 HOUR) + INTERVAL 9 HOUR,
                    '%Y-%m-%d') AS d, {mean_sql('value')} AS m
    FROM events GROUP BY 1
    """
)
def local_date_mean(spark, sf_dir):
    means = tumbling_combine(table(spark, sf_dir, "events"), "ts", "value")
    return means.select(
        local_date(instant("window_start")).cast("string").alias("d"), rounded("mean").alias("m")
    )


# --- sliding windows ---------------------------------------------------------------------

_SLIDING = f"""
    SELECT date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS s,
           {mean_sql('value')} AS m, count(*) AS n
    FROM events, range(3) r(k) GROUP BY 1
"""


@query(_SLIDING)
def sliding_mean(spark, sf_dir):
    return _mean_and_count(sliding_combine, table(spark, sf_dir, "events"))


@query(
    f"""
    SELECT user_id, date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS s,
           {mean_sql('value')} AS m, count(*) AS n
    FROM events, range(3) r(k) GROUP BY ALL
    """
)
def sliding_mean_by_user(spark, sf_dir):
    return _mean_and_count(sliding_combine, table(spark, sf_dir, "events"), "user_id", prefold=False)


@query(
    f"""
    SELECT l_returnflag, date_trunc('day', l_shipdate) - k * INTERVAL 1 DAY AS s,
           {mean_sql('l_quantity')} AS m, count(*) AS n
    FROM lineitem, range(30) r(k) GROUP BY ALL
    """
)
def sliding_mean_lineitem(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("value")
    )
    return _mean_and_count(sliding_combine, items, "l_returnflag", width=30 * DAY, slide=DAY)


# --- session windows ------------------------------------------------------------------------


@query(
    f"""
    SELECT time_bucket(INTERVAL 1 DAY, ts, INTERVAL 15 HOUR) AS s, {mean_sql('value')} AS m
    FROM events GROUP BY 1
    """
)
def exact_mean(spark, sf_dir):
    """Daily means whose bits do not depend on how the rows are dealt out."""
    out = tumbling_combine(table(spark, sf_dir, "events"), "ts", "value", combine=EXACT_MEAN)
    return out.select(ntz("window_start").alias("s"), rounded("mean").alias("m"))


def _sessions_sql(rows: str, key: str, gap: str, tail: str = "") -> str:
    """Runs of ``rows`` (k, t) per key, by the gap before each row."""
    return f"""
    WITH r AS ({rows}),
    a AS (SELECT k, t, CASE WHEN t - lag(t) OVER (PARTITION BY k ORDER BY t) <= {gap}
                            THEN 0 ELSE 1 END AS f FROM r),
    b AS (SELECT *, sum(f) OVER (PARTITION BY k ORDER BY t, f DESC ROWS UNBOUNDED PRECEDING) AS g FROM a),
    sessions AS (SELECT k AS {key}, min(t) AS started, max(t) + {gap} AS stopped, count(*) AS n
                 FROM b GROUP BY k, g)
    SELECT * FROM sessions {tail}
    """


def _session_columns(out: DataFrame, key: str) -> DataFrame:
    return out.select(
        key, ntz("window_start").alias("started"), ntz("window_end").alias("stopped"), "n"
    )


_ACTIVE = "SELECT user_id AS k, ts AS t FROM events WHERE value > 40"


@query(_sessions_sql(_ACTIVE, "user_id", "INTERVAL 1 HOUR"))
def session_count(spark, sf_dir):
    active = keep_above(table(spark, sf_dir, "events"), "value", 40.0)
    return _session_columns(session_combine(active, "ts", "value", keys=["user_id"]), "user_id")


@query(
    _sessions_sql("SELECT event_type AS k, ts AS t FROM events", "event_type", "INTERVAL 30 MINUTE")
)
def session_count_hot_keys(spark, sf_dir):
    """Five keys, each with a fifth of all rows."""
    out = session_combine(
        table(spark, sf_dir, "events"), "ts", "value", keys=["event_type"], gap=HOUR / 2
    )
    return _session_columns(out, "event_type")


@query(
    _sessions_sql("SELECT event_type AS k, ts AS t FROM events", "event_type", "INTERVAL 10 SECOND")
)
def session_count_short_gap(spark, sf_dir):
    """A short gap: cells are chained in chunks first."""
    out = session_combine(
        table(spark, sf_dir, "events"),
        "ts",
        "value",
        keys=["event_type"],
        gap=timedelta(seconds=10),
    )
    return _session_columns(out, "event_type")


@query(
    _sessions_sql("SELECT l_suppkey AS k, l_shipdate AS t FROM lineitem", "l_suppkey", "INTERVAL 1 DAY")
)
def session_count_lineitem(spark, sf_dir):
    out = session_combine(
        table(spark, sf_dir, "lineitem"), "l_shipdate", "l_quantity", keys=["l_suppkey"], gap=DAY
    )
    return _session_columns(out, "l_suppkey")


@query(
    f"""
    WITH a AS (SELECT user_id, ts, value,
                      CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR
                           THEN 0 ELSE 1 END AS f FROM events),
    b AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, f DESC ROWS UNBOUNDED PRECEDING) AS g
          FROM a)
    SELECT user_id, min(ts) AS started, {mean_sql('value')} AS m FROM b GROUP BY user_id, g
    """
)
def session_mean(spark, sf_dir):
    """Another aggregate passed to the same window."""
    out = session_combine(
        table(spark, sf_dir, "events"), "ts", "value",
        keys=["user_id"], gap=6 * HOUR, combine=MEAN, name="mean",
    )
    return out.select("user_id", ntz("window_start").alias("started"), rounded("mean").alias("m"))


# --- the windowed jobs from messages to lines ---------------------------------------------------

_DAILY_LINES = f"""
    WITH {_READINGS}
    SELECT topic, concat('date:', strftime(date_trunc('day', t), '%Y-%m-%d'), chr(9),
        'meanTemperature(daily):', {mean_text_sql('CAST(temperature AS DOUBLE)')}) AS value
    FROM readings GROUP BY topic, date_trunc('day', t)
"""
_MOVING_LINES = f"""
    WITH {_READINGS}
    SELECT topic, concat('leftmost datetime:',
        strftime(date_trunc('hour', t) - k * INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.%g'), '+09:00', chr(9),
        'meanTemperature(per 3-hour):', {mean_text_sql('CAST(temperature AS DOUBLE)')}) AS value
    FROM readings, range(3) r(k) GROUP BY topic, date_trunc('hour', t) - k * INTERVAL 1 HOUR
"""


def _rain_lines_sql(closed: str) -> str:
    return f"""
    WITH {_READINGS},
    a AS (SELECT topic, t, CASE WHEN t - lag(t) OVER (PARTITION BY topic ORDER BY t) <= INTERVAL 1 HOUR
                                THEN 0 ELSE 1 END AS f FROM readings WHERE rainfall > 0),
    b AS (SELECT *, sum(f) OVER (PARTITION BY topic ORDER BY t, f DESC ROWS UNBOUNDED PRECEDING) AS g FROM a),
    runs AS (SELECT topic, max(t) + INTERVAL 1 HOUR AS stopped, count(*) AS n FROM b GROUP BY topic, g)
    SELECT topic, concat('rainStoppedAt:', strftime(stopped, '%Y-%m-%dT%H:%M:%S.%g'), '+09:00', chr(9),
                         'rainContinued[h]:', n) AS value
    FROM runs {closed}
    """


def _readings(spark, sf_dir) -> DataFrame:
    return timed_readings(event_messages(table(spark, sf_dir, "events")), delay=None)


@query(_DAILY_LINES)
def daily_mean_job(spark, sf_dir):
    means = daily_means(_readings(spark, sf_dir))
    return means.select("topic", daily_mean_line(F.col("window_start"), rounded("mean")).alias("value"))


@query(_MOVING_LINES)
def moving_mean_job(spark, sf_dir):
    means = moving_means(_readings(spark, sf_dir))
    return means.select("topic", moving_mean_line(F.col("window_start"), rounded("mean")).alias("value"))


@query(_rain_lines_sql(""))
def rain_run_job(spark, sf_dir):
    runs = rain_runs(_readings(spark, sf_dir))
    return runs.select("topic", rain_run_line(F.col("window_end"), F.col("hours")).alias("value"))


# --- panes ------------------------------------------------------------------------------------


@query(
    f"SELECT event_id // 1000 AS pane, {mean_sql('value')} AS m, count(*) AS n FROM events GROUP BY 1"
)
def pane_means(spark, sf_dir):
    out = pane_mean(table(spark, sf_dir, "events"), "value", F.expr("event_id div 1000").alias("pane"))
    return out.select("pane", rounded("mean").alias("m"), "n")


@query(
    f"""WITH {_READINGS}
    SELECT concat('currentMeanTemperature:',
                  {mean_text_sql('CAST(temperature AS DOUBLE)')}) AS value
    FROM readings"""
)
def pane_mean_line(spark, sf_dir):
    """The whole table as one pane."""
    readings = temperatures(event_messages(table(spark, sf_dir, "events")))
    return pane_mean(readings, "reading").select(refreshing_mean_line(rounded("mean")).alias("value"))


# --- streams ------------------------------------------------------------------------------------


def _message_stream(spark, sf_dir) -> DataFrame:
    return event_messages(table_stream(spark, sf_dir, "events", "ts"))


@query(f"SELECT event_id AS key, {_MESSAGE} AS value FROM events")
def stream_passthrough(spark, sf_dir):
    out = passthrough(_message_stream(spark, sf_dir))
    stored = drain_to_table(spark, out, "passthrough")
    return stored.select(decode_long(F.col("key")).alias("key"), decode_text(F.col("value")).alias("value"))


@query(
    f"""WITH {_READINGS}
    SELECT topic, concat(stamp, chr(9), 'temperature:', CAST(temperature AS VARCHAR)) AS value
    FROM readings WHERE temperature >= 0"""
)
def stream_temperature_lines(spark, sf_dir):
    return drain_to_table(spark, non_negative_lines(_message_stream(spark, sf_dir)), "temperature-lines")


_LAST = "(SELECT date_trunc('millisecond', max(ts)) FROM events)"


def _timed_stream(spark, sf_dir, delay: timedelta = NO_DELAY) -> DataFrame:
    events = table_stream(spark, sf_dir, "events", "ts").withColumn("ts", instant("ts"))
    return with_watermark(events, delay, "ts")


@query(f"SELECT * FROM ({_DAILY}) WHERE s + INTERVAL 1 DAY <= {_LAST}")
def stream_tumbling_mean(spark, sf_dir):
    out = _mean_and_count(tumbling_combine, _timed_stream(spark, sf_dir))
    return drain_to_table(spark, out, "tumbling")


@query(f"SELECT * FROM ({_SLIDING}) WHERE s + INTERVAL 3 HOUR <= {_LAST}")
def stream_sliding_mean(spark, sf_dir):
    out = _mean_and_count(sliding_combine, _timed_stream(spark, sf_dir))
    return drain_to_table(spark, out, "sliding")


@query(
    _sessions_sql(_ACTIVE, "user_id", "INTERVAL 1 HOUR",
                  f"WHERE stopped <= {_LAST} - INTERVAL 1 MILLISECOND")
)
def stream_session_count(spark, sf_dir):
    active = keep_above(_timed_stream(spark, sf_dir, SESSION_DELAY), "value", 40.0, time="ts")
    out = session_combine(active, "ts", "value", keys=["user_id"])
    return drain_to_table(spark, _session_columns(out, "user_id"), "session")


@query(_rain_lines_sql(f"WHERE stopped <= {_LAST} - INTERVAL 1 MILLISECOND"))
def stream_rain_run_job(spark, sf_dir):
    """The whole rain job: messages, event time, watermark, filter, session, line."""
    readings = timed_readings(_message_stream(spark, sf_dir), delay=SESSION_DELAY)
    line = rain_run_line(F.col("window_end"), F.col("hours"))
    return drain_to_table(spark, rain_runs(readings).select("topic", line.alias("value")), "rain")


@query(
    f"""{_DAILY_LINES}
    HAVING date_trunc('day', t) + INTERVAL 1 DAY <= {_LAST}"""
)
def stream_daily_mean_job(spark, sf_dir):
    """The whole daily job on a stream: the last day stays open."""
    means = daily_means(timed_readings(_message_stream(spark, sf_dir), delay=NO_DELAY))
    line = daily_mean_line(F.col("window_start"), rounded("mean"))
    return drain_to_table(spark, means.select("topic", line.alias("value")), "daily")


@query(
    f"""{_MOVING_LINES}
    HAVING date_trunc('hour', t) - k * INTERVAL 1 HOUR + INTERVAL 3 HOUR <= {_LAST}"""
)
def stream_moving_mean_job(spark, sf_dir):
    means = moving_means(timed_readings(_message_stream(spark, sf_dir), delay=NO_DELAY))
    line = moving_mean_line(F.col("window_start"), rounded("mean"))
    return drain_to_table(spark, means.select("topic", line.alias("value")), "moving")


_MIDDLE = "TIMESTAMP '2024-01-16 00:00:00'"


@query(
    f"""SELECT * FROM (
        SELECT time_bucket(INTERVAL 1 DAY, ts, INTERVAL 15 HOUR) AS s,
               {mean_sql('value')} AS m, count(*) AS n
        FROM events WHERE ts >= {_MIDDLE} GROUP BY 1)
    WHERE s + INTERVAL 1 DAY <= {_LAST}"""
)
def stream_late_rows(spark, sf_dir):
    """The second half of the month first; the first half comes when its windows are
    past the watermark, in a second run from the same checkpoint, and is dropped."""
    base = scratch_dir(spark, "late")
    rows = table(spark, sf_dir, "events").select("ts", "value")
    middle = F.to_timestamp_ntz(F.lit("2024-01-16 00:00:00"))
    for half, part in (("second", rows.filter(F.col("ts") >= middle)),
                       ("first", rows.filter(F.col("ts") < middle))):
        write_slices(part, slice_of(part, "ts", 3), f"{base}/in/{half}", 3)
        arrived = read_slices(spark, f"{base}/in/*", rows.schema)
        timed = with_watermark(arrived.withColumn("ts", instant("ts")), NO_DELAY, "ts")
        start_file_sink(
            _mean_and_count(tumbling_combine, timed), f"{base}/table", f"{base}/checkpoint",
            available_now=True,
        ).awaitTermination()
    return spark.read.parquet(f"{base}/table")


@query(f"SELECT * FROM ({_DAILY}) WHERE s + INTERVAL 1 DAY <= {_LAST} - INTERVAL 6 DAY")
def stream_skewed_partitions(spark, sf_dir):
    """Rows of odd numbers come a slice of time after those of even ones, as from a slow
    partition. A delay of a slice loses none of them: six days, as a slice is shorter."""
    events = table(spark, sf_dir, "events").withColumn("ts", instant("ts"))
    path = scratch_dir(spark, "skewed")
    write_slices(events, slice_of(events, "ts") + F.col("event_id") % 2, path, SLICES + 1)
    timed = with_watermark(read_slices(spark, path, events.schema), timedelta(days=6), "ts")
    return drain_to_table(spark, _mean_and_count(tumbling_combine, timed), "skewed")


_PARTITIONS, _BEHIND = 4, 3
_SLOWEST = f"(SELECT min(t) FROM (SELECT max(ts) AS t FROM events GROUP BY event_id % {_PARTITIONS}))"


def _uneven_partitions(spark, sf_dir) -> DataFrame:
    """Events of four partitions, of which the last comes three slices after the others."""
    events = table(spark, sf_dir, "events").withColumns(
        {"ts": instant("ts"), "partition": (F.col("event_id") % _PARTITIONS).cast("int"), "topic": F.lit("events")}
    )
    path = scratch_dir(spark, "partitions")
    slow = F.when(F.col("partition") == _PARTITIONS - 1, _BEHIND).otherwise(0)
    write_slices(events, slice_of(events, "ts") + slow, path, SLICES + _BEHIND)
    return read_slices(spark, path, events.schema)


def _by_stretches(
    spark, rows: DataFrame, windows: Callable[[DataFrame, Stretch, str], DataFrame], **how
) -> DataFrame:
    """What ``windows`` makes of the stretches that all partitions have passed."""
    folder = scratch_dir(spark, "stretches")

    def write(complete: DataFrame, stretch: Stretch) -> None:
        write_numbered(windows(complete, stretch, f"{folder}/open"), f"{folder}/table", stretch.number)

    expected = [("events", i) for i in range(_PARTITIONS)]
    start_complete_stretches(
        rows, write, folder, expected=expected, time="ts", available_now=True, **how
    ).awaitTermination()
    return spark.read.option("basePath", f"{folder}/table").parquet(f"{folder}/table/batch=*").drop("batch")


@query(f"SELECT * FROM ({_DAILY}) WHERE s + INTERVAL 1 DAY <= {_SLOWEST}")
def stream_partition_watermark(spark, sf_dir):
    """One partition is three slices behind. Without any delay, no row is lost: days are released
    when the slowest partition has passed them."""
    return _by_stretches(
        spark, _uneven_partitions(spark, sf_dir),
        lambda rows, *_: _mean_and_count(tumbling_combine, rows), cell=DAY, offset=15 * HOUR,
    )


@query(f"SELECT * FROM ({_SLIDING}) WHERE s + INTERVAL 3 HOUR <= date_trunc('hour', {_SLOWEST})")
def stream_partition_sliding(spark, sf_dir):
    """Overlapping windows look back into what an earlier stretch has released."""

    def closed(rows: DataFrame, stretch: Stretch, _: str) -> DataFrame:
        out = _mean_and_count(sliding_combine, rows)
        return out.filter(stretch.closes(F.col("s") + F.expr("INTERVAL 3 HOURS")))

    return _by_stretches(spark, _uneven_partitions(spark, sf_dir), closed, lookback=2 * HOUR)


@query(
    _sessions_sql("SELECT event_type AS k, ts AS t FROM events", "event_type", "INTERVAL 30 MINUTE",
                  f"WHERE stopped < date_trunc('hour', {_SLOWEST})")
)
def stream_session_hot_keys(spark, sf_dir):
    """Five keys on a stream: rows are folded into cells before they meet at their key, and
    open sessions are carried on as one row each."""

    def closed(rows: DataFrame, stretch: Stretch, open_folder: str) -> DataFrame:
        out = closed_sessions(rows, stretch, open_folder, "ts", "value", keys=["event_type"], gap=HOUR / 2)
        return _session_columns(out, "event_type")

    return _by_stretches(spark, _uneven_partitions(spark, sf_dir), closed)


@query(
    f"""
    WITH edge AS (SELECT time_bucket(INTERVAL 1 DAY, max(ts), INTERVAL 15 HOUR) AS t FROM events)
    SELECT event_id, TRUE AS late, t AS missed FROM events, edge WHERE ts < {_MIDDLE}
    UNION ALL SELECT event_id, FALSE, NULL FROM events, edge WHERE ts >= {_MIDDLE} AND ts < t
    """
)
def stream_late_side_output(spark, sf_dir):
    """The second half of the month first: what the first half brings is late, each row set
    apart with the time up to which all had been released. Late and released rows, and those of
    the day still open, are all rows."""
    base = scratch_dir(spark, "side-output")
    rows = table(spark, sf_dir, "events").withColumns({"ts": instant("ts"), "partition": F.lit(0)})
    middle = F.to_timestamp(F.lit("2024-01-16 00:00:00"))

    def write(complete: DataFrame, stretch: Stretch) -> None:
        write_numbered(complete.select("event_id"), f"{base}/table", stretch.number)

    for half, part in (("second", rows.filter(F.col("ts") >= middle)),
                       ("first", rows.filter(F.col("ts") < middle))):
        write_slices(part, slice_of(part, "ts", 3), f"{base}/in/{half}", 3)
        start_complete_stretches(
            read_slices(spark, f"{base}/in/*", rows.schema), write, base, partition=["partition"], time="ts",
            cell=DAY, offset=15 * HOUR, available_now=True,
        ).awaitTermination()
    kept = spark.read.parquet(f"{base}/table").select(
        "event_id", F.lit(False).alias("late"), F.lit(None).cast("timestamp_ntz").alias("missed")
    )
    late = late_rows(spark, base, rows.schema).select("event_id", F.lit(True).alias("late"), ntz("missed").alias("missed"))
    return late.union(kept)


@query(
    """
    WITH r AS (SELECT 'orders' AS source, o_orderdate AS ts FROM orders
               UNION ALL SELECT 'lineitem', l_shipdate FROM lineitem),
    ends AS (SELECT source, max(ts) AS t FROM r GROUP BY source)
    SELECT source, time_bucket(INTERVAL 1 DAY, ts, INTERVAL 15 HOUR) AS s, count(*) AS n
    FROM r GROUP BY ALL
    HAVING time_bucket(INTERVAL 1 DAY, ts, INTERVAL 15 HOUR) + INTERVAL 1 DAY
           <= (SELECT min(t) FROM ends)
    """
)
def stream_joint_watermark(spark, sf_dir):
    """Two streams with a watermark each: a window closes when both have passed it."""
    sources = [
        table_stream(spark, sf_dir, name, time).select(F.lit(name).alias("source"), instant(time).alias("ts"))
        for name, time in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ]
    both = watermark_per_source(sources, NO_DELAY, "ts")
    counts = tumbling_combine(both, "ts", "source", combine=COUNT, name="n", keys=["source"])
    return drain_to_table(spark, counts.select("source", ntz("window_start").alias("s"), "n"), "joint")


_SLICE = f"""(epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) * {SLICES}
    // (SELECT max(epoch_us(ts)) - min(epoch_us(ts)) + 1 FROM events)"""


@query(
    f"""SELECT {_SLICE} AS pane, event_type, {mean_sql('value')} AS m, count(*) AS n
    FROM events GROUP BY 1, 2"""
)
def stream_pane_means(spark, sf_dir):
    """One pane for each micro-batch, a micro-batch for each slice of time. A pane that
    kept the rows of those before would have another mean."""
    base = scratch_dir(spark, "panes")

    def write(means: DataFrame, number: int) -> None:
        means.write.mode("overwrite").parquet(f"{base}/table/batch={number}")

    start_pane_means(
        table_stream(spark, sf_dir, "events", "ts"), "value", write, f"{base}/checkpoint",
        keys=("event_type",), available_now=True,
    ).awaitTermination()
    panes = spark.read.parquet(f"{base}/table")
    return panes.select(F.col("batch").cast("long").alias("pane"), "event_type", rounded("mean").alias("m"), "n")


@query(f"SELECT event_type, {mean_sql('value')} AS m, count(*) AS n FROM events GROUP BY 1")
def stream_timer_pane_means(spark, sf_dir):
    """Panes closed by a timer of each key, brought together again: the count-weighted
    mean of all panes is the mean of all rows, wherever the timers cut."""
    panes = timer_pane_means(table_stream(spark, sf_dir, "events", "ts"), "value", key="event_type")
    stored = drain_timers_to_table(spark, panes, "timer-panes")
    return _joined_panes(stored.withColumnRenamed("pane_key", "event_type"), "event_type")


def _joined_panes(panes: DataFrame, key: str) -> DataFrame:
    total = F.sum(F.col("mean") * F.col("n")) / F.sum("n")
    return panes.groupBy(key).agg(F.round(total + 1e-9, 6).alias("m"), F.sum("n").alias("n"))


# --- files ------------------------------------------------------------------------------------


@query(
    """
    SELECT strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || '+09:00' AS "timestamp",
           o_orderpriority AS "temperature [°C]", o_orderstatus AS "rainfall [mm]"
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
    """
)
def clean_raw(spark, sf_dir):
    """Orders laid out as raw observation rows, then cleaned to one year."""
    day = F.date_format("o_orderdate", "yyyy/M/d H:mm:ss")
    raw = table(spark, sf_dir, "orders").select(
        day.alias("c0"),
        F.col("o_orderpriority").alias("c1"),
        F.col("o_custkey").cast("string").alias("c2"),
        F.lit("1").alias("c3"),
        F.col("o_orderstatus").alias("c4"),
        *[F.lit("8").alias(c) for c in ("c5", "c6", "c7")],
    )
    return clean_observations(raw, first_day=date(1996, 1, 1), last_day=date(1996, 12, 31))


@query(
    """
    SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+09:00' AS "timestamp",
           CAST(value AS FLOAT) AS temperature_c, date_trunc('millisecond', ts) AS local_time
    FROM events
    """
)
def tsv_roundtrip(spark, sf_dir):
    """Write the table as TSV with a header, columns in another order, and read it as an
    hourly table."""
    path = scratch_dir(spark, "tsv") + "/20240101-20240131-osaka"
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    rows = table(spark, sf_dir, "events").select(
        F.concat(stamp, F.lit("+09:00")).alias("timestamp"),
        F.get_json_object("props", "$.k").alias("rainfall [mm]"),
        F.col("value").alias("temperature [°C]"),
    )
    write_tsv(rows, path)
    return read_weather_tsv(spark, path).select(TIMESTAMP, TEMPERATURE, "local_time")


@query(
    """
    SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+09:00' AS "timestamp", CAST(value AS FLOAT) AS temperature_c,
           CASE WHEN event_id % 2 = 0 THEN 'Osaka' ELSE 'Nagoya' END AS station
    FROM events
    """
)
def tsv_two_layouts(spark, sf_dir):
    """Files whose columns stand in two orders, in one load."""
    base = scratch_dir(spark, "layouts")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    columns = {
        "timestamp": F.concat(stamp, F.lit("+09:00")),
        "temperature [°C]": F.col("value"),
        "rainfall [mm]": F.get_json_object("props", "$.k"),
    }
    names = list(columns)
    for turn, (station, order) in enumerate((("osaka", names), ("nagoya", names[::-1]))):
        rows = table(spark, sf_dir, "events").filter(F.col("event_id") % 2 == turn)
        write_tsv(rows.select(*[columns[c].alias(c) for c in order]), f"{base}/20240101-20240131-{station}")
    return read_weather_tsv(spark, f"{base}/*", headers="each").select(TIMESTAMP, TEMPERATURE, "station")


@query(
    f"""
    SELECT CASE event_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END || '/20240101-20240115-osaka' AS file,
           strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.%g') || '+09:00' AS "timestamp",
           CAST(event_id AS VARCHAR) AS temperature
    FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-16'
    """
)
def stream_clean_raw(spark, sf_dir):
    """Raw files in Shift-JIS bytes, of one name in three folders, cleaned as they arrive: each run
    of the stream takes the new folder only."""
    base = scratch_dir(spark, "arriving")
    day = F.date_format("ts", "yyyy/M/d H:mm:ss")
    line = F.concat(day, F.lit(","), F.col("event_id").cast("string"), F.lit(",8,1,0,1,8,1"))
    above = ["ダウンロードした時刻：2024/02/01 12:00:00", "", "年月日時,気温(℃),気温(℃),気温(℃),降水量(mm)"]
    events = table(spark, sf_dir, "events")
    for turn, folder in enumerate("abc"):
        rows = events.filter(F.col("event_id") % 3 == turn).select(F.encode(line, "US-ASCII").alias("line"))
        header = spark.createDataFrame([(x.encode("cp932"),) for x in above], "line binary")
        # One file of bytes below the name that a download has.
        _write_bytes(header.union(rows), f"{base}/raw/{folder}/20240101-20240115-osaka.csv")
        raw = read_raw_observations(
            spark, f"{base}/raw/*/*", stream=True, root=f"{base}/raw", maxFilesPerTrigger=1
        )
        # Spark wrote the file as a folder of parts, which the name is taken from.
        raw = raw.withColumn("file_name", F.regexp_replace("file_name", "/[^/]*$", ""))
        start_tsv_sink(
            clean_observations(raw, keep_file=True), f"{base}/tidy", f"{base}/checkpoint", folders=FILE,
            available_now=True,
        ).awaitTermination()
    tidy = spark.read.option("sep", "\t").option("header", True).csv(f"{base}/tidy")
    return tidy.select("file", "timestamp", F.col("temperature [°C]").alias("temperature"))


def _write_bytes(lines: DataFrame, path: str) -> None:
    """Lines of bytes as text files, with CRLF. Every byte is one character of Latin-1."""
    text = lines.select(F.decode("line", "ISO-8859-1").alias("value"))
    text.coalesce(2).write.option("lineSep", "\r\n").option("encoding", "ISO-8859-1").text(path)


@query(
    """
    SELECT 'documents' AS label, text FROM documents
    UNION ALL SELECT 'benchmark', text FROM benchmark
    UNION ALL SELECT 'conversations', text FROM conversations
    """
)
def labelled_files(spark, sf_dir):
    """Several files read as one table, labelled by the name of the file."""
    names = ("documents", "benchmark", "conversations")
    paths = [f"{sf_dir}/{name}.parquet" for name in names]
    label = F.regexp_extract("_metadata.file_path", r"/([a-z]+)\.parquet(?:/|$)", 1)
    return spark.read.schema("text string").parquet(*paths).select(label.alias("label"), "text")


@query(
    """
    SELECT 'Summer' AS season, event_id, value FROM events WHERE event_type IN ('click', 'view')
    UNION ALL
    SELECT 'Winter', event_id, value FROM events WHERE event_type IN ('signup', 'purchase')
    UNION ALL
    SELECT 'Autumn', event_id, value FROM events
    WHERE event_type NOT IN ('click', 'view', 'signup', 'purchase') OR event_type IS NULL
    """
)
def labelled_union(spark, sf_dir):
    """A labelled set of selections, from one scan."""
    season = (
        F.when(F.col("event_type").isin("click", "view"), "Summer")
        .when(F.col("event_type").isin("signup", "purchase"), "Winter")
        .otherwise("Autumn")
    )
    return table(spark, sf_dir, "events").select(season.alias("season"), "event_id", "value")


@query(
    """
    SELECT CASE WHEN o_custkey % 2 = 0 THEN 'Sapporo' ELSE 'Naha' END AS station,
           CASE WHEN o_custkey % 2 = 0 THEN 'Winter' ELSE 'Summer' END AS season,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || '+09:00' AS "timestamp",
           CAST(o_orderkey % 1000 AS FLOAT) AS temperature_c, CAST(o_custkey % 50 AS FLOAT) AS rainfall_mm
    FROM orders
    WHERE CASE WHEN o_custkey % 2 = 0 THEN o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
               ELSE o_orderdate >= TIMESTAMP '1996-07-01' AND o_orderdate < TIMESTAMP '1998-01-01' END
    """
)
def clean_then_load(spark, sf_dir):
    """Orders written as raw files of two stations, with the lines above the data and rows
    of other days; read, cleaned by the days in the names, written, and loaded."""
    base = scratch_dir(spark, "clean")
    day = F.date_format("o_orderdate", "yyyy/M/d H:mm:ss")
    reading = F.format_string("%s,%d,8,1,%d,1,8,1", day, F.col("o_orderkey") % 1000, F.col("o_custkey") % 50)
    names = {0: "19960101-19961231-sapporo", 1: "19960701-19971231-naha"}
    orders = table(spark, sf_dir, "orders")
    for turn, name in names.items():
        rows = orders.filter(F.col("o_custkey") % 2 == turn).select(reading.alias("value"))
        above = ["downloaded: 2023/10/01 12:00:00", "", ",x,x,x,x,x,x,x", "time,a,a,a,b,b,b,b", ",,q,h,,n,q,h"]
        rows = spark.createDataFrame([(x,) for x in above], "value string").union(rows)
        rows.write.option("lineSep", "\r\n").text(f"{base}/raw/{name}")
    # The name is the folder's here, as Spark names the files below it.
    folder = F.element_at(F.split("_path", "/"), -2)
    raw = read_raw_observations(spark, [f"{base}/raw/{n}" for n in names.values()], path="_path")
    raw = raw.withColumn("file_name", folder)
    write_tsv(clean_observations(raw, keep_file=True), f"{base}/tidy", folders=FILE)
    return read_weather_tsv(spark, f"{base}/tidy").select(
        "station", "season", TIMESTAMP, TEMPERATURE, RAINFALL
    )
