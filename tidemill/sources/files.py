"""Hourly weather TSV files, Parquet tables and message files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from itertools import permutations
from typing import Literal
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import parse_instant
from tidemill.schema import (
    EVENT_TIME,
    FILE,
    LOCAL_OFFSET,
    RAINFALL,
    RAINFALL_FIELD,
    READING_FIELDS,
    READING_SCHEMA,
    SEASON,
    STATION,
    TEMPERATURE,
    TEMPERATURE_FIELD,
    TIMESTAMP,
    TIMESTAMP_FIELD,
    TOPIC_PREFIX,
)

# Files are named <first day>-<last day>-<station>.tsv, and a season
# is told by the month of the first day. Cleaned files lie in folders of that name, or of
# the path that the file had, in which Spark writes %2F for a slash.
_NAME = r"(?:^|[/=]|%2F)\d{4}(\d{2})\d{2}-\d{8}-([^./=]+)(?=[./]|$)"
_SEASONS = ("Winter", "Spring", "Summer", "Autumn")


def with_file_labels(df: DataFrame, file_name: Column) -> DataFrame:
    """Label rows with the station and season their file, or a folder above it, is named
    for. A name or path that says neither fails the job."""
    name = F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))
    unnamed = F.raise_error(F.concat(F.lit("no station in file name: "), file_name)).cast("int")
    month = F.coalesce(F.regexp_extract(name, _NAME, 1).try_cast("int"), unnamed)
    # Winter starts in December: 12, 1, 2 -> 0; 3, 4, 5 -> 1; ...
    season = F.element_at(
        F.array(*[F.lit(s) for s in _SEASONS]), ((month % 12) / 3).cast("int") + 1
    )
    return df.withColumns(
        {STATION: F.initcap(F.regexp_extract(name, _NAME, 2)), SEASON: season}
    )


def read_weather_tsv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    stream: bool = False,
    headers: Literal["alike", "each"] = "alike",
) -> DataFrame:
    """Read any number of hourly TSV files (paths, folders or globs) as one labelled
    table. ``event_time`` is the true instant, ``local_time`` the wall-clock time.

    Columns are bound by the header: a batch takes the order of the first file, a
    stream that of the format, and a file with another header fails the job. With
    ``headers="each"`` a batch binds the columns of each file by its own: one pass finds the
    header lines, and files are then read together by the order of their columns, of which
    there are six at most. A file without a header fails the job.

    A stream takes one path: a folder or a glob.
    """
    if headers == "each":
        if stream:
            raise ValueError("a stream binds its files by the format's header")
        return reduce(DataFrame.union, [read_weather_tsv(spark, same) for same in _by_header(spark, paths)])
    layout = {"sep": "\t", "header": True, "mode": "FAILFAST", "enforceSchema": False}
    types = dict(zip(READING_FIELDS, [f.dataType for f in READING_SCHEMA], strict=True))
    order = list(READING_FIELDS)
    if not stream:
        order = [c for c in spark.read.options(**layout).csv(paths).columns if c != FILE]
        if sorted(order) != sorted(READING_FIELDS):
            raise ValueError(f"columns {order} are not {list(READING_FIELDS)}: {paths}")
    schema = T.StructType([T.StructField(c, types[c]) for c in order])
    reader = spark.readStream if stream else spark.read
    found = reader.schema(schema).options(**layout).csv(paths)
    rows = found.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(READING_FIELDS, READING_SCHEMA.names, strict=True)],
        F.col("_metadata.file_path").alias("_path"),
    )
    instant = parse_instant(F.col(TIMESTAMP))
    timed = rows.withColumns(
        {
            EVENT_TIME: instant,
            "local_time": F.from_utc_timestamp(instant, LOCAL_OFFSET).cast("timestamp_ntz"),
        }
    )
    return with_file_labels(timed, F.col("_path")).drop("_path")


def _by_header(spark: SparkSession, paths: str | Sequence[str]) -> list[list[str]]:
    """The files with the same order of columns."""
    orders = ["\t".join(order) for order in permutations(READING_FIELDS)]
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths))
    # A row of readings is no header, whatever its columns hold.
    of_file = lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.max(F.when(F.col("value").isin(orders), F.col("value"))).alias("header")
    )
    found: dict[str, list[str]] = {}
    for row in of_file.collect():  # as many as the files, which the driver lists anyway
        if row.header is None:
            raise ValueError(f"no line with the columns {list(READING_FIELDS)}: {row.path}")
        found.setdefault(row.header, []).append(unquote(row.path))
    return list(found.values())


def as_messages(readings: DataFrame) -> DataFrame:
    """Labelled readings in the layout of Kafka records, one JSON object each."""
    body = F.to_json(
        F.struct(
            F.col(TIMESTAMP).alias(TIMESTAMP_FIELD),
            F.col(TEMPERATURE).alias(TEMPERATURE_FIELD),
            F.col(RAINFALL).alias(RAINFALL_FIELD),
        )
    )
    topic = F.concat(F.lit(TOPIC_PREFIX), F.lower(STATION))
    return readings.select(
        F.lit(None).cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        topic.alias("topic"),
    )


def message_lines(
    spark: SparkSession, path: str, *, stream: bool = True, partitions: bool = False, **options
) -> DataFrame:
    """Text files with one JSON message per line, as keyless records. The topic is
    the name of the folder a file lies in: ``<path>/<topic>/<file>``. With ``partitions``
    a number that the file's name begins with is the partition, or else 0."""
    reader = spark.readStream if stream else spark.read
    lines = (
        reader.schema(T.StructType([T.StructField("value", T.StringType())]))
        .options(**options)
        .text(f"{path.rstrip('/')}/*")
    )
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^\d+", 0).try_cast("int")
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        folder.alias("topic"),
        *([F.coalesce(number, F.lit(0)).alias("partition")] if partitions else []),
    )


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, **options
) -> DataFrame:
    """Read a Parquet table (a file or a folder) as a stream. Give
    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` to bound a micro-batch."""
    # Streams take paths for patterns, and their micro-batches do so once more.
    if re.search(r"[\\\[\]{}*?]", path):
        raise ValueError(f"a stream would take this path for a pattern: {path}")
    # A stream takes a single file only through a pattern that matches it.
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).options(**options).parquet(pattern)
