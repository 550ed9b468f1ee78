"""The given tables as inputs of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.schema import RAINFALL_FIELD, TEMPERATURE_FIELD, TIMESTAMP_FIELD
from tidemill.session import configure, scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SLICES, SLICE_FILES = 6, 2


def slice_of(df: DataFrame, time: str, slices: int = SLICES) -> Column:
    """Which of so many equally long slices of time a row lies in, from 0."""
    us = F.unix_micros(F.col(time).cast("timestamp"))
    low, high = df.agg(F.min(us), F.max(us)).first()
    low, high = low or 0, high or 0
    return F.expr(f"({low} * -1L + unix_micros(cast({time} as timestamp))) * {slices} div {high - low + 1}")


def write_slices(df: DataFrame, slices: Column, path: str, n: int = SLICES) -> None:
    """Every slice after the one before, each in as many files, so that a stream of so
    many files a micro-batch replays them in order."""
    sliced = df.withColumn("_slice", slices)
    for i in range(n):
        part = sliced.filter(F.col("_slice") == i).drop("_slice")
        part.repartition(SLICE_FILES).write.parquet(f"{path}/{i}")


def read_slices(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", SLICE_FILES)
        .parquet(f"{path}/*")
    )


def table_stream(spark: SparkSession, sf_dir: str, name: str, time: str) -> DataFrame:
    """A whole table as a stream: slices of time, one for each micro-batch."""
    rows, path = table(spark, sf_dir, name), scratch_dir(spark, f"slices-{name}")
    write_slices(rows, slice_of(rows, time), path)
    return read_slices(spark, path, rows.schema)


def instant(column: str) -> Column:
    """Watermarks need an instant, not a zoneless time; the session zone is UTC."""
    return F.col(column).cast("timestamp")


def event_messages(events: DataFrame) -> DataFrame:
    """Events as weather messages: ``value`` less 50 is the temperature (written as
    a string, as some producers do), the number in ``props`` less 50 the rainfall,
    so that half of it is dry. The event type names the topic."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    rain = F.get_json_object("props", "$.k").cast("int") - 50
    # None of the values needs escaping, and plain text stays in generated code.
    body = F.concat(
        F.lit(f'{{"{TIMESTAMP_FIELD}":"'), stamp, F.lit(f'+09:00","{TEMPERATURE_FIELD}":"'),
        F.round(F.col("value") - 50, 2).cast("string"), F.lit(f'","{RAINFALL_FIELD}":'),
        rain.cast("string"), F.lit("}"),
    )
    return events.select(
        F.unhex(F.lpad(F.hex("event_id"), 16, "0")).alias("key"),
        body.cast("binary").alias("value"),
        F.concat(F.lit("weather-"), F.col("event_type")).alias("topic"),
    )
