"""Kafka and file sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemill.functions import encode_long, encode_text


def to_keyed_messages(df: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Rows as Kafka records with a key. Bytes pass as they are; a number or text
    is encoded."""
    types = dict(df.dtypes)

    def encoded(name: str) -> Column:
        column = F.col(name)
        if types[name] == "binary":
            return column
        return encode_text(column) if types[name] == "string" else encode_long(column)

    return df.select(encoded(key).alias("key"), encoded(value).alias("value"))


def to_value_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows as Kafka records without a key."""
    return df.select(F.col(value).cast("binary").alias("value"))


def to_topic_messages(df: DataFrame) -> DataFrame:
    """Lines of several stations as Kafka records that name theirs in the key."""
    return to_keyed_messages(df, "topic", "value")


def start_query(
    writer: DataStreamWriter, *, trigger: str | None = None, available_now: bool = False
) -> StreamingQuery:
    """Start a query: on a processing-time trigger, once over what is there, or
    (by default) micro-batch after micro-batch."""
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def start_kafka_sink(
    messages: DataFrame,
    bootstrap_servers: str,
    topic: str,
    checkpoint: str,
    *,
    trigger: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append records to a topic. A micro-batch that is run again after a failure
    is written again (at-least-once)."""
    writer = (
        messages.writeStream.format("kafka")
        .outputMode("append")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return start_query(writer, trigger=trigger, available_now=available_now)


def start_file_sink(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    file_format: str = "parquet",
    trigger: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append rows to a folder of files, each row exactly once."""
    writer = (
        rows.writeStream.format(file_format)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return start_query(writer, trigger=trigger, available_now=available_now)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder where there is none, wherever Spark can write."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)


def write_tsv(
    df: DataFrame, path: str, *, mode: str = "errorifexists", folders: str | None = None
) -> None:
    """Write tab-separated text with a header line per file, with a folder for each
    value of the column ``folders``."""
    writer = df.write.mode(mode).option("sep", "\t").option("header", True)
    (writer.partitionBy(folders) if folders else writer).csv(path)


def start_tsv_sink(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    folders: str,
    trigger: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """What :func:`write_tsv` writes, as a stream: each row exactly once."""
    writer = (
        rows.writeStream.format("csv").outputMode("append").partitionBy(folders)
        .option("sep", "\t").option("header", True)
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return start_query(writer, trigger=trigger, available_now=available_now)


def write_parquet(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)
