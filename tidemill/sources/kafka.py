"""Kafka topics as streams (or, for backfills, as batches)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class KafkaSource:
    """Where and how to read. Only committed records are read, from the latest
    offsets on; a restarted query goes on from its checkpoint instead."""

    bootstrap_servers: str
    topics: tuple[str, ...]
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": ",".join(self.topics),
            "startingOffsets": self.starting_offsets,
            "kafka.isolation.level": "read_committed",
        }
        if self.max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.min_partitions is not None:
            # Splits a hot topic partition over several tasks.
            options["minPartitions"] = str(self.min_partitions)
        return {**options, **self.extra}


def read_kafka(
    spark: SparkSession, source: KafkaSource, *, stream: bool = True, partitions: bool = False
) -> DataFrame:
    """Key, value and topic of each record; the other metadata is dropped. The
    topic stays, since it names the station that windows are grouped by. ``partitions``
    keeps the number of the topic's partition, too, for watermarks of their own.

    Needs the ``spark-sql-kafka`` connector on the class path.
    """
    reader = spark.readStream if stream else spark.read
    options = source.options()
    if not stream and source.starting_offsets == "latest":
        options["startingOffsets"] = "earliest"
    kept = ["key", "value", "topic", *(["partition"] if partitions else [])]
    return reader.format("kafka").options(**options).load().select(*kept)
