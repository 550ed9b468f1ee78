from tidemill.sources.files import (
    as_messages,
    message_lines,
    read_weather_tsv,
    stream_parquet,
    with_file_labels,
)
from tidemill.sources.kafka import KafkaSource, read_kafka
from tidemill.sources.raw import common_root, read_raw_observations
from tidemill.sources.sinks import (
    make_folder,
    start_file_sink,
    start_kafka_sink,
    start_query,
    start_tsv_sink,
    to_keyed_messages,
    to_topic_messages,
    to_value_messages,
    write_parquet,
    write_tsv,
)

__all__ = [
    "KafkaSource",
    "as_messages",
    "common_root",
    "make_folder",
    "message_lines",
    "read_kafka",
    "read_raw_observations",
    "read_weather_tsv",
    "start_file_sink",
    "start_kafka_sink",
    "start_query",
    "start_tsv_sink",
    "stream_parquet",
    "to_keyed_messages",
    "to_topic_messages",
    "to_value_messages",
    "with_file_labels",
    "write_parquet",
    "write_tsv",
]
