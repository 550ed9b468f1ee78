"""Column names and schemas of the weather messages and hourly readings."""

from pyspark.sql import types as T

# The field names of the JSON messages, which are also the header
# of the hourly TSV files.
TIMESTAMP_FIELD = "timestamp"
TEMPERATURE_FIELD = "temperature [°C]"
RAINFALL_FIELD = "rainfall [mm]"

READING_FIELDS = (TIMESTAMP_FIELD, TEMPERATURE_FIELD, RAINFALL_FIELD)

# Working names used by every operator after parsing.
TIMESTAMP = "timestamp"
TEMPERATURE = "temperature_c"
RAINFALL = "rainfall_mm"
EVENT_TIME = "event_time"
STATION = "station"
SEASON = "season"
FILE = "file"

# Readings are 32-bit floats: a mean is taken over float values widened to
# double, so -8.2 contributes -8.199999809...
READING_SCHEMA = T.StructType(
    [
        T.StructField(TIMESTAMP, T.StringType()),
        T.StructField(TEMPERATURE, T.FloatType()),
        T.StructField(RAINFALL, T.FloatType()),
    ]
)

# The layout a Kafka source delivers (the part of it this library uses).
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
    ]
)

# Raw observation files: c0 timestamp, c1 temperature, c4 rainfall, the rest are
# quality, homogeneity and phenomenon flags.
RAW_COLUMNS = tuple(f"c{i}" for i in range(8))
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

# Topic prefix per station and the UTC offset of all local times.
TOPIC_PREFIX = "weather-"
LOCAL_OFFSET = "+09:00"
