"""Kafka key and value bytes <-> columns, in built-in expressions only."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_long(value: Column) -> Column:
    """BIGINT -> 8 bytes, big-endian. NULL stays NULL."""
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))


def decode_long(data: Column) -> Column:
    """8 big-endian bytes -> BIGINT. NULL stays NULL; any other length fails."""
    number = F.conv(F.hex(data), 16, -10).cast("bigint")
    wrong = F.raise_error(F.concat(F.lit("key is not 8 bytes long: "), F.hex(data)))
    return F.when(data.isNull(), F.lit(None).cast("bigint")).otherwise(
        F.when(F.octet_length(data) == 8, number).otherwise(wrong.cast("bigint"))
    )


def encode_text(text: Column) -> Column:
    """STRING -> UTF-8 bytes."""
    return text.cast("binary")


def decode_text(data: Column) -> Column:
    """UTF-8 bytes -> STRING."""
    return data.cast("string")
