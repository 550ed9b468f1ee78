"""Passthrough and projections."""

from pyspark.sql import DataFrame


def passthrough(messages: DataFrame) -> DataFrame:
    """Key and value as they came. The bytes are never decoded."""
    return messages.select("key", "value")


def project(df: DataFrame, *fields: str) -> DataFrame:
    """Keep the named fields."""
    return df.select(*fields)


def extract(df: DataFrame, field: str, *carried: str) -> DataFrame:
    """Keep one measured field, with the columns later steps need (event time and
    grouping keys), under the general name ``reading``."""
    return df.select(*carried, df[field].alias("reading"))
