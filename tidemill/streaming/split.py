"""Records parsed once, into good and malformed ones.

One query reads and parses the source and commits both kinds to one table together, so
every record is in exactly one of them, whatever fails in between. What follows reads the
table as a stream: only committed micro-batches can be seen there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.records import ERROR, accepted, rejected
from tidemill.sources.sinks import make_folder, start_query

_REJECTED = "_rejected"


def start_split(
    parsed: DataFrame,
    folder: str,
    checkpoint: str,
    *,
    trigger: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Write the rows of a quarantine parse to ``folder``, good and malformed ones apart."""
    make_folder(parsed.sparkSession, folder)
    rows = parsed.withColumn(_REJECTED, F.col(ERROR).isNotNull())
    writer = (
        rows.writeStream.format("parquet").partitionBy(_REJECTED)
        .option("path", folder).option("checkpointLocation", checkpoint)
    )
    return start_query(writer, trigger=trigger, available_now=available_now)


def _split(spark: SparkSession, folder: str, schema: T.StructType, bad: bool) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField(_REJECTED, T.BooleanType())])
    rows = spark.readStream.schema(whole).parquet(folder)
    return rows.filter(F.col(_REJECTED) == bad).drop(_REJECTED)


def accepted_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The good rows of a split, as a stream. ``schema`` is that of the parse."""
    return accepted(_split(spark, folder, schema, False))


def rejected_stream(spark: SparkSession, folder: str, schema: T.StructType, *carried: str) -> DataFrame:
    """The malformed rows of a split, as a stream, as they came."""
    return rejected(_split(spark, folder, schema, True), *carried)
