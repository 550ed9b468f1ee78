"""Running a stream over the data that is there."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemill.session import scratch_dir
from tidemill.sources.sinks import start_file_sink


def drain_to_table(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """Run a streaming frame until its sources hold nothing new, into a table in
    the shared scratch folder, and return that table. Nothing passes the driver."""
    base = scratch_dir(spark, purpose)
    query = start_file_sink(rows, f"{base}/table", f"{base}/checkpoint", available_now=True)
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/table")


def drain_timers_to_table(
    spark: SparkSession, rows: DataFrame, purpose: str
) -> DataFrame:
    """Like :func:`drain_to_table`, for a query with processing-time timers. Such a
    query never counts as finished, so it is stopped once a micro-batch has found
    no input and no state is left, however long that takes; it gives up only if the
    query fails."""
    base = scratch_dir(spark, purpose)
    query = start_file_sink(rows, f"{base}/table", f"{base}/checkpoint", trigger="500 milliseconds")
    try:
        while not _is_idle(query):
            if query.exception() is not None:
                raise query.exception()
            time.sleep(0.2)
    finally:
        query.stop()
    return spark.read.schema(rows.schema).parquet(f"{base}/table")


def _is_idle(query: StreamingQuery) -> bool:
    last = query.lastProgress
    if last is None or last["numInputRows"] > 0 or last["batchId"] == 0:
        return False
    return all(op["numRowsTotal"] == 0 for op in last["stateOperators"])
