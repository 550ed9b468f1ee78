"""Event time, watermarks and filters that leave a watermark alone."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import interval_text, parse_instant
from tidemill.schema import EVENT_TIME, TIMESTAMP

# Only for a single ordered partition, and only when asked for: nothing is out of
# order, so nothing is waited for.
NO_DELAY = timedelta(0)
# The watermark follows the fastest partition, and even one topic has several: the
# slower ones need an allowance to not count as late.
DEFAULT_DELAY = timedelta(hours=2)
# Sessions close when the watermark has passed their end, not when it meets it.
SESSION_DELAY = timedelta(milliseconds=1)


def with_event_time(
    df: DataFrame, text: str = TIMESTAMP, name: str = EVENT_TIME, *, strict: bool = True
) -> DataFrame:
    """Take the event time from the payload's timestamp text.

    ``strict`` fails the job on bad or missing text; otherwise such a row gets a
    NULL event time, which no window takes in.
    """
    instant = parse_instant(F.col(text), strict=strict)
    if strict:
        missing = F.raise_error(F.lit(f"record without {text}")).cast("timestamp")
        # The last choice is never reached. It tells the optimizer that the column
        # has no NULLs, so that windows do not parse the text again to look for them.
        instant = F.coalesce(instant, missing, F.timestamp_micros(F.lit(0)))
    return df.withColumn(name, instant)


def with_watermark(
    df: DataFrame, delay: timedelta = DEFAULT_DELAY, name: str = EVENT_TIME
) -> DataFrame:
    """Set the watermark to the greatest event time seen, minus ``delay``.

    Place it right after :func:`with_event_time`, before any filter on readings:
    rows that a later filter drops still move event time forward.
    """
    return df.withWatermark(name, interval_text(delay))


def watermark_per_source(
    sources: Sequence[DataFrame], delay: timedelta = DEFAULT_DELAY, name: str = EVENT_TIME
) -> DataFrame:
    """One stream from several, each with a watermark of its own.

    Spark moves the joint watermark with the slowest source (its default policy,
    ``spark.sql.streaming.multipleWatermarkPolicy=min``), so a source that lags
    behind others loses no rows. The delay makes up for the partitions inside one.
    """
    return reduce(DataFrame.unionByName, [with_watermark(s, delay, name) for s in sources])


def filter_above_watermark(df: DataFrame, test: Column, name: str = EVENT_TIME) -> DataFrame:
    """Filter a stream without holding its watermark back.

    The optimizer moves a filter below the watermark unless it mentions the
    event-time column; below it, the dropped rows would no longer advance event
    time and the last window would wait for the next row that passes. A batch
    has no watermark: there the plain test stays free to reach the scan.
    """
    if df.isStreaming:
        # True for every time. A check for NULL would be folded away, and the column
        # with it, where the column cannot be NULL.
        timed = F.unix_micros(name) >= F.lit(-(2**63))
        test = F.when(timed, test).otherwise(F.lit(False))
    return df.filter(test)
