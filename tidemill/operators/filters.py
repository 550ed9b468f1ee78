"""Threshold filters on a reading. NaN passes neither of them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.eventtime import filter_above_watermark


def _threshold(df: DataFrame, field: str, test: Column, time: str | None) -> DataFrame:
    # Spark orders NaN above every number, so it would pass a lower bound. Only
    # fractional columns can hold it.
    if dict(df.dtypes)[field] in ("float", "double"):
        test = test & ~F.isnan(field)
    return df.filter(test) if time is None else filter_above_watermark(df, test, time)


def keep_at_least(
    df: DataFrame, field: str, bound: float = 0.0, *, time: str | None = None
) -> DataFrame:
    """Rows with ``field >= bound``. Name the event-time column in ``time`` where a
    watermark was set before this filter."""
    return _threshold(df, field, F.col(field) >= bound, time)


def keep_above(
    df: DataFrame, field: str, bound: float = 0.0, *, time: str | None = None
) -> DataFrame:
    """Rows with ``field > bound``; see :func:`keep_at_least` for ``time``."""
    return _threshold(df, field, F.col(field) > bound, time)
