"""Mean per pane, for panes that are already told apart by a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pane_mean(df: DataFrame, reading: str, *pane: str | Column) -> DataFrame:
    """Mean and row count of each pane; without ``pane``, of the whole frame.

    A pane without rows gives no row: a global aggregate of nothing would.
    """
    grouped = df.groupBy(*pane) if pane else df
    return grouped.agg(
        F.avg(reading).alias("mean"), F.count(F.lit(1)).alias("n")
    ).filter(F.col("n") > 0)
