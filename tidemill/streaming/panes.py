"""Means of what arrived lately, refreshed on processing time.

Each result is the mean of its own pane only: fired panes are discarded, so this
is no running mean over all data.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemill.operators.panes import pane_mean
from tidemill.sources.sinks import start_query

ONE_SECOND = timedelta(seconds=1)

# Executors get the two small Python steps below with the plan, so they need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def start_pane_means(
    df: DataFrame,
    reading: str,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    keys: tuple[str, ...] = (),
    trigger: str = "1 second",
    available_now: bool = False,
) -> StreamingQuery:
    """One pane per micro-batch, one micro-batch per ``trigger``.

    ``write`` gets the pane's means (``mean``, ``n`` and the keys) and the batch
    number. A batch is given again with the same number after a failure, so a
    writer that overwrites by number stays exact. Readings are averaged in the map
    tasks first; an empty pane gives no row.
    """

    def fire(batch: DataFrame, number: int) -> None:
        write(pane_mean(batch, reading, *keys), number)

    writer = df.writeStream.foreachBatch(fire).option("checkpointLocation", checkpoint)
    return start_query(writer, trigger=trigger, available_now=available_now)


class _PaneTimer(StatefulProcessor):
    """Sum and count of the open pane of a key, and the timer that closes it."""

    def __init__(self, delay_ms: int):
        self._delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._pane = handle.getValueState("pane", "total double, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        total, n = 0.0, 0
        for part in rows:
            total += float(part["total"].sum())
            n += int(part["n"].sum())
        if self._pane.exists():
            held = self._pane.get()
            total, n = total + held[0], n + held[1]
        else:
            # The first arrival of a pane starts its clock.
            now = timerValues.getCurrentProcessingTimeInMs()
            self._handle.registerTimer(now + self._delay_ms)
        self._pane.update((total, n))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self._pane.exists():
            total, n = self._pane.get()
            self._pane.clear()
            yield pd.DataFrame({"pane_key": [key[0]], "mean": [total / n], "n": [n]})

    def close(self) -> None:
        pass


def _fold_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum and count per key of each Arrow batch, before the shuffle."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table.filter(pc.is_valid(table["reading"]))
        sums = table.group_by("pane_key").aggregate([("reading", "sum"), ("reading", "count")])
        out = pa.table(
            {
                "pane_key": sums["pane_key"],
                "total": pc.cast(sums["reading_sum"], pa.float64()),
                "n": pc.cast(sums["reading_count"], pa.int64()),
            }
        )
        yield from out.to_batches()


def timer_pane_means(
    df: DataFrame, reading: str, *, key: str, delay: timedelta = ONE_SECOND
) -> DataFrame:
    """One pane per key and timer: a pane is closed ``delay`` of processing time
    after its first arrival, whatever the micro-batches are.

    Each map task folds its rows to one row per key and Arrow batch, so that a hot
    key shuffles sums and not rows. Columns: ``pane_key``, ``mean``, ``n``. Needs
    the RocksDB state store. State is kept by a Python call for each key and
    micro-batch: made for stations, not for millions of keys.
    """
    rows = df.select(
        F.col(key).cast("string").alias("pane_key"), F.col(reading).cast("double").alias("reading")
    )
    folded = rows.mapInArrow(_fold_batches, "pane_key string, total double, n long")
    return folded.groupBy("pane_key").transformWithStateInPandas(
        _PaneTimer(delay // timedelta(milliseconds=1)),
        outputStructType="pane_key string, mean double, n long",
        outputMode="Append",
        timeMode="ProcessingTime",
    )
