"""Stretches of time that every partition has passed.

Spark's own watermark follows the fastest partition of a source. Here each (topic,
partition) has a watermark of its own, the greatest event time it has brought, and rows
are released when the slowest of them has passed: none is lost however far the others
are ahead, without any delay. Rows wait in files, by cells of time, and a released stretch
is a batch like any other, so the batch operators work on it, with their shuffles and
without a hot key in one task.

A row whose cell was released before it came is late. It is set apart before anything is
aggregated, with the time it missed: see :func:`late_rows`.

What a micro-batch writes goes to folders of its number, and a micro-batch that is run
again after a failure overwrites them, so the folders stay exact.
"""

from __future__ import annotations

import time as clock
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions import COUNT, Combine, micros
from tidemill.operators.windows import HOUR, close_sessions, session_runs
from tidemill.schema import EVENT_TIME
from tidemill.sources.sinks import start_query

_LATE, _CELL, _MISSED = "_late", "_cell_of", "_missed"
_MICROSECOND = timedelta(microseconds=1)
RESERVED = (_LATE, _CELL, _MISSED)


@dataclass(frozen=True)
class Stretch:
    """Time from ``low`` (None: the beginning) to below ``high``, in microseconds, released by
    micro-batch ``number``. ``before`` is the number that released the stretch before."""

    number: int
    before: int | None
    low: int | None
    high: int

    def closes(self, end: Column) -> Column:
        """Whether a window that ends so is complete since this stretch."""
        us = F.unix_micros(end.cast("timestamp"))
        done = us <= F.lit(self.high)
        return done if self.low is None else done & (us > F.lit(self.low))


def write_numbered(rows: DataFrame, path: str, number: int) -> None:
    """The output of a micro-batch, in a folder of its number."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={number}")


def start_complete_stretches(
    rows: DataFrame,
    write: Callable[[DataFrame, Stretch], None],
    folder: str,
    *,
    partition: Sequence[str] = ("topic", "partition"),
    expected: Sequence[tuple] = (),
    time: str = EVENT_TIME,
    cell: timedelta = HOUR,
    offset: timedelta = timedelta(0),
    lookback: timedelta = timedelta(0),
    delay: timedelta = timedelta(0),
    idle: timedelta | None = None,
    trigger: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Call ``write`` with the rows of each stretch of whole cells that all partitions have
    passed (by ``delay``), and with rows up to ``lookback`` before it.

    ``partition`` names the columns that tell partitions apart; rows of one are taken to
    come in order of time. Those in ``expected`` hold the others back from the start, others
    from their first row on. With ``idle``, one that brings nothing for so long stops holding
    the others back; its rows are late if their cells have been released when it comes back.
    Rows without a time are late, and have missed nothing.

    Each row is written once when it comes and read once when it is released, besides the
    lookback. ``folder`` is a shared one, and holds the checkpoint; folders
    ``arrived/batch=n`` of released micro-batches are not read again, but for late rows.
    """
    clash = sorted({*RESERVED} & {c.lower() for c in rows.columns})
    if clash:
        raise ValueError(f"reserved names, rename these columns: {', '.join(clash)}")
    step, shift, back, wait = (d // _MICROSECOND for d in (cell, offset % cell, lookback, delay))
    arrived = f"{folder}/arrived"
    kept = _stored(rows.schema)
    keys = T.StructType([rows.schema[c] for c in partition])

    def cell_of(us: int) -> int:
        return (us - shift) // step

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        marks, last = _marks(spark, folder, number - 1), _last(spark, folder, number - 1)
        us = F.unix_micros(F.col(time).cast("timestamp"))
        behind = us - F.lit(shift)
        in_cell = ((behind - F.pmod(behind, F.lit(step))) / F.lit(step)).cast("long")
        missed = F.lit(None).cast("timestamp")
        late = F.col(_CELL).isNull()
        if last.high is not None:
            late = late | (F.col(_CELL) < cell_of(last.high))
            missed = F.when(late & F.col(_CELL).isNotNull(), F.timestamp_micros(F.lit(last.high)))
        # The only pass over the source.
        stored = batch.withColumn(_CELL, in_cell).withColumn(_LATE, late).withColumn(_MISSED, missed)
        here = f"{arrived}/batch={number}"
        stored.sortWithinPartitions(_CELL).write.mode("overwrite").partitionBy(_LATE).parquet(here)
        came = _read(spark, [here], kept, arrived)

        now = int(clock.time() * 1e6)
        new = came.filter(F.col(time).isNotNull()).groupBy(*partition).agg(
            F.max(us).alias("_seen"), F.lit(now).alias("_arrived")
        )
        if marks is None:
            marks = spark.createDataFrame(list(expected), keys).withColumns(
                {"_seen": F.lit(None).cast("long"), "_arrived": F.lit(now)}
            )
        marks = marks.unionByName(new).groupBy(*partition).agg(
            F.max("_seen").alias("_seen"), F.max("_arrived").alias("_arrived")
        )
        _one_file(marks, f"{folder}/marks/batch={number}")
        marks = _marks(spark, folder, number)
        if idle is not None:
            marks = marks.filter(F.col("_arrived") >= now - idle // _MICROSECOND)
        slowest, unseen = marks.agg(F.min("_seen"), F.count_if(F.col("_seen").isNull())).first()
        high = last.high
        if slowest is not None and not unseen:
            passed = cell_of(slowest - wait) * step + shift
            high = passed if high is None else max(high, passed)

        top = came.filter(f"NOT {_LATE}").agg(F.max(_CELL)).first()[0]
        holding = {**last.holding, **({number: top} if top is not None else {})}
        opens = high is not None and (last.high is None or high > last.high)
        if opens:
            stretch = Stretch(number, last.released, last.high, high)
            first = None if stretch.low is None else cell_of(stretch.low - back)
            ready = F.col(_CELL) < cell_of(high)
            if first is not None:
                ready = ready & (F.col(_CELL) >= first)
            paths = [f"{arrived}/batch={n}" for n in holding]
            released = _read(spark, paths, kept, arrived).filter(~F.col(_LATE) & ready).drop(*RESERVED)
            write(released, stretch)
            again = cell_of(high - back)
            holding = {n: c for n, c in holding.items() if c >= again}
        _Last(high, number if opens else last.released, holding).save(spark, folder, number)

    writer = rows.writeStream.foreachBatch(take).option("checkpointLocation", f"{folder}/checkpoint")
    return start_query(writer, trigger=trigger, available_now=available_now)


@dataclass(frozen=True)
class _Last:
    """What a micro-batch leaves: the end of what has been released, the number that did it, and
    the last cell of each earlier micro-batch that still has rows to wait or look back to."""

    high: int | None
    released: int | None
    holding: dict[int, int]

    SCHEMA = "high long, released long, holding map<long, long>"

    def save(self, spark: SparkSession, folder: str, number: int) -> None:
        row = spark.createDataFrame([(self.high, self.released, self.holding)], self.SCHEMA)
        _one_file(row, f"{folder}/released/batch={number}")


def _last(spark: SparkSession, folder: str, number: int) -> _Last:
    if number < 0:
        return _Last(None, None, {})
    row = spark.read.schema(_Last.SCHEMA).parquet(f"{folder}/released/batch={number}").first()
    return _Last(row.high, row.released, dict(row.holding))


def _marks(spark: SparkSession, folder: str, number: int) -> DataFrame | None:
    """The greatest time of each partition, and when it last came: a row for each partition."""
    return spark.read.parquet(f"{folder}/marks/batch={number}") if number >= 0 else None


def _one_file(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def _read(spark: SparkSession, paths: list[str], schema: T.StructType, base: str) -> DataFrame:
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def _stored(schema: T.StructType) -> T.StructType:
    """Rows as they are kept. Whether they were late names the folder."""
    own = ((_CELL, T.LongType()), (_MISSED, T.TimestampType()), (_LATE, T.BooleanType()))
    return T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in own]])


def late_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows that came too late, as they came, and ``missed``: up to where all rows had been
    released by then (NULL for a row without a time). ``schema`` is that of the stream."""
    rows = spark.read.schema(_stored(schema)).parquet(f"{folder}/arrived")
    return rows.filter(_LATE).select(*schema.names, F.col(_MISSED).alias("missed"))


def closed_sessions(
    rows: DataFrame,
    stretch: Stretch,
    open_folder: str,
    time: str,
    reading: str,
    *,
    keys: Sequence[str],
    combine: Combine = COUNT,
    name: str = "n",
    gap: timedelta = HOUR,
) -> DataFrame:
    """The sessions that are complete since this stretch. Those still open are kept in
    ``open_folder``, one folded row for each, and go on in the next stretch.

    Rows are folded into cells before any shuffle, and cells chained in chunks, as in
    :func:`tidemill.operators.session_combine`: of a hot key, one task sees cells only.
    """
    spark, time_type = rows.sparkSession, dict(rows.dtypes)[time]
    earlier = None
    if stretch.before is not None:
        earlier = spark.read.parquet(f"{open_folder}/batch={stretch.before}")
    runs = session_runs(rows, time, reading, keys=keys, combine=combine, gap=gap, earlier=earlier)
    # A row that comes yet may lie exactly a gap after the last one.
    ends = F.col("_last") + micros(gap) < F.lit(stretch.high)
    write_numbered(runs.withColumn("_ends", ends), f"{open_folder}-runs", stretch.number)
    runs = spark.read.parquet(f"{open_folder}-runs/batch={stretch.number}")
    write_numbered(runs.filter("NOT _ends").drop("_ends"), open_folder, stretch.number)
    return close_sessions(runs.filter("_ends"), time_type, keys=keys, combine=combine, name=name, gap=gap)
