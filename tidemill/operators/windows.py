"""Event-time windows: tumbling, sliding and session.

Each function works on batches and streams. The result has the grouping keys,
``window_start``, ``window_end`` and the aggregate. A stream emits a window once,
in append mode, when the watermark has passed its end.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from math import gcd, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import COUNT, MEAN, Combine, interval_text, micros
from tidemill.functions.combine import refuse_reserved

DAY = timedelta(days=1)
HOUR = timedelta(hours=1)

# The time span that the chunks of sessions are laid out for; see session_combine.
# Longer ones are right as well.
_LONG_SPAN = timedelta(days=3650)

# Rows for each task that chains sessions, at most, unless one chunk of a key has more
# cells: a task takes some 350 bytes of memory for a cell, far more than it reads.
_TASK_ROWS = 500_000

BOUNDS = ("window_start", "window_end")


def _bounds(window: str) -> list[Column]:
    return [F.col(f"{window}.start").alias(BOUNDS[0]), F.col(f"{window}.end").alias(BOUNDS[1])]


def tumbling_combine(
    df: DataFrame,
    time: str,
    reading: str,
    *,
    combine: Combine = MEAN,
    name: str = "mean",
    width: timedelta = DAY,
    offset: timedelta = timedelta(hours=15),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Aggregate over fixed windows. The default is a calendar day at +09:00: a
    UTC day moved by 15 hours.

    Rows are combined in the map tasks, so a task sends at most one row per key
    and window: a hot key or day costs no more than any other.
    """
    refuse_reserved(keys)
    start = interval_text(offset % width)
    window = F.window(time, interval_text(width), interval_text(width), start)
    folded = df.groupBy(*keys, window.alias("_w")).agg(*combine.fold(F.col(reading)))
    return folded.select(*keys, *_bounds("_w"), combine.result().alias(name))


def sliding_combine(
    df: DataFrame,
    time: str,
    reading: str,
    *,
    combine: Combine = MEAN,
    name: str = "mean",
    width: timedelta = 3 * HOUR,
    slide: timedelta = HOUR,
    keys: Sequence[str] = (),
    prefold: bool | None = None,
) -> DataFrame:
    """Aggregate over overlapping windows; partial ones at both ends are kept.

    A batch is first folded into panes, the widest slices that no window edge
    cuts, and only panes are copied into the ``width / slide`` windows they
    belong to, not rows. A stream keeps one state instead of two, so there each
    row is copied and combined in the map task. ``prefold`` overrides either
    choice: ``False`` for a batch with about one row per key and pane, ``True`` for
    a stream with many overlapping windows.
    """
    refuse_reserved(keys)
    window = F.window("_t", interval_text(width), interval_text(slide)).alias("_w")
    if prefold is None:
        prefold = not df.isStreaming
    if prefold:
        pane_width = timedelta(microseconds=gcd(micros(width), micros(slide)))
        panes = df.groupBy(
            *keys, F.window(time, interval_text(pane_width)).alias("_pane")
        ).agg(*combine.fold(F.col(reading)))
        # All rows of a pane lie in the same windows as its first instant, and as its
        # last one, which carries the watermark on. A batch says that it is not NULL:
        # otherwise the check for that would be moved down to the rows.
        if df.isStreaming:
            instant = F.window_time("_pane")
        else:
            never = F.timestamp_micros(F.lit(0)).cast(dict(df.dtypes)[time])
            instant = F.coalesce(F.col("_pane.start"), never)
        folded = (
            panes.select(*keys, instant.alias("_t"), *combine.parts)
            .groupBy(*keys, window)
            .agg(*combine.merge_parts())
        )
    else:
        timed = df.withColumnRenamed(time, "_t")
        folded = timed.groupBy(*keys, window).agg(*combine.fold(F.col(reading)))
    return folded.select(*keys, *_bounds("_w"), combine.result().alias(name))


def session_combine(
    df: DataFrame,
    time: str,
    reading: str,
    *,
    keys: Sequence[str],
    combine: Combine = COUNT,
    name: str = "n",
    gap: timedelta = HOUR,
    prefold: bool = True,
) -> DataFrame:
    """Aggregate over sessions: runs of rows of one key, each at most ``gap`` after
    the one before. Rows exactly ``gap`` apart belong together. ``window_end`` is
    the last row's time plus ``gap``.

    A stream uses Spark's session windows. A batch does not, as they bring all
    rows of a key into one sorted task. Instead it uses that rows in the same
    cell of width ``gap`` are always in one session:

    1. fold rows into cells (key, time // gap), combined in the map tasks;
    2. chain the cells of a (key, chunk of cells) that are at most ``gap`` apart;
    3. chain the first and last session of each chunk by key. The others are done.

    A key has at most (time span / gap) cells, however many rows it has: 88,000 for
    ten years and one hour. Chunks are as long as there are many in ten years, so
    steps 2 and 3 see about the square root of that bound in one task, and what
    step 3 shuffles is two sessions a chunk. A batch is counted first, and steps 2 and
    3 get so many tasks that none has much more than half a million rows to hold,
    whatever the session's number of shuffle partitions.

    ``prefold=False`` uses Spark's session windows in a batch, too: one shuffle
    instead of two, for data known to have many small keys and no large one.
    """
    if not keys:
        raise ValueError("sessions need at least one grouping key, such as the station")
    refuse_reserved(keys)
    if df.isStreaming or not prefold:
        window = F.session_window(time, interval_text(gap)).alias("_w")
        folded = df.groupBy(*keys, window).agg(*combine.fold(F.col(reading)))
        return folded.select(*keys, *_bounds("_w"), combine.result().alias(name))

    tasks = -(-df.filter(F.col(time).isNotNull()).count() // _TASK_ROWS)
    runs = session_runs(df, time, reading, keys=keys, combine=combine, gap=gap, tasks=tasks)
    return close_sessions(runs, dict(df.dtypes)[time], keys=keys, combine=combine, name=name, gap=gap)


def session_runs(
    df: DataFrame,
    time: str,
    reading: str,
    *,
    keys: Sequence[str],
    combine: Combine = COUNT,
    gap: timedelta = HOUR,
    earlier: DataFrame | None = None,
    tasks: int = 1,
) -> DataFrame:
    """Steps 1 to 3 of :func:`session_combine` on a batch: one folded row for each session,
    with the first and last time in microseconds. ``earlier`` has such rows of sessions that
    may go on; all of them end before the first row of ``df``. If more than one, ``tasks``
    is how many steps 2 and 3 have at least; otherwise Spark decides."""
    gap_us = micros(gap)

    def dealt(runs: DataFrame, by: list[str]) -> DataFrame:
        if tasks <= 1:
            return runs
        return runs.repartition(max(tasks, df.sparkSession.sparkContext.defaultParallelism), *by)

    instant = F.unix_micros(F.col(time).cast("timestamp"))
    cells = (
        df.filter(F.col(time).isNotNull())
        .select(*keys, instant.alias("_us"), F.col(reading).alias("_reading"))
        .groupBy(*keys, (F.col("_us") - F.pmod("_us", F.lit(gap_us))).alias("_cell"))
        .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"),
             *combine.fold(F.col("_reading")))
    )
    if earlier is not None:
        start = F.col("_first") - F.pmod("_first", F.lit(gap_us))
        cells = cells.unionByName(earlier.withColumn("_cell", start))
    chunk_us = gap_us * max(1, isqrt(micros(_LONG_SPAN) // gap_us))
    chunked = cells.withColumn("_part", F.col("_cell") - F.pmod("_cell", F.lit(chunk_us)))
    local = _chain(dealt(chunked, [*keys, "_part"]), [*keys, "_part"], gap_us, combine)
    # Sessions strictly inside a chunk cannot meet another one. Both branches read the
    # same shuffle.
    whole = ["_first", "_last", *combine.parts]
    inner = local.filter(~F.col("_edge")).select(*keys, *whole)
    edges = dealt(local.filter("_edge").drop("_part", "_edge"), list(keys))
    outer = _chain(edges, list(keys), gap_us, combine)
    return inner.union(outer.select(*keys, *whole))


def close_sessions(
    runs: DataFrame,
    time_type: str,
    *,
    keys: Sequence[str],
    combine: Combine = COUNT,
    name: str = "n",
    gap: timedelta = HOUR,
) -> DataFrame:
    """Folded sessions as windows with their aggregate."""

    def as_time(us: Column) -> Column:
        return F.timestamp_micros(us).cast(time_type)

    return runs.select(
        *keys,
        as_time(F.col("_first")).alias(BOUNDS[0]),
        as_time(F.col("_last") + micros(gap)).alias(BOUNDS[1]),
        combine.result().alias(name),
    )


def _chain(runs: DataFrame, group: list[str], gap_us: int, combine: Combine) -> DataFrame:
    """Merge the disjoint runs of a group that are at most ``gap_us`` apart. ``_edge``
    tells the first and the last session of the group."""
    ordered = Window.partitionBy(*group).orderBy("_first")
    starts = F.col("_before").isNull() | (F.col("_first") - F.col("_before") > gap_us)
    # A session is named by the start of its first run.
    session = F.max(F.when(F.col("_starts"), F.col("_first"))).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    at_edge = F.col("_before").isNull() | F.col("_after").isNull()
    return (
        runs.withColumn("_before", F.lag("_last").over(ordered))
        .withColumn("_after", F.lead("_first").over(ordered))
        .withColumn("_starts", starts)
        .withColumn("_session", session)
        .groupBy(*group, "_session")
        .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"),
             F.bool_or(at_edge).alias("_edge"), *combine.merge_parts())
        .drop("_session")
    )
