"""Raw observation rows -> tidy hourly readings."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import local_datetime_text
from tidemill.schema import FILE, LOCAL_OFFSET, READING_FIELDS

# How a data row begins (no line above the data begins with a digit),
# how its time is written, and how a file names the days it covers (last day included).
DATA_ROW = r"^\s*\d"
RAW_TIME = "yyyy/M/d H:mm:ss XXX"
FILE_DAYS = r"^(\d{8})-(\d{8})"


def _named_day(file_name: Column, group: int) -> Column:
    text = F.regexp_extract(F.substring_index(file_name, "/", -1), FILE_DAYS, group)
    unnamed = F.raise_error(F.concat(F.lit("no days in file name: "), file_name)).cast("date")
    return F.when(text == "", unnamed).otherwise(F.to_date(text, "yyyyMMdd"))


def clean_observations(
    raw: DataFrame,
    *,
    first_day: date | None = None,
    last_day: date | None = None,
    keep_file: bool = False,
) -> DataFrame:
    """Keep the data rows of the covered days, in three renamed text columns; with
    ``keep_file`` also ``file``, the file's name (or path below a root) without its suffix,
    which says the station.

    Preamble, header and sub-header lines are told by their first column, not by
    position, so a split of a large file needs no neighbour. A line that begins with
    a digit is a data row: if its time cannot be read, the job fails. The covered days
    come from the file name (column ``file_name``) unless given. Readings stay
    text, as in the source; a missing one is NULL in its own column.
    """
    rows = raw.filter(F.col("c0").rlike(DATA_ROW))
    unreadable = F.raise_error(F.concat(F.lit("unreadable time: "), "c0")).cast("timestamp")
    instant = F.coalesce(
        F.try_to_timestamp(F.concat("c0", F.lit(f" {LOCAL_OFFSET}")), F.lit(RAW_TIME)), unreadable
    )
    day = F.to_date(F.from_utc_timestamp(F.col("_instant"), LOCAL_OFFSET))
    first = F.lit(first_day) if first_day else _named_day(F.col("file_name"), 1)
    if last_day:
        end = F.lit(last_day + timedelta(days=1))
    else:
        end = F.date_add(_named_day(F.col("file_name"), 2), 1)
    # Through a one-element generator, below which the filter cannot be moved: there it
    # would parse every time again.
    timed = rows.select("*", F.explode(F.array(instant)).alias("_instant"))
    kept = timed.filter((day >= first) & (day < end))
    values = (local_datetime_text(F.col("_instant")), F.col("c1"), F.col("c4"))
    named = [v.alias(name) for v, name in zip(values, READING_FIELDS, strict=True)]
    if keep_file:
        named.append(F.regexp_replace("file_name", r"\.[^./]*$", "").alias(FILE))
    return kept.select(*named)
