"""JSON messages -> typed columns, parsed once per record."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import decode_text
from tidemill.schema import (
    RAINFALL,
    RAINFALL_FIELD,
    TEMPERATURE,
    TEMPERATURE_FIELD,
    TIMESTAMP,
    TIMESTAMP_FIELD,
)

ERROR = "parse_error"

_CORRUPT = "_corrupt"
_WHITESPACE = " \t\r\n"

OnMalformed = Literal["fail", "quarantine"]
OnMissing = Literal["zero", "null"]
OnUnknown = Literal["ignore", "fail"]


def _is_blank(text: Column) -> Column:
    """Absent, JSON null, or a string that stands for it."""
    return text.isNull() | F.trim(text).isin("", "null")


def _number(text: Column, dtype: T.DataType, missing: OnMissing) -> Column:
    absent = F.lit(0 if missing == "zero" else None).cast(dtype)
    return F.when(_is_blank(text), absent).otherwise(text.try_cast(dtype))


def parse_json_records(
    messages: DataFrame,
    fields: Sequence[tuple[str, str, T.DataType]],
    *,
    value: str = "value",
    carry: Sequence[str] = (),
    times: Sequence[str] = (),
    on_malformed: OnMalformed = "fail",
    on_missing: OnMissing = "zero",
    on_unknown: OnUnknown = "ignore",
) -> DataFrame:
    """Parse one flat JSON object per row into typed columns.

    ``fields`` lists (JSON name, column name, type). Numbers may come as JSON
    numbers or as strings. A missing or null number is 0 or NULL by
    ``on_missing``; a missing string is NULL. A record that is no JSON object, or
    holds text where a number belongs (and, with ``on_unknown="fail"``, a field
    not listed) is malformed: it fails the job, or with ``"quarantine"`` comes
    out with the reason in the column ``parse_error`` (NULL on good rows); see
    :func:`accepted` and :func:`rejected`. ``times`` lists JSON names whose text must
    be a time for the record to be good.
    """
    text = "_text"
    schema = T.StructType(
        [T.StructField(name, T.StringType()) for name, _, _ in fields]
        + [T.StructField(_CORRUPT, T.StringType())]
    )
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        "allowSingleQuotes": "false",
        "allowNonNumericNumbers": "false",
    }
    # The parsed struct goes through a one-element generator: a later filter on a
    # parsed column cannot be moved below it, which would parse every record twice.
    kept = [c for c in carry if c != value]
    texts = messages.select(*kept, decode_text(F.col(value)).alias(text))
    rows = texts.select(
        *kept, text, F.inline(F.array(F.from_json(F.col(text), schema, options)))
    )

    reasons = [
        F.when(F.col(text).isNull(), "no value"),
        F.when(
            F.col(_CORRUPT).isNotNull()
            | ~F.startswith(F.ltrim(F.col(text), F.lit(_WHITESPACE)), F.lit("{")),
            "not a JSON object",
        ),
    ]
    for name, _, dtype in fields:
        if isinstance(dtype, T.StringType):
            continue
        raw = F.col(f"`{name}`")
        reasons.append(
            F.when(~_is_blank(raw) & raw.try_cast(dtype).isNull(), f"{name}: not a number")
        )
    for name in times:
        bad_time = F.try_to_timestamp(F.col(f"`{name}`")).isNull()
        reasons.append(F.when(bad_time, f"{name}: not a time"))
    if on_unknown == "fail":
        known = F.array(*[F.lit(name) for name, _, _ in fields])
        extra = F.array_except(F.json_object_keys(text), known)
        reasons.append(F.when(F.size(extra) > 0, "unknown field"))
    reason = F.coalesce(*reasons)

    typed = [
        (F.col(f"`{name}`") if isinstance(dtype, T.StringType)
         else _number(F.col(f"`{name}`"), dtype, on_missing)).alias(column)
        for name, column, dtype in fields
    ]
    if on_malformed == "quarantine":
        return rows.select(*kept, *typed, F.col(text).alias("raw_value"), reason.alias(ERROR))
    # As a filter the check runs for every record, whatever columns are used later.
    shown = F.coalesce(F.col(text), F.lit("NULL"))
    message = F.concat(F.lit("malformed record ("), reason, F.lit("): "), shown)
    checked = rows.filter(
        F.when(reason.isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    )
    return checked.select(*kept, *typed)


def parse_weather(
    messages: DataFrame, *, carry: Sequence[str] = ("topic",), timed: bool = False, **rules
) -> DataFrame:
    """Parse weather messages; ``rules`` are those of :func:`parse_json_records`.
    With ``timed``, a record needs a timestamp that can be read."""
    fields = [
        (TIMESTAMP_FIELD, TIMESTAMP, T.StringType()),
        (TEMPERATURE_FIELD, TEMPERATURE, T.FloatType()),
        (RAINFALL_FIELD, RAINFALL, T.FloatType()),
    ]
    times = [TIMESTAMP_FIELD] if timed else []
    return parse_json_records(messages, fields, carry=carry, times=times, **rules)


def accepted(parsed: DataFrame) -> DataFrame:
    """The good rows of a quarantine parse."""
    return parsed.filter(F.col(ERROR).isNull()).drop(ERROR, "raw_value")


def rejected(parsed: DataFrame, *carried: str) -> DataFrame:
    """The malformed rows of a quarantine parse, as they came."""
    return parsed.filter(F.col(ERROR).isNotNull()).select(*carried, "raw_value", ERROR)
