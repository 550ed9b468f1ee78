from tidemill.functions.codec import decode_long, decode_text, encode_long, encode_text
from tidemill.functions.combine import COUNT, EXACT_MEAN, MEAN, MEAN_AND_COUNT, Combine
from tidemill.functions.lines import (
    daily_mean_line,
    moving_mean_line,
    rain_run_line,
    reading_line,
    refreshing_mean_line,
    temperature_line,
)
from tidemill.functions.timetext import (
    interval_text,
    local_date,
    local_datetime_text,
    micros,
    parse_instant,
)

__all__ = [
    "COUNT",
    "EXACT_MEAN",
    "Combine",
    "MEAN",
    "MEAN_AND_COUNT",
    "daily_mean_line",
    "decode_long",
    "decode_text",
    "encode_long",
    "encode_text",
    "interval_text",
    "local_date",
    "local_datetime_text",
    "micros",
    "moving_mean_line",
    "parse_instant",
    "rain_run_line",
    "reading_line",
    "refreshing_mean_line",
    "temperature_line",
]
