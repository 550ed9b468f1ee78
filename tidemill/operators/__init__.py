from tidemill.operators.cleaning import clean_observations
from tidemill.operators.eventtime import (
    filter_above_watermark,
    watermark_per_source,
    with_event_time,
    with_watermark,
)
from tidemill.operators.filters import keep_above, keep_at_least
from tidemill.operators.panes import pane_mean
from tidemill.operators.projection import extract, passthrough, project
from tidemill.operators.records import ERROR, accepted, parse_json_records, parse_weather, rejected
from tidemill.operators.windows import session_combine, sliding_combine, tumbling_combine

__all__ = [
    "ERROR",
    "accepted",
    "clean_observations",
    "extract",
    "filter_above_watermark",
    "keep_above",
    "keep_at_least",
    "pane_mean",
    "parse_json_records",
    "parse_weather",
    "passthrough",
    "project",
    "rejected",
    "session_combine",
    "sliding_combine",
    "tumbling_combine",
    "watermark_per_source",
    "with_event_time",
    "with_watermark",
]
