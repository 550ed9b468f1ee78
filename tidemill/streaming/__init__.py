from tidemill.streaming.complete import (
    Stretch,
    closed_sessions,
    late_rows,
    start_complete_stretches,
    write_numbered,
)
from tidemill.streaming.late import LateRows, LateRowsError
from tidemill.streaming.panes import start_pane_means, timer_pane_means
from tidemill.streaming.run import drain_timers_to_table, drain_to_table
from tidemill.streaming.split import accepted_stream, rejected_stream, start_split

__all__ = [
    "LateRows",
    "LateRowsError",
    "Stretch",
    "accepted_stream",
    "closed_sessions",
    "drain_timers_to_table",
    "drain_to_table",
    "late_rows",
    "rejected_stream",
    "start_complete_stretches",
    "start_pane_means",
    "start_split",
    "timer_pane_means",
    "write_numbered",
]
