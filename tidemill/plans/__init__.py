from tidemill.plans.weather import (
    COMPLETE_DAILY_MEANS,
    COMPLETE_MOVING_MEANS,
    COMPLETE_RAIN_RUNS,
    daily_mean_lines,
    daily_means,
    json_lines,
    moving_mean_lines,
    moving_means,
    non_negative_lines,
    rain_run_lines,
    rain_runs,
    refreshing_mean_lines,
    start_stretch_job,
    temperatures,
    timed_readings,
)

__all__ = [
    "COMPLETE_DAILY_MEANS",
    "COMPLETE_MOVING_MEANS",
    "COMPLETE_RAIN_RUNS",
    "daily_mean_lines",
    "daily_means",
    "json_lines",
    "moving_mean_lines",
    "moving_means",
    "non_negative_lines",
    "rain_run_lines",
    "rain_runs",
    "refreshing_mean_lines",
    "start_stretch_job",
    "temperatures",
    "timed_readings",
]
