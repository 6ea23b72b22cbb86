"""Column expressions shared by the operators and the reports."""

from playtide.functions.expressions import (
    bucket,
    clear_points,
    day,
    event_ts,
    hour_label,
    is_bot,
    json_number,
    json_text,
    late,
    latency_ms,
    local_hour,
    mean,
    per_cent,
    rounded,
    score_cap,
    stage_part,
)

__all__ = [
    "bucket", "clear_points", "day", "event_ts", "hour_label", "is_bot", "json_number", "json_text", "late", "latency_ms",
    "local_hour", "mean", "per_cent", "rounded", "score_cap", "stage_part",
]
