"""Built-in column expressions: they stay inside whole-stage code generation and never call Python per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds, limits and caps of the event rules.
LATE_MS = 30_000
BOT_PATTERN = "user_bot%"
REPORT_ZONE = "Asia/Seoul"
SCORE_CAPS = {"3x3": 500, "3x4": 600, "4x3": 600, "4x4": 600, "5x5": 700}
DEFAULT_SCORE_CAP = 700
BASE_POINTS = 100
BONUS_POINTS = 50
SPEED_POINTS = ((3_000, 200), (5_000, 150), (10_000, 100))


def rounded(value: Column, digits: int = 0, rounding: str = "half_even") -> Column:
    """Round a double at ``digits`` places.

    ``half_even`` scales, rounds to the nearest even integer and scales back; ``half_up`` moves ties upwards.
    """
    scale = float(10**digits)
    scaled = value.cast("double") * F.lit(scale)
    if rounding == "half_even":
        return F.rint(scaled) / F.lit(scale)
    if rounding == "half_up":
        return F.floor(scaled + F.lit(0.5)) / F.lit(scale)
    raise ValueError(f"unknown rounding {rounding!r}")


def per_cent(part: Column, whole: Column, digits: int, rounding: str = "half_even") -> Column:
    """``part`` of ``whole`` in per cent; null when there is nothing to divide by."""
    return rounded(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), digits, rounding)


def mean(value: Column, digits: int | None = None, rounding: str = "half_even") -> Column:
    """Mean that is null for no rows, optionally rounded."""
    average = F.avg(value)
    return average if digits is None else rounded(average, digits, rounding)


def event_ts(ms: Column | str = "timestamp") -> Column:
    """Epoch milliseconds as a timestamp."""
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def day(ms: Column | str = "timestamp") -> Column:
    """UTC calendar day of an epoch millisecond column."""
    return F.to_date(event_ts(ms))


def local_hour(ms: Column | str = "timestamp", zone: str = REPORT_ZONE) -> Column:
    """Start of the hour on the wall clock of ``zone``."""
    return F.date_trunc("HOUR", F.from_utc_timestamp(event_ts(ms), zone))


def hour_label(ms: Column | str = "timestamp", zone: str = REPORT_ZONE) -> Column:
    """Hour of day in ``zone`` as ``HH:00``."""
    return F.date_format(F.from_utc_timestamp(event_ts(ms), zone), "HH:00")


def is_bot(user: Column | str = "user_key", pattern: str = BOT_PATTERN) -> Column:
    """Users the dashboards leave out. ``_`` in the pattern matches any one character."""
    return (F.col(user) if isinstance(user, str) else user).like(pattern)


def latency_ms() -> Column:
    """Server time minus client time."""
    return F.col("timestamp") - F.col("client_timestamp")


def late(threshold_ms: int = LATE_MS) -> Column:
    """True when the two clocks differ by more than the threshold, in either direction."""
    return F.abs(latency_ms()) > F.lit(threshold_ms)


def stage_part(stage: Column | str, index: int) -> Column:
    """The ``index``-th number of a ``chapter-stage`` (or ``ta-N``) id, 0 where it is not a number."""
    stage = F.col(stage) if isinstance(stage, str) else stage
    return F.coalesce(F.split_part(stage, F.lit("-"), F.lit(index)).try_cast("int"), F.lit(0))


def json_text(payload: Column | str, field: str) -> Column:
    """A payload field as text, '' when absent."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    return F.coalesce(F.get_json_object(payload, f"$.{field}"), F.lit(""))


def json_number(payload: Column | str, field: str, kind: str = "double") -> Column:
    """A payload field as a number, 0 when absent or not a number."""
    return F.coalesce(json_text(payload, field).try_cast(kind), F.lit(0).cast(kind))


def score_cap(grid: Column | str = "grid_size") -> Column:
    """Highest score a grid allows; 0 switches the rule off when there is no grid."""
    grid = F.col(grid) if isinstance(grid, str) else grid
    cap = F.when(grid.isNull(), F.lit(0))
    for size, limit in SCORE_CAPS.items():
        cap = cap.when(grid == size, F.lit(limit))
    return cap.otherwise(F.lit(DEFAULT_SCORE_CAP))


def bucket(value: Column, limits: Sequence[tuple[float, object]], last: object, inclusive: bool = False) -> Column:
    """The label of the first limit the value is below (or, inclusive, not above), else ``last``."""
    label = F.lit(last)
    for limit, name in reversed(limits):
        label = F.when((value <= limit) if inclusive else (value < limit), F.lit(name)).otherwise(label)
    return label


def clear_points(mode: Column, clear_time_ms: Column, bonus: Column) -> Column:
    """Points the game awards for one clear."""
    speed = bucket(clear_time_ms, SPEED_POINTS, 0)
    return F.lit(BASE_POINTS) + F.when(mode == "time_attack", speed).otherwise(0) + bonus * F.lit(BONUS_POINTS)
