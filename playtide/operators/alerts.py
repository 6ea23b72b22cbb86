"""Anomaly rules on stage clears. Two of them look at one row only; the third counts a user's recent clears."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.functions import score_cap
from playtide.operators.ordered import ARRIVAL, HOUR_MS, with_running_counts, with_trailing_count
from playtide.schema import ALERT_SCHEMA, names

# Rule names and thresholds.
IMPOSSIBLE_CLEAR = "IMPOSSIBLE_CLEAR"
RAPID_FIRE = "RAPID_FIRE"
SCORE_OVERFLOW = "SCORE_OVERFLOW"
MIN_CLEAR_MS = 500
RAPID_WINDOW_MS = 60_000
RAPID_COUNT = 20


def _clears(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type") == "stage_clear")


def _text(column: str) -> Column:
    """A missing id reads ``null`` in an alert text."""
    return F.coalesce(F.col(column), F.lit("null"))


def _alert(kind: str, description: Column, **set_columns: Column) -> Column:
    """An alert struct; what a rule leaves open is 0 or ''."""
    values = {
        "user_key": F.col("user_key"),
        "session_id": F.coalesce(F.col("session_id"), F.lit("")),
        "alert_type": F.lit(kind),
        "description": description,
        "detected_at": F.col("timestamp"),
        "event_id": F.col("event_id"),
        "stage_id": F.lit(""),
        "score": F.lit(0),
        "clear_time_ms": F.lit(0),
        "event_count": F.lit(0),
        **set_columns,
    }
    return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA.fields])


def _impossible_clear(min_ms: int) -> Column:
    text = F.format_string(f"Cleared stage %s in %dms (< {min_ms}ms threshold)", _text("stage_id"), F.col("clear_time_ms"))
    return F.when(
        (F.col("clear_time_ms") > 0) & (F.col("clear_time_ms") < min_ms),
        _alert(
            IMPOSSIBLE_CLEAR, text, stage_id=F.coalesce(F.col("stage_id"), F.lit("")), score=F.col("score"),
            clear_time_ms=F.col("clear_time_ms"),
        ),
    )


def _score_overflow() -> Column:
    cap = score_cap()
    text = F.format_string("Score %d exceeds max %d for grid %s", F.col("score"), cap, _text("grid_size"))
    return F.when(
        (cap > 0) & (F.col("score") > cap),
        _alert(SCORE_OVERFLOW, text, stage_id=F.coalesce(F.col("stage_id"), F.lit("")), score=F.col("score")),
    )


def row_alerts(df: DataFrame, min_clear_ms: int = MIN_CLEAR_MS) -> DataFrame:
    """Alerts of the rules that need a single event: a filter and projection, no shuffle. Works on streams too."""
    found = F.array_compact(F.array(_impossible_clear(min_clear_ms), _score_overflow()))
    return _clears(df).select(F.explode(found).alias("alert")).select("alert.*")


def impossible_clear(df: DataFrame, min_clear_ms: int = MIN_CLEAR_MS) -> DataFrame:
    """Clears faster than a person can be."""
    alert = _impossible_clear(min_clear_ms).alias("alert")
    return _clears(df).select(alert).filter(F.col("alert").isNotNull()).select("alert.*")


def score_overflow(df: DataFrame) -> DataFrame:
    """Clears that score more than their grid allows."""
    return _clears(df).select(_score_overflow().alias("alert")).filter(F.col("alert").isNotNull()).select("alert.*")


def rapid_fire(
    df: DataFrame, window_ms: int = RAPID_WINDOW_MS, threshold: int = RAPID_COUNT, slice_ms: int = HOUR_MS
) -> DataFrame:
    """Every clear that brings its user to ``threshold`` or more clears within the trailing window."""
    narrow = _clears(df).select("user_key", "session_id", *ARRIVAL)
    counted = with_trailing_count(narrow, ["user_key"], "recent", window_ms, slice_ms=slice_ms)
    return rapid_fire_alerts(counted, threshold)


def rapid_fire_alerts(counted: DataFrame, threshold: int = RAPID_COUNT) -> DataFrame:
    """The alerts of clears with their count ``recent`` in the trailing window."""
    text = F.format_string(f"%d stage clears in 1 minute (threshold: {threshold})", F.col("recent"))
    return (
        counted.filter(F.col("recent") >= threshold)
        .select(_alert(RAPID_FIRE, text, event_count=F.col("recent")).alias("alert"))
        .select("alert.*")
    )


def detect_anomalies(
    df: DataFrame,
    min_clear_ms: int = MIN_CLEAR_MS,
    window_ms: int = RAPID_WINDOW_MS,
    threshold: int = RAPID_COUNT,
) -> DataFrame:
    """All alerts; one event may raise up to three."""
    return row_alerts(df, min_clear_ms).unionByName(rapid_fire(df, window_ms, threshold)).select(*names(ALERT_SCHEMA))


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Alerts per user."""
    return alerts.groupBy("user_key").agg(F.count(F.lit(1)).alias("alerts"))


def with_alert_no(alerts: DataFrame) -> DataFrame:
    """Add ``alert_no``, the running number of the alert within its user; one event's alerts in rule order."""
    rank = F.array_position(F.array(F.lit(IMPOSSIBLE_CLEAR), F.lit(RAPID_FIRE), F.lit(SCORE_OVERFLOW)), F.col("alert_type"))
    ranked = alerts.withColumn("_rule", rank)
    order = ("detected_at", "event_id", "_rule")
    return with_running_counts(ranked, ["user_key"], {"alert_no": F.lit(True)}, order=order).drop("_rule")
