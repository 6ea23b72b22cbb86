"""Explicit schemas of the event stream and of the tables the jobs write."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Names, order and types of a version 2 event record.
EVENT_SCHEMA = _struct(
    ("event_id", _S), ("event_type", _S), ("user_key", _S), ("session_id", _S),
    ("timestamp", _L), ("client_timestamp", _L), ("app_version", _S), ("schema_version", _S),
    ("seq", _I), ("mode", _S), ("stage_id", _S), ("grid_size", _S), ("time_limit_sec", _I),
    ("clear_time_ms", _L), ("taps", _I), ("score", _I), ("bonus_collected", _I),
    ("universal_used", _I), ("completion_pct", _I), ("duration_ms", _L), ("platform", _S),
    ("from_screen", _S), ("to_screen", _S), ("action", _S), ("item_type", _S), ("reason", _S),
)

# Payload fields that become columns; everything else goes to ``extra``.
STRUCTURED_FIELDS = (
    "seq", "mode", "stage_id", "grid_size", "time_limit_sec", "clear_time_ms", "taps", "score", "bonus_collected",
    "universal_used", "completion_pct", "duration_ms", "platform", "action", "item_type", "reason", "cost",
    "remaining", "from_screen", "to_screen",
)

# Payload names that differ from the column names.
RENAMED_FIELDS = {"from": "from_screen", "to": "to_screen"}

#: Columns an accepted record may carry on top of :data:`EVENT_SCHEMA`.
INGEST_COLUMNS = (("cost", _I), ("remaining", _I), ("extra", _S), ("payload", _S))

#: One HTTP request: a user and its buffered events. Variants keep what the client sent, so its type can be checked.
BATCH_EVENT_SCHEMA = _struct(
    ("event_type", _S), ("session_id", _S), ("client_timestamp", T.VariantType()),
    ("app_version", T.VariantType()), ("schema_version", T.VariantType()), ("payload", T.VariantType()),
)
BATCH_SCHEMA = _struct(
    ("user_key", _S), ("app_version", _S), ("events", T.ArrayType(BATCH_EVENT_SCHEMA)),
)

SESSION_SCHEMA = _struct(
    ("user_key", _S), ("session_id", _S), ("session_start", _L), ("session_end", _L), ("duration_ms", _L),
    ("total_events", _L), ("stage_clears", _L), ("stage_fails", _L), ("total_score", _L), ("primary_mode", _S),
    ("distinct_stages", _L), ("avg_clear_time_ms", _D), ("universal_used", _L), ("navigations", _L),
)

ALERT_SCHEMA = _struct(
    ("user_key", _S), ("session_id", _S), ("alert_type", _S), ("description", _S), ("detected_at", _L),
    ("event_id", _S), ("stage_id", _S), ("score", _L), ("clear_time_ms", _L), ("event_count", _L),
)

#: The stored tables add the time of writing.
SESSION_FACT_SCHEMA = T.StructType([*SESSION_SCHEMA.fields, T.StructField("created_at", _TS)])
ALERT_FACT_SCHEMA = T.StructType([*ALERT_SCHEMA.fields, T.StructField("created_at", _TS)])

LEADERBOARD_SCHEMA = _struct(
    ("entry_id", _S), ("user_key", _S), ("mode", _S), ("time_limit_sec", _I), ("score", _I), ("stages_cleared", _I),
    ("avg_clear_ms", _I), ("universal_used", _I), ("played_at", _TS),
)

USER_SCHEMA = _struct(("user_key", _S), ("nickname", _S), ("created_at", _TS), ("last_seen_at", _TS))

PROGRESS_SCHEMA = _struct(
    ("user_key", _S), ("stage_id", _S), ("best_time_ms", _L), ("clear_count", _L), ("universal_used", _L),
    ("first_cleared_at", _L), ("updated_at", _L),
)


def names(schema: T.StructType) -> list[str]:
    return [field.name for field in schema.fields]
