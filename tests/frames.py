"""Hand-made event rows: only the columns a test names differ from the defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playtide.schema import EVENT_SCHEMA

DEFAULTS = {
    "event_type": "stage_clear", "user_key": "u", "session_id": "s", "timestamp": 0, "client_timestamp": 0,
    "app_version": "1", "schema_version": "2", "seq": 0, "mode": "story", "stage_id": "1-1", "grid_size": "3x3",
    "time_limit_sec": 0, "clear_time_ms": 0, "taps": 0, "score": 0, "bonus_collected": 0, "universal_used": 0,
    "completion_pct": 0, "duration_ms": 0, "platform": "", "from_screen": "", "to_screen": "", "action": "",
    "item_type": "", "reason": "",
}


def events(spark: SparkSession, rows: list[dict], partitions: int | None = None) -> DataFrame:
    filled = [{"event_id": f"e{i:06d}", **DEFAULTS, **row} for i, row in enumerate(rows)]
    df = spark.createDataFrame([tuple(r[f.name] for f in EVENT_SCHEMA.fields) for r in filled], EVENT_SCHEMA)
    return df.repartition(partitions) if partitions else df


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
