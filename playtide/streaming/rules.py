"""Rules that Spark's own streaming operators express; those that carry more state are in ``carried``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.functions import late
from playtide.functions.expressions import LATE_MS


def with_arrival(df: DataFrame, delay: str, name: str = "arrived_at") -> DataFrame:
    """Add the time a row reached the stream, with the watermark on it: that clock only grows, so no row is ever late."""
    return df.withColumn(name, F.current_timestamp()).withWatermark(name, delay)


def dedup_stream(df: DataFrame, ttl: str = "1 hour", key: str = "event_id") -> DataFrame:
    """Drop copies of an id that arrive within ``ttl`` of the first one, by the clock of arrival."""
    return with_arrival(df, ttl).dropDuplicatesWithinWatermark([key]).drop("arrived_at")


def observe_quality(df: DataFrame, name: str = "quality", threshold_ms: int = LATE_MS) -> DataFrame:
    """Report events and late events of each micro-batch as observed metrics; rows pass unchanged."""
    return df.observe(name, F.count(F.lit(1)).alias("total"), F.count_if(late(threshold_ms)).alias("late"))
