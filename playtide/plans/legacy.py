"""Reports on first-version events, whose details sit in a JSON ``payload``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.functions import event_ts, hour_label, json_number, json_text, mean, rounded

# First-version event types by meaning, and the session lengths that count.
TIME_ATTACK_CLEAR = "stage_clear"
STORY_CLEAR = "story_stage_clear"
ROUND_END = "time_attack_end"
GAME_START = "game_start"
PLAY_TYPES = ("game_start", "stage_start", "stage_clear", "story_stage_clear")
SESSION_SECONDS = (5, 10_800)


def active_users(events: DataFrame, as_of_ms: int | Column, hours: int = 24, error: float = 0.05) -> DataFrame:
    """Approximate number of users active in the hours before ``as_of_ms``."""
    recent = events.filter(F.col("timestamp") >= as_of_ms - hours * 3_600_000)
    return recent.agg(F.approx_count_distinct("user_key", error).alias("active_users"))


def completion_rate(events: DataFrame) -> DataFrame:
    """Time-attack rounds finished per game started."""
    ended = F.count_if(F.col("event_type") == ROUND_END).cast("double")
    started = F.greatest(F.count_if(F.col("event_type") == GAME_START), F.lit(1))
    return events.agg((ended / started).alias("rate"))


def clear_time(events: DataFrame, event_type: str = TIME_ATTACK_CLEAR) -> DataFrame:
    """Mean clear time of one clear type; text that is not a number counts as 0."""
    rows = events.filter((F.col("event_type") == event_type) & (json_text("payload", "clear_time_ms") != ""))
    return rows.agg(mean(json_number("payload", "clear_time_ms")).alias("avg_ms"))


def events_per_hour(events: DataFrame, from_ms: int, to_ms: int) -> DataFrame:
    """Events per hour within a time range, both ends included."""
    return (
        events.filter(F.col("timestamp").between(from_ms, to_ms))
        .groupBy(F.date_trunc("HOUR", event_ts()).alias("hour"))
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy("hour")
    )


def grid_clear_times(events: DataFrame) -> DataFrame:
    """Mean clear time per grid, one column per mode; the event type tells the mode."""
    clears = (
        events.filter(F.col("event_type").isin(TIME_ATTACK_CLEAR, STORY_CLEAR))
        .select(
            "event_type",
            json_text("payload", "grid_size").alias("grid_size"),
            json_text("payload", "clear_time_ms").alias("raw_ms"),
            json_number("payload", "clear_time_ms").alias("clear_ms"),
        )
        .filter((F.col("grid_size") != "") & (F.col("raw_ms") != ""))
    )
    return (
        clears.groupBy("grid_size")
        .agg(
            rounded(F.avg(F.when(F.col("event_type") == TIME_ATTACK_CLEAR, F.col("clear_ms"))), 0).alias("time_attack"),
            rounded(F.avg(F.when(F.col("event_type") == STORY_CLEAR, F.col("clear_ms"))), 0).alias("story"),
        )
        .orderBy("grid_size")
    )


def stage_funnel(events: DataFrame) -> DataFrame:
    """Clears per stage number, in number order."""
    return (
        events.filter(F.col("event_type").isin(TIME_ATTACK_CLEAR, STORY_CLEAR) & (json_text("payload", "stage_num") != ""))
        .groupBy(json_number("payload", "stage_num", "int").alias("stage_no"))
        .agg(F.count(F.lit(1)).alias("clears"))
        .orderBy("stage_no")
        .select(F.col("stage_no").cast("string").alias("stage"), "clears")
    )


def play_hours(events: DataFrame) -> DataFrame:
    """Starts and clears per hour of day on the report's wall clock."""
    return (
        events.filter(F.col("event_type").isin(*PLAY_TYPES))
        .groupBy(hour_label().alias("hour_kst"))
        .agg(F.count(F.lit(1)).alias("plays"))
        .orderBy("hour_kst")
    )


def session_length(events: DataFrame, above: int = SESSION_SECONDS[0], below: int = SESSION_SECONDS[1]) -> DataFrame:
    """Mean seconds between first and last event of a session, of sessions within the bounds."""
    seconds = F.floor(F.max("timestamp") / F.lit(1000)) - F.floor(F.min("timestamp") / F.lit(1000))
    lengths = events.groupBy("session_id").agg(seconds.alias("seconds"))
    return lengths.filter((F.col("seconds") > above) & (F.col("seconds") < below)).agg(
        mean(F.col("seconds"), 0).alias("avg_sec")
    )
