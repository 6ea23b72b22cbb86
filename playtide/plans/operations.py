"""Operations and data-quality reports.

Every function takes the frame it reads (``events``: event facts, ``daily``: daily user summary, ``sessions``,
``alerts``) and returns a small result. Event reports look at the current schema version unless told otherwise.
Distinct counts group by user before they count, so a frequent user is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtide.functions import bucket, day, is_bot, late, latency_ms, local_hour, mean, per_cent, rounded
from playtide.functions.expressions import LATE_MS, REPORT_ZONE
from playtide.operators.ingest import CURRENT_SCHEMA_VERSION

# Latency buckets (upper bound exclusive) and the fields whose fill rate is reported.
LATENCY_BUCKETS = ((1_000, "< 1s"), (5_000, "1-5s"), (10_000, "5-10s"), (30_000, "10-30s"))
LAST_LATENCY_BUCKET = "30s+"
FILL_FIELDS = (
    ("mode_pct", "mode"), ("stage_id_pct", "stage_id"), ("grid_pct", "grid_size"),
    ("score_pct", "score"), ("clear_time_pct", "clear_time_ms"), ("seq_pct", "seq"),
)
MAX_SESSION_MS = 7_200_000
MAX_SESSION_EVENTS = 500
MAX_SESSION_CLEARS = 100


def scope(
    events: DataFrame,
    *types: str,
    mode: str | None = None,
    bots: bool = True,
    version: str | None = CURRENT_SCHEMA_VERSION,
) -> DataFrame:
    """The event rows a report looks at. All conditions are plain comparisons, so they reach the scan."""
    if version is not None:
        events = events.filter(F.col("schema_version") == version)
    if types:
        events = events.filter(F.col("event_type").isin(*types))
    if mode is not None:
        events = events.filter(F.col("mode") == mode)
    return events if bots else events.filter(~is_bot())


def total_events(events: DataFrame, version: str | None = CURRENT_SCHEMA_VERSION) -> DataFrame:
    return scope(events, version=version).agg(F.count(F.lit(1)).alias("total"))


def total_users(events: DataFrame) -> DataFrame:
    return scope(events).agg(F.count_distinct("user_key").alias("users"))


def dau_trend(daily: DataFrame, since: Column | None = None) -> DataFrame:
    """Active users per day, optionally from a day on."""
    rows = daily if since is None else daily.filter(F.col("day") >= since)
    return rows.groupBy("day").agg(F.count_distinct("user_key").alias("dau")).orderBy("day")


def latest_dau(daily: DataFrame, before: Column | None = None) -> DataFrame:
    """Active users of the latest day, optionally the latest one before a given day."""
    rows = daily if before is None else daily.filter(F.col("day") < before)
    newest = rows.agg(F.max("day")).scalar()
    return rows.filter(F.col("day") == newest).agg(F.count_distinct("user_key").alias("dau"))


def clears_per_user_day(daily: DataFrame) -> DataFrame:
    """Mean clears of a (user, day, mode) row that has any."""
    return daily.filter(F.col("clears") > 0).agg(mean(F.col("clears"), 1).alias("avg_clears"))


def total_rows(rows: DataFrame, name: str = "total") -> DataFrame:
    """Number of rows of a table, as shown for alerts and sessions."""
    return rows.agg(F.count(F.lit(1)).alias(name))


def daily_events(events: DataFrame, since_ms: int | None = None) -> DataFrame:
    """Events, clears and fails per day."""
    rows = scope(events)
    if since_ms is not None:
        rows = rows.filter(F.col("timestamp") >= since_ms)
    return (
        rows.groupBy(day().alias("day"))
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_if(F.col("event_type") == "stage_clear").alias("clears"),
            F.count_if(F.col("event_type") == "stage_fail").alias("fails"),
        )
        .orderBy("day")
    )


def event_types(events: DataFrame) -> DataFrame:
    """Events per type and their share in per cent."""
    counts = scope(events).groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    everything = Window.partitionBy()  # over the counted types, a handful of rows
    return counts.withColumn("pct", per_cent(F.col("cnt"), F.sum("cnt").over(everything), 1)).orderBy(
        F.desc("cnt"), "event_type"
    )


def hourly_events(events: DataFrame, zone: str = REPORT_ZONE, since_ms: int | None = None) -> DataFrame:
    """Events per hour on the report's wall clock."""
    rows = scope(events)
    if since_ms is not None:
        rows = rows.filter(F.col("timestamp") >= since_ms)
    return rows.groupBy(local_hour(zone=zone).alias("hour")).agg(F.count(F.lit(1)).alias("events")).orderBy("hour")


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Alerts, users and last detection (UTC text) per alert type."""
    last = F.timestamp_seconds(F.floor(F.max("detected_at") / F.lit(1000)))
    return (
        alerts.groupBy("alert_type")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.count_distinct("user_key").alias("users"),
            F.date_format(last, "yyyy-MM-dd HH:mm:ss").alias("last_detected"),
        )
        .orderBy(F.desc("cnt"), "alert_type")
    )


def late_share(events: DataFrame, threshold_ms: int = LATE_MS) -> DataFrame:
    """Share of late events in per cent."""
    return scope(events).agg(per_cent(F.count_if(late(threshold_ms)), F.count(F.lit(1)), 2).alias("late_pct"))


def daily_late_share(events: DataFrame, threshold_ms: int = LATE_MS) -> DataFrame:
    """Share of late events per day in per cent."""
    return (
        scope(events)
        .groupBy(day().alias("day"))
        .agg(per_cent(F.count_if(late(threshold_ms)), F.count(F.lit(1)), 2).alias("late_pct"))
        .orderBy("day")
    )


def current_version_share(events: DataFrame) -> DataFrame:
    """Share of current-version events among all, in per cent."""
    current = F.count_if(F.col("schema_version") == CURRENT_SCHEMA_VERSION)
    return events.agg(per_cent(current, F.count(F.lit(1)), 1).alias("v2_pct"))


def flagged_users(alerts: DataFrame) -> DataFrame:
    """Users with any alert."""
    return alerts.agg(F.count_distinct("user_key").alias("users"))


def latency_buckets(events: DataFrame) -> DataFrame:
    """Events by distance between server and client clock, with their share in per cent."""
    distance = F.abs(latency_ms())
    label = bucket(distance, LATENCY_BUCKETS, LAST_LATENCY_BUCKET)
    numbers = [(limit, position) for position, (limit, _) in enumerate(LATENCY_BUCKETS, start=1)]
    number = bucket(distance, numbers, len(numbers) + 1)
    counts = scope(events).groupBy(label.alias("bucket"), number.alias("bucket_no")).agg(F.count(F.lit(1)).alias("cnt"))
    everything = Window.partitionBy()  # over at most five rows
    return (
        counts.withColumn("pct", per_cent(F.col("cnt"), F.sum("cnt").over(everything), 2))
        .orderBy("bucket_no")
        .select("bucket", "cnt", "pct")
    )


def alert_types(alerts: DataFrame) -> DataFrame:
    """Alerts per type."""
    return alerts.groupBy("alert_type").agg(F.count(F.lit(1)).alias("cnt"))


def latest_alerts(alerts: DataFrame, limit: int = 50) -> DataFrame:
    """The newest alerts; Spark keeps ``limit`` rows per task and merges them."""
    detected = F.date_format(F.timestamp_seconds(F.floor(F.col("detected_at") / F.lit(1000))), "yyyy-MM-dd HH:mm:ss")
    return (
        alerts.orderBy(F.desc("detected_at"), "event_id", "alert_type")
        .limit(limit)
        .select(
            detected.alias("detected"), "alert_type", "user_key", "stage_id", "score", "clear_time_ms", "description"
        )
    )


def schema_versions(events: DataFrame) -> DataFrame:
    """Events per schema version."""
    return events.groupBy("schema_version").agg(F.count(F.lit(1)).alias("cnt"))


def fill_rates(events: DataFrame, by: str = "event_type", fields: tuple[tuple[str, str], ...] = FILL_FIELDS) -> DataFrame:
    """Share of rows per group where each field is set (text not empty, number above 0), in whole per cent."""
    rows = scope(events)
    text = {f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"}

    def filled(column: str) -> Column:
        return (F.col(column) != "") if column in text else (F.col(column) > 0)

    return (
        rows.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("total"),
            *[per_cent(F.count_if(filled(column)), F.count(F.lit(1)), 0).alias(name) for name, column in fields],
        )
        .orderBy(F.desc("total"), by)
    )


def session_minutes(sessions: DataFrame, below_ms: int | None = MAX_SESSION_MS) -> DataFrame:
    """Mean session length in minutes, of sessions longer than 0 and shorter than the limit."""
    rows = sessions.filter(F.col("duration_ms") > 0)
    if below_ms is not None:
        rows = rows.filter(F.col("duration_ms") < below_ms)
    return rows.agg(rounded(F.avg("duration_ms") / 1000 / 60, 1).alias("minutes"))


def session_minutes_text(sessions: DataFrame, unit: str = "분") -> DataFrame:
    """The mean session length as display text."""
    return session_minutes(sessions).select(F.concat(F.col("minutes").cast("string"), F.lit(f" {unit}")).alias("label"))


def session_seconds(sessions: DataFrame) -> DataFrame:
    """Mean session length in whole seconds, of sessions longer than 0."""
    return sessions.filter(F.col("duration_ms") > 0).agg(rounded(F.avg("duration_ms") / 1000, 0).alias("seconds"))


def events_per_session(sessions: DataFrame, below: int | None = MAX_SESSION_EVENTS, digits: int = 1) -> DataFrame:
    """Mean number of events of a session."""
    rows = sessions if below is None else sessions.filter((F.col("total_events") > 0) & (F.col("total_events") < below))
    return rows.agg(mean(F.col("total_events"), digits).alias("avg_events"))


def clears_per_session(sessions: DataFrame, below: int | None = MAX_SESSION_CLEARS) -> DataFrame:
    """Mean clears of a session that has any."""
    rows = sessions.filter(F.col("stage_clears") > 0)
    if below is not None:
        rows = rows.filter(F.col("stage_clears") < below)
    return rows.agg(mean(F.col("stage_clears"), 1).alias("avg_clears"))


def events_per_day(events: DataFrame) -> DataFrame:
    """Mean number of events per day."""
    return daily_events(events).agg(mean(F.col("total_events"), 0).alias("avg_events"))
