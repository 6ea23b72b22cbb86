"""Per-event quality rules: lateness, lost events and long silences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtide.functions import late, latency_ms
from playtide.functions.expressions import LATE_MS
from playtide.operators.ordered import ARRIVAL, HOUR_MS, time_slice, with_previous, with_running_counts

# A silence longer than this is reported.
SILENCE_MS = 1_800_000


def with_latency(df: DataFrame) -> DataFrame:
    """Add ``latency_ms``, server minus client time."""
    return df.withColumn("latency_ms", latency_ms())


def flag_late(df: DataFrame, threshold_ms: int = LATE_MS) -> DataFrame:
    """Add ``is_late``; no event is dropped."""
    return df.withColumn("is_late", late(threshold_ms))


def with_event_no(df: DataFrame, slice_ms: int = HOUR_MS) -> DataFrame:
    """Add ``event_no``, the running number of the event within its user."""
    return with_running_counts(df, ["user_key"], {"event_no": F.lit(True)}, slice_ms=slice_ms)


def seq_gaps(df: DataFrame, slice_ms: int = HOUR_MS) -> DataFrame:
    """Events whose sequence number skips ahead of the user's previous numbered event in the same session.

    Only positive numbers take part; they neither look at nor leave a trace of unnumbered events.
    """
    numbered = df.filter(F.col("seq") > 0).select(*ARRIVAL, "user_key", "session_id")
    step = with_previous(numbered, ["user_key"], ["session_id", "seq"], slice_ms=slice_ms)
    expected = F.col("previous.seq") + 1
    skipped = (F.col("previous.session_id") == F.col("session_id")) & (F.col("seq") > expected)
    return step.filter(skipped).select(
        "user_key", "session_id", "event_id", "timestamp",
        expected.alias("expected_seq"), "seq", (F.col("seq") - expected).alias("missing"),
    )


def inactivity_gaps(df: DataFrame, silence_ms: int = SILENCE_MS) -> DataFrame:
    """Events that end a silence longer than ``silence_ms``, with whole minutes of it and the user's event number.

    Two events in one time slice of that width cannot be further apart than the width, so only the first event of a
    slice can end a silence: users and times meet one hash aggregation per (user, slice), and only the events at the
    times so found, most often one each, are compared to tell which came first.
    """
    slices = (
        df.withColumn("_slice", time_slice("timestamp", silence_ms))
        .groupBy("user_key", "_slice")
        .agg(F.min("timestamp").alias("_first_ms"), F.max("timestamp").alias("_last_ms"), F.count(F.lit(1)).alias("_rows"))
    )
    by_user = Window.partitionBy("user_key").orderBy("_slice")
    gap = F.col("_first_ms") - F.lag("_last_ms").over(by_user)
    number = F.sum("_rows").over(by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_rows") + 1
    silences = slices.select(
        F.col("user_key").alias("_user"), F.col("_first_ms"), gap.alias("gap_ms"), number.alias("event_no")
    ).filter(F.col("gap_ms") > F.lit(silence_ms))
    ends = (
        df.select("user_key", *ARRIVAL)
        .join(silences, F.col("user_key").eqNullSafe(F.col("_user")) & (F.col("timestamp") == F.col("_first_ms")))
        .groupBy("user_key", "timestamp", "gap_ms", "event_no")
        .agg(F.min(F.struct("seq", "event_id"))["event_id"].alias("event_id"))
    )
    return ends.select(
        "user_key", "event_id", "timestamp", "gap_ms", F.floor(F.col("gap_ms") / F.lit(60_000)).alias("gap_minutes"), "event_no"
    )


def quality_stats(df: DataFrame, threshold_ms: int = LATE_MS) -> DataFrame:
    """One row: events, events on time, late events and the late share in per cent (not rounded)."""
    is_late = late(threshold_ms)
    total, late_count = F.count(F.lit(1)), F.count_if(is_late)
    return df.agg(
        total.alias("total"),
        F.count_if(~is_late).alias("normal"),
        late_count.alias("late"),
        F.try_divide(late_count.cast("double") * F.lit(100.0), total.cast("double")).alias("late_rate"),
    )


def running_quality_stats(
    df: DataFrame, every: int = 1000, threshold_ms: int = LATE_MS, slice_ms: int = 1000
) -> DataFrame:
    """The quality counters after each ``every`` events, in arrival order over all users.

    The count runs over all rows, so the slices are short: a task sorts one second of traffic. The counts are carried from
    second to second within a span of slices, and from span to span.
    """
    narrow = df.select(*ARRIVAL, late(threshold_ms).alias("_late"))
    counted = with_running_counts(narrow, [], {"total": F.lit(True), "late": F.col("_late")}, slice_ms=slice_ms)
    return counted.filter(F.col("total") % F.lit(every) == 0).select(
        "total",
        (F.col("total") - F.col("late")).alias("normal"),
        "late",
        (F.col("late").cast("double") * F.lit(100.0) / F.col("total").cast("double")).alias("late_rate"),
    )
