"""Sessions by inactivity gap, without sorting a user's rows.

Rows are put into time slots as wide as the gap. Two rows of one slot are always closer than the gap, so a session is a
run of slots, and its borders follow from the first and last event time of each (user, slot). That table has at most
one row per user and slot; everything else is a sum, minimum or maximum that Spark combines before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.operators.ordered import time_slice
from playtide.schema import EVENT_SCHEMA, SESSION_SCHEMA, names
from playtide.session import written

# The inactivity gap that ends a session, and the label for a session without mode or id.
GAP_MS = 300_000
UNKNOWN = "unknown"


def session_slots(df: DataFrame, gap_ms: int = GAP_MS, time_col: str = "timestamp", user: str = "user_key") -> DataFrame:
    """(user, slot) with the start time and running number of the session the slot belongs to."""
    ends = df.select(user, time_slice(time_col, gap_ms).alias("slot"), F.col(time_col).alias("first_ms"), F.col(time_col).alias("last_ms"))
    return _starts(ends, gap_ms, user)


def _starts(ends: DataFrame, gap_ms: int, user: str = "user_key") -> DataFrame:
    """:func:`session_slots` from rows that hold the first and last time of some events of a (user, slot)."""
    spans = ends.groupBy(user, "slot").agg(F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"))
    by_user = Window.partitionBy(user).orderBy("slot")
    so_far = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("last_ms").over(by_user)
    opens = before.isNull() | (F.col("first_ms") - before > F.lit(gap_ms))
    return spans.withColumn("opens", opens).select(
        user,
        "slot",
        F.max(F.when(F.col("opens"), F.col("first_ms"))).over(so_far).alias("session_start"),
        F.sum(F.col("opens").cast("bigint")).over(so_far).alias("session_no"),
    )


def sessionize(df: DataFrame, gap_ms: int = GAP_MS, time_col: str = "timestamp", user: str = "user_key") -> DataFrame:
    """Add ``session_start`` and ``session_no`` (1, 2, … per user) to every event."""
    slots = session_slots(df, gap_ms, time_col, user)
    return df.withColumn("slot", time_slice(time_col, gap_ms)).join(slots, [user, "slot"]).drop("slot")


def _count_type(event_type: str) -> Column:
    return F.count_if(F.col("event_type") == event_type)


#: What partial sums of one session are told apart by, and their sums.
PART_KEYS = ("mode", "stage_id", "session_id")
PART_SUMS = ("total_events", "stage_clears", "stage_fails", "navigations", "total_score", "universal_used", "clear_ms", "timed_clears")
#: Partial sums of a run of events that a session holds from ``run_first`` to ``run_last``.
RUN_SCHEMA = T.StructType([
    EVENT_SCHEMA["user_key"], T.StructField("run_first", T.LongType()), T.StructField("run_last", T.LongType()),
    *(EVENT_SCHEMA[c] for c in PART_KEYS), *(T.StructField(c, T.LongType()) for c in ("first_ms", "last_ms", *PART_SUMS))])


def session_parts(df: DataFrame, gap_ms: int = GAP_MS, time_col: str = "timestamp") -> DataFrame:
    """Partial sums per (user, slot, mode, stage, session id): raw rows meet one hash aggregation with numeric buffers only."""
    is_clear = F.col("event_type") == "stage_clear"
    timed_clear = is_clear & (F.col("clear_time_ms") > 0)
    sums = (
        F.count(F.lit(1)), _count_type("stage_clear"), _count_type("stage_fail"), _count_type("navigation"),
        F.sum(F.when(is_clear, F.col("score")).otherwise(0).cast("bigint")),
        F.sum(F.when(is_clear, F.col("universal_used")).otherwise(0).cast("bigint")),
        F.sum(F.when(timed_clear, F.col("clear_time_ms")).otherwise(0).cast("bigint")),
        F.count_if(timed_clear),
    )
    return df.withColumn("slot", time_slice(time_col, gap_ms)).groupBy("user_key", "slot", *PART_KEYS).agg(
        F.min(time_col).alias("first_ms"), F.max(time_col).alias("last_ms"), *[total.alias(name) for name, total in zip(PART_SUMS, sums)])


def runs_of(parts: DataFrame) -> DataFrame:
    """The parts of (user, slot) pairs as runs: events of one slot always share a session."""
    spans = parts.groupBy("user_key", "slot").agg(F.min("first_ms").alias("run_first"), F.max("last_ms").alias("run_last"))
    return parts.join(spans, ["user_key", "slot"]).select(*RUN_SCHEMA.names)


def merged_runs(runs: DataFrame, gap_ms: int = GAP_MS) -> DataFrame:
    """Runs that are at most the gap apart become one, and their partial sums are added up.

    There is one row per run, mode, stage and session id afterwards, however many events it holds. Runs may overlap or hold one another.
    """
    intervals = runs.select("user_key", "run_first", "run_last").distinct()
    by_user = Window.partitionBy("user_key").orderBy("run_first", "run_last")
    reached = F.max("run_last").over(by_user.rowsBetween(Window.unboundedPreceding, -1))
    opens = reached.isNull() | (F.col("run_first") - reached > F.lit(gap_ms))
    start = F.max(F.when(F.col("_opens"), F.col("run_first"))).over(by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = intervals.withColumn("_opens", opens).withColumn("_start", start)
    whole = Window.partitionBy("user_key", "_start")
    placed = placed.select("user_key", "run_first", "run_last", "_start", F.max("run_last").over(whole).alias("_end"))
    joined = runs.join(placed, ["user_key", "run_first", "run_last"])
    return joined.groupBy("user_key", F.col("_start").alias("run_first"), F.col("_end").alias("run_last"), *PART_KEYS).agg(
        F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"), *[F.sum(c).alias(c) for c in PART_SUMS])


def session_summary(df: DataFrame, gap_ms: int = GAP_MS, time_col: str = "timestamp") -> DataFrame:
    """One row per session with the 14 summary fields.

    The session id is the earliest one that is set (the smaller of two ids at the same time); the primary mode is the
    most frequent non-empty one, the greater of two equally frequent ones. Both are ``unknown`` when there is none.
    """
    # Raw rows are read once; all later steps, the session borders among them, work on the much smaller parts.
    parts = written(session_parts(df, gap_ms, time_col), "session-parts")
    return summary_of_parts(parts.join(_starts(parts, gap_ms), ["user_key", "slot"]))


def summary_of_parts(parts: DataFrame) -> DataFrame:
    """The session summaries from partial sums with their session (user_key, session_start)."""
    session = ["user_key", "session_start"]
    again = [F.sum(name).alias(name) for name in PART_SUMS]
    ends = [F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms")]
    opener = F.min(F.when(F.col("session_id").isNotNull(), F.struct("first_ms", "session_id")))
    by_stage = parts.groupBy(*session, "mode", "stage_id").agg(opener.alias("opener"), *ends, *again)
    # A stage played in two modes counts once: only its first mode row carries the mark.
    same_stage = Window.partitionBy(*session, "stage_id").orderBy("mode")
    counted = (F.row_number().over(same_stage) == 1) & F.col("stage_id").isNotNull() & (F.col("stage_id") != "")
    by_mode = (
        by_stage.withColumn("stages", counted.cast("bigint"))
        .groupBy(*session, "mode")
        .agg(F.min("opener").alias("opener"), F.sum("stages").alias("stages"), *ends, *again)
    )
    favourite = F.max(F.when(F.col("mode") != "", F.struct("total_events", "mode")))
    out = by_mode.groupBy(*session).agg(
        F.min("opener").alias("opener"), F.sum("stages").alias("distinct_stages"), favourite.alias("favourite"), *ends, *again
    )
    return out.select(
        "user_key",
        F.coalesce("opener.session_id", F.lit(UNKNOWN)).alias("session_id"),
        F.col("first_ms").alias("session_start"),
        F.col("last_ms").alias("session_end"),
        (F.col("last_ms") - F.col("first_ms")).alias("duration_ms"),
        "total_events", "stage_clears", "stage_fails", "total_score",
        F.coalesce("favourite.mode", F.lit(UNKNOWN)).alias("primary_mode"),
        "distinct_stages",
        F.coalesce(F.try_divide(F.col("clear_ms").cast("double"), F.col("timed_clears").cast("double")), F.lit(0.0)).alias(
            "avg_clear_time_ms"
        ),
        "universal_used", "navigations",
    ).select(*names(SESSION_SCHEMA))
