"""Per-player statistics, and checks of the data as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtide.functions import clear_points, day, is_bot, late, rounded, score_cap
from playtide.operators.alerts import MIN_CLEAR_MS
from playtide.operators.ingest import with_stage
from playtide.operators.ordered import HOUR_MS, with_running_counts
from playtide.plans.operations import scope
from playtide.sources.stages import CHAPTERS, STAGES_PER_CHAPTER

# Bounds of the user segments.
CHURN_DAYS = 3
HEAVY_DAYS_PER_WEEK = 6.0
NORMAL_DAYS_PER_WEEK = 3.0


def login_streaks(events: DataFrame, event_type: str = "session_start") -> DataFrame:
    """Per user: consecutive login days up to the last login, the longest run, and the last login day."""
    days = scope(events, event_type).select("user_key", day().alias("day")).distinct()
    by_user = Window.partitionBy("user_key").orderBy("day")  # one row per user and calendar day
    runs = (
        days.withColumn("run", F.date_sub("day", F.row_number().over(by_user)))
        .groupBy("user_key", "run")
        .agg(F.count(F.lit(1)).alias("length"), F.max("day").alias("last_day"))
    )
    last = F.max(F.struct("last_day", "length"))
    return (
        runs.groupBy("user_key")
        .agg(last.alias("l"), F.max("length").alias("longest"))
        .select("user_key", F.col("l.length").alias("streak_days"), "longest", F.col("l.last_day").alias("last_day"))
    )


def _catalogue_clears(events: DataFrame) -> DataFrame:
    """Story clears of catalogue stages with the stage's running number 1 to 50."""
    clears = with_stage(scope(events, "stage_clear", mode="story"))
    known = F.col("chapter").between(1, CHAPTERS) & F.col("stage_no").between(1, STAGES_PER_CHAPTER)
    number = (F.col("chapter") - 1) * STAGES_PER_CHAPTER + F.col("stage_no")
    return clears.filter(known).withColumn("stage_number", number)


def cleared_stages(events: DataFrame) -> DataFrame:
    """Per user: the catalogue stages cleared (sorted array of at most 50), how many, and the highest."""
    return (
        _catalogue_clears(events)
        .groupBy("user_key")
        .agg(F.array_sort(F.collect_set("stage_number")).alias("cleared_stages"), F.max("stage_number").alias("best_stage"))
        .withColumn("cleared", F.size("cleared_stages"))
    )


def personal_bests(rounds: DataFrame) -> DataFrame:
    """Highest total per (user, time limit) with its stages; the first of equal totals is kept.

    ``rounds`` has user_key, time_limit_sec, score, stages_cleared and ``played_at``.
    """
    best = F.max(F.struct("score", (-F.col("played_at")).alias("early"), "stages_cleared"))
    return (
        rounds.groupBy("user_key", "time_limit_sec")
        .agg(best.alias("b"))
        .select("user_key", "time_limit_sec", F.col("b.score").alias("score"), F.col("b.stages_cleared").alias("stages_cleared"))
    )


def total_plays(events: DataFrame, rounds: DataFrame) -> DataFrame:
    """Story clears plus finished time-attack rounds per user."""
    clears = scope(events, "stage_clear", mode="story").groupBy("user_key").agg(F.count(F.lit(1)).alias("plays"))
    finished = rounds.groupBy("user_key").agg(F.count(F.lit(1)).alias("plays"))
    return clears.unionByName(finished).groupBy("user_key").agg(F.sum("plays").alias("plays"))


def _cleared_bits(events: DataFrame) -> DataFrame:
    """Per user a 50-bit mask of cleared catalogue stages: one additive aggregate, whatever the number of clears."""
    bit = F.expr("shiftleft(1L, stage_number - 1)")
    return _catalogue_clears(events).withColumn("_bit", bit).groupBy("user_key").agg(F.bit_or("_bit").alias("_mask"))


def _by_chapter(masks: DataFrame) -> DataFrame:
    chapter_bits = F.expr(f"shiftright(_mask, (chapter - 1) * {STAGES_PER_CHAPTER}) & {2**STAGES_PER_CHAPTER - 1}")
    return masks.withColumn("chapter", F.explode(F.sequence(F.lit(1), F.lit(CHAPTERS)))).withColumn("_bits", chapter_bits)


def chapter_progress(events: DataFrame) -> DataFrame:
    """Per (user, chapter): stages cleared, whether all are, and the story progress in whole per cent."""
    stages = CHAPTERS * STAGES_PER_CHAPTER
    return _by_chapter(_cleared_bits(events)).select(
        "user_key",
        "chapter",
        F.bit_count("_bits").alias("cleared"),
        (F.bit_count("_bits") == STAGES_PER_CHAPTER).alias("complete"),
        rounded(F.bit_count("_mask") * F.lit(100.0) / F.lit(stages), 0, "half_up").alias("story_pct"),
    )


def next_stages(events: DataFrame) -> DataFrame:
    """Per (user, chapter): the first stage not cleared yet, null for a finished chapter.

    ``m ^ (m + 1)`` has ones up to the lowest zero of ``m``; their number is the stage sought.
    """
    position = F.expr("bit_count(_bits ^ (_bits + 1))")
    return _by_chapter(_cleared_bits(events)).select(
        "user_key", "chapter", F.when(position <= STAGES_PER_CHAPTER, position).alias("next_stage")
    )


def score_mismatches(events: DataFrame) -> DataFrame:
    """Clears whose score is not what the game awards for mode, time and bonus."""
    expected = clear_points(F.col("mode"), F.col("clear_time_ms"), F.col("bonus_collected"))
    rows = scope(events, "stage_clear").withColumn("expected_score", expected)
    return rows.filter(F.col("score") != F.col("expected_score")).select(
        "user_key", "event_id", "mode", "score", "expected_score"
    )


def with_round(events: DataFrame, slice_ms: int = HOUR_MS) -> DataFrame:
    """Time-attack events with ``round_no``: a round of a session starts at each start of stage ``ta-1``."""
    rows = scope(events, mode="time_attack")
    opens = (F.col("event_type") == "stage_start") & (F.col("stage_id") == "ta-1")
    return with_running_counts(rows, ["user_key", "session_id"], {"round_no": opens}, slice_ms=slice_ms)


def round_summary(events: DataFrame) -> DataFrame:
    """Per round: stages cleared, total score, mean clear time in whole ms, and universal blocks used."""
    clear = F.col("event_type") == "stage_clear"
    return (
        with_round(events)
        .groupBy("user_key", "session_id", "round_no")
        .agg(
            F.max("time_limit_sec").alias("time_limit_sec"),
            F.count_if(clear).alias("stages_cleared"),
            F.sum(F.when(clear, F.col("score")).otherwise(0)).alias("score"),
            F.coalesce(rounded(F.avg(F.when(clear, F.col("clear_time_ms"))), 0, "half_up"), F.lit(0.0)).alias("avg_clear_ms"),
            F.sum(F.when(clear, F.col("universal_used")).otherwise(0)).alias("universal_used"),
            F.max("timestamp").alias("played_at"),
        )
    )


def type_profile(events: DataFrame) -> DataFrame:
    """Events per type and their share in per cent, of all versions."""
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    share = rounded(F.col("cnt") * F.lit(100.0) / F.sum("cnt").over(Window.partitionBy()), 1)
    return counts.withColumn("pct", share)


def user_profile(events: DataFrame) -> DataFrame:
    """Users, and the most, middle and fewest events of a user.

    The middle is element ``users // 2`` (from 0) of the counts in falling order. It is read off the histogram of
    counts, which has fewer than ``sqrt(2 * events)`` rows because the distinct counts add up to at most all events.
    """
    per_user = events.groupBy("user_key").agg(F.count(F.lit(1)).alias("cnt"))
    histogram = per_user.groupBy("cnt").agg(F.count(F.lit(1)).alias("n"))
    falling = Window.partitionBy().orderBy(F.desc("cnt")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = histogram.withColumns({"upto": F.sum("n").over(falling), "users": F.sum("n").over(Window.partitionBy())})
    middle = F.max(F.when(F.col("upto") > F.floor(F.col("users") / 2), F.col("cnt")))
    return placed.agg(
        F.sum("n").alias("users"), F.max("cnt").alias("most"), middle.alias("middle"), F.min("cnt").alias("fewest")
    )


def bot_profile(events: DataFrame) -> DataFrame:
    """Events of bot-like users and how many of them the single-event rules should flag."""
    clear = F.col("event_type") == "stage_clear"
    fast = (F.col("clear_time_ms") > 0) & (F.col("clear_time_ms") < MIN_CLEAR_MS)
    known_grid = F.col("grid_size").isin("3x3", "3x4", "4x3", "4x4", "5x5")
    return events.filter(is_bot()).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(clear & fast).alias("impossible_clears"),
        F.count_if(clear & known_grid & (F.col("score") > score_cap())).alias("score_overflows"),
    )


def day_profile(events: DataFrame) -> DataFrame:
    """Events per day."""
    return events.groupBy(day().alias("day")).agg(F.count(F.lit(1)).alias("events")).orderBy("day")


def late_profile(events: DataFrame) -> DataFrame:
    """Late events and their share in per cent."""
    share = F.try_divide(F.count_if(late()) * F.lit(100.0), F.count(F.lit(1)).cast("double"))
    return events.agg(F.count_if(late()).alias("late"), rounded(share, 1).alias("late_pct"))


def user_segments(events: DataFrame, as_of_ms: int | None = None, span_days: int | None = None) -> DataFrame:
    """Label users bot, churned, heavy, normal or casual by their active days.

    Churned: silent for more than three days at the end. The others go by active days per week of the covered span.
    Without ``as_of_ms`` and ``span_days`` both come from the data.
    """
    per_day = events.groupBy("user_key", day().alias("day")).agg(F.count_distinct("session_id").alias("sessions"))
    users = per_day.groupBy("user_key").agg(
        F.count(F.lit(1)).alias("active_days"), F.sum("sessions").alias("sessions"), F.max("day").alias("last_day")
    )
    first, last = events.agg(day(F.min("timestamp"))), events.agg(day(F.max("timestamp")))
    as_of: Column = last.scalar() if as_of_ms is None else day(F.lit(as_of_ms))
    span: Column = (F.date_diff(last.scalar(), first.scalar()) + 1) if span_days is None else F.lit(span_days)
    per_week = F.col("active_days") * F.lit(7.0) / span
    label = (
        F.when(is_bot(), "bot")
        .when(F.date_diff(as_of, "last_day") > CHURN_DAYS, "churned")
        .when(per_week >= HEAVY_DAYS_PER_WEEK, "heavy")
        .when(per_week >= NORMAL_DAYS_PER_WEEK, "normal")
        .otherwise("casual")
    )
    return users.select(
        "user_key", "active_days", "sessions",
        rounded(F.col("sessions").cast("double") / F.col("active_days"), 2).alias("sessions_per_day"),
        "last_day", label.alias("segment"),
    )
