"""Game reports: modes, stages, retention, funnels, scores and fail progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playtide.functions import bucket, day, hour_label, mean, per_cent, rounded, stage_part
from playtide.functions.expressions import REPORT_ZONE
from playtide.operators.rollups import PLAYS, finalize_stage
from playtide.plans.operations import scope
from playtide.sources.stages import CHAPTERS, STAGES_PER_CHAPTER

# Modes, offered time limits, retention days, and the buckets of stage reach and fail progress.
MODES = ("story", "time_attack")
TIME_LIMITS = (60, 120, 180)
RETENTION_DAYS = (1, 3, 7)
REACH_BUCKETS = ((3, "1-3"), (6, "4-6"), (10, "7-10"))
LAST_REACH_BUCKET = "11+"
PROGRESS_BUCKETS = ((25, "0~25%"), (50, "25~50%"), (75, "50~75%"))
LAST_PROGRESS_BUCKET = "75~100%"



def plays_by_mode(events: DataFrame) -> DataFrame:
    """Clears and fails per mode."""
    return scope(events, *PLAYS).filter(F.col("mode").isin(*MODES)).groupBy("mode").agg(F.count(F.lit(1)).alias("cnt"))


def daily_plays(daily: DataFrame, since: Column | None = None) -> DataFrame:
    """Plays per day, one column per mode."""
    rows = daily if since is None else daily.filter(F.col("day") >= since)
    plays = F.col("clears") + F.col("fails")
    per_mode = [F.sum(F.when(F.col("mode") == m, plays).otherwise(0)).alias(m) for m in MODES]
    return rows.groupBy("day").agg(*per_mode).orderBy("day")


def daily_results(daily: DataFrame, since: Column | None = None) -> DataFrame:
    """Clears and fails per day."""
    rows = daily if since is None else daily.filter(F.col("day") >= since)
    return rows.groupBy("day").agg(F.sum("clears").alias("clears"), F.sum("fails").alias("fails")).orderBy("day")


def _stage_order() -> Column:
    return stage_part("stage_id", 1) * 100 + stage_part("stage_id", 2)


def story_clear_rates(stage_parts: DataFrame) -> DataFrame:
    """Clear rate per story stage, in stage order."""
    rows = finalize_stage(stage_parts.filter((F.col("mode") == "story") & (F.col("stage_id") != "")))
    return rows.select("stage_id", rounded(F.col("clear_rate"), 1).alias("clear_rate_pct")).orderBy(_stage_order(), "stage_id")


def story_clear_times(stage_parts: DataFrame) -> DataFrame:
    """Mean clear time per story stage, in stage order."""
    rows = finalize_stage(stage_parts.filter((F.col("mode") == "story") & (F.col("stage_id") != "")))
    return rows.select("stage_id", rounded(F.col("avg_clear_ms"), 0).alias("avg_clear_ms")).orderBy(_stage_order(), "stage_id")


def chapter_grid(spark: SparkSession, stage_parts: DataFrame, chapter: int) -> DataFrame:
    """Clear rate of the ten stages of a chapter, 0 where a stage was never played."""
    wanted = spark.range(1, STAGES_PER_CHAPTER + 1).select(
        F.col("id").alias("stage_no"), F.concat(F.lit(f"{chapter}-"), F.col("id").cast("string")).alias("stage")
    )
    in_chapter = (F.col("mode") == "story") & F.col("stage_id").like(f"{chapter}-%")
    rates = finalize_stage(stage_parts.filter(in_chapter)).select(
        F.col("stage_id").alias("stage"), rounded(F.col("clear_rate"), 1).alias("rate")
    )
    return (
        wanted.join(rates, "stage", "left")
        .orderBy("stage_no")
        .select("stage", F.coalesce("rate", F.lit(0.0)).alias("clear_rate"))
    )


def retention(events: DataFrame, bots: bool = False, days: tuple[int, ...] = RETENTION_DAYS) -> DataFrame:
    """Per cohort of first active day: its size and the share of users active 1, 3 and 7 days later.

    Events collapse to distinct (user, day) pairs before anything is grouped by user.
    """
    active = scope(events, bots=bots).select("user_key", day().alias("active_day")).distinct()
    seen = active.withColumn("cohort", F.min("active_day").over(Window.partitionBy("user_key")))
    offset = F.date_diff("active_day", "cohort")
    size = F.count_if(offset == 0)
    shares = [per_cent(F.count_if(offset == n), size, 1).alias(f"d{n}_pct") for n in days]
    return seen.groupBy("cohort").agg(size.alias("cohort_size"), *shares).orderBy("cohort")


def play_hours(events: DataFrame, zone: str = REPORT_ZONE) -> DataFrame:
    """Plays per hour of day on the report's wall clock."""
    hours = scope(events, *PLAYS).groupBy(hour_label(zone=zone).alias("hour_kst"))
    return hours.agg(F.count(F.lit(1)).alias("events")).orderBy("hour_kst")


def _when_mode(mode: str, value: str) -> Column:
    return F.when(F.col("mode") == mode, F.col(value))


def daily_scores(events: DataFrame, bots: bool = False, digits: int | None = 0) -> DataFrame:
    """Mean positive score of a clear per day and mode."""
    scored = F.when(F.col("score") > 0, F.col("score"))
    means = [
        mean(F.when(F.col("mode") == mode, scored), digits).alias(name)
        for mode, name in (("story", "story_avg"), ("time_attack", "ta_avg"))
    ]
    return scope(events, "stage_clear", bots=bots).groupBy(day().alias("day")).agg(*means).orderBy("day")


def item_actions(events: DataFrame) -> DataFrame:
    """Item events per action."""
    return scope(events, "item_use").groupBy("action").agg(F.count(F.lit(1)).alias("cnt"))


def grid_clear_times(events: DataFrame, bots: bool = False) -> DataFrame:
    """Mean clear time per grid and mode."""
    return (
        scope(events, "stage_clear", bots=bots)
        .filter(F.col("clear_time_ms") > 0)
        .groupBy("grid_size")
        .agg(
            mean(_when_mode("story", "clear_time_ms"), 0).alias("story_ms"),
            mean(_when_mode("time_attack", "clear_time_ms"), 0).alias("ta_ms"),
        )
        .orderBy("grid_size")
    )


def story_funnel(events: DataFrame, bots: bool = False) -> DataFrame:
    """Users who started a stage of each chapter."""
    return (
        scope(events, "stage_start", mode="story", bots=bots)
        .filter(F.col("stage_id") != "")
        .select("user_key", stage_part("stage_id", 1).alias("chapter_no"))
        .filter(F.col("chapter_no").between(1, CHAPTERS))
        .groupBy("chapter_no")
        .agg(F.count_distinct("user_key").alias("users"))
        .orderBy("chapter_no")
        .select(F.concat(F.lit("Ch."), F.col("chapter_no").cast("string")).alias("chapter"), "users")
    )


def time_attack_reach(events: DataFrame) -> DataFrame:
    """Users by time-attack stage they started."""
    reached = bucket(stage_part("stage_id", 2), REACH_BUCKETS, LAST_REACH_BUCKET, inclusive=True)
    return (
        scope(events, "stage_start", mode="time_attack")
        .filter(F.col("stage_id").like("ta-%"))
        .groupBy(reached.alias("stage_group"))
        .agg(F.count_distinct("user_key").alias("users"))
        .orderBy("stage_group")
    )


def _limit_label(unit: str) -> Column:
    return F.concat(F.col("time_limit_sec").cast("string"), F.lit(unit)).alias("time_limit")


def _offered_limits() -> Column:
    return F.col("time_limit_sec").isin(*TIME_LIMITS)


def _scored_time_attack(events: DataFrame) -> DataFrame:
    return scope(events, "stage_clear", mode="time_attack", bots=False).filter((F.col("score") > 0) & _offered_limits())


def limit_scores(events: DataFrame, unit: str = "초") -> DataFrame:
    """Mean time-attack score per time limit."""
    return (
        _scored_time_attack(events)
        .groupBy("time_limit_sec")
        .agg(mean(F.col("score"), 0).alias("avg_score"))
        .orderBy("time_limit_sec")
        .select(_limit_label(unit), "avg_score")
    )


def clears_per_day(events: DataFrame, bots: bool = False) -> DataFrame:
    """Mean clears per day."""
    per_day = scope(events, "stage_clear", bots=bots).groupBy(day().alias("day")).agg(F.count(F.lit(1)).alias("clears"))
    return per_day.agg(mean(F.col("clears"), 0).alias("avg_clears"))


def dau_by_mode(daily: DataFrame) -> DataFrame:
    """Active users per day, in total and in time attack."""
    # One row per (day, user) first, so both counts are plain counts.
    users = daily.groupBy("day", "user_key").agg(F.max(F.col("mode") == "time_attack").alias("_ta"))
    return (
        users.groupBy("day")
        .agg(F.count(F.lit(1)).alias("total_dau"), F.count_if(F.col("_ta")).alias("ta_dau"))
        .orderBy("day")
    )


def limit_preference(events: DataFrame, unit: str = "초") -> DataFrame:
    """Time-attack starts per time limit."""
    return (
        scope(events, "stage_start", mode="time_attack", bots=False)
        .filter(_offered_limits())
        .groupBy("time_limit_sec")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy("time_limit_sec")
        .select(_limit_label(unit), "cnt")
    )


def limit_score_table(events: DataFrame, unit: str = "s") -> DataFrame:
    """Mean and highest score, their distance, and clears per time limit."""
    return (
        _scored_time_attack(events)
        .groupBy("time_limit_sec")
        .agg(
            mean(F.col("score"), 0).alias("avg_score"),
            F.max("score").alias("max_score"),
            rounded(F.max("score") - F.avg("score"), 0).alias("gap"),
            F.count(F.lit(1)).alias("total_clears"),
        )
        .orderBy("time_limit_sec")
        .select(_limit_label(unit), "avg_score", "max_score", "gap", "total_clears")
    )


def time_attack_share(daily: DataFrame) -> DataFrame:
    """Share of users who ever played time attack, in per cent."""
    users = daily.groupBy("user_key").agg(F.max(F.col("mode") == "time_attack").alias("_ta"))
    share = F.count_if(F.col("_ta")) * F.lit(100.0) / F.greatest(F.count(F.lit(1)), F.lit(1))
    return users.agg(rounded(share, 1).alias("ta_share_pct"))


def rounds_per_user_day(events: DataFrame) -> DataFrame:
    """Mean number of time-attack rounds of a (user, day) that has any; a round starts with stage ``ta-1``."""
    per_day = (
        scope(events, "stage_start", mode="time_attack", bots=False)
        .filter(F.col("stage_id") == "ta-1")
        .groupBy("user_key", day().alias("day"))
        .agg(F.count(F.lit(1)).alias("rounds"))
    )
    return per_day.agg(mean(F.col("rounds"), 1).alias("avg_rounds"))


def time_attack_clears_per_session(events: DataFrame) -> DataFrame:
    """Mean time-attack clears of a session that has any."""
    per_session = (
        scope(events, "stage_clear", mode="time_attack", bots=False).groupBy("session_id").agg(F.count(F.lit(1)).alias("clears"))
    )
    return per_session.agg(mean(F.col("clears"), 1).alias("avg_clears"))


def time_attack_repeaters(events: DataFrame, min_days: int = 2) -> DataFrame:
    """Users who started time attack on at least ``min_days`` days."""
    days = scope(events, "stage_start", mode="time_attack", bots=False).select("user_key", day().alias("day")).distinct()
    return (
        days.groupBy("user_key").agg(F.count(F.lit(1)).alias("days")).agg(F.count_if(F.col("days") >= min_days).alias("repeaters"))
    )


def platforms(events: DataFrame) -> DataFrame:
    """Session starts per platform."""
    return scope(events, "session_start").filter(F.col("platform") != "").groupBy("platform").agg(F.count(F.lit(1)).alias("cnt"))


def _fails(events: DataFrame, **kwargs) -> DataFrame:
    return scope(events, "stage_fail", bots=False, **kwargs).filter(F.col("completion_pct") > 0)


def fail_progress(events: DataFrame) -> DataFrame:
    """Mean progress at a fail."""
    return _fails(events).agg(mean(F.col("completion_pct"), 1).alias("avg_progress"))


def fail_progress_buckets(events: DataFrame) -> DataFrame:
    """Fails by quarter of progress."""
    quarter = bucket(F.col("completion_pct"), PROGRESS_BUCKETS, LAST_PROGRESS_BUCKET)
    return (
        _fails(events).groupBy(quarter.alias("progress_bucket"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy("progress_bucket")
    )


def chapter_fail_progress(events: DataFrame) -> DataFrame:
    """Mean progress at a fail per story chapter."""
    return (
        _fails(events, mode="story")
        .withColumn("chapter_no", stage_part("stage_id", 1))
        .filter(F.col("chapter_no").between(1, CHAPTERS))
        .groupBy("chapter_no")
        .agg(mean(F.col("completion_pct"), 1).alias("avg_completion"))
        .orderBy("chapter_no")
        .select(F.concat(F.lit("Ch."), F.col("chapter_no").cast("string")).alias("chapter"), "avg_completion")
    )
