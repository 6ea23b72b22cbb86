"""Leaderboard, stage progress and user tables.

A user's best row is a map-side combined minimum, so a user may have any number of scores. No rank is computed by one
task over all users: a page ranks only the rows it shows and those above it, a single user's rank is a count of better
results, and the full ranking counts results column by column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtide.schema import LEADERBOARD_SCHEMA, names
from playtide.session import written

# Page size limits.
DEFAULT_PAGE = 20
MAX_PAGE = 100

RESULT = ("score", "stages_cleared", "avg_clear_ms")


def append_scores(old: DataFrame, new: DataFrame) -> DataFrame:
    """The leaderboard with newly submitted scores; columns a submission leaves out are null."""
    return old.unionByName(new, allowMissingColumns=True)


def _better_first() -> list[Column]:
    """Sort key of a result: high score, many stages, short mean time; no time comes last."""
    return [F.desc("score"), F.desc("stages_cleared"), F.asc_nulls_last("avg_clear_ms")]


def best_rows(rows: DataFrame) -> DataFrame:
    """The best of each user's rows, a map-side combined minimum; among equal results the earliest entry wins."""
    rest = [c for c in rows.columns if c not in ("user_key", "played_at", "entry_id", *RESULT)]
    preference = F.struct(
        (-F.col("score").cast("bigint")).alias("score"),
        (-F.col("stages_cleared").cast("bigint")).alias("stages_cleared"),
        F.col("avg_clear_ms").isNull().alias("untimed"),
        F.col("avg_clear_ms"), F.col("played_at"), F.col("entry_id"), *[F.col(c) for c in rest],
    )
    best = rows.groupBy("user_key").agg(F.min(preference).alias("b"))
    turned = {c: (-F.col(f"b.{c}")).cast(rows.schema[c].dataType).alias(c) for c in ("score", "stages_cleared")}
    return best.select(*[turned.get(c, F.col("user_key" if c == "user_key" else f"b.{c}")) for c in rows.columns])


def best_scores(
    leaderboard: DataFrame, users: DataFrame, mode: str = "time_attack", time_limit_sec: int | None = None
) -> DataFrame:
    """Best entry per user with the user's nickname; users without a user record are left out.

    Among equal results the earliest entry wins.
    """
    rows = leaderboard.filter(F.col("mode") == mode)
    if time_limit_sec is not None:
        rows = rows.filter(F.col("time_limit_sec") == time_limit_sec)
    return best_rows(rows.select(*names(LEADERBOARD_SCHEMA))).join(users.select("user_key", "nickname"), "user_key")


def result_digits() -> dict[str, Column]:
    """A result as six digits of 16 bits; results sort like them, the best first, and each has at most 65,537 values below those before it."""
    ascending = (-F.col("score").cast("bigint"), -F.col("stages_cleared").cast("bigint"), F.col("avg_clear_ms").cast("bigint"))
    digits: dict[str, Column] = {}
    for number, value in enumerate(ascending):
        # A missing time sorts behind every 32-bit number.
        value = F.coalesce(value, F.lit(1 << 32))
        digits |= {f"_d{number}a": F.floor(value / F.lit(1 << 16)), f"_d{number}b": value}
    return digits


def rank_scores(best: DataFrame) -> DataFrame:
    """Add ``rank``, the dense rank of each user's result.

    The rank of a result is one more than the number of distinct better results. They are counted digit by digit: each
    column of the result is split into two digits of 16 bits, and a result is behind those with the same leading digits
    and a smaller next one. So no sort sees more than the 65,537 values of one digit, and the tables joined on the way
    are counts per leading digits.
    """
    digits = result_digits()
    keys = list(digits)
    results = written(best.select(*RESULT).distinct().withColumns(digits), "results")

    ahead = None
    for depth in range(1, len(keys) + 1):
        prefix, parent = keys[:depth], keys[: depth - 1]
        smaller = Window.partitionBy(*parent).orderBy(keys[depth - 1]).rowsBetween(Window.unboundedPreceding, -1)
        counts = results.groupBy(*prefix).agg(F.count(F.lit(1)).alias("_n"))
        here = counts.select(*prefix, F.coalesce(F.sum("_n").over(smaller), F.lit(0)).alias("_here"))
        ahead = here.withColumnRenamed("_here", "_ahead") if ahead is None else (
            here.join(ahead, parent).select(*prefix, (F.col("_ahead") + F.col("_here")).alias("_ahead"))
        )
    ranks = ahead.select(*keys, (F.col("_ahead") + 1).alias("rank"))
    return best.withColumns(digits).join(ranks, keys).drop(*keys)


def leaderboard_page(best: DataFrame, limit: int = DEFAULT_PAGE, offset: int = 0) -> DataFrame:
    """One page ordered by rank and user.

    A rank depends only on the rows above, so the first ``offset + limit`` rows are taken and ranked.
    """
    if not 0 < limit <= MAX_PAGE or offset < 0:
        raise ValueError(f"limit must be 1 to {MAX_PAGE} and offset not negative")
    top = best.orderBy(*_better_first(), "user_key").limit(offset + limit)
    rank = F.dense_rank().over(Window.partitionBy().orderBy(*_better_first()))
    return top.withColumn("rank", rank).orderBy("rank", "user_key").offset(offset).limit(limit)


def my_rank(best: DataFrame, user_key: str) -> DataFrame:
    """A user's best entry with its rank; no row for a user without one.

    The rank is one more than the number of distinct results that sort before the user's. The board is worked out once: its
    distinct results are written, the user's own with the user's entry.
    """
    result = F.struct(
        (-F.col("score")).alias("score"), (-F.col("stages_cleared")).alias("stages"),
        F.col("avg_clear_ms").isNull().alias("untimed"), F.col("avg_clear_ms"),
    ).alias("result")
    entry = F.when(F.col("user_key") == user_key, F.struct(*best.columns))
    results = written(best.groupBy(result).agg(F.max(entry).alias("mine")), "results")
    own = results.filter(F.col("mine").isNotNull())
    better = results.filter(F.col("result") < own.select("result").scalar()).agg(F.count(F.lit(1)))
    return own.select("mine.*").withColumn("rank", better.scalar() + 1)


def stage_progress(clears: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Best time, clears and universal blocks per (user, stage), with first and last clear time."""
    return clears.groupBy("user_key", "stage_id").agg(
        F.min("clear_time_ms").alias("best_time_ms"),
        F.count(F.lit(1)).alias("clear_count"),
        F.sum(F.col("universal_used").cast("bigint")).alias("universal_used"),
        F.min(time_col).alias("first_cleared_at"),
        F.max(time_col).alias("updated_at"),
    )


def merge_progress(old: DataFrame, delta: DataFrame) -> DataFrame:
    """Fold newer progress into the stored table."""
    return old.unionByName(delta).groupBy("user_key", "stage_id").agg(
        F.min("best_time_ms").alias("best_time_ms"),
        F.sum("clear_count").alias("clear_count"),
        F.sum("universal_used").alias("universal_used"),
        F.min("first_cleared_at").alias("first_cleared_at"),
        F.max("updated_at").alias("updated_at"),
    )


def progress_of(progress: DataFrame, user_key: str) -> DataFrame:
    """One user's progress in text order of the stage id."""
    return progress.filter(F.col("user_key") == user_key).drop("user_key").orderBy("stage_id")


def upsert_users(old: DataFrame, delta: DataFrame, now: Column | None = None) -> DataFrame:
    """Create or touch users: ``delta`` is (user_key, nickname, seen_at); a null nickname keeps the stored one.

    Several touches of a user fold into one: the latest nickname that is set and the latest time.
    """
    seen = F.col("seen_at") if now is None else now
    touch = delta.groupBy("user_key").agg(
        F.max(F.when(F.col("nickname").isNotNull(), F.struct(seen.alias("at"), F.col("nickname")))).alias("_name"),
        F.min(seen).alias("_first"),
        F.max(seen).alias("_last"),
    )
    return old.join(touch, "user_key", "full").select(
        "user_key",
        F.coalesce("_name.nickname", "nickname").alias("nickname"),
        F.coalesce("created_at", "_first").alias("created_at"),
        F.coalesce("_last", "last_seen_at").alias("last_seen_at"),
    )


def get_user(users: DataFrame, user_key: str) -> DataFrame:
    """One user's record."""
    return users.filter(F.col("user_key") == user_key).select("user_key", "nickname", "created_at", "last_seen_at")
