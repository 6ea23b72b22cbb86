"""Active days as bits and users as sketches, against the reports that read the events."""

import random

from frames import events, rows
from pyspark.sql import functions as F

from playtide.operators import activity
from playtide.plans import game, player

DAY_MS = 86_400_000
START = 19_700  # a day number that is no multiple of 32


def some_days(spark, users=60, span=150, seed=3):
    rng, out = random.Random(seed), []
    for u in range(users):
        share = rng.choice([0.02, 0.3, 0.9, 1.0])
        days = [d for d in range(span) if rng.random() < share] or [rng.randrange(span)]
        out += [{"user_key": f"u{u}", "timestamp": (START + d) * DAY_MS + rng.randrange(DAY_MS), "event_type": "session_start"} for d in days]
    out += [{**out[0]}, {**out[-1], "user_key": None}]
    return events(spark, out, 4)


def test_reports_from_words_equal_those_from_events(spark):
    df = some_days(spark)
    halves = [activity.active_words(df.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == k)) for k in (0, 1)]
    words = activity.merged_words(halves[0].unionByName(halves[1]))
    assert rows(words, "user_key", "word", "bits") == rows(activity.active_words(df), "user_key", "word", "bits")
    # Any day may be asked for, also one more than a word away.
    for days in ((1, 3, 7), (31, 32, 33, 100)):
        columns = ["cohort", "cohort_size", *(f"d{n}_pct" for n in days)]
        known = words.filter("user_key IS NOT NULL")
        expected = game.retention(df.filter("user_key IS NOT NULL"), bots=True, days=days)
        assert rows(activity.retention_from_words(known, days), *columns) == rows(expected, *columns)
    columns = ["user_key", "streak_days", "longest", "last_day"]
    assert rows(activity.streaks_from_words(words), *columns) == rows(player.login_streaks(df), *columns)
    starts = df.withColumn("event_type", F.lit("stage_start")).withColumn("mode", F.lit("time_attack")).filter("user_key IS NOT NULL")
    assert rows(activity.repeaters_from_words(activity.active_words(starts)), "repeaters") == rows(game.time_attack_repeaters(starts), "repeaters")
    assert activity.streaks_from_words(words.limit(0)).count() == 0


def test_sketches_merge_within_their_error(spark):
    df = spark.range(300_000).select(
        F.concat(F.lit("u"), (F.xxhash64("id") % 40_000).cast("string")).alias("user_key"),
        ((F.col("id") % 60 + START) * DAY_MS).alias("timestamp"), (F.col("id") % 3).cast("string").alias("mode"))
    parts = [activity.user_sketches(df.filter(F.xxhash64("user_key", "timestamp") % 2 == k), "mode") for k in (-1, 0, 1)]
    whole = activity.merged_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    for period in (F.date_trunc("week", "day"), F.date_trunc("month", "day")):
        found = {r.p: r.users for r in activity.users_of(whole, p=period).collect()}
        exact = {r.p: r.n for r in df.withColumn("day", F.timestamp_millis("timestamp")).groupBy(period.alias("p")).agg(F.countDistinct("user_key").alias("n")).collect()}
        assert found.keys() == exact.keys() and all(abs(found[p] - n) <= 0.05 * n for p, n in exact.items())
    by_mode = activity.users_of(whole, mode=F.col("mode"))
    assert by_mode.count() == 3
