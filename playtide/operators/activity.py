"""Distinct users and active days as mergeable aggregate states, so that reports need no second look at the events.

Active days of a user are bits: a row for each user and run of ``WORD`` days, kept up to date by OR. Distinct users of a day are a
sketch, and sketches of any days are merged by union. Both are small tables that micro-batches add parts to (``merged_words`` and
``merged_sketches`` are the merges of a ``TieredTable``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtide.functions import day
from playtide.functions.expressions import per_cent

#: Days of one word of bits; a sum of two words never leaves 64 bits.
WORD = 32
#: Sketch size: 2^12 registers, a standard error of 1.6 %.
LOG_REGISTERS = 12


def _day_no(date: Column) -> Column:
    return F.unix_date(date).cast("bigint")


def _date(number: Column) -> Column:
    return F.date_from_unix_date(number.cast("int"))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def active_words(df: DataFrame, *keys: str) -> DataFrame:
    """(user_key, keys, word, bits) of the days on which a user has any of the rows."""
    number = _day_no(day())
    bit = _bit(F.pmod(number, F.lit(WORD)))
    return df.groupBy("user_key", *keys, F.floor(number / F.lit(WORD)).alias("word")).agg(F.bit_or(bit).alias("bits"))


def merged_words(rows: DataFrame, oldest: bool = False) -> DataFrame:
    """Parts of the table of words as one."""
    return rows.groupBy(*[c for c in rows.columns if c != "bits"]).agg(F.bit_or("bits").alias("bits")).select(*rows.columns)


def _lowest(bits: Column) -> Column:
    """Place of the lowest bit that is set."""
    return F.bit_count(bits.bitwiseAND(-bits) - 1).cast("bigint")


def retention_from_words(words: DataFrame, days: Sequence[int]) -> DataFrame:
    """Per cohort of first active day: its size, and the share of users active ``n`` days later for each of ``days``, whichever they are.

    A user has a row per 32 days; whether the n-th day was active is one bit of the row it falls into.
    """
    words = merged_words(words.select("user_key", "word", "bits"))
    first = F.min(F.col("word") * WORD + _lowest(F.col("bits"))).over(Window.partitionBy("user_key"))
    rows = words.withColumn("cohort", first)

    def active(n: int) -> Column:
        at = F.col("cohort") + n
        here = F.floor(at / F.lit(WORD)) == F.col("word")
        return here & (F.col("bits").bitwiseAND(_bit(F.pmod(at, F.lit(WORD)))) != 0)

    size = F.count_if(active(0))
    shares = [per_cent(F.count_if(active(n)), size, 1).alias(f"d{n}_pct") for n in days]
    return rows.groupBy("cohort").agg(size.alias("cohort_size"), *shares).orderBy("cohort").withColumn("cohort", _date(F.col("cohort")))


def repeaters_from_words(words: DataFrame, min_days: int = 2) -> DataFrame:
    """Users active on at least ``min_days`` days."""
    days = merged_words(words.select("user_key", "word", "bits")).groupBy("user_key").agg(F.sum(F.bit_count("bits")).alias("days"))
    return days.agg(F.count_if(F.col("days") >= min_days).alias("repeaters"))


def streaks_from_words(words: DataFrame) -> DataFrame:
    """Per user: consecutive active days up to the last one, the longest run, and the last day.

    A run begins at a bit without one below and ends at a bit without one above, also across words; the k-th beginning belongs to the
    k-th end.
    """
    words = merged_words(words.select("user_key", "word", "bits"))
    by_user = Window.partitionBy("user_key").orderBy("word")
    one, top = F.lit(1).cast("bigint"), F.lit(1 << (WORD - 1))

    def bit_of(neighbour: Column, distance: int, bit: Column, shifted: Column) -> Column:
        """``shifted`` where the neighbouring word is the next one in time and has ``bit``."""
        adjoins = neighbour["word"] == F.col("word") + distance
        return F.when(adjoins & (neighbour["bits"].bitwiseAND(bit) != 0), shifted).otherwise(F.lit(0).cast("bigint"))

    row = F.struct("word", "bits")
    before, after = F.lag(row).over(by_user), F.lead(row).over(by_user)
    bits = F.col("bits")
    from_below = F.shiftleft(bits, 1).bitwiseOR(bit_of(before, -1, top, one))
    from_above = F.shiftright(bits, 1).bitwiseOR(bit_of(after, 1, one, top))
    places = F.sequence(F.lit(0), F.lit(WORD - 1))

    def days_of(mask: str) -> Column:
        found = F.filter(places, lambda p: F.col(mask).bitwiseAND(_bit(p)) != 0)
        return F.transform(found, lambda p: F.col("word") * WORD + p)

    marked = words.select(
        "user_key", "word", bits.bitwiseAND(F.bitwise_not(from_below)).alias("_begin"), bits.bitwiseAND(F.bitwise_not(from_above)).alias("_end"))
    ends = marked.select("user_key", days_of("_begin").alias("begins"), days_of("_end").alias("ends"))
    # At most one run for every other day.
    whole = ends.groupBy("user_key").agg(
        F.sort_array(F.flatten(F.collect_list("begins"))).alias("begins"), F.sort_array(F.flatten(F.collect_list("ends"))).alias("ends"))
    lengths = F.zip_with("begins", "ends", lambda b, e: e - b + 1)
    return whole.select(
        "user_key", F.element_at(lengths, -1).alias("streak_days"), F.array_max(lengths).alias("longest"), _date(F.element_at("ends", -1)).alias("last_day"))


def user_sketches(df: DataFrame, *keys: str) -> DataFrame:
    """(day, keys, sketch) of the users of each day."""
    return df.groupBy(day().alias("day"), *keys).agg(F.hll_sketch_agg("user_key", F.lit(LOG_REGISTERS)).alias("sketch"))


def merged_sketches(rows: DataFrame, oldest: bool = False) -> DataFrame:
    """Parts of the table of sketches as one."""
    return rows.groupBy(*[c for c in rows.columns if c != "sketch"]).agg(F.hll_union_agg("sketch").alias("sketch")).select(*rows.columns)


def users_of(sketches: DataFrame, **periods: Column) -> DataFrame:
    """Estimated distinct users per period, such as ``month=F.date_trunc("month", "day")``: within 5 % for all but one in 500."""
    return sketches.groupBy(*[c.alias(name) for name, c in periods.items()]).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"))
