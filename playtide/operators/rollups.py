"""Additive rollups and latest-state tables. All of them combine before the shuffle, so no key can be too frequent."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.functions import day

PLAYS = ("stage_clear", "stage_fail")


#: Source rows behind a row of a signed rollup, less those taken back.
SOURCE_ROWS = "source_rows"


def _count(condition: Column, sign: Column | None) -> Column:
    return F.count_if(condition) if sign is None else F.sum(F.when(condition, sign).otherwise(0)).cast("bigint")


def _signed(sign: Column | None) -> list[Column]:
    return [] if sign is None else [F.sum(sign).cast("bigint").alias(SOURCE_ROWS)]


def daily_user_summary(df: DataFrame, sign: Column | None = None) -> DataFrame:
    """Clears and fails per (day, user, mode).

    The users of a day are those with any event, so a user without plays has a row with zeros. With ``sign`` (1 for a new row, -1 for one
    taken back) the sums are signed and the source rows are counted, see :func:`settled`.
    """
    return df.groupBy(day().alias("day"), "user_key", "mode").agg(
        _count(F.col("event_type") == "stage_clear", sign).alias("clears"),
        _count(F.col("event_type") == "stage_fail", sign).alias("fails"),
        *_signed(sign),
    )


def stage_difficulty(df: DataFrame, sign: Column | None = None) -> DataFrame:
    """Mergeable parts per (mode, stage): clears, attempts (clears and fails), and sum and number of clear times; ``sign`` as above."""
    is_clear = F.col("event_type") == "stage_clear"
    timed = is_clear & (F.col("clear_time_ms") > 0)
    weight = F.lit(1) if sign is None else sign
    return (
        df.filter(F.col("event_type").isin(*PLAYS))
        .groupBy("mode", "stage_id")
        .agg(
            _count(is_clear, sign).alias("clears"),
            _count(F.lit(True), sign).alias("attempts"),
            F.sum(F.when(timed, F.col("clear_time_ms") * weight).otherwise(0).cast("bigint")).alias("clear_ms"),
            _count(timed, sign).alias("timed_clears"),
            *_signed(sign),
        )
    )


def sum_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up any number of partial rows of an additive rollup."""
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in parts.columns if c not in keys])


def merge_rollup(old: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a new delta to a stored additive rollup."""
    return sum_parts(old.unionByName(delta), keys)


def settled(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rollup from any number of signed parts."""
    return sum_parts(parts, keys).filter(F.col(SOURCE_ROWS) != 0).drop(SOURCE_ROWS)


def added_up(keys: Sequence[str]) -> Callable[[DataFrame, bool], DataFrame]:
    """Merge of stored parts of an additive rollup; rows whose sums are all zero say nothing and go if the rollup is signed."""
    def merge(rows: DataFrame, oldest: bool) -> DataFrame:
        out = sum_parts(rows, keys).select(*rows.columns)
        if SOURCE_ROWS not in out.columns:
            return out
        return out.filter(reduce(or_, [F.col(c) != 0 for c in out.columns if c not in keys]))

    return merge


def latest_of(keys: Sequence[str], version: Sequence[str], horizon: int, op: str = "op") -> Callable[[DataFrame, bool], DataFrame]:
    """Merge of stored parts of a change feed: the latest row of each key, deletes included.

    A delete may be forgotten once nothing older is stored and it is more than ``horizon`` behind the newest change by the first version
    column; changes that arrive later than that may bring a deleted key back.
    """
    def merge(rows: DataFrame, oldest: bool) -> DataFrame:
        last = latest_by_key(rows, keys, version, op=None)
        newest = rows.agg(F.max(version[0])).first()[0]
        if not oldest or newest is None:
            return last
        return last.filter((F.coalesce(F.col(op), F.lit("")) != "d") | (F.col(version[0]) >= F.lit(newest) - horizon))

    return merge


def finalize_stage(parts: DataFrame) -> DataFrame:
    """Clear rate in per cent and mean clear time per (mode, stage), from any number of partial rows."""
    return sum_parts(parts, ["mode", "stage_id"]).withColumns({
        "clear_rate": F.col("clears") * F.lit(100.0) / F.greatest(F.col("attempts"), F.lit(1)),
        "avg_clear_ms": F.try_divide(F.col("clear_ms").cast("double"), F.col("timed_clears").cast("double")),
    })


def latest_by_key(changes: DataFrame, keys: Sequence[str], version: Sequence[str], op: str | None = "op") -> DataFrame:
    """Latest row per key of a change feed; a key whose last change is a delete (``op`` = 'd') is gone."""
    rest = [c for c in changes.columns if c not in keys and c not in version]
    last = changes.groupBy(*keys).agg(F.max(F.struct(*version, *rest)).alias("_last"))
    state = last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in changes.columns])
    return state if op is None else state.filter(F.coalesce(F.col(op), F.lit("")) != "d").drop(op)


def apply_cdc(state: DataFrame, changes: DataFrame, keys: Sequence[str], version: Sequence[str], op: str = "op") -> DataFrame:
    """Bring a latest-state table up to date with newer changes; rows that did not change pass through."""
    current = state.withColumn(op, F.lit("r"))
    return latest_by_key(current.unionByName(changes.select(*current.columns)), keys, version, op)
