"""Row-ordered rules per user that stay balanced when one user owns a large share of the rows.

A plain window over ``user_key`` sorts a whole user in one task. Here the rows are windowed per (user, time slice),
and what has to cross a slice border travels through a small per-slice table: one row per user and slice, so its size
per user depends on the covered time span only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
#: Slices whose counts one task carries on where there is no key to share them out.
SPAN = 86_400

#: Arrival order of events. All events of one request share ``timestamp``; ``seq`` and the unique id settle ties.
ARRIVAL = ("timestamp", "seq", "event_id")


def time_slice(time_col: str, width_ms: int) -> Column:
    return F.floor(F.col(time_col) / F.lit(width_ms))


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str],
    order: Sequence[str] = ARRIVAL,
    slice_ms: int = HOUR_MS,
) -> DataFrame:
    """Add struct ``previous`` with the ``payload`` of the preceding row of the same key, null for the first row.

    ``order`` starts with the epoch millisecond column that is sliced.
    """
    sliced = df.withColumn("_slice", time_slice(order[0], slice_ms))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    tails = sliced.groupBy(*keys, "_slice").agg(F.max(F.struct(*order, F.struct(*payload).alias("row"))).alias("_last"))
    carried = tails.select(
        *keys, "_slice", F.lag("_last.row").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_carried")
    )
    return (
        sliced.withColumn("_inside", F.lag(F.struct(*payload)).over(inside))
        .join(carried, [*keys, "_slice"], "left")
        .withColumn("previous", F.coalesce("_inside", "_carried"))
        .drop("_slice", "_inside", "_carried")
    )


def _carried(rows: DataFrame, keys: Sequence[str], order: str, sums: dict[str, str]) -> DataFrame:
    """For each row, the sums over the earlier rows of its key: new name -> summed column."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(*keys, order, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(name) for name, c in sums.items()])


def with_running_counts(
    df: DataFrame,
    keys: Sequence[str],
    counts: dict[str, Column],
    order: Sequence[str] = ARRIVAL,
    slice_ms: int = HOUR_MS,
) -> DataFrame:
    """Add one running count per entry of ``counts``: rows of the key up to and including this one where the flag holds.

    Without ``keys`` the count runs over all rows; choose a slice narrow enough for one task then. Counts are carried in two
    levels there: over the slices of a span of ``SPAN`` slices, and over the spans, of which a second's slices make one a day.
    """
    hits = {name: F.when(flag, F.lit(1)).otherwise(F.lit(0)).cast("bigint") for name, flag in counts.items()}
    sliced = df.withColumns({"_slice": time_slice(order[0], slice_ms), **{f"_hit_{n}": hit for n, hit in hits.items()}})
    inside = (
        Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    per_slice = sliced.groupBy(*keys, "_slice").agg(*[F.sum(f"_hit_{n}").alias(f"_hits_{n}") for n in counts])
    hits_of = {f"_carry_{n}": f"_hits_{n}" for n in counts}
    if keys:
        carried = _carried(per_slice, keys, "_slice", hits_of)
    else:
        per_slice = per_slice.withColumn("_span", F.floor(F.col("_slice") / F.lit(SPAN)))
        per_span = per_slice.groupBy("_span").agg(*[F.sum(f"_hits_{n}").alias(f"_hits_{n}") for n in counts])
        spans = _carried(per_span, [], "_span", {f"_span_{n}": f"_hits_{n}" for n in counts})
        carried = _carried(per_slice, ["_span"], "_slice", hits_of).join(spans, "_span").select(
            "_slice", *[(F.col(f"_carry_{n}") + F.col(f"_span_{n}")).alias(f"_carry_{n}") for n in counts])
    return (
        sliced.withColumns({f"_in_{n}": F.sum(f"_hit_{n}").over(inside) for n in counts})
        .join(carried, [*keys, "_slice"], "left")
        .select(*df.columns, *[(F.col(f"_in_{n}") + F.col(f"_carry_{n}")).alias(n) for n in counts])
    )


def with_trailing_count(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    window_ms: int,
    order: Sequence[str] = ARRIVAL,
    slice_ms: int = HOUR_MS,
) -> DataFrame:
    """Add ``name``: rows of the key within ``window_ms`` before the row, the row itself included.

    A row counts up when it arrives and down once the window has passed it, so one running sum gives every count in
    linear time, however many rows fall into a window. A row whose window reaches into the next slice also opens that
    slice. Rows of equal time count in arrival order, as a stream would see them.
    """
    time = F.col(order[0])
    width = max(slice_ms, window_ms + 1)
    home, leaves = F.floor(time / F.lit(width)), time + F.lit(window_ms + 1)
    last_home = F.floor(leaves / F.lit(width))

    def step(slice_no: Column, at: Column, kind: int, delta: int) -> Column:
        return F.struct(
            slice_no.alias("slice"), at.alias("at"), F.lit(kind).alias("kind"), F.lit(delta).cast("bigint").alias("delta")
        )

    opens, drops, arrives = 0, 1, 2
    steps = F.array_compact(
        F.array(
            step(home, time, arrives, 1),
            F.when(last_home > home, step(last_home, last_home * F.lit(width), opens, 1)),
            step(last_home, leaves, drops, -1),
        )
    )
    row = F.struct(*[F.col(c) for c in df.columns])
    running = (
        Window.partitionBy(*[F.col(f"_{k}") for k in keys], F.col("_step.slice"))
        .orderBy(F.col("_step.at"), F.col("_step.kind"), *[F.col(f"_row.{c}") for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        df.select(*[F.col(k).alias(f"_{k}") for k in keys], row.alias("_all"), F.explode(steps).alias("_step"))
        .withColumn("_row", F.when(F.col("_step.kind") == arrives, F.col("_all")))
        .drop("_all")
        .withColumn("_count", F.sum("_step.delta").over(running))
        .filter(F.col("_step.kind") == arrives)
        .select("_row.*", F.col("_count").alias(name))
    )


def time_ordered(df: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """All users' events merged into one time order (a range-partitioned sort)."""
    return df.orderBy(*order)
