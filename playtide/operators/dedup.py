"""First-seen filter per event id with a time to live that duplicates do not refresh.

An id is let through, blocks its copies for ``ttl_ms`` and may then pass again. One hash aggregation of the times finds
the ids that come more than once; the rows of all others pass untouched. The first copy of a repeated id always passes, which
a map-side combined minimum finds. Only ids whose copies span the whole time to live can pass twice; those are rare, and
their later passes are found by pointer doubling over (id, time) pairs. No task ever holds all the copies of an id, so one id
may be as frequent as it likes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtide.session import written

TTL_MS = 3_600_000


def _first_rows(df: DataFrame, by: list[str], time_col: str) -> DataFrame:
    """One row per group: the earliest, and among equal times the smallest."""
    rest = [c for c in df.columns if c not in by and c != time_col]
    lead = [] if time_col in by else [time_col]
    first = F.min(F.struct(*lead, *rest)).alias("_first")
    picked = df.groupBy(*by).agg(first)
    return picked.select(*[F.col(c) if c in by else F.col(f"_first.{c}").alias(c) for c in df.columns])


def _split_repeated(df: DataFrame, key: str, time_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows of keys that come once, and the rows of the others with their key's first and last time (``_lo``, ``_hi``).

    The repeated keys are written, so their real size decides whether the raw rows need a shuffle to be told apart. Rows without a
    key share one.
    """
    spans = df.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(time_col).alias("_lo"), F.max(time_col).alias("_hi"))
    repeated = written(spans.filter("_rows > 1").drop("_rows"), "repeated")
    same = F.col(key).eqNullSafe(F.col("_key"))
    return df.join(repeated.select("_key"), same, "left_anti"), written(df.join(repeated, same).drop("_key"), "copies")


def first_by_key(df: DataFrame, key: str = "event_id", time_col: str = "timestamp") -> DataFrame:
    """Keep the first row per key, without expiry."""
    single, copies = _split_repeated(df, key, time_col)
    return single.unionByName(_first_rows(copies.select(*df.columns), [key], time_col))


def _next_pass(nodes: DataFrame, ttl_ms: int) -> DataFrame:
    """For each (key, at): the first later copy that is at least ``ttl_ms`` away, as ``nxt``.

    Copies are sliced by the time to live, so the copy sought lies in the probe's own slice or is the first of a later
    one; the slice table has one row per key and slice.
    """
    copies = nodes.select("key", F.col("at").alias("x"), F.lit(None).cast("bigint").alias("src"))
    probes = nodes.select("key", (F.col("at") + F.lit(ttl_ms)).alias("x"), F.col("at").alias("src"))
    both = copies.unionByName(probes).withColumn("slice", F.floor(F.col("x") / F.lit(ttl_ms)))
    copy_time = F.when(F.col("src").isNull(), F.col("x"))
    down = (
        Window.partitionBy("key", "slice")
        .orderBy(F.desc("x"), F.asc_nulls_first("src"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    later = Window.partitionBy("key").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        both.groupBy("key", "slice")
        .agg(F.min(copy_time).alias("lo"))
        .select("key", "slice", F.min("lo").over(later).alias("next_lo"))
    )
    return (
        both.withColumn("found", F.min(copy_time).over(down))
        .filter(F.col("src").isNotNull())
        .join(opening, ["key", "slice"])
        .select("key", F.col("src").alias("at"), F.coalesce("found", "next_lo").alias("nxt"))
    )


def _passes(nodes: DataFrame, ttl_ms: int) -> DataFrame:
    """(key, at) of every pass after the first, for keys with distinct copy times ``nodes``."""
    nodes = written(nodes, "times")
    longest = nodes.groupBy("key").agg((F.max("at") - F.min("at")).alias("span")).agg(F.max("span")).first()[0]
    if longest is None:
        return nodes
    jump = written(_next_pass(nodes, ttl_ms).filter(F.col("nxt").isNotNull()), "jumps")
    reached = nodes.groupBy("key").agg(F.min("at").alias("at"))
    steps = longest // ttl_ms
    covered = 0
    while covered < steps:
        hop = reached.join(jump, ["key", "at"]).select("key", F.col("nxt").alias("at"))
        reached = written(reached.unionByName(hop), "passes")
        covered = 2 * covered + 1
        if covered < steps:
            onward = jump.select("key", F.col("at").alias("nxt"), F.col("nxt").alias("far"))
            jump = written(jump.join(onward, ["key", "nxt"]).select("key", "at", F.col("far").alias("nxt")), "jumps")
    return reached


def dedup(df: DataFrame, key: str = "event_id", ttl_ms: int = TTL_MS, time_col: str = "timestamp") -> DataFrame:
    """Drop the copies of an id that arrive while the id is still remembered.

    ``time_col`` is the arrival clock in epoch milliseconds.
    """
    single, copies = _split_repeated(df, key, time_col)
    wide = copies.filter((F.col("_hi") - F.col("_lo") >= F.lit(ttl_ms)) & F.col(key).isNotNull())
    nodes = wide.select(F.col(key).alias("key"), F.col(time_col).alias("at")).distinct()
    passes = _passes(nodes, ttl_ms).select(F.col("key").alias(key), F.col("at").alias(time_col))
    later = wide.filter(F.col(time_col) > F.col("_lo")).join(passes, [key, time_col]).select(*df.columns)
    first = _first_rows(copies.select(*df.columns), [key], time_col)
    return single.unionByName(first).unionByName(_first_rows(later, [key, time_col], time_col))


def dedup_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows seen, rows dropped as copies, and their share in per cent."""
    seen = before.agg(F.count(F.lit(1)).alias("total"), F.lit(0).cast("bigint").alias("kept"))
    kept = after.agg(F.lit(0).cast("bigint").alias("total"), F.count(F.lit(1)).alias("kept"))
    both = seen.unionByName(kept).agg(F.sum("total").alias("total"), F.sum("kept").alias("kept"))
    dropped = F.col("total") - F.col("kept")
    rate = F.coalesce(F.try_divide(dropped * F.lit(100.0), F.col("total").cast("double")), F.lit(0.0))
    return both.select("total", dropped.alias("duplicates"), rate.alias("duplicate_pct"))
