"""Stateful rules on streams: the batch operators over each micro-batch and a small carried state.

A rule turns (state, rows) into (output, new state), all DataFrames. Each micro-batch owns a folder of the output, the state and the
rows, and overwrites it when it is repeated, so a restart neither loses nor doubles anything. The rules run in the JVM with the
batch operators' plans: a user (or id) with a large share of the rows is split there like in a batch job.

Nothing is dropped as late: a row counts in the micro-batch in which it arrives. Within a micro-batch rows are ordered by time; a row
that is older than what earlier micro-batches held is measured against the state that is still carried.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from playtide.operators import alerts, dedup, quality, sessions
from playtide.operators.ordered import ARRIVAL, with_previous, with_trailing_count
from playtide.schema import ALERT_SCHEMA, SESSION_SCHEMA, names
from playtide.session import collected, drop
from playtide.sources.tiered import KeyedState

#: How far behind the newest event a session's end must be before the session is written.
DELAY_MS = 3_600_000

Keep = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Rule:
    """``step(state, rows, keep)`` gives the output and the new state; ``keep(df, name)`` stores what it uses twice.

    Without ``keys`` the state is small and written anew by each micro-batch. With ``keys`` it is a log of changes: ``step`` gets the state of
    the keys that are in the micro-batch and returns rows of these keys, and only those are written. ``alive(rows)`` may tell from the
    micro-batch which state rows still count; the others are dropped as parts of the log are merged.
    """

    state: T.StructType
    step: Callable[[DataFrame, DataFrame, Keep], tuple[DataFrame, DataFrame]]
    keys: tuple[str, ...] = ()
    alive: Callable[[DataFrame], Column] | None = None


def carried(stream: DataFrame, rule: Rule, path: str, work: str, write: Callable[[DataFrame, str], None] | None = None) -> DataStreamWriter:
    """Run ``rule`` over a stream: outputs go to ``path``, state and kept rows below ``work`` (both shared folders).

    A rule without keys holds the state of the last two micro-batches, one with keys that of :class:`KeyedState`. Whatever else a micro-batch
    stores is deleted at its end. ``write(df, folder)`` may replace the plain Parquet write.
    """
    put = write or (lambda df, folder: df.write.mode("overwrite").parquet(folder))

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        used = set()

        def keep(df: DataFrame, name: str) -> DataFrame:
            used.add(name)
            folder = f"{work}/{name}/batch_id={number}"
            df.write.mode("overwrite").parquet(folder)
            return spark.read.schema(df.schema).parquet(folder)

        with collected() as tables:
            rows = keep(batch, "rows")
            if rule.keys:
                stored = KeyedState(spark, f"{work}/state", rule.state, rule.keys)
                out, state = rule.step(stored.of(rows, number), rows, keep)
                put(out, f"{path}/batch_id={number}")
                stored.commit(state.select(*rule.state.names), number, rule.alive(rows) if rule.alive else None)
            else:
                before = spark.createDataFrame([], rule.state) if number == 0 else spark.read.schema(rule.state).parquet(
                    f"{work}/state/batch_id={number - 1}")
                out, state = rule.step(before, rows, keep)
                state.select(*rule.state.names).write.mode("overwrite").parquet(f"{work}/state/batch_id={number}")
                put(out, f"{path}/batch_id={number}")
                drop(spark, f"{work}/state/batch_id={number - 2}")
        for folder in [*tables, *(f"{work}/{name}/batch_id={number}" for name in used)]:
            drop(spark, folder)

    return stream.writeStream.foreachBatch(run)


def rapid_fire_rule(
    window_ms: int = alerts.RAPID_WINDOW_MS, threshold: int = alerts.RAPID_COUNT, delay_ms: int = DELAY_MS,
) -> Rule:
    """Alerts for clears that bring a user to ``threshold`` within the trailing window. State: each user's clears of the last window.

    Clears more than ``delay_ms`` and the window behind the newest event of all users are forgotten, also those of users who fell silent.
    """
    state = T.StructType.fromDDL("user_key string, session_id string, timestamp long, seq int, event_id string")

    def step(before: DataFrame, rows: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame]:
        clears = rows.filter(F.col("event_type") == "stage_clear").select(*state.names)
        both = before.withColumn("fresh", F.lit(False)).unionByName(clears.withColumn("fresh", F.lit(True)))
        counted = with_trailing_count(both, ["user_key"], "recent", window_ms)
        newest = both.groupBy("user_key").agg(F.max("timestamp").alias("newest"))
        clock = rows.select("timestamp").union(before.select("timestamp")).agg(F.max("timestamp")).first()[0]
        since = F.greatest(F.col("newest") - window_ms, F.lit(clock) - window_ms - delay_ms)
        held = both.join(newest, "user_key").filter(F.col("timestamp") >= since)
        return alerts.rapid_fire_alerts(counted.filter("fresh"), threshold), held

    return Rule(state, step)


def alerts_rule(
    min_clear_ms: int = alerts.MIN_CLEAR_MS, window_ms: int = alerts.RAPID_WINDOW_MS, threshold: int = alerts.RAPID_COUNT,
) -> Rule:
    """All alerts of a cleaned event stream."""
    rapid = rapid_fire_rule(window_ms, threshold)

    def step(before: DataFrame, rows: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame]:
        fired, held = rapid.step(before, rows, keep)
        return alerts.row_alerts(rows, min_clear_ms).unionByName(fired).select(*names(ALERT_SCHEMA)), held

    return Rule(rapid.state, step)


def user_quality_rule() -> Rule:
    """Per event: its number within the user, the time since the user's previous event, and skipped sequence numbers.

    ``gap_ms`` is null for a user's first event and ``missing`` where nothing was skipped. State: one row per user, of which a micro-batch
    reads and writes those of its own users.
    """
    state = T.StructType.fromDDL("user_key string, events long, last struct<timestamp:long,seq:int,event_id:string>, "
                                 "numbered struct<timestamp:long,seq:int,event_id:string,session_id:string>")

    def step(before: DataFrame, rows: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame]:
        rows = rows.select("user_key", "session_id", *ARRIVAL)
        earlier = before.select("user_key", "events", F.col("last.timestamp").alias("last_ms"), F.col("numbered").alias("_numbered"))
        counted = with_previous(quality.with_event_no(rows), ["user_key"], ["timestamp"])
        steps = with_previous(rows.filter(F.col("seq") > 0), ["user_key"], ["session_id", "seq"])
        previous = F.coalesce(F.col("previous"), F.struct(F.col("_numbered.session_id"), F.col("_numbered.seq")))
        skipped = steps.join(earlier, "user_key", "left").withColumn("previous", previous).filter(
            (F.col("previous.session_id") == F.col("session_id")) & (F.col("seq") > F.col("previous.seq") + 1)
        ).select(
            "user_key", *ARRIVAL, (F.col("previous.seq") + 1).cast("long").alias("expected_seq"),
            (F.col("seq") - F.col("previous.seq") - 1).cast("long").alias("missing"))
        out = counted.join(earlier, "user_key", "left").join(skipped, ["user_key", *ARRIVAL], "left").select(
            "user_key", "event_id", "timestamp", (F.col("event_no") + F.coalesce("events", F.lit(0))).alias("event_no"),
            (F.col("timestamp") - F.coalesce("previous.timestamp", "last_ms")).alias("gap_ms"), "expected_seq",
            F.col("seq").cast("long").alias("seq"), "missing")
        now = rows.groupBy("user_key").agg(
            F.count(F.lit(1)).alias("events"), F.max(F.struct(*ARRIVAL)).alias("last"),
            F.max(F.when(F.col("seq") > 0, F.struct(*ARRIVAL, "session_id"))).alias("numbered"))
        # Of the micro-batches that know a user, the later one tells its last event: it is the one that arrived last.
        old = before.withColumn("_turn", F.lit(0)).unionByName(now.withColumn("_turn", F.lit(1)))
        latest = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct("_turn", c)))[c].alias(c)
        return out, old.groupBy("user_key").agg(F.sum("events").alias("events"), latest("last"), latest("numbered"))

    return Rule(state, step, ("user_key",))


def alert_numbers_rule() -> Rule:
    """Alerts of a stream with ``alert_no``, the running number within their user. State: how many alerts each user has had."""
    state = T.StructType([T.StructField("user_key", T.StringType()), T.StructField("alerts", T.LongType())])

    def step(before: DataFrame, rows: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame]:
        earlier = before.select(F.col("user_key").alias("_user"), F.col("alerts").alias("_earlier"))
        same = F.col("user_key").eqNullSafe(F.col("_user"))
        numbered = alerts.with_alert_no(rows).join(earlier, same, "left").withColumn(
            "alert_no", F.col("alert_no") + F.coalesce("_earlier", F.lit(0))).drop("_user", "_earlier")
        both = before.unionByName(alerts.alert_counts(rows))
        return numbered, both.groupBy("user_key").agg(F.sum("alerts").alias("alerts"))

    return Rule(state, step, ("user_key",))


def dedup_rule(schema: T.StructType, ttl_ms: int = dedup.TTL_MS, key: str = "event_id", time_col: str = "timestamp") -> Rule:
    """Drop copies within ``ttl_ms`` of an id's last pass; later copies pass again. State: the last pass of each id, for ``ttl_ms``.

    ``time_col`` is the clock in epoch milliseconds. A copy that is older than its id's last pass is blocked like one of the same time.
    A micro-batch opens the passes of its own ids and writes those that passed; passes that block nothing any more, by the newest row,
    go when parts are merged.
    """
    state = T.StructType([schema[key], T.StructField("last_pass", T.LongType())])

    def step(before: DataFrame, rows: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame]:
        row = F.struct(*[F.col(c) for c in schema.names]).alias("row")
        held = keep(before, "held").select(F.col(key).alias("held"), "last_pass")
        clock = F.greatest(F.col(time_col), F.coalesce("last_pass", F.col(time_col)))
        timed = rows.join(held, F.col(key).eqNullSafe(F.col("held")), "left").select(F.col(key).alias("key"), clock.alias("at"), F.lit(1).alias("fresh"), row)
        old = held.select(F.col("held").alias("key"), F.col("last_pass").alias("at"), F.lit(0).alias("fresh"), F.lit(None).cast(schema).alias("row"))
        # At equal times the remembered pass sorts first and blocks the copies.
        both = keep(old.unionByName(timed), "copies")
        passed = keep(dedup.dedup(both, "key", ttl_ms, "at").filter("fresh = 1"), "passed")
        return passed.select("row.*"), passed.groupBy(F.col("key").alias(key)).agg(F.max("at").alias("last_pass"))

    def alive(rows: DataFrame) -> Column:
        newest = rows.agg(F.max(time_col)).first()[0]
        return F.col("last_pass") > F.lit(newest) - ttl_ms if newest is not None else F.lit(True)

    return Rule(state, step, (key,), alive)


def sessions_rule(gap_ms: int = sessions.GAP_MS, delay_ms: int = DELAY_MS) -> Rule:
    """Sessions, written once the newest event is ``delay_ms`` past their end and gap. State: partial sums of the others.

    A session's state does not grow with its events. A late event that closes the gap between two open sessions joins them; events that come
    after their session was written form sessions of their own.
    """
    def step(before: DataFrame, rows: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame]:
        parts = keep(sessions.session_parts(rows, gap_ms), "parts")
        runs = keep(sessions.merged_runs(before.unionByName(sessions.runs_of(parts)), gap_ms), "runs")
        newest = runs.agg(F.max("run_last")).first()[0]
        closed = F.col("run_last") + gap_ms <= F.lit(newest) - delay_ms
        out = sessions.summary_of_parts(runs.filter(closed).withColumn("session_start", F.col("run_first")))
        return out.select(*names(SESSION_SCHEMA)), runs.filter(~closed)

    return Rule(sessions.RUN_SCHEMA, step)
