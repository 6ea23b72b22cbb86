"""Streaming jobs: sources wired to rules and durable sinks.

The cleaned events are a table of their own, and sessions and alerts are separate queries over it. Each query restarts
from its own checkpoint after a failure, and none of them depends on data kept by an executor.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from playtide.operators import ingest
from playtide.operators.alerts import RAPID_COUNT, RAPID_WINDOW_MS
from playtide.operators.sessions import GAP_MS
from playtide.schema import ALERT_SCHEMA, EVENT_SCHEMA, names
from playtide.session import collected, drop
from playtide.sources.tables import JDBC_BATCH_ROWS, clustered_events, month_of
from playtide.sources.tiered import TieredTable
from playtide.streaming.carried import DELAY_MS, Rule, alert_numbers_rule, alerts_rule, carried, sessions_rule
from playtide.streaming.rules import dedup_stream

# How often the sinks write.
SINK_INTERVAL = "5 seconds"


def _triggered(writer: DataStreamWriter, available_now: bool) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=SINK_INTERVAL)


def start_fact_sink(df: DataFrame, path: str, checkpoint: str, time_col: str, available_now: bool = False) -> StreamingQuery:
    """Append a stream to a month-partitioned table; the file sink writes each micro-batch exactly once."""
    writer = df.withColumn("month", month_of(time_col)).writeStream.format("parquet").partitionBy("month")
    return _triggered(writer.options(path=path, checkpointLocation=checkpoint), available_now).start()


def read_fact_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Follow a table another query appends to."""
    return spark.readStream.schema(T.StructType([*schema.fields, T.StructField("month", T.StringType())])).parquet(path)


def start_jdbc_sink(df: DataFrame, table: str, checkpoint: str, available_now: bool = False, **options: str) -> StreamingQuery:
    """Append each micro-batch to a JDBC table in batches of 500 rows.

    A micro-batch that is repeated after a failure is written again, as with any plain JDBC append.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        settings = {"batchsize": str(JDBC_BATCH_ROWS), **options}
        batch.write.format("jdbc").mode("append").options(**settings).option("dbtable", table).save()

    return _triggered(df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now).start()


def _stored(df: DataFrame, path: str) -> DataFrame:
    """A micro-batch's frame, worked out once: each micro-batch overwrites the last one's."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def start_routed_sink(
    parsed: DataFrame, accepted_path: str, dead_path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Write accepted records and dead letters of one stream to two tables.

    A micro-batch owns one folder in each table and overwrites it when it is repeated, so nothing is written twice. How many records
    it accepted and refused goes to a third table beside the dead letters, ``{dead_path}-counts``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        accepted, dead, counts = ingest.route_dlq(_stored(batch, f"{checkpoint}-parsed"))
        counts.write.mode("overwrite").parquet(f"{dead_path}-counts/batch_id={batch_id}")
        accepted.write.mode("overwrite").parquet(f"{accepted_path}/batch_id={batch_id}")
        dead.write.mode("overwrite").parquet(f"{dead_path}/batch_id={batch_id}")

    return _triggered(parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now).start()


def start_ingest(
    requests: DataFrame, records_path: str, refused_path: str, checkpoint: str,
    server_time: Column | None = None, available_now: bool = False,
) -> StreamingQuery:
    """Requests as JSON text (column ``value``) to event records; refused requests keep their text and errors."""

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = _stored(ingest.validate_batches(ingest.parse_batches(batch.select("value"))), f"{checkpoint}-checked")
        records = ingest.flatten_payload(ingest.enrich(ingest.explode_batches(checked), server_time))
        records.write.mode("overwrite").parquet(f"{records_path}/batch_id={batch_id}")
        refused = checked.filter(F.size("errors") > 0).select(
            F.array_join("errors", ",").alias("error"), F.col("value").alias("record")
        )
        refused.write.mode("overwrite").parquet(f"{refused_path}/batch_id={batch_id}")

    return _triggered(requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now).start()


def parts_table(
    stream: DataFrame, summarise: Callable[[DataFrame], DataFrame], path: str, merge: Callable[[DataFrame, bool], DataFrame],
) -> TieredTable:
    """The table of a rollup's or latest-state table's parts, one for each micro-batch, merged in tiers (``added_up``, ``latest_of``)."""
    return TieredTable(stream.sparkSession, path, summarise(stream).schema, merge)


def start_parts(
    stream: DataFrame, summarise: Callable[[DataFrame], DataFrame], table: TieredTable, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Keep a rollup or a latest-state table up to date: each micro-batch adds its own summary to the table of parts.

    Readers combine what is stored (``sum_parts``, ``latest_by_key`` over ``table.read()``). A repeated micro-batch replaces its part.
    """
    return start_tiered(stream, summarise, table, checkpoint, available_now)


def start_tiered(
    stream: DataFrame, change: Callable[[DataFrame], DataFrame], table: TieredTable, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Each micro-batch's ``change`` becomes a part of the table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        with collected() as used:
            table.commit(change(batch), batch_id)
        for path in used:
            drop(batch.sparkSession, path)

    return _triggered(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now).start()


def start_clustering(stream: DataFrame, table: TieredTable, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Follow a fact stream (with its ``month``) into a clustered table: few files, each with a narrow range of keys."""
    return start_tiered(stream, lambda batch: batch, table, checkpoint, available_now)


@dataclass(frozen=True)
class JobPaths:
    """Where a job keeps its tables and checkpoints, below one folder all executors reach."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def work(self, name: str) -> str:
        return f"{self.root}/work/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def start_cleaning(events: DataFrame, paths: JobPaths, available_now: bool = False) -> StreamingQuery:
    """Accepted events without copies, appended to the table ``events``. ``events`` has the typed event columns."""
    clean = dedup_stream(ingest.require(ingest.only_version(events))).select(*names(EVENT_SCHEMA))
    return start_fact_sink(clean, paths.table("events"), paths.checkpoint("events"), "timestamp", available_now)


def start_carried(
    stream: DataFrame, rule: Rule, path: str, work: str, checkpoint: str, time_col: str | None = None, available_now: bool = False
) -> StreamingQuery:
    """Run a rule with carried state into a table; ``time_col`` partitions it by month, and stamps the time of writing."""
    def write(df: DataFrame, folder: str) -> None:
        stamped = df.select("*", F.current_timestamp().alias("created_at"), month_of(time_col).alias("month"))
        stamped.write.mode("overwrite").partitionBy("month").parquet(folder)

    writer = carried(stream, rule, path, work, write if time_col else None)
    return _triggered(writer.option("checkpointLocation", checkpoint), available_now).start()


def _follow(spark: SparkSession, paths: JobPaths, rule: Rule, name: str, time_col: str, available_now: bool) -> StreamingQuery:
    events = read_fact_stream(spark, paths.table("events"), EVENT_SCHEMA)
    return start_carried(
        events, rule, paths.table(name), paths.work(name), paths.checkpoint(name), time_col, available_now)


def start_sessions(
    spark: SparkSession, paths: JobPaths, gap_ms: int = GAP_MS, delay_ms: int = DELAY_MS, available_now: bool = False
) -> StreamingQuery:
    """Sessions of the cleaned events, in the table ``sessions``."""
    return _follow(spark, paths, sessions_rule(gap_ms, delay_ms), "sessions", "session_start", available_now)


def start_alerts(
    spark: SparkSession, paths: JobPaths, window_ms: int = RAPID_WINDOW_MS, threshold: int = RAPID_COUNT,
    available_now: bool = False,
) -> StreamingQuery:
    """Alerts of the cleaned events, in the table ``alerts``."""
    rule = alerts_rule(window_ms=window_ms, threshold=threshold)
    return _follow(spark, paths, rule, "alerts", "detected_at", available_now)


def start_alert_numbers(spark: SparkSession, paths: JobPaths, available_now: bool = False) -> StreamingQuery:
    """The alerts with their running number within the user, in the table ``alert_numbers``."""
    alerts = read_fact_stream(spark, paths.table("alerts"), ALERT_SCHEMA).select(*names(ALERT_SCHEMA))
    return start_carried(
        alerts, alert_numbers_rule(), paths.table("alert_numbers"), paths.work("alert_numbers"), paths.checkpoint("alert_numbers"),
        available_now=available_now)


def start_event_clustering(spark: SparkSession, paths: JobPaths, available_now: bool = False) -> StreamingQuery:
    """The cleaned events in the clustered table ``clustered_events``, beside the append-only one that the other queries follow."""
    events = read_fact_stream(spark, paths.table("events"), EVENT_SCHEMA)
    return start_clustering(
        events, clustered_events(spark, paths.table("clustered_events")), paths.checkpoint("clustered_events"), available_now)


def run_available(
    events: DataFrame, root: str, gap_ms: int = GAP_MS, window_ms: int = RAPID_WINDOW_MS, threshold: int = RAPID_COUNT
) -> JobPaths:
    """Run cleaning, then sessions and alerts, over the input that is there now."""
    paths, spark = JobPaths(root), events.sparkSession
    start_cleaning(events, paths, available_now=True).awaitTermination()
    followers = [
        start_sessions(spark, paths, gap_ms, available_now=True),
        start_alerts(spark, paths, window_ms, threshold, available_now=True),
    ]
    for query in followers:
        query.awaitTermination()
    return paths
