"""Stored tables: fact and state tables on files, JDBC tables, JSON lines, retention.

A fact table is partitioned by month. Its rows are range-partitioned by (month, sort key) before the write, so a large
month is spread over many tasks and files, every file covers a narrow key range, and the scan can skip by min/max.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.functions import event_ts
from playtide.schema import ALERT_FACT_SCHEMA, ALERT_SCHEMA, EVENT_SCHEMA, SESSION_FACT_SCHEMA, SESSION_SCHEMA, names
from playtide.sources.tiered import TieredTable

# Sort keys of the stored tables and how long raw events are kept.
EVENT_SORT = ("event_type", "user_key", "timestamp")
SESSION_SORT = ("user_key", "session_start")
ALERT_SORT = ("alert_type", "user_key", "detected_at")
RETENTION_MONTHS = 6
JDBC_BATCH_ROWS = 500


def month_of(ms: str) -> Column:
    """Partition value ``yyyyMM`` of an epoch millisecond column."""
    return F.date_format(event_ts(ms), "yyyyMM")


def _write_fact(df: DataFrame, path: str, time_col: str, sort: Sequence[str], mode: str, partitions: int | None) -> None:
    keyed = df.withColumn("month", month_of(time_col))
    columns = ["month", *sort]
    spread = keyed.repartitionByRange(partitions, *columns) if partitions else keyed.repartitionByRange(*columns)
    spread.sortWithinPartitions(*columns).write.mode(mode).partitionBy("month").parquet(path)


def write_fact_events(df: DataFrame, path: str, mode: str = "append", partitions: int | None = None) -> None:
    """Append raw events, sorted by (type, user, time) within each file."""
    _write_fact(df, path, "timestamp", EVENT_SORT, mode, partitions)


def write_fact_sessions(df: DataFrame, path: str, mode: str = "append", partitions: int | None = None) -> None:
    """Append session summaries with the time of writing."""
    stamped = df.select(*names(SESSION_SCHEMA), F.current_timestamp().alias("created_at"))
    _write_fact(stamped, path, "session_start", SESSION_SORT, mode, partitions)


def write_fact_alerts(df: DataFrame, path: str, mode: str = "append", partitions: int | None = None) -> None:
    """Append alerts with the time of writing; missing text is stored as ''."""
    stamped = df.select(*names(ALERT_SCHEMA)).na.fill("").na.fill(0).withColumn("created_at", F.current_timestamp())
    _write_fact(stamped, path, "detected_at", ALERT_SORT, mode, partitions)


def read_fact(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan a fact table of the given schema; ``month`` is text and prunes partitions."""
    stored = T.StructType([*schema.fields, T.StructField("month", T.StringType())])
    return spark.read.schema(stored).parquet(path).select(*stored.names)


def in_months(df: DataFrame, time_col: str, from_ms: int | None = None, to_ms: int | None = None) -> DataFrame:
    """Rows of a fact table with ``from_ms <= time < to_ms``; the month filter keeps other partitions unread."""
    keep = F.lit(True)
    if from_ms is not None:
        first = F.date_format(F.timestamp_millis(F.lit(from_ms)), "yyyyMM")
        keep = keep & (F.col("month") >= first) & (F.col(time_col) >= from_ms)
    if to_ms is not None:
        last = F.date_format(F.timestamp_millis(F.lit(to_ms - 1)), "yyyyMM")
        keep = keep & (F.col("month") <= last) & (F.col(time_col) < to_ms)
    return df.filter(keep)


def apply_retention(df: DataFrame, as_of: Column, months: int = RETENTION_MONTHS, time_col: str = "timestamp") -> DataFrame:
    """Rows not older than ``months`` before ``as_of`` (a timestamp). On a fact table whole partitions are skipped."""
    oldest = F.make_interval(months=F.lit(-months)) + as_of
    keep = event_ts(time_col) >= oldest
    if "month" in df.columns:
        keep = (F.col("month") >= F.date_format(oldest, "yyyyMM")) & keep
    return df.filter(keep)


def clustered_table(spark: SparkSession, path: str, schema: T.StructType, sort: Sequence[str]) -> TieredTable:
    """A fact table that streams write: months, small parts merged into sorted ones, and a key range for each file."""
    stored = T.StructType([*schema.fields, T.StructField("month", T.StringType())])
    return TieredTable(spark, path, stored, sort=sort, partition=["month"])


def clustered_events(spark: SparkSession, path: str) -> TieredTable:
    """Raw events by (type, user, time)."""
    return clustered_table(spark, path, EVENT_SCHEMA, EVENT_SORT)


def clustered_sessions(spark: SparkSession, path: str) -> TieredTable:
    """Session summaries by (user, start)."""
    return clustered_table(spark, path, SESSION_FACT_SCHEMA, SESSION_SORT)


def clustered_alerts(spark: SparkSession, path: str) -> TieredTable:
    """Alerts by (type, user, time)."""
    return clustered_table(spark, path, ALERT_FACT_SCHEMA, ALERT_SORT)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Events from JSON lines, one object per line."""
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Events as JSON lines, one file per partition."""
    df.write.mode(mode).json(path)


def read_table(spark: SparkSession, source: str, format: str = "parquet", **options: str) -> DataFrame:
    """A stored table: a path for file formats, a table name for ``format="jdbc"`` (url and credentials as options)."""
    reader = spark.read.format(format).options(**options)
    return reader.option("dbtable", source).load() if format == "jdbc" else reader.load(source)


def append_table(df: DataFrame, target: str, format: str = "parquet", **options: str) -> None:
    """Append rows to a stored table; JDBC goes in batches of 500 rows."""
    writer = df.write.mode("append").format(format)
    if format == "jdbc":
        writer.options(**{"batchsize": str(JDBC_BATCH_ROWS), **options}).option("dbtable", target).save()
    else:
        writer.options(**options).save(target)
