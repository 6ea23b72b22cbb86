"""Counters of streams that survive a restart: observed metrics, kept once for each micro-batch."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from playtide.functions import late
from playtide.functions.expressions import LATE_MS


def _plain(value):
    return value.isoformat() if isinstance(value, (date, datetime)) else value


class StoredMetrics(StreamingQueryListener):
    """Stores what ``df.observe(name, ...)`` reports below ``root``: one small file for each query, metric and micro-batch.

    The file of a micro-batch that is repeated after a failure replaces the earlier one, so sums count it once. A query keeps its id over
    restarts from its checkpoint. Register it by ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            values = {k: _plain(v) for k, v in row.asDict().items()}
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/query={progress.id}/batch-{progress.batchId:09d}.json")
            stream = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
            stream.write(bytearray(json.dumps(values).encode()))
            stream.close()


def read_metrics(spark: SparkSession, root: str, name: str, columns: list[str]) -> DataFrame:
    """A row of counters (long) for each micro-batch stored, with its query."""
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in columns), T.StructField("query", T.StringType())])
    return spark.read.schema(schema).json(f"{root.rstrip('/')}/{name}")


def observe_dedup(df: DataFrame, name: str) -> DataFrame:
    """Count the rows that pass here, as metric ``name``; place one before and one after a dedup."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def dedup_totals(spark: SparkSession, root: str, before: str, after: str) -> DataFrame:
    """The statistics of ``dedup_stats`` over all micro-batches: rows seen, rows dropped as copies, and their share in per cent."""
    seen = read_metrics(spark, root, before, ["rows"]).select(F.col("rows").alias("total"), F.lit(0).cast("bigint").alias("kept"))
    kept = read_metrics(spark, root, after, ["rows"]).select(F.lit(0).cast("bigint").alias("total"), F.col("rows").alias("kept"))
    both = seen.unionByName(kept).agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("kept"), F.lit(0)).alias("kept"))
    dropped = F.col("total") - F.col("kept")
    rate = F.coalesce(F.try_divide(dropped * F.lit(100.0), F.col("total").cast("double")), F.lit(0.0))
    return both.select("total", dropped.alias("duplicates"), rate.alias("duplicate_pct"))


def observe_lateness(df: DataFrame, name: str, threshold_ms: int = LATE_MS) -> DataFrame:
    """Count events and late events, as metric ``name``."""
    is_late: Column = late(threshold_ms)
    return df.observe(name, F.count(F.lit(1)).alias("total"), F.count_if(is_late).alias("late"))


def quality_totals(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The counters of ``quality_stats`` over all micro-batches."""
    sums = read_metrics(spark, root, name, ["total", "late"]).agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("late"), F.lit(0)).alias("late"))
    return sums.select(
        "total", (F.col("total") - F.col("late")).alias("normal"), "late",
        F.try_divide(F.col("late").cast("double") * F.lit(100.0), F.col("total").cast("double")).alias("late_rate"))
