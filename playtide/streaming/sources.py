"""Event streams in and out. Each consumer of a topic is its own query with its own checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from playtide.operators.ingest import to_message

# Topic names and producer settings.
EVENT_TOPIC = "game-events"
DEAD_LETTER_TOPIC = "game-events-dlq"
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.compression.type": "gzip", "kafka.linger.ms": "50"}


def read_events_stream(spark: SparkSession, servers: str, topic: str = EVENT_TOPIC, **options: str) -> DataFrame:
    """Message texts of a topic as column ``value``, from the newest message on unless told otherwise."""
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "latest", **options}
    return spark.readStream.format("kafka").options(**settings).load().selectExpr("CAST(value AS STRING) AS value")


def read_text_stream(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """Message texts from the lines of arriving files, as column ``value``."""
    return spark.readStream.options(**options).text(folder)


def write_events(df: DataFrame, servers: str, topic: str = EVENT_TOPIC, **options: str) -> None:
    """Publish records of a batch, keyed by user, as JSON."""
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER_OPTIONS, **options}
    to_message(df).write.format("kafka").options(**settings).save()


def write_events_stream(df: DataFrame, servers: str, checkpoint: str, topic: str = EVENT_TOPIC, **options: str) -> DataStreamWriter:
    """Publish a stream of records, keyed by user, as JSON; the caller starts it."""
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint, **PRODUCER_OPTIONS, **options}
    return to_message(df).writeStream.format("kafka").options(**settings)


def start_console(df: DataFrame, checkpoint: str, name: str, **options: str) -> StreamingQuery:
    """Print a stream for debugging."""
    return df.writeStream.format("console").queryName(name).options(checkpointLocation=checkpoint, **options).start()
