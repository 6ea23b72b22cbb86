"""Game events, scores and users derived from the star-schema sample tables (``events`` and ``customer``).

Every row of the table becomes events through plain projections, so the same expressions serve batch and streaming
reads, and the work grows with the table. ``k`` is the number inside ``props``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.functions import event_ts, rounded
from playtide.schema import EVENT_SCHEMA, names
from playtide.session import configure

RAW_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    return spark.read.schema(RAW_SCHEMA).parquet(f"{folder}/events.parquet")


def raw_events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same table as a stream of files."""
    configure(spark)
    return spark.readStream.schema(RAW_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(folder)


def _user_key(column: str) -> str:
    return f"concat(IF({column} % 25 = 0, 'user_bot_', 'user_'), {column})"


# The base columns, then the event columns in schema order, as SQL text over the sample's columns.
_BASE = (
    "*",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
    "unix_millis(CAST(ts AS TIMESTAMP)) AS ms",
    f"{_user_key('user_id')} AS user",
    "event_type IN ('view', 'purchase', 'error') AS on_stage",
    "event_type = 'purchase' AS is_clear",
)
_GAME_EVENT = {
    "event_id": "concat('e', event_id)",
    "event_type": """CASE event_type WHEN 'signup' THEN 'session_start' WHEN 'view' THEN 'stage_start'
        WHEN 'purchase' THEN 'stage_clear' WHEN 'error' THEN 'stage_fail'
        ELSE IF(k % 4 = 0, 'item_use', 'navigation') END""",
    "user_key": "user",
    "session_id": "concat(user, '-', date_format(ts, 'yyyyMMdd'))",
    "timestamp": "ms",
    "client_timestamp": "ms - IF(event_id % 50 = 0, 5000 + 1000 * (event_id % 41), 20 * k - 200)",
    "app_version": "'1.0.0'",
    "schema_version": "IF(event_id % 40 = 0, '1', '2')",
    "seq": "k % 6",
    "mode": "CASE WHEN NOT on_stage THEN '' WHEN k % 2 = 0 THEN 'story' ELSE 'time_attack' END",
    "stage_id": """CASE WHEN NOT on_stage THEN '' WHEN k % 2 = 0 THEN concat(k div 20 + 1, '-', k % 10 + 1)
        ELSE concat('ta-', k % 15 + 1) END""",
    "grid_size": """CASE WHEN NOT on_stage THEN '' WHEN k < 20 THEN '3x3' WHEN k < 40 THEN '4x3' WHEN k < 60 THEN '4x4'
        ELSE '5x5' END""",
    "time_limit_sec": "IF(on_stage AND k % 2 = 1, 60 * (k % 3 + 1), 0)",
    "clear_time_ms": "IF(is_clear, floor(value * 100D + 0.5D), 0)",
    "taps": "IF(is_clear, k % 30 + 1, 0)",
    "score": "IF(is_clear, 100 + 7 * k, 0)",
    "bonus_collected": "IF(is_clear, k % 4, 0)",
    "universal_used": "IF(is_clear AND k % 10 = 0, 1, 0)",
    "completion_pct": "IF(event_type = 'error', 20 + k % 66, 0)",
    "duration_ms": "0",
    "platform": "IF(event_type = 'signup', IF(user_id % 2 = 0, 'android', 'ios'), '')",
    "from_screen": "IF(event_type = 'click' AND k % 4 <> 0, 'title', '')",
    "to_screen": "IF(event_type = 'click' AND k % 4 <> 0, IF(k < 50, 'stageSelect', 'leaderboard'), '')",
    "action": "IF(event_type = 'click' AND k % 4 = 0, IF(k % 8 = 0, 'purchase', 'use'), '')",
    "item_type": "IF(event_type = 'click' AND k % 4 = 0, 'universal_block', '')",
    "reason": "IF(event_type = 'error', 'timeout', '')",
}
_LEGACY_EVENT = {
    "event_id": "concat('e', event_id)",
    "event_type": """CASE event_type WHEN 'signup' THEN 'game_start' WHEN 'view' THEN 'stage_start'
        WHEN 'error' THEN 'time_attack_end' WHEN 'click' THEN 'leaderboard_view'
        ELSE IF(k % 2 = 0, 'story_stage_clear', 'stage_clear') END""",
    "user_key": "user",
    "session_id": "concat(user, '-', date_format(ts, 'yyyyMMdd'))",
    "timestamp": "ms",
    "schema_version": "'1'",
    "payload": """to_json(named_struct(
        'clear_time_ms', CASE k % 10 WHEN 9 THEN NULL WHEN 8 THEN 'fast' ELSE CAST(floor(value * 100D + 0.5D) AS STRING) END,
        'grid_size', CASE WHEN k % 7 = 0 THEN NULL WHEN k < 50 THEN '3x3' ELSE '4x4' END,
        'stage_num', CASE WHEN k % 9 = 0 THEN NULL ELSE CAST(k % 50 + 1 AS STRING) END))""",
}


def game_events(raw: DataFrame) -> DataFrame:
    """Events in the canonical schema; a part of them in the first schema version."""
    columns = [f"CAST({_GAME_EVENT[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in EVENT_SCHEMA.fields]
    return raw.selectExpr(*_BASE).selectExpr(*columns)


def legacy_events(raw: DataFrame) -> DataFrame:
    """First-version events: the details are text fields of a JSON payload, some of them missing or not numeric."""
    return raw.selectExpr(*_BASE).selectExpr(*[f"{text} AS {name}" for name, text in _LEGACY_EVENT.items()])


def redelivered(events: DataFrame) -> DataFrame:
    """Events with copies as a broker may deliver them: some 10 minutes later, some chains over about two hours."""
    number = F.substring("event_id", 2, 20).cast("bigint")
    delays = (
        F.when(number % 60 == 0, F.array(*[F.lit(n) for n in (0, 1800, 3600, 5000, 7300)]))
        .when(number % 20 == 0, F.array(F.lit(0), F.lit(600)))
        .when(number % 45 == 0, F.array(F.lit(0), F.lit(7200), F.lit(7200)))
        .otherwise(F.array(F.lit(0)))
    )
    rows = events.withColumn("_delay", F.explode(delays))
    return rows.withColumn("timestamp", F.col("timestamp") + F.col("_delay") * 1000).select(*events.columns)


def leaderboard(events: DataFrame) -> DataFrame:
    """A score per (user, day, time limit) of time-attack clears."""
    clears = events.filter(
        (F.col("schema_version") == "2") & (F.col("event_type") == "stage_clear") & (F.col("mode") == "time_attack")
    )
    by = ["user_key", "day", "time_limit_sec"]
    return (
        clears.withColumn("day", F.date_format(event_ts(), "yyyyMMdd"))
        .groupBy(*by)
        .agg(
            F.sum("score").cast("int").alias("score"),
            F.count(F.lit(1)).cast("int").alias("stages_cleared"),
            rounded(F.avg("clear_time_ms"), 0).cast("int").alias("avg_clear_ms"),
            F.sum("universal_used").cast("int").alias("universal_used"),
            event_ts(F.max("timestamp")).alias("played_at"),
        )
        .select(
            F.concat_ws("-", *by).alias("entry_id"), "user_key", F.lit("time_attack").alias("mode"), "time_limit_sec",
            "score", "stages_cleared", "avg_clear_ms", "universal_used", "played_at",
        )
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    """Users from the customer table; those with a negative balance have no nickname."""
    configure(spark)
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    start = F.timestamp_seconds(F.lit(1_704_067_200))
    return customer.select(
        F.expr(_user_key("c_custkey")).alias("user_key"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("nickname"),
        start.alias("created_at"), start.alias("last_seen_at"),
    )


def user_changes(events: DataFrame) -> DataFrame:
    """A change feed of user state: each event is a change, fails with full progress delete the user."""
    return events.select(
        "user_key", "timestamp", "event_id",
        F.when((F.col("event_type") == "stage_fail") & (F.col("completion_pct") > 70), "d")
        .when(F.col("event_type") == "session_start", "c").otherwise("u").alias("op"),
        "event_type", "stage_id",
    )


def batch_requests(events: DataFrame) -> DataFrame:
    """Each event as an HTTP request with one to three events; some requests break a limit."""
    number = F.col("seq") + F.col("completion_pct")
    payload = F.struct(
        "seq", "mode", "stage_id", "score", "clear_time_ms",
        F.col("from_screen").alias("from"), F.col("to_screen").alias("to"),
        F.struct(F.col("platform"), F.lit(360).alias("width")).alias("device_info"), F.col("taps").alias("elapsed_ms"),
    )
    event = F.struct(
        "event_type", "session_id", "client_timestamp",
        F.when(number % 11 == 10, F.repeat(F.lit("9"), F.lit(21))).otherwise(F.col("app_version")).alias("app_version"),
        F.when(number % 7 == 6, F.lit("3")).otherwise(F.col("schema_version")).alias("schema_version"),
        payload.alias("payload"),
    )
    many = F.when(F.col("taps") == 30, F.lit(51)).otherwise(F.col("seq") % 3 + 1)
    request = F.struct(
        F.when(F.col("taps") == 29, F.concat(F.col("user_key"), F.repeat(F.lit("x"), F.lit(64))))
        .otherwise(F.col("user_key")).alias("user_key"),
        "app_version",
        F.array_repeat(event, many).alias("events"),
    )
    return events.select("event_id", "timestamp", F.to_json(request).alias("value"))


def event_messages(events: DataFrame) -> DataFrame:
    """Each event as message text; some texts are cut off and some lack the user."""
    whole = F.to_json(F.struct(*names(EVENT_SCHEMA), F.lit("x").alias("unknown_field")))
    nobody = F.to_json(F.struct(*[c for c in names(EVENT_SCHEMA) if c != "user_key"]))
    value = (
        F.when(F.col("taps") == 7, F.substring(whole, 1, 60))
        .when(F.col("completion_pct") == 40, nobody)
        .otherwise(whole)
    )
    return events.select("event_id", "timestamp", value.alias("value"))
