"""Ingest operators and the stored tables. Tables are written below the shared folder and read back."""

from pyspark.sql import functions as F

from playtide.catalog.registry import WIDE_GAP_MS, query
from playtide.functions import clear_points, json_number, json_text, score_cap, stage_part
from playtide.operators import ingest
from playtide.operators.sessions import session_summary
from playtide.schema import ALERT_FACT_SCHEMA, EVENT_SCHEMA, SESSION_FACT_SCHEMA, SESSION_SCHEMA, names
from playtide.session import work_path
from playtide.sources import star_tables, tables
from playtide.sources.stages import STAGES, dim_stage

# How the request builder breaks limits, in SQL.
_REQUESTS = """SELECT *, seq % 3 + 1 AS many, CASE WHEN (seq + completion_pct) % 7 = 6 THEN '3' ELSE schema_version END AS sent_version,
taps = 29 AS long_key, taps = 30 AS too_many, (seq + completion_pct) % 11 = 10 AS long_version FROM allev"""


def _requests(t):
    return ingest.validate_batches(ingest.parse_batches(star_tables.batch_requests(t.events)))


query(
    "request_errors",
    f"""SELECT event_id, concat_ws(',', CASE WHEN long_key THEN 'user_key' END, CASE WHEN too_many THEN 'events' END,
CASE WHEN long_version THEN 'event_app_version' END) AS errors FROM ({_REQUESTS})""",
)(lambda t: _requests(t).select("event_id", F.array_join("errors", ",").alias("errors")))
query(
    "exploded_requests",
    f"""SELECT event_id, pos AS batch_pos, user_key, event_type, session_id, client_timestamp, sent_version AS schema_version
FROM ({_REQUESTS}) AS r, LATERAL (SELECT unnest(range(r.many)) AS pos) WHERE NOT (long_key OR too_many OR long_version)""",
)(
    lambda t: ingest.explode_batches(_requests(t), "event_id").select(
        "event_id", "batch_pos", "user_key", "event_type", "session_id", "client_timestamp", "schema_version"
    )
)
query(
    "flattened_payloads",
    f"""SELECT event_id, pos AS batch_pos, sent_version AS schema_version,
CASE WHEN flat THEN seq END AS seq, CASE WHEN flat THEN mode END AS mode, CASE WHEN flat THEN score END AS score,
CASE WHEN flat THEN from_screen END AS from_screen, CASE WHEN flat THEN to_screen END AS to_screen,
CASE WHEN flat THEN platform END AS platform, CASE WHEN flat THEN taps END AS elapsed_in_extra,
CASE WHEN flat THEN 360 END AS width_in_extra, NOT flat AS has_payload
FROM (SELECT *, sent_version >= '2' AS flat FROM ({_REQUESTS})) AS r, LATERAL (SELECT unnest(range(r.many)) AS pos)
WHERE NOT (long_key OR too_many OR long_version)""",
)(
    lambda t: ingest.flatten_payload(ingest.explode_batches(_requests(t), "event_id")).select(
        "event_id", "batch_pos", "schema_version", "seq", "mode", "score", "from_screen", "to_screen", "platform",
        F.get_json_object("extra", "$.elapsed_ms").cast("int").alias("elapsed_in_extra"),
        F.get_json_object("extra", "$.device_info.width").cast("int").alias("width_in_extra"),
        F.col("payload").isNotNull().alias("has_payload"),
    )
)


@query(
    "ingested_records",
    f"""SELECT sent_version AS schema_version, event_type, count(*) AS records, count(*) AS ids, 1 AS receive_times,
count(*) FILTER (sent_version >= '2') AS with_extra
FROM ({_REQUESTS}) AS r, LATERAL (SELECT unnest(range(r.many)) AS pos)
WHERE NOT (long_key OR too_many OR long_version) GROUP BY 1, 2""",
)
def _ingested_records(t):
    """Whole ingest; ids are random, so the written records are counted."""
    path = work_path(t.spark, "records")
    ingest.ingest_records(star_tables.batch_requests(t.events)).write.parquet(path)
    return t.spark.read.parquet(path).groupBy("schema_version", "event_type").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("event_id").alias("ids"),
        F.count_distinct("timestamp").alias("receive_times"), F.count("extra").alias("with_extra"),
    )


query(
    "score_submission_errors",
    """SELECT entry_id, concat_ws(',', CASE WHEN stages_cleared % 5 = 0 THEN 'mode' END, CASE WHEN stages_cleared % 3 = 0 THEN 'score' END)
AS errors FROM lb""",
)(
    lambda t: ingest.validate_scores(t.leaderboard.withColumns({
        "mode": F.when(F.col("stages_cleared") % 5 != 0, F.col("mode")),
        "score": F.when(F.col("stages_cleared") % 3 == 0, -F.col("score") - 1).otherwise(F.col("score")),
    })).select("entry_id", F.array_join("errors", ",").alias("errors"))
)
query(
    "user_record_errors",
    "SELECT user_key, CASE WHEN length(nickname) * 2 > 30 THEN 'nickname' ELSE '' END AS errors FROM usr",
)(
    lambda t: ingest.validate_users(t.users.withColumn("nickname", F.repeat("nickname", F.lit(2)))).select(
        "user_key", F.array_join("errors", ",").alias("errors"))
)

# Messages

# Columns that the view of all events lacks.
_ADDED = {
    "app_version": "'1.0.0'", "duration_ms": "0", "item_type": "CASE WHEN action <> '' THEN 'universal_block' ELSE '' END",
    "reason": "CASE WHEN event_type = 'stage_fail' THEN 'timeout' ELSE '' END",
}
_EVENT_COLUMNS = ", ".join(f'{_ADDED[c]} AS {c}' if c in _ADDED else f'"{c}"' for c in names(EVENT_SCHEMA))
_BROKEN = "CASE WHEN taps = 7 THEN 'json' WHEN completion_pct = 40 THEN 'field' END"
query(
    "parsed_events",
    f"SELECT {_EVENT_COLUMNS} FROM allev WHERE {_BROKEN} IS NULL AND schema_version = '2'",
)(lambda t: ingest.accepted_events(star_tables.event_messages(t.events)))
query(
    "dead_letters",
    f"""SELECT {_BROKEN} AS error, event_type AS type_in_record FROM allev WHERE {_BROKEN} IS NOT NULL""",
)(
    lambda t: ingest.route_dlq(ingest.parse_events(star_tables.event_messages(t.events)))[1].select(
        "error", F.regexp_extract("record", '"event_type":"([a-z_]+)', 1).alias("type_in_record")
    )
)
query(
    "accepted_and_failed",
    f"SELECT count(*) FILTER ({_BROKEN} IS NULL) AS accepted, count(*) FILTER ({_BROKEN} IS NOT NULL) AS failed FROM allev",
)(lambda t: ingest.route_dlq(ingest.parse_events(star_tables.event_messages(t.events)))[2])
query(
    "keyed_messages",
    "SELECT user_key AS key, event_id AS id_in_value, score AS score_in_value FROM ev",
)(
    lambda t: ingest.to_message(t.current).select(
        "key", json_text("value", "event_id").alias("id_in_value"),
        json_number("value", "score", "int").alias("score_in_value"),
    )
)
query("complete_events", f"SELECT event_id, user_key FROM allev WHERE {_BROKEN} IS NULL")(
    lambda t: ingest.require(ingest.parse_events(star_tables.event_messages(t.events))).select("event_id", "user_key")
)
query("people_only", "SELECT event_id, user_key FROM nb")(
    lambda t: ingest.exclude_bots(t.current).select("event_id", "user_key")
)
query(
    "filled_defaults",
    "SELECT event_id, coalesce(nullif(seq, 0), 0) AS seq, mode, stage_id FROM allev",
)(
    lambda t: ingest.fill_defaults(
        t.events.select(
            "event_id", F.nullif(F.col("seq"), F.lit(0)).alias("seq"),
            F.nullif(F.col("mode"), F.lit("")).alias("mode"), F.nullif(F.col("stage_id"), F.lit("")).alias("stage_id"),
        )
    )
)
query(
    "event_stages",
    """SELECT event_id, CASE WHEN mode = 'story' THEN CAST(split_part(stage_id, '-', 1) AS INTEGER) END AS chapter,
CASE WHEN mode = 'story' THEN CAST(split_part(stage_id, '-', 2) AS INTEGER) END AS stage_no FROM ev""",
)(lambda t: ingest.with_stage(t.current).select("event_id", "chapter", "stage_no"))
query(
    "plain_stage_ids",
    """SELECT event_id, greatest(score - 100, 0) // 7 % 50 // 10 + 1 AS chapter, greatest(score - 100, 0) // 7 % 10 + 1 AS stage_no
FROM ev""",
)(
    lambda t: ingest.with_stage(
        t.current.select(
            "event_id", (F.floor(F.greatest(F.col("score") - 100, F.lit(0)) / 7) % 50 + 1).cast("string").alias("stage_id")
        )
    ).select("event_id", "chapter", "stage_no")
)
query(
    "score_rules",
    """SELECT event_id, CASE grid_size WHEN '3x3' THEN 500 WHEN '4x3' THEN 600 WHEN '4x4' THEN 600 ELSE 700 END AS cap,
100 + 50 * bonus_collected + CASE WHEN mode <> 'time_attack' THEN 0 WHEN clear_time_ms < 3000 THEN 200
WHEN clear_time_ms < 5000 THEN 150 WHEN clear_time_ms < 10000 THEN 100 ELSE 0 END AS points,
coalesce(try_cast(split_part(stage_id, '-', 2) AS INTEGER), 0) AS stage_number FROM ev WHERE event_type = 'stage_clear'""",
)(
    lambda t: t.current.filter(F.col("event_type") == "stage_clear").select(
        "event_id", score_cap().alias("cap"),
        clear_points(F.col("mode"), F.col("clear_time_ms"), F.col("bonus_collected")).alias("points"),
        stage_part("stage_id", 2).alias("stage_number"),
    )
)
_CATALOGUE = ", ".join(
    f"('{(i - 1) // 10 + 1}-{(i - 1) % 10 + 1}', '{r}x{c}', {(i - 1) // 10 + 1}, {w}, {d}, {b})" for i, r, c, w, d, _, b in STAGES
)
query(
    "clears_with_stage_data",
    f"""SELECT event_id, s.grid AS catalogue_grid, s.chapter, CAST(least(5, floor(CAST(w AS DOUBLE) * CAST(2.5 AS DOUBLE)
+ d * CAST(0.7 AS DOUBLE) + b * CAST(0.3 AS DOUBLE) + CAST(0.5 AS DOUBLE))) AS INTEGER) AS difficulty
FROM ev JOIN (VALUES {_CATALOGUE}) AS s(id, grid, chapter, w, d, b) ON s.id = ev.stage_id
WHERE event_type = 'stage_clear' AND mode = 'story'""",
)(
    lambda t: t.current.filter((F.col("event_type") == "stage_clear") & (F.col("mode") == "story"))
    .select("event_id", "stage_id")
    .join(F.broadcast(dim_stage(t.spark).withColumnRenamed("grid_size", "catalogue_grid")), "stage_id")
    .select("event_id", "catalogue_grid", "chapter", "difficulty")
)

# Stored tables


@query(
    "stored_events",
    f"""SELECT {_EVENT_COLUMNS}, strftime(day, '%Y%m') AS month FROM allev""",
)
def _stored_events(t):
    path = work_path(t.spark, "fact-events")
    tables.write_fact_events(t.events, path)
    stored = tables.read_fact(t.spark, path, EVENT_SCHEMA)
    return stored.select(*names(EVENT_SCHEMA), "month")


@query(
    "stored_sessions",
    """SELECT user_key, session_start, total_events, strftime(make_timestamp(session_start * 1000), '%Y%m') AS month,
TRUE AS stamped FROM sess""",
)
def _stored_sessions(t):
    path = work_path(t.spark, "fact-sessions")
    tables.write_fact_sessions(t.sessions, path)
    return tables.read_fact(t.spark, path, SESSION_FACT_SCHEMA).select(
        "user_key", "session_start", "total_events", "month", F.col("created_at").isNotNull().alias("stamped")
    )


@query(
    "stored_alerts",
    "SELECT event_id, alert_type, stage_id, strftime(make_timestamp(detected_at * 1000), '%Y%m') AS month FROM alerts",
)
def _stored_alerts(t):
    path = work_path(t.spark, "fact-alerts")
    tables.write_fact_alerts(t.alerts, path)
    return tables.read_fact(t.spark, path, ALERT_FACT_SCHEMA).select("event_id", "alert_type", "stage_id", "month")


@query("jsonl_round_trip", f"SELECT {_EVENT_COLUMNS} FROM allev")
def _jsonl_round_trip(t):
    path = work_path(t.spark, "jsonl")
    tables.write_jsonl(t.events, path)
    return tables.read_jsonl(t.spark, path).select(*names(EVENT_SCHEMA))


@query(
    "appended_table",
    """SELECT user_key, session_start, duration_ms FROM sess
UNION ALL SELECT user_key, session_start, duration_ms FROM sess5""",
)
def _appended_table(t):
    """Two appends of session rows to one table."""
    path = work_path(t.spark, "appended")
    for gap in (WIDE_GAP_MS, 300_000):
        tables.append_table(session_summary(t.current, gap).select(*names(SESSION_SCHEMA)), path)
    return tables.read_table(t.spark, path).select("user_key", "session_start", "duration_ms")


query(
    "recent_months",
    """SELECT event_id FROM allev WHERE "timestamp" >= (SELECT epoch_us(make_timestamp(max("timestamp") * 1000 + 14515200000000)
- INTERVAL 6 MONTH) // 1000 FROM allev )""",
)(
    # Seen from 24 weeks after the last event, the six months reach back into the sample.
    lambda t: tables.apply_retention(
        t.events, F.timestamp_millis(t.events.agg(F.max("timestamp")).scalar() + 14_515_200_000)
    ).select("event_id")
)
query(
    "month_range",
    """SELECT event_id FROM allev WHERE "timestamp" >= 1704412800000 AND "timestamp" < 1705017600000""",
)(
    lambda t: tables.in_months(
        t.events.withColumn("month", tables.month_of("timestamp")), "timestamp", 1_704_412_800_000, 1_705_017_600_000
    ).select("event_id")
)
