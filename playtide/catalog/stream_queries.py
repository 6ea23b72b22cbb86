"""Streaming jobs, run until the available input is used up; each returns the table the stream wrote."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtide.catalog.registry import WIDE_COUNT, WIDE_GAP_MS, WIDE_WINDOW_MS, Tables, query
from playtide.catalog.report_queries import _retention_sql
from playtide.catalog.rule_queries import _ALERT_COLUMNS, _LATEST, _ORDER, _SESSION_COLUMNS
from playtide.operators import activity, ingest, rollups
from playtide.plans import game
from playtide.plans.operations import scope
from playtide.schema import ALERT_FACT_SCHEMA, SESSION_FACT_SCHEMA
from playtide.session import work_path
from playtide.sources import star_tables, tables
from playtide.streaming import carried, jobs, metrics, rules


DAY_MS = 86_400_000


def _events_stream(t: Tables) -> DataFrame:
    return star_tables.game_events(star_tables.raw_events_stream(t.spark, t.folder))


def _written(t: Tables, stream: DataFrame, purpose: str) -> DataFrame:
    """Run a stream into a table and read it back."""
    root = work_path(t.spark, purpose)
    writer = stream.writeStream.format("parquet").options(path=f"{root}/out", checkpointLocation=f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{root}/out")


FILES = 4


def _shuffled_files(t: Tables, rows: DataFrame, parts: int = 3) -> DataFrame:
    """A stream over some parts of rows, one part a micro-batch: times ascend from part to part, not within one."""
    path = work_path(t.spark, "arrivals")
    days = rows.select(F.floor(F.col("timestamp") / DAY_MS).alias("_day")).distinct().withColumn("_part", F.ntile(parts).over(Window.orderBy("_day")))
    split = rows.withColumn("_day", F.floor(F.col("timestamp") / DAY_MS)).join(days, "_day")
    for part in range(1, parts + 1):
        own = split.filter(F.col("_part") == part).drop("_day", "_part").repartition(FILES)
        own.sortWithinPartitions(F.xxhash64(*rows.columns)).write.parquet(f"{path}/p{part}")
    reader = t.spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", FILES)
    return reader.option("pathGlobFilter", "*.parquet").parquet(path)


def _carried(t: Tables, stream: DataFrame, rule: carried.Rule, purpose: str) -> DataFrame:
    """Run a rule with carried state over all there is and read its table back."""
    root = work_path(t.spark, purpose)
    jobs.start_carried(stream, rule, f"{root}/out", f"{root}/work", f"{root}/checkpoint", available_now=True).awaitTermination()
    return t.spark.read.parquet(f"{root}/out").drop("batch_id")


def _hot(rows: DataFrame) -> DataFrame:
    """A third of all rows belong to one user."""
    hot = F.substring("event_id", -1, 1).isin("0", "3", "6")
    return rows.withColumn("user_key", F.when(hot, F.lit("user_hot")).otherwise(F.col("user_key")))


_HOT = """(SELECT * REPLACE (CASE WHEN right(event_id, 1) IN ('0', '3', '6') THEN 'user_hot' ELSE user_key END AS user_key) FROM ev)"""


@query("stream_dedup", 'SELECT kept.event_id, kept.sent_ms AS "timestamp", ev.user_key FROM kept JOIN ev USING (event_id)')
def _stream_dedup(t: Tables) -> DataFrame:
    sent = star_tables.redelivered(t.current)
    return _carried(t, _shuffled_files(t, sent), carried.dedup_rule(sent.schema), "dedup").select("event_id", "timestamp", "user_key")


query("stream_dedup_watermark", "SELECT DISTINCT event_id, user_key FROM sent")(
    lambda t: _written(
        t, rules.dedup_stream(star_tables.redelivered(ingest.only_version(_events_stream(t)))), "dedup-watermark"
    ).select("event_id", "user_key")
)
@query(
    "stream_user_quality",
    f"""SELECT e.user_key, e.event_id, e.event_no, e.gap_ms, s.seq - s.prev_seq - 1 AS missing
FROM (SELECT *, row_number() OVER ({_ORDER}) AS event_no, "timestamp" - lag("timestamp") OVER ({_ORDER}) AS gap_ms FROM {_HOT} h) e
LEFT JOIN (SELECT *, lag(seq) OVER ({_ORDER}) AS prev_seq, lag(session_id) OVER ({_ORDER}) AS prev_session
FROM {_HOT} h WHERE seq > 0) s ON s.event_id = e.event_id AND s.prev_session = s.session_id AND s.seq > s.prev_seq + 1""",
)
def _stream_user_quality(t: Tables) -> DataFrame:
    found = _carried(t, _shuffled_files(t, _hot(t.current)), carried.user_quality_rule(), "quality")
    return found.select("user_key", "event_id", "event_no", "gap_ms", "missing")


@query(
    "stream_rapid_fire",
    f"""SELECT user_key, event_id, n AS event_count FROM (SELECT user_key, event_id, count(*) OVER (PARTITION BY user_key
ORDER BY "timestamp" RANGE BETWEEN {WIDE_WINDOW_MS} PRECEDING AND CURRENT ROW) AS n FROM {_HOT} h WHERE event_type = 'stage_clear')
WHERE n >= {WIDE_COUNT}""",
)
def _stream_rapid_fire(t: Tables) -> DataFrame:
    rule = carried.rapid_fire_rule(WIDE_WINDOW_MS, WIDE_COUNT)
    return _carried(t, _shuffled_files(t, _hot(t.current)), rule, "rapid").select("user_key", "event_id", "event_count")


def _job(t: Tables) -> jobs.JobPaths:
    return jobs.run_available(_events_stream(t), work_path(t.spark, "job"), WIDE_GAP_MS, WIDE_WINDOW_MS, WIDE_COUNT)


# A session is written once the newest event is an hour past its end plus the gap.
query(
    "stream_sessions",
    f"""SELECT {_SESSION_COLUMNS} FROM sess
WHERE session_end + {WIDE_GAP_MS} <= (SELECT max("timestamp") FROM ev ) - 3600000""",
)(lambda t: tables.read_fact(t.spark, _job(t).table("sessions"), SESSION_FACT_SCHEMA).drop("created_at", "month"))
query("stream_alerts", f"SELECT {_ALERT_COLUMNS} FROM alerts")(
    lambda t: tables.read_fact(t.spark, _job(t).table("alerts"), ALERT_FACT_SCHEMA).drop("created_at", "month")
)


@query(
    "stream_routing",
    """SELECT route, count(*) AS records FROM (SELECT CASE WHEN taps = 7 THEN 'json' WHEN completion_pct = 40 THEN 'field'
ELSE 'accepted' END AS route FROM allev ) GROUP BY 1""",
)
def _stream_routing(t: Tables) -> DataFrame:
    root = work_path(t.spark, "routing")
    parsed = ingest.parse_events(star_tables.event_messages(_events_stream(t)))
    accepted, dead = f"{root}/accepted", f"{root}/dead"
    jobs.start_routed_sink(parsed, accepted, dead, f"{root}/checkpoint", available_now=True).awaitTermination()
    routes = t.spark.read.parquet(accepted).selectExpr("'accepted' AS route").unionByName(
        t.spark.read.parquet(dead).selectExpr("error AS route")
    )
    return routes.groupBy("route").agg({"*": "count"}).withColumnRenamed("count(1)", "records")


@query(
    "stream_ingest",
    """SELECT outcome, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN taps = 29 THEN 'user_key' WHEN taps = 30 THEN 'events'
WHEN (seq + completion_pct) % 11 = 10 THEN 'event_app_version' ELSE 'record' END AS outcome,
CASE WHEN taps = 29 OR taps = 30 OR (seq + completion_pct) % 11 = 10 THEN 1 ELSE seq % 3 + 1 END AS n FROM allev ) GROUP BY 1""",
)
def _stream_ingest(t: Tables) -> DataFrame:
    root = work_path(t.spark, "ingest")
    records, refused = f"{root}/records", f"{root}/refused"
    requests = star_tables.batch_requests(_events_stream(t))
    jobs.start_ingest(requests, records, refused, f"{root}/checkpoint", available_now=True).awaitTermination()
    outcomes = t.spark.read.parquet(records).selectExpr("'record' AS outcome").unionByName(
        t.spark.read.parquet(refused).selectExpr("error AS outcome")
    )
    return outcomes.groupBy("outcome").agg({"*": "count"}).withColumnRenamed("count(1)", "n")


def _parts(t: Tables, summarise, merge, purpose: str, stream: DataFrame) -> DataFrame:
    root = work_path(t.spark, purpose)
    table = jobs.parts_table(stream, summarise, f"{root}/parts", merge)
    jobs.start_parts(stream, summarise, table, f"{root}/checkpoint", available_now=True).awaitTermination()
    return table.read()


_DAILY, _STAGE = ["day", "user_key", "mode"], ["mode", "stage_id"]

query("stream_daily_summary", "SELECT day_text AS day, user_key, mode, clears, fails FROM daily")(
    lambda t: rollups.sum_parts(
        _parts(t, rollups.daily_user_summary, rollups.added_up(_DAILY), "daily", ingest.only_version(_events_stream(t))), _DAILY
    )
)
query("stream_stage_difficulty", "SELECT mode, stage_id, clears, attempts, clear_ms, timed_clears FROM stage")(
    lambda t: rollups.sum_parts(
        _parts(t, rollups.stage_difficulty, rollups.added_up(_STAGE), "stages", ingest.only_version(_events_stream(t))), _STAGE
    )
)


@query("stream_latest_by_key", _LATEST.format(rows="ev"))
def _stream_latest(t: Tables) -> DataFrame:
    """Parts keep deletes, so that a delete in a later part still counts."""
    key, version = ["user_key"], ["timestamp", "event_id"]
    changes = star_tables.user_changes(ingest.only_version(_events_stream(t)))
    merge = rollups.latest_of(key, version, DAY_MS)
    return rollups.latest_by_key(_parts(t, lambda batch: rollups.latest_by_key(batch, key, version, op=None), merge, "latest", changes), key, version)


@query(
    "stream_daily_summary_corrected",
    """SELECT day_text AS day, user_key, mode, clears, fails FROM (SELECT CAST(to_timestamp("timestamp" / 1000) AT TIME ZONE 'UTC' AS DATE)::VARCHAR AS day_text,
user_key, mode, count(*) FILTER (event_type = 'stage_clear') AS clears, count(*) FILTER (event_type = 'stage_fail') AS fails
FROM ev WHERE right(event_id, 1) NOT IN ('1', '7') GROUP BY 1, 2, 3)""",
)
def _stream_daily_corrected(t: Tables) -> DataFrame:
    """Events whose id ends in 1 or 7 are taken back in a later micro-batch; rows without any event left are gone."""
    bad = F.substring("event_id", -1, 1).isin("1", "7")
    last = t.current.agg(F.max("timestamp")).first()[0]
    added = t.current.withColumn("sign", F.lit(1)).withColumn("event_ms", F.col("timestamp"))
    removed = t.current.filter(bad).withColumn("sign", F.lit(-1)).withColumn("event_ms", F.col("timestamp")).withColumn(
        "timestamp", F.lit(last) + 8 * DAY_MS)
    stream = _shuffled_files(t, added.unionByName(removed), 5).withColumn("timestamp", F.col("event_ms"))
    summarise = lambda rows: rollups.daily_user_summary(rows, F.col("sign"))
    return rollups.settled(_parts(t, summarise, rollups.added_up(_DAILY), "daily-signed", stream), _DAILY)


@query("stream_clustered_clears", """SELECT event_id, user_key, "timestamp" FROM ev WHERE event_type = 'stage_clear'""")
def _stream_clustered(t: Tables) -> DataFrame:
    """Clears from the clustered table that a stream keeps up to date; files of other types are not opened."""
    root = work_path(t.spark, "clustered")
    table = tables.clustered_events(t.spark, f"{root}/events")
    stream = _shuffled_files(t, t.current, 10).withColumn("month", tables.month_of("timestamp"))
    jobs.start_clustering(stream, table, f"{root}/checkpoint", available_now=True).awaitTermination()
    return table.read("stage_clear").select("event_id", "user_key", "timestamp")


@query(
    "stream_alert_numbers",
    f"""SELECT user_key, event_id, alert_type, row_number() OVER (PARTITION BY user_key ORDER BY detected_at, event_id,
CASE alert_type WHEN 'IMPOSSIBLE_CLEAR' THEN 1 WHEN 'RAPID_FIRE' THEN 2 ELSE 3 END) AS alert_no FROM alerts""",
)
def _stream_alert_numbers(t: Tables) -> DataFrame:
    found = t.alerts.withColumn("timestamp", F.col("detected_at"))
    stream = _shuffled_files(t, found, 4).drop("timestamp")
    return _carried(t, stream, carried.alert_numbers_rule(), "alert-numbers").select("user_key", "event_id", "alert_type", "alert_no")


def _with_metrics(t: Tables, stream: DataFrame, purpose: str) -> str:
    """Run a stream that observes metrics, and return the folder that keeps them."""
    root = work_path(t.spark, purpose)
    listener = metrics.StoredMetrics(t.spark, f"{root}/metrics")
    t.spark.streams.addListener(listener)
    try:
        writer = stream.writeStream.format("noop").option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
        t.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        t.spark.streams.removeListener(listener)
    return f"{root}/metrics"


@query("stream_dedup_stats", """SELECT (SELECT count(*) FROM sent) AS total, (SELECT count(*) FROM sent) - count(DISTINCT event_id) AS duplicates,
((SELECT count(*) FROM sent) - count(DISTINCT event_id)) * 100.0 / (SELECT count(*) FROM sent) AS duplicate_pct FROM sent""")
def _stream_dedup_stats(t: Tables) -> DataFrame:
    sent = metrics.observe_dedup(star_tables.redelivered(ingest.only_version(_events_stream(t))), "seen")
    folder = _with_metrics(t, metrics.observe_dedup(rules.dedup_stream(sent), "kept"), "dedup-stats")
    return metrics.dedup_totals(t.spark, folder, "seen", "kept")


def _words(t: Tables, rows: DataFrame, purpose: str) -> DataFrame:
    """The users' active days, kept by a stream of five micro-batches in merged parts."""
    return _parts(t, activity.active_words, activity.merged_words, purpose, _shuffled_files(t, rows, 5))


query("stream_activity_retention", _retention_sql("nb"))(
    lambda t: activity.retention_from_words(_words(t, scope(t.events, bots=False), "words-all"), game.RETENTION_DAYS))
query(
    "stream_activity_repeaters",
    """SELECT count(*) AS repeaters FROM (SELECT user_key FROM nb WHERE mode = 'time_attack' AND event_type = 'stage_start'
GROUP BY 1 HAVING count(DISTINCT day) >= 2)""",
)(lambda t: activity.repeaters_from_words(_words(t, scope(t.events, "stage_start", mode="time_attack", bots=False), "words-starts")))
query(
    "stream_activity_streaks",
    """SELECT user_key, arg_max(len, last_day) AS streak_days, max(len) AS longest, strftime(max(last_day), '%Y-%m-%d') AS last_day
FROM (SELECT user_key, island, count(*) AS len, max(day) AS last_day FROM (SELECT user_key, day,
day - CAST(row_number() OVER (PARTITION BY user_key ORDER BY day) AS INTEGER) AS island
FROM (SELECT DISTINCT user_key, day FROM ev WHERE event_type = 'session_start')) GROUP BY 1, 2) GROUP BY 1""",
)(lambda t: activity.streaks_from_words(_words(t, scope(t.events, "session_start"), "words-logins")))


@query(
    "stream_monthly_users",
    """SELECT strftime(date_trunc('month', day), '%Y-%m-%d') AS month, count(DISTINCT user_key) AS exact, true AS within_5_pct FROM ev GROUP BY 1""",
)
def _stream_monthly(t: Tables) -> DataFrame:
    """Monthly users from daily sketches alone, beside the exact count that they are held against."""
    month = F.to_date(F.date_trunc("month", "day"))
    sketches = _parts(t, activity.user_sketches, activity.merged_sketches, "sketches", _shuffled_files(t, t.current, 5))
    found = activity.users_of(sketches, month=month)
    exact = t.current.groupBy(F.to_date(F.date_trunc("month", F.timestamp_millis("timestamp"))).alias("month")).agg(F.countDistinct("user_key").alias("exact"))
    return found.join(exact, "month").select("month", "exact", (F.abs(F.col("users") - F.col("exact")) <= 0.05 * F.col("exact")).alias("within_5_pct"))
