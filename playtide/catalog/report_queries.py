"""Dashboard reports."""

from pyspark.sql import functions as F

from playtide.catalog.registry import query
from playtide.catalog.sql import pct, rnd
from playtide.plans import game, legacy, operations as ops

LATE = 'abs("timestamp" - client_timestamp) > 30000'
#: The reports of a part of the time start at the 15th of January 2024.
SINCE_MS = 1_705_276_800_000

# Operations and quality

query("total_events", "SELECT count(*) AS total FROM ev")(lambda t: ops.total_events(t.events))
query("total_users", "SELECT count(DISTINCT user_key) AS users FROM ev")(lambda t: ops.total_users(t.events))
query(
    "latest_dau",
    "SELECT count(DISTINCT user_key) AS dau FROM daily WHERE day = (SELECT max(day) FROM daily )",
)(lambda t: ops.latest_dau(t.daily))
query(
    "latest_full_day_dau",
    """SELECT count(DISTINCT user_key) AS dau FROM daily
WHERE day = (SELECT max(day) FROM daily WHERE day < (SELECT max(day) FROM daily ))""",
)(lambda t: ops.latest_dau(t.daily, before=t.daily.agg(F.max("day")).scalar()))
query("clears_per_user_day", f"SELECT {rnd('avg(clears)', 1)} AS avg_clears FROM daily WHERE clears > 0")(
    lambda t: ops.clears_per_user_day(t.daily)
)
query("total_alerts", "SELECT count(*) AS total FROM alerts")(lambda t: ops.total_rows(t.alerts))
query("total_sessions", "SELECT count(*) AS total FROM sess")(lambda t: ops.total_rows(t.sessions))
query("dau_trend", "SELECT day_text AS day, count(DISTINCT user_key) AS dau FROM daily GROUP BY 1")(
    lambda t: ops.dau_trend(t.daily)
)
query(
    "dau_trend_14_days",
    """SELECT day_text AS day, count(DISTINCT user_key) AS dau FROM daily
WHERE day >= (SELECT max(day) FROM daily ) - 14 GROUP BY 1""",
)(lambda t: ops.dau_trend(t.daily, since=F.date_sub(t.daily.agg(F.max("day")).scalar(), 14)))
query(
    "daily_events",
    """SELECT day_text AS day, count(*) AS total_events, count(*) FILTER (event_type = 'stage_clear') AS clears,
count(*) FILTER (event_type = 'stage_fail') AS fails FROM ev GROUP BY 1""",
)(lambda t: ops.daily_events(t.events))
query(
    "daily_events_since",
    f"""SELECT day_text AS day, count(*) AS total_events, count(*) FILTER (event_type = 'stage_clear') AS clears,
count(*) FILTER (event_type = 'stage_fail') AS fails FROM ev WHERE "timestamp" >= {SINCE_MS} GROUP BY 1""",
)(lambda t: ops.daily_events(t.events, SINCE_MS))
query(
    "event_types",
    f"""SELECT event_type, count(*) AS cnt, {pct('count(*)', '(SELECT count(*) FROM ev )', 1)} AS pct
FROM ev GROUP BY 1""",
)(lambda t: ops.event_types(t.events))
query(
    "hourly_events",
    """SELECT strftime(hour + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS events FROM ev GROUP BY 1""",
)(lambda t: ops.hourly_events(t.events))
query(
    "hourly_events_since",
    f"""SELECT strftime(hour + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS events FROM ev
WHERE "timestamp" >= {SINCE_MS} GROUP BY 1""",
)(lambda t: ops.hourly_events(t.events, since_ms=SINCE_MS))
query(
    "alert_summary",
    """SELECT alert_type, count(*) AS cnt, count(DISTINCT user_key) AS users,
strftime(make_timestamp(max(detected_at) // 1000 * 1000000), '%Y-%m-%d %H:%M:%S') AS last_detected
FROM alerts GROUP BY 1""",
)(lambda t: ops.alert_summary(t.alerts))
query("late_share", f"SELECT {pct(f'count(*) FILTER ({LATE})', 'count(*)', 2)} AS late_pct FROM ev")(
    lambda t: ops.late_share(t.events)
)
query("current_version_share", f"""SELECT {pct("count(*) FILTER (schema_version = '2')", 'count(*)', 1)} AS v2_pct FROM allev""")(
    lambda t: ops.current_version_share(t.events)
)
query("flagged_users", "SELECT count(DISTINCT user_key) AS users FROM alerts")(lambda t: ops.flagged_users(t.alerts))
query(
    "daily_late_share",
    f"SELECT day_text AS day, {pct(f'count(*) FILTER ({LATE})', 'count(*)', 2)} AS late_pct FROM ev GROUP BY 1",
)(lambda t: ops.daily_late_share(t.events))
query(
    "latency_buckets",
    f"""SELECT bucket, cnt, {pct('cnt', 'sum(cnt) OVER ()', 2)} AS pct FROM (SELECT CASE WHEN d < 1000 THEN '< 1s'
WHEN d < 5000 THEN '1-5s' WHEN d < 10000 THEN '5-10s' WHEN d < 30000 THEN '10-30s' ELSE '30s+' END AS bucket, count(*) AS cnt
FROM (SELECT abs("timestamp" - client_timestamp) AS d FROM ev ) GROUP BY 1)""",
)(lambda t: ops.latency_buckets(t.events))
query("alert_types", "SELECT alert_type, count(*) AS cnt FROM alerts GROUP BY 1")(lambda t: ops.alert_types(t.alerts))
query(
    "latest_alerts",
    """SELECT strftime(make_timestamp(detected_at // 1000 * 1000000), '%Y-%m-%d %H:%M:%S') AS detected, alert_type, user_key,
stage_id, score, clear_time_ms, description FROM alerts ORDER BY detected_at DESC, event_id, alert_type LIMIT 50""",
)(lambda t: ops.latest_alerts(t.alerts))
query("schema_versions", "SELECT schema_version, count(*) AS cnt FROM allev GROUP BY 1")(lambda t: ops.schema_versions(t.events))
query(
    "fill_rates",
    "SELECT event_type, count(*) AS total, "
    + ", ".join(
        f"{pct(f'count(*) FILTER ({test})', 'count(*)', 0)} AS {name}"
        for name, test in (
            ("mode_pct", "mode <> ''"), ("stage_id_pct", "stage_id <> ''"), ("grid_pct", "grid_size <> ''"),
            ("score_pct", "score > 0"), ("clear_time_pct", "clear_time_ms > 0"), ("seq_pct", "seq > 0"),
        )
    )
    + " FROM ev GROUP BY 1",
)(lambda t: ops.fill_rates(t.events))
query(
    "session_minutes",
    f"SELECT {rnd('avg(duration_ms) / 1000 / 60', 1)} AS minutes FROM sess WHERE duration_ms > 0 AND duration_ms < 7200000",
)(lambda t: ops.session_minutes(t.sessions))
query(
    "session_minutes_text",
    f"""SELECT CAST({rnd('avg(duration_ms) / 1000 / 60', 1)} AS VARCHAR) || ' 분' AS label
FROM sess WHERE duration_ms > 0 AND duration_ms < 7200000""",
)(lambda t: ops.session_minutes_text(t.sessions))
query("session_seconds", f"SELECT {rnd('avg(duration_ms) / 1000')} AS seconds FROM sess WHERE duration_ms > 0")(
    lambda t: ops.session_seconds(t.sessions)
)
query(
    "events_per_session",
    f"SELECT {rnd('avg(total_events)', 1)} AS avg_events FROM sess WHERE total_events > 0 AND total_events < 500",
)(lambda t: ops.events_per_session(t.sessions))
query(
    "clears_per_session",
    f"SELECT {rnd('avg(stage_clears)', 1)} AS avg_clears FROM sess WHERE stage_clears > 0 AND stage_clears < 100",
)(lambda t: ops.clears_per_session(t.sessions))
query(
    "events_per_day",
    f"SELECT {rnd('avg(c)')} AS avg_events FROM (SELECT day, count(*) AS c FROM ev GROUP BY 1)",
)(lambda t: ops.events_per_day(t.events))

# Game

query(
    "plays_by_mode",
    """SELECT mode, count(*) AS cnt FROM ev WHERE mode IN ('story', 'time_attack')
AND event_type IN ('stage_clear', 'stage_fail') GROUP BY 1""",
)(lambda t: game.plays_by_mode(t.events))
query(
    "daily_plays",
    """SELECT day_text AS day, CAST(sum(CASE WHEN mode = 'story' THEN clears + fails ELSE 0 END) AS BIGINT) AS story,
CAST(sum(CASE WHEN mode = 'time_attack' THEN clears + fails ELSE 0 END) AS BIGINT) AS time_attack FROM daily GROUP BY 1""",
)(lambda t: game.daily_plays(t.daily))
query(
    "daily_results",
    "SELECT day_text AS day, CAST(sum(clears) AS BIGINT) AS clears, CAST(sum(fails) AS BIGINT) AS fails FROM daily GROUP BY 1",
)(lambda t: game.daily_results(t.daily))
query(
    "daily_plays_14_days",
    """SELECT day_text AS day, CAST(sum(CASE WHEN mode = 'story' THEN clears + fails ELSE 0 END) AS BIGINT) AS story,
CAST(sum(CASE WHEN mode = 'time_attack' THEN clears + fails ELSE 0 END) AS BIGINT) AS time_attack FROM daily
WHERE day >= (SELECT max(day) FROM daily ) - 14 GROUP BY 1""",
)(lambda t: game.daily_plays(t.daily, since=F.date_sub(t.daily.agg(F.max("day")).scalar(), 14)))
query(
    "daily_results_14_days",
    """SELECT day_text AS day, CAST(sum(clears) AS BIGINT) AS clears, CAST(sum(fails) AS BIGINT) AS fails FROM daily
WHERE day >= (SELECT max(day) FROM daily ) - 14 GROUP BY 1""",
)(lambda t: game.daily_results(t.daily, since=F.date_sub(t.daily.agg(F.max("day")).scalar(), 14)))
query(
    "story_clear_rates",
    f"""SELECT stage_id, {rnd('clears * CAST(100 AS DOUBLE) / greatest(attempts, 1)', 1)} AS clear_rate_pct
FROM stage WHERE mode = 'story'""",
)(lambda t: game.story_clear_rates(t.stage_parts))
query(
    "story_clear_times",
    f"SELECT stage_id, {rnd('CAST(clear_ms AS DOUBLE) / nullif(timed_clears, 0)')} AS avg_clear_ms FROM stage WHERE mode = 'story'",
)(lambda t: game.story_clear_times(t.stage_parts))
for _chapter in range(1, 6):
    query(
        f"chapter_{_chapter}_grid",
        f"""SELECT '{_chapter}-' || s.num AS stage,
coalesce({rnd('clears * CAST(100 AS DOUBLE) / greatest(attempts, 1)', 1)}, 0) AS clear_rate
FROM (SELECT unnest(range(1, 11)) AS num) s LEFT JOIN (SELECT * FROM stage WHERE mode = 'story') d
ON d.stage_id = '{_chapter}-' || s.num""",
    )(lambda t, chapter=_chapter: game.chapter_grid(t.spark, t.stage_parts, chapter))


def _retention_sql(rows: str) -> str:
    shares = ", ".join(
        f"{pct(f'count(DISTINCT a.user_key) FILTER (a.day = f.first_day + {n})', 'count(DISTINCT f.user_key)', 1)} AS d{n}_pct"
        for n in (1, 3, 7)
    )
    return f"""SELECT strftime(f.first_day, '%Y-%m-%d') AS cohort, count(DISTINCT f.user_key) AS cohort_size, {shares}
FROM (SELECT user_key, min(day) AS first_day FROM {rows} GROUP BY 1) f
LEFT JOIN (SELECT DISTINCT user_key, day FROM {rows} ) a ON a.user_key = f.user_key GROUP BY f.first_day"""


query("retention", _retention_sql("nb"))(lambda t: game.retention(t.events))
query("retention_with_bots", _retention_sql("ev"))(lambda t: game.retention(t.events, bots=True))
query(
    "play_hours",
    """SELECT strftime(hour + INTERVAL 9 HOUR, '%H:00') AS hour_kst, count(*) AS events FROM ev
WHERE event_type IN ('stage_clear', 'stage_fail') GROUP BY 1""",
)(lambda t: game.play_hours(t.events))
query(
    "daily_scores",
    f"""SELECT day_text AS day, {rnd("avg(score) FILTER (mode = 'story' AND score > 0)")} AS story_avg,
{rnd("avg(score) FILTER (mode = 'time_attack' AND score > 0)")} AS ta_avg FROM nb WHERE event_type = 'stage_clear' GROUP BY 1""",
)(lambda t: game.daily_scores(t.events))
query("item_actions", "SELECT action, count(*) AS cnt FROM ev WHERE event_type = 'item_use' GROUP BY 1")(
    lambda t: game.item_actions(t.events)
)
query(
    "grid_clear_times",
    f"""SELECT grid_size, {rnd("avg(clear_time_ms) FILTER (mode = 'story')")} AS story_ms,
{rnd("avg(clear_time_ms) FILTER (mode = 'time_attack')")} AS ta_ms
FROM nb WHERE event_type = 'stage_clear' AND clear_time_ms > 0 GROUP BY 1""",
)(lambda t: game.grid_clear_times(t.events))
query(
    "story_funnel",
    """SELECT 'Ch.' || split_part(stage_id, '-', 1) AS chapter, count(DISTINCT user_key) AS users FROM nb
WHERE mode = 'story' AND event_type = 'stage_start' AND try_cast(split_part(stage_id, '-', 1) AS INTEGER) BETWEEN 1 AND 5
GROUP BY 1""",
)(lambda t: game.story_funnel(t.events))
query(
    "time_attack_reach",
    """SELECT CASE WHEN s <= 3 THEN '1-3' WHEN s <= 6 THEN '4-6' WHEN s <= 10 THEN '7-10' ELSE '11+' END AS stage_group,
count(DISTINCT user_key) AS users FROM (SELECT user_key, CAST(split_part(stage_id, '-', 2) AS INTEGER) AS s FROM ev
WHERE mode = 'time_attack' AND event_type = 'stage_start' AND stage_id LIKE 'ta-%') GROUP BY 1""",
)(lambda t: game.time_attack_reach(t.events))
query(
    "limit_scores",
    f"""SELECT time_limit_sec || '초' AS time_limit, {rnd('avg(score)')} AS avg_score FROM nb WHERE mode = 'time_attack'
AND event_type = 'stage_clear' AND score > 0 AND time_limit_sec IN (60, 120, 180) GROUP BY 1""",
)(lambda t: game.limit_scores(t.events))
query(
    "clears_per_day",
    f"""SELECT {rnd('avg(c)')} AS avg_clears FROM (SELECT day, count(*) AS c FROM nb
WHERE event_type = 'stage_clear' GROUP BY 1)""",
)(lambda t: game.clears_per_day(t.events))
query(
    "dau_by_mode",
    """SELECT day_text AS day, count(DISTINCT user_key) AS total_dau,
count(DISTINCT user_key) FILTER (mode = 'time_attack') AS ta_dau FROM daily GROUP BY 1""",
)(lambda t: game.dau_by_mode(t.daily))
query(
    "limit_preference",
    """SELECT time_limit_sec || '초' AS time_limit, count(*) AS cnt FROM nb WHERE mode = 'time_attack'
AND event_type = 'stage_start' AND time_limit_sec IN (60, 120, 180) GROUP BY 1""",
)(lambda t: game.limit_preference(t.events))
query(
    "limit_score_table",
    f"""SELECT time_limit_sec || 's' AS time_limit, {rnd('avg(score)')} AS avg_score, max(score) AS max_score,
{rnd('max(score) - avg(score)')} AS gap, count(*) AS total_clears FROM nb WHERE mode = 'time_attack'
AND event_type = 'stage_clear' AND score > 0 AND time_limit_sec IN (60, 120, 180) GROUP BY time_limit_sec""",
)(lambda t: game.limit_score_table(t.events))
query(
    "time_attack_share",
    f"""SELECT {rnd("count(DISTINCT user_key) FILTER (mode = 'time_attack') * CAST(100 AS DOUBLE) / greatest(count(DISTINCT user_key), 1)", 1)}
AS ta_share_pct FROM daily""",
)(lambda t: game.time_attack_share(t.daily))
query(
    "rounds_per_user_day",
    f"""SELECT {rnd('avg(r)', 1)} AS avg_rounds FROM (SELECT user_key, day, count(*) FILTER (stage_id = 'ta-1') AS r FROM nb
WHERE mode = 'time_attack' AND event_type = 'stage_start' GROUP BY 1, 2 HAVING r > 0)""",
)(lambda t: game.rounds_per_user_day(t.events))
query(
    "time_attack_clears_per_session",
    f"""SELECT {rnd('avg(c)', 1)} AS avg_clears FROM (SELECT session_id, count(*) AS c FROM nb
WHERE mode = 'time_attack' AND event_type = 'stage_clear' GROUP BY 1)""",
)(lambda t: game.time_attack_clears_per_session(t.events))
query(
    "time_attack_repeaters",
    """SELECT count(*) AS repeaters FROM (SELECT user_key FROM nb WHERE mode = 'time_attack' AND event_type = 'stage_start'
GROUP BY 1 HAVING count(DISTINCT day) >= 2)""",
)(lambda t: game.time_attack_repeaters(t.events))
query(
    "platforms",
    "SELECT platform, count(*) AS cnt FROM ev WHERE event_type = 'session_start' AND platform <> '' GROUP BY 1",
)(lambda t: game.platforms(t.events))
query(
    "fail_progress",
    f"SELECT {rnd('avg(completion_pct)', 1)} AS avg_progress FROM nb WHERE event_type = 'stage_fail' AND completion_pct > 0",
)(lambda t: game.fail_progress(t.events))
query(
    "fail_progress_buckets",
    """SELECT CASE WHEN completion_pct < 25 THEN '0~25%' WHEN completion_pct < 50 THEN '25~50%'
WHEN completion_pct < 75 THEN '50~75%' ELSE '75~100%' END AS progress_bucket, count(*) AS cnt
FROM nb WHERE event_type = 'stage_fail' AND completion_pct > 0 GROUP BY 1""",
)(lambda t: game.fail_progress_buckets(t.events))
query(
    "chapter_fail_progress",
    f"""SELECT 'Ch.' || split_part(stage_id, '-', 1) AS chapter, {rnd('avg(completion_pct)', 1)} AS avg_completion FROM nb
WHERE event_type = 'stage_fail' AND completion_pct > 0 AND mode = 'story'
AND try_cast(split_part(stage_id, '-', 1) AS INTEGER) BETWEEN 1 AND 5 GROUP BY 1""",
)(lambda t: game.chapter_fail_progress(t.events))

# First-version events

query("legacy_total_events", "SELECT count(*) AS total FROM legacy")(lambda t: ops.total_events(t.legacy, version=None))
query(
    "legacy_completion_rate",
    """SELECT CAST(count(*) FILTER (event_type = 'time_attack_end') AS DOUBLE) /
greatest(count(*) FILTER (event_type = 'game_start'), 1) AS rate FROM legacy""",
)(lambda t: legacy.completion_rate(t.legacy))
for _name, _type in (("time_attack", legacy.TIME_ATTACK_CLEAR), ("story", legacy.STORY_CLEAR)):
    query(
        f"legacy_{_name}_clear_time",
        f"""SELECT avg(coalesce(try_cast(p_clear_ms AS DOUBLE), 0)) AS avg_ms FROM legacy
WHERE event_type = '{_type}' AND p_clear_ms <> ''""",
    )(lambda t, kind=_type: legacy.clear_time(t.legacy, kind))
# 2024-01-05 00:00 to 2024-01-12 00:00 UTC, inside the sample's days.
_FROM_MS, _TO_MS = 1_704_412_800_000, 1_705_017_600_000
query(
    "legacy_events_per_hour",
    f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS events FROM legacy
WHERE "timestamp" BETWEEN {_FROM_MS} AND {_TO_MS} GROUP BY 1""",
)(lambda t: legacy.events_per_hour(t.legacy, _FROM_MS, _TO_MS))
query(
    "legacy_grid_clear_times",
    f"""SELECT p_grid AS grid_size, {rnd("avg(c) FILTER (event_type = 'stage_clear')")} AS time_attack,
{rnd("avg(c) FILTER (event_type = 'story_stage_clear')")} AS story
FROM (SELECT *, coalesce(try_cast(p_clear_ms AS DOUBLE), 0) AS c FROM legacy
WHERE event_type IN ('stage_clear', 'story_stage_clear') AND p_grid <> '' AND p_clear_ms <> '') GROUP BY 1""",
)(lambda t: legacy.grid_clear_times(t.legacy))
query(
    "legacy_stage_funnel",
    """SELECT CAST(p_stage AS VARCHAR) AS stage, count(*) AS clears FROM legacy
WHERE event_type IN ('stage_clear', 'story_stage_clear') AND p_stage IS NOT NULL GROUP BY 1""",
)(lambda t: legacy.stage_funnel(t.legacy))
query(
    "legacy_play_hours",
    """SELECT strftime(ts + INTERVAL 9 HOUR, '%H:00') AS hour_kst, count(*) AS plays FROM legacy
WHERE event_type IN ('game_start', 'stage_start', 'stage_clear', 'story_stage_clear') GROUP BY 1""",
)(lambda t: legacy.play_hours(t.legacy))
query(
    "legacy_session_length",
    f"""SELECT {rnd('avg(s)')} AS avg_sec FROM (SELECT session_id, max("timestamp") // 1000 - min("timestamp") // 1000 AS s
FROM legacy GROUP BY 1 HAVING s > 5 AND s < 10800)""",
)(lambda t: legacy.session_length(t.legacy))


@query(
    "legacy_active_users",
    """SELECT count(DISTINCT user_key) AS active_users, TRUE AS estimate_close FROM legacy
WHERE "timestamp" >= (SELECT max("timestamp") FROM legacy ) - 86400000""",
)
def _legacy_active_users(t):
    """The estimate has no SQL twin; the exact count stands next to a check of the estimate's error."""
    latest = t.legacy.agg(F.max("timestamp")).scalar()
    exact = t.legacy.filter(F.col("timestamp") >= latest - 86_400_000).agg(F.count_distinct("user_key").alias("active_users"))
    estimate = legacy.active_users(t.legacy, latest).scalar()
    return exact.withColumn("estimate_close", F.abs(estimate - F.col("active_users")) <= 0.2 * F.col("active_users"))
