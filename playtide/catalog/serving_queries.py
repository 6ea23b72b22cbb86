"""Leaderboard, progress, users and per-player statistics."""

from pyspark.sql import functions as F

from playtide.catalog.registry import query
from playtide.catalog.sql import pct, rnd
from playtide.functions import event_ts
from playtide.plans import player, serving
from playtide.plans.board import RankedBoard
from playtide.session import work_path

_BEST = "entry_id, user_key, nickname, time_limit_sec, score, stages_cleared, avg_clear_ms, universal_used"
_BEST_COLUMNS = _BEST.split(", ")


def _best(t, limit_sec=None):
    return serving.best_scores(t.leaderboard, t.users, time_limit_sec=limit_sec)


def _best_sql(limit_sec: int) -> str:
    return f"""(SELECT *, dense_rank() OVER (ORDER BY score DESC, stages_cleared DESC, avg_clear_ms ASC NULLS LAST) AS rank
FROM (SELECT lb.*, usr.nickname, row_number() OVER (PARTITION BY lb.user_key ORDER BY score DESC, stages_cleared DESC,
avg_clear_ms ASC NULLS LAST, played_ms, entry_id) AS pick FROM lb JOIN usr USING (user_key) WHERE time_limit_sec = {limit_sec})
WHERE pick = 1)"""


query("best_scores", f"SELECT {_BEST} FROM best")(lambda t: _best(t).select(*_BEST_COLUMNS))
query("ranked_scores", f"SELECT {_BEST}, rank FROM ranked")(
    lambda t: serving.rank_scores(_best(t)).select(*_BEST_COLUMNS, "rank")
)
query("leaderboard", f"SELECT {_BEST}, rank FROM ranked ORDER BY rank, user_key LIMIT 20")(
    lambda t: serving.leaderboard_page(_best(t)).select(*_BEST_COLUMNS, "rank")
)
query("leaderboard_page_3", f"SELECT {_BEST}, rank FROM ranked ORDER BY rank, user_key LIMIT 10 OFFSET 20")(
    lambda t: serving.leaderboard_page(_best(t), 10, 20).select(*_BEST_COLUMNS, "rank")
)
query("leaderboard_60_seconds", f"SELECT {_BEST}, rank FROM {_best_sql(60)} ORDER BY rank, user_key LIMIT 20")(
    lambda t: serving.leaderboard_page(_best(t, 60)).select(*_BEST_COLUMNS, "rank")
)
query("my_rank", f"SELECT {_BEST}, rank FROM ranked WHERE user_key = 'user_7'")(
    lambda t: serving.my_rank(_best(t), "user_7").select(*_BEST_COLUMNS, "rank")
)
query("my_rank_120_seconds", f"SELECT {_BEST}, rank FROM {_best_sql(120)} WHERE user_key = 'user_7'")(
    lambda t: serving.my_rank(_best(t, 120), "user_7").select(*_BEST_COLUMNS, "rank")
)


def _indexed(t) -> RankedBoard:
    """The board, kept up by three thirds of the scores."""
    third = F.pmod(F.xxhash64("entry_id"), F.lit(3))
    deltas = [serving.best_scores(t.leaderboard.filter(third == i), t.users) for i in range(3)]
    board = RankedBoard(t.spark, work_path(t.spark, "board"), deltas[0].schema)
    for number, delta in enumerate(deltas):
        board.commit(delta, number)
    return board


query("indexed_page", f"SELECT {_BEST}, rank FROM ranked ORDER BY rank, user_key LIMIT 50 OFFSET 40")(
    lambda t: _indexed(t).page(50, 40).select(*_BEST_COLUMNS, "rank")
)
query("indexed_rank", f"SELECT {_BEST}, rank FROM ranked WHERE user_key = 'user_7'")(
    lambda t: _indexed(t).rank_of("user_7").select(*_BEST_COLUMNS, "rank")
)


@query(
    "appended_scores",
    """SELECT user_key, time_limit_sec, score, stages_cleared FROM lb
UNION ALL SELECT user_key, time_limit_sec, score, stages_cleared FROM lb""",
)
def _appended_scores(t):
    again = t.leaderboard.drop("avg_clear_ms")
    return serving.append_scores(t.leaderboard, again).select("user_key", "time_limit_sec", "score", "stages_cleared")


_PROGRESS_SQL = """SELECT user_key, stage_id, min(clear_time_ms) AS best_time_ms, count(*) AS clear_count,
CAST(sum(universal_used) AS BIGINT) AS universal_used, min("timestamp") AS first_cleared_at, max("timestamp") AS updated_at
FROM ev WHERE event_type = 'stage_clear' AND mode = 'story' GROUP BY 1, 2"""


def _story_clears(t):
    return t.current.filter((F.col("event_type") == "stage_clear") & (F.col("mode") == "story"))


query("stage_progress", _PROGRESS_SQL)(lambda t: serving.stage_progress(_story_clears(t)))


@query("merged_progress", _PROGRESS_SQL)
def _merged_progress(t):
    """Progress up to the middle of the month, with the later clears folded in."""
    early = F.col("timestamp") < 1_705_276_800_000
    clears = _story_clears(t)
    return serving.merge_progress(
        serving.stage_progress(clears.filter(early)), serving.stage_progress(clears.filter(~early))
    )


query(
    "progress_of_user",
    f"SELECT * EXCLUDE (user_key) FROM ({_PROGRESS_SQL}) WHERE user_key = 'user_7'",
)(lambda t: serving.progress_of(serving.stage_progress(_story_clears(t)), "user_7"))


@query(
    "upserted_users",
    """SELECT coalesce(usr.user_key, touch.user_key) AS user_key, coalesce(touch.name, usr.nickname) AS nickname,
strftime(make_timestamp(coalesce(CASE WHEN usr.user_key IS NOT NULL THEN 1704067200000 END, touch.a) * 1000), '%Y-%m-%d %H:%M:%S') AS created_at,
strftime(make_timestamp(coalesce(touch.z, 1704067200000) * 1000), '%Y-%m-%d %H:%M:%S') AS last_seen_at
FROM usr FULL JOIN (SELECT user_key, min("timestamp") AS a, max("timestamp") AS z,
arg_max(platform || '-player', "timestamp") FILTER (platform <> '') AS name FROM ev GROUP BY 1) touch ON usr.user_key = touch.user_key""",
)
def _upserted_users(t):
    """Every event touches its user; session starts also rename it."""
    touches = t.current.select(
        "user_key", F.when(F.col("platform") != "", F.concat("platform", F.lit("-player"))).alias("nickname"),
        event_ts().alias("seen_at"),
    )
    return serving.upsert_users(t.users, touches)


query(
    "get_user",
    "SELECT user_key, nickname, '2024-01-01 00:00:00' AS created_at, '2024-01-01 00:00:00' AS last_seen_at FROM usr WHERE user_key = 'user_7'",
)(lambda t: serving.get_user(t.users, "user_7"))

# Players

query(
    "login_streaks",
    """SELECT user_key, arg_max(len, last_day) AS streak_days, max(len) AS longest, strftime(max(last_day), '%Y-%m-%d') AS last_day
FROM (SELECT user_key, island, count(*) AS len, max(day) AS last_day FROM (SELECT user_key, day,
day - CAST(row_number() OVER (PARTITION BY user_key ORDER BY day) AS INTEGER) AS island
FROM (SELECT DISTINCT user_key, day FROM ev WHERE event_type = 'session_start')) GROUP BY 1, 2) GROUP BY 1""",
)(lambda t: player.login_streaks(t.events))

_STORY = """(SELECT user_key, (chapter - 1) * 10 + stage_no AS stage_number, chapter, stage_no FROM (SELECT user_key,
CAST(split_part(stage_id, '-', 1) AS INTEGER) AS chapter, CAST(split_part(stage_id, '-', 2) AS INTEGER) AS stage_no
FROM ev WHERE event_type = 'stage_clear' AND mode = 'story'))"""
query(
    "cleared_stages",
    f"""SELECT user_key, array_to_string(list_sort(list(DISTINCT stage_number)), ',') AS cleared_stages,
max(stage_number) AS best_stage, count(DISTINCT stage_number) AS cleared FROM {_STORY} GROUP BY 1""",
)(lambda t: player.cleared_stages(t.events).withColumn("cleared_stages", F.array_join("cleared_stages", ",")))
query(
    "chapter_progress",
    f"""SELECT u.user_key, c.chapter, count(DISTINCT s.stage_no) AS cleared, count(DISTINCT s.stage_no) = 10 AS complete,
any_value(u.story_pct) AS story_pct FROM (SELECT user_key, floor(count(DISTINCT stage_number) * CAST(100 AS DOUBLE) / 50 + 0.5) AS story_pct
FROM {_STORY} GROUP BY 1) u, (SELECT unnest(range(1, 6)) AS chapter) c
LEFT JOIN {_STORY} s ON s.user_key = u.user_key AND s.chapter = c.chapter GROUP BY 1, 2""",
)(lambda t: player.chapter_progress(t.events))
query(
    "next_stages",
    f"""SELECT u.user_key, c.chapter, (SELECT min(n) FROM range(1, 11) AS r(n) WHERE NOT EXISTS
(SELECT 1 FROM {_STORY} s WHERE s.user_key = u.user_key AND s.chapter = c.chapter AND s.stage_no = n)) AS next_stage
FROM (SELECT DISTINCT user_key FROM {_STORY}) u, (SELECT unnest(range(1, 6)) AS chapter) c""",
)(lambda t: player.next_stages(t.events))
_POINTS = """100 + 50 * bonus_collected + CASE WHEN mode <> 'time_attack' THEN 0 WHEN clear_time_ms < 3000 THEN 200
WHEN clear_time_ms < 5000 THEN 150 WHEN clear_time_ms < 10000 THEN 100 ELSE 0 END"""
query(
    "score_mismatches",
    f"""SELECT user_key, event_id, mode, score, {_POINTS} AS expected_score FROM ev
WHERE event_type = 'stage_clear' AND score <> {_POINTS}""",
)(lambda t: player.score_mismatches(t.events))
_ROUNDS = """(SELECT user_key, session_id, round_no, max(time_limit_sec) AS time_limit_sec,
count(*) FILTER (event_type = 'stage_clear') AS stages_cleared, CAST(sum(score) AS BIGINT) AS score,
coalesce(floor(avg(clear_time_ms) FILTER (event_type = 'stage_clear') + CAST(0.5 AS DOUBLE)), 0) AS avg_clear_ms,
CAST(sum(universal_used) AS BIGINT) AS universal_used, max("timestamp") AS played_at
FROM (SELECT *, CAST(sum(CASE WHEN event_type = 'stage_start' AND stage_id = 'ta-1' THEN 1 ELSE 0 END) OVER
(PARTITION BY user_key, session_id ORDER BY "timestamp", seq, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS round_no
FROM ev WHERE mode = 'time_attack') GROUP BY 1, 2, 3)"""
query("round_summary", f"SELECT * FROM {_ROUNDS}")(lambda t: t.rounds)
query(
    "personal_bests",
    f"""SELECT user_key, time_limit_sec, score, stages_cleared FROM (SELECT *, row_number() OVER (PARTITION BY user_key,
time_limit_sec ORDER BY score DESC, played_at, stages_cleared DESC) AS pick FROM {_ROUNDS}) WHERE pick = 1""",
)(lambda t: player.personal_bests(t.rounds))
query(
    "total_plays",
    f"""SELECT user_key, CAST(sum(n) AS BIGINT) AS plays FROM (SELECT user_key, count(*) AS n FROM {_STORY} GROUP BY 1
UNION ALL SELECT user_key, count(*) FROM {_ROUNDS} GROUP BY 1) GROUP BY 1""",
)(lambda t: player.total_plays(t.events, t.rounds))

# The data as a whole

query("type_profile", f"SELECT event_type, count(*) AS cnt, {pct('count(*)', '(SELECT count(*) FROM allev )', 1)} AS pct FROM allev GROUP BY 1")(
    lambda t: player.type_profile(t.events)
)
query(
    "user_profile",
    """SELECT count(*) AS users, max(c) AS most, (list(c ORDER BY c DESC))[count(*) // 2 + 1] AS middle, min(c) AS fewest
FROM (SELECT user_key, count(*) AS c FROM allev GROUP BY 1)""",
)(lambda t: player.user_profile(t.events))
query(
    "bot_profile",
    """SELECT count(*) AS events, count(*) FILTER (clear_time_ms > 0 AND clear_time_ms < 500) AS impossible_clears,
count(*) FILTER (event_type = 'stage_clear' AND score > CASE grid_size WHEN '3x3' THEN 500 WHEN '4x3' THEN 600
WHEN '4x4' THEN 600 ELSE 700 END) AS score_overflows FROM allev WHERE user_key LIKE 'user_bot%'""",
)(lambda t: player.bot_profile(t.events))
query("day_profile", "SELECT day_text AS day, count(*) AS events FROM allev GROUP BY 1")(lambda t: player.day_profile(t.events))
query(
    "late_profile",
    f"""SELECT count(*) FILTER (abs("timestamp" - client_timestamp) > 30000) AS late,
{rnd('count(*) FILTER (abs("timestamp" - client_timestamp) > 30000) * CAST(100 AS DOUBLE) / count(*)', 1)} AS late_pct FROM allev""",
)(lambda t: player.late_profile(t.events))
query(
    "user_segments",
    f"""SELECT user_key, active_days, sessions, {rnd('CAST(sessions AS DOUBLE) / active_days', 2)} AS sessions_per_day,
strftime(last_day, '%Y-%m-%d') AS last_day, CASE WHEN user_key LIKE 'user_bot%' THEN 'bot' WHEN hi - last_day > 3 THEN 'churned'
WHEN active_days * CAST(7 AS DOUBLE) / (hi - lo + 1) >= 6 THEN 'heavy'
WHEN active_days * CAST(7 AS DOUBLE) / (hi - lo + 1) >= 3 THEN 'normal' ELSE 'casual' END AS segment
FROM (SELECT user_key, count(DISTINCT day) AS active_days, count(DISTINCT session_id) AS sessions, max(day) AS last_day
FROM allev GROUP BY 1), (SELECT min(day) AS lo, max(day) AS hi FROM allev )""",
)(lambda t: player.user_segments(t.events))
