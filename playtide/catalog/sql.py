"""SQL twins of the frames in the registry, for the comparison run."""

from __future__ import annotations

# name -> (text, names it reads). Only what a statement needs is put in front of it.
_PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "src": (
        """SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) // 1000 AS ms,
  CASE WHEN user_id % 25 = 0 THEN 'user_bot_' ELSE 'user_' END || user_id AS uk,
  event_type IN ('view', 'purchase', 'error') AS on_stage, event_type = 'purchase' AS is_clear
FROM events""",
        (),
    ),
    "allev": (
        """SELECT 'e' || event_id AS event_id,
  CASE WHEN event_type = 'signup' THEN 'session_start' WHEN event_type = 'view' THEN 'stage_start'
       WHEN event_type = 'purchase' THEN 'stage_clear' WHEN event_type = 'error' THEN 'stage_fail'
       WHEN k % 4 = 0 THEN 'item_use' ELSE 'navigation' END AS event_type,
  uk AS user_key, uk || '-' || strftime(ts, '%Y%m%d') AS session_id, ms AS "timestamp",
  ms - CASE WHEN event_id % 50 = 0 THEN 5000 + 1000 * (event_id % 41) ELSE 20 * k - 200 END AS client_timestamp,
  CASE WHEN event_id % 40 = 0 THEN '1' ELSE '2' END AS schema_version, k % 6 AS seq,
  CASE WHEN NOT on_stage THEN '' WHEN k % 2 = 0 THEN 'story' ELSE 'time_attack' END AS mode,
  CASE WHEN NOT on_stage THEN '' WHEN k % 2 = 0 THEN (k // 20 + 1) || '-' || (k % 10 + 1)
       ELSE 'ta-' || (k % 15 + 1) END AS stage_id,
  CASE WHEN NOT on_stage THEN '' WHEN k < 20 THEN '3x3' WHEN k < 40 THEN '4x3' WHEN k < 60 THEN '4x4'
       ELSE '5x5' END AS grid_size,
  CASE WHEN on_stage AND k % 2 = 1 THEN 60 * (k % 3 + 1) ELSE 0 END AS time_limit_sec,
  CASE WHEN is_clear THEN CAST(floor(value * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) ELSE 0 END AS clear_time_ms,
  CASE WHEN is_clear THEN k % 30 + 1 ELSE 0 END AS taps,
  CASE WHEN is_clear THEN 100 + 7 * k ELSE 0 END AS score,
  CASE WHEN is_clear THEN k % 4 ELSE 0 END AS bonus_collected,
  CASE WHEN is_clear AND k % 10 = 0 THEN 1 ELSE 0 END AS universal_used,
  CASE WHEN event_type = 'error' THEN 20 + k % 66 ELSE 0 END AS completion_pct,
  CASE WHEN event_type <> 'signup' THEN '' WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END AS platform,
  CASE WHEN event_type = 'click' AND k % 4 <> 0 THEN 'title' ELSE '' END AS from_screen,
  CASE WHEN event_type = 'click' AND k % 4 <> 0 THEN CASE WHEN k < 50 THEN 'stageSelect' ELSE 'leaderboard' END
       ELSE '' END AS to_screen,
  CASE WHEN event_type = 'click' AND k % 4 = 0 THEN CASE WHEN k % 8 = 0 THEN 'purchase' ELSE 'use' END
       ELSE '' END AS action,
  CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m-%d') AS day_text, date_trunc('hour', ts) AS hour, event_id AS n
FROM src""",
        ("src",),
    ),
    "ev": ("SELECT * FROM allev WHERE schema_version = '2'", ("allev",)),
    "nb": ("SELECT * FROM ev WHERE user_key NOT LIKE 'user_bot%'", ("ev",)),
    "legacy": (
        """SELECT uk AS user_key, uk || '-' || strftime(ts, '%Y%m%d') AS session_id, ms AS "timestamp", ts,
  CASE WHEN event_type = 'signup' THEN 'game_start' WHEN event_type = 'view' THEN 'stage_start'
       WHEN event_type = 'error' THEN 'time_attack_end' WHEN event_type = 'click' THEN 'leaderboard_view'
       WHEN k % 2 = 0 THEN 'story_stage_clear' ELSE 'stage_clear' END AS event_type,
  CASE WHEN k % 10 = 9 THEN NULL WHEN k % 10 = 8 THEN 'fast'
       ELSE CAST(CAST(floor(value * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS VARCHAR) END AS p_clear_ms,
  CASE WHEN k % 7 = 0 THEN NULL WHEN k < 50 THEN '3x3' ELSE '4x4' END AS p_grid,
  CASE WHEN k % 9 = 0 THEN NULL ELSE k % 50 + 1 END AS p_stage
FROM src""",
        ("src",),
    ),
    "sent": (
        """SELECT ev.*, ev."timestamp" + 1000 * d.delay AS sent_ms
FROM ev, LATERAL (SELECT unnest(CASE WHEN n % 60 = 0 THEN [0, 1800, 3600, 5000, 7300] WHEN n % 20 = 0 THEN [0, 600]
  WHEN n % 45 = 0 THEN [0, 7200, 7200] ELSE [0] END) AS delay) AS d""",
        ("ev",),
    ),
    "kept": (
        """SELECT event_id, min(sent_ms) AS sent_ms FROM sent GROUP BY event_id
UNION ALL
SELECT kept.event_id, (SELECT min(s.sent_ms) FROM sent s WHERE s.event_id = kept.event_id AND s.sent_ms >= kept.sent_ms + 3600000)
FROM kept WHERE EXISTS (SELECT 1 FROM sent s WHERE s.event_id = kept.event_id AND s.sent_ms >= kept.sent_ms + 3600000)""",
        ("sent",),
    ),
    "daily": (
        """SELECT day, day_text, user_key, mode, count(*) FILTER (event_type = 'stage_clear') AS clears,
  count(*) FILTER (event_type = 'stage_fail') AS fails FROM ev GROUP BY ALL""",
        ("ev",),
    ),
    "stage": (
        """SELECT mode, stage_id, count(*) FILTER (event_type = 'stage_clear') AS clears, count(*) AS attempts,
  CAST(sum(clear_time_ms) AS BIGINT) AS clear_ms, count(*) FILTER (clear_time_ms > 0) AS timed_clears
FROM ev WHERE event_type IN ('stage_clear', 'stage_fail') GROUP BY ALL""",
        ("ev",),
    ),
    "lb": (
        """SELECT user_key || '-' || strftime(day, '%Y%m%d') || '-' || time_limit_sec AS entry_id, user_key,
  'time_attack' AS mode, time_limit_sec, CAST(sum(score) AS INTEGER) AS score, CAST(count(*) AS INTEGER) AS stages_cleared,
  CAST(round_even(avg(clear_time_ms), 0) AS INTEGER) AS avg_clear_ms, CAST(sum(universal_used) AS INTEGER) AS universal_used,
  max("timestamp") AS played_ms
FROM ev WHERE event_type = 'stage_clear' AND mode = 'time_attack' GROUP BY user_key, day, time_limit_sec""",
        ("ev",),
    ),
    "usr": (
        """SELECT CASE WHEN c_custkey % 25 = 0 THEN 'user_bot_' ELSE 'user_' END || c_custkey AS user_key,
  CASE WHEN c_acctbal >= 0 THEN c_name END AS nickname FROM customer""",
        (),
    ),
    "best": (
        """SELECT * EXCLUDE (pick) FROM (SELECT lb.*, usr.nickname, row_number() OVER (PARTITION BY lb.user_key
  ORDER BY score DESC, stages_cleared DESC, avg_clear_ms ASC NULLS LAST, played_ms, entry_id) AS pick
FROM lb JOIN usr USING (user_key)) WHERE pick = 1""",
        ("lb", "usr"),
    ),
    "ranked": (
        """SELECT *, dense_rank() OVER (ORDER BY score DESC, stages_cleared DESC, avg_clear_ms ASC NULLS LAST) AS rank
FROM best""",
        ("best",),
    ),
}


def _sessions(name: str, gap_ms: int) -> dict[str, tuple[str, tuple[str, ...]]]:
    """Row-wise sessions: a gap test per row and a running count, unlike the slot method of the library."""
    return {
        f"{name}_rows": (
            f"""SELECT *, sum(CASE WHEN prev IS NULL OR "timestamp" - prev > {gap_ms} THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_key ORDER BY "timestamp", seq, event_id ROWS UNBOUNDED PRECEDING) AS session_no
FROM (SELECT *, lag("timestamp") OVER (PARTITION BY user_key ORDER BY "timestamp", seq, event_id) AS prev FROM ev)""",
            ("ev",),
        ),
        f"{name}_modes": (
            f"""SELECT user_key, session_no, mode AS primary_mode FROM (SELECT user_key, session_no, mode, row_number()
  OVER (PARTITION BY user_key, session_no ORDER BY count(*) DESC, mode DESC) AS r
FROM {name}_rows WHERE mode <> '' GROUP BY user_key, session_no, mode) WHERE r = 1""",
            (f"{name}_rows",),
        ),
        name: (
            f"""SELECT user_key, arg_min(session_id, {{'t': "timestamp", 's': session_id}}) AS session_id,
  min("timestamp") AS session_start, max("timestamp") AS session_end,
  max("timestamp") - min("timestamp") AS duration_ms, count(*) AS total_events,
  count(*) FILTER (event_type = 'stage_clear') AS stage_clears, count(*) FILTER (event_type = 'stage_fail') AS stage_fails,
  CAST(sum(score) AS BIGINT) AS total_score, coalesce(max(primary_mode), 'unknown') AS primary_mode,
  count(DISTINCT stage_id) FILTER (stage_id <> '') AS distinct_stages,
  coalesce(avg(clear_time_ms) FILTER (event_type = 'stage_clear' AND clear_time_ms > 0), 0) AS avg_clear_time_ms,
  CAST(sum(universal_used) AS BIGINT) AS universal_used, count(*) FILTER (event_type = 'navigation') AS navigations
FROM {name}_rows LEFT JOIN {name}_modes USING (user_key, session_no) GROUP BY user_key, session_no""",
            (f"{name}_rows", f"{name}_modes"),
        ),
    }


def _alerts(name: str, window_ms: int, threshold: int) -> dict[str, tuple[str, tuple[str, ...]]]:
    return {
        f"{name}_recent": (
            f"""SELECT *, count(*) OVER (PARTITION BY user_key ORDER BY "timestamp" RANGE BETWEEN {window_ms} PRECEDING
  AND CURRENT ROW) AS recent, CASE grid_size WHEN '3x3' THEN 500 WHEN '3x4' THEN 600 WHEN '4x3' THEN 600
  WHEN '4x4' THEN 600 ELSE 700 END AS cap FROM ev WHERE event_type = 'stage_clear'""",
            ("ev",),
        ),
        name: (
            f"""SELECT user_key, session_id, 'IMPOSSIBLE_CLEAR' AS alert_type,
  'Cleared stage ' || stage_id || ' in ' || clear_time_ms || 'ms (< 500ms threshold)' AS description,
  "timestamp" AS detected_at, event_id, stage_id, score, clear_time_ms, 0 AS event_count
FROM {name}_recent WHERE clear_time_ms > 0 AND clear_time_ms < 500
UNION ALL SELECT user_key, session_id, 'RAPID_FIRE', recent || ' stage clears in 1 minute (threshold: {threshold})',
  "timestamp", event_id, '', 0, 0, recent FROM {name}_recent WHERE recent >= {threshold}
UNION ALL SELECT user_key, session_id, 'SCORE_OVERFLOW', 'Score ' || score || ' exceeds max ' || cap || ' for grid ' || grid_size,
  "timestamp", event_id, stage_id, score, 0, 0 FROM {name}_recent WHERE score > cap""",
            (f"{name}_recent",),
        ),
    }


_PARTS |= _sessions("sess", 6 * 3_600_000) | _sessions("sess5", 300_000)
_PARTS |= _alerts("alerts", 86_400_000, 3) | _alerts("alerts20", 60_000, 20)


def _needed(text: str) -> list[str]:
    """Parts a statement mentions, each after the parts it reads."""
    order: list[str] = []

    def visit(name: str) -> None:
        for below in _PARTS[name][1]:
            visit(below)
        if name not in order:
            order.append(name)

    words = set(text.replace(",", " ").replace("(", " ").replace(")", " ").replace(".", " ").split())
    for name in _PARTS:
        if name in words:
            visit(name)
    return order


def with_base(text: str) -> str:
    """Put the parts a statement reads in front of it."""
    needed = _needed(text)
    parts = ",\n".join(f"{name} AS ({_PARTS[name][0]})" for name in needed)
    return f"WITH RECURSIVE {parts}\n{text}" if needed else text


def rnd(value: str, digits: int = 0) -> str:
    """Round a double half to even."""
    scale = f"CAST({10**digits} AS DOUBLE)"
    return f"(round_even(CAST({value} AS DOUBLE) * {scale}, 0) / {scale})"


def pct(part: str, whole: str, digits: int) -> str:
    return rnd(f"CAST({part} AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(nullif({whole}, 0) AS DOUBLE)", digits)
