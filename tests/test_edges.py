"""Edge rows of the stateful rules, written by hand."""

import json

import pytest
from frames import events, rows
from pyspark.sql import functions as F

from playtide.operators import alerts, dedup, ingest, quality, rollups, sessions
from playtide.plans import game, player, serving
from playtide.schema import LEADERBOARD_SCHEMA

DAY = 86_400_000


@pytest.mark.parametrize("second, expected", [(300_000, 1), (300_001, 2)])
def test_session_gap(spark, second, expected):
    df = events(spark, [{"timestamp": 0}, {"timestamp": second}])
    assert sessions.session_summary(df).count() == expected
    assert sessions.sessionize(df).agg(F.max("session_no")).first()[0] == expected


def test_session_gap_between_slots(spark):
    """Sessions that run over several slots, start late in a slot, or break inside neighbouring slots."""
    times = [299_999, 300_000, 599_000, 899_000, 1_199_001, 1_800_000, 2_100_001]
    got = rows(sessions.session_summary(events(spark, [{"timestamp": t} for t in times])), "session_start", "session_end")
    assert got == [(1_199_001, 1_199_001), (1_800_000, 1_800_000), (2_100_001, 2_100_001), (299_999, 899_000)]


def test_session_mode_tie_and_unknowns(spark):
    tie = events(spark, [{"mode": "story"}, {"mode": "time_attack"}])
    assert rows(sessions.session_summary(tie), "primary_mode") == [("time_attack",)]
    empty = events(spark, [{"mode": "", "session_id": None, "stage_id": "", "event_type": "heartbeat"}])
    got = rows(sessions.session_summary(empty), "primary_mode", "session_id", "avg_clear_time_ms", "distinct_stages")
    assert got == [("unknown", "unknown", 0.0, 0)]


def test_session_fields(spark):
    df = events(spark, [
        {"timestamp": 5, "session_id": None, "event_type": "navigation", "mode": "", "stage_id": ""},
        {"timestamp": 9, "session_id": "b", "clear_time_ms": 1000, "score": 10, "universal_used": 2},
        {"timestamp": 7, "session_id": "a", "clear_time_ms": 0, "score": 20, "mode": "time_attack"},
        {"timestamp": 8, "session_id": "a", "event_type": "stage_fail", "score": 99, "clear_time_ms": 7, "stage_id": "1-2"},
    ])
    got = sessions.session_summary(df).first().asDict()
    assert got == {
        "user_key": "u", "session_id": "a", "session_start": 5, "session_end": 9, "duration_ms": 4, "total_events": 4,
        "stage_clears": 2, "stage_fails": 1, "total_score": 30, "primary_mode": "story", "distinct_stages": 2,
        "avg_clear_time_ms": 1000.0, "universal_used": 2, "navigations": 1,
    }


def test_dedup_ttl(spark):
    seconds = [0, 1800, 3600, 5000, 7300]
    df = events(spark, [{"event_id": "x", "timestamp": s * 1000} for s in seconds] + [{"event_id": "y", "timestamp": 1}])
    assert rows(dedup.dedup(df), "event_id", "timestamp") == [("x", 0), ("x", 3_600_000), ("x", 7_300_000), ("y", 1)]
    stats = dedup.dedup_stats(df, dedup.dedup(df)).first()
    assert (stats["total"], stats["duplicates"]) == (6, 2)


def test_dedup_without_expiry_needs_no_second_pass(spark):
    df = events(spark, [{"event_id": "x", "timestamp": t} for t in (0, 0, 5, 3_599_999)])
    assert rows(dedup.dedup(df), "event_id", "timestamp") == [("x", 0)]


def test_late_flag(spark):
    df = events(spark, [{"timestamp": t, "client_timestamp": 0} for t in (30_000, 30_001, -30_001)])
    assert rows(quality.flag_late(df), "timestamp", "is_late") == [(-30_001, True), (30_000, False), (30_001, True)]
    assert quality.quality_stats(df).select("normal", "late").first() == (1, 2)


def test_seq_gaps(spark):
    spec = [(1, "s"), (2, "s"), (5, "s"), (0, "s"), (7, "t"), (2, "t"), (2, "t")]
    df = events(spark, [{"timestamp": i, "seq": seq, "session_id": sid} for i, (seq, sid) in enumerate(spec)])
    assert rows(quality.seq_gaps(df), "timestamp", "expected_seq", "seq", "missing") == [(2, 3, 5, 2)]
    # The same with the rows in different slices.
    far = events(spark, [{"timestamp": i * 4_000_000, "seq": seq, "session_id": sid} for i, (seq, sid) in enumerate(spec)])
    assert rows(quality.seq_gaps(far), "timestamp", "missing") == [(8_000_000, 2)]


def test_inactivity(spark):
    df = events(spark, [{"timestamp": t} for t in (0, 1_800_000, 3_600_001, 3_600_002)])
    assert rows(quality.inactivity_gaps(df), "timestamp", "gap_minutes", "event_no") == [(3_600_001, 30, 3)]


def test_impossible_clear(spark):
    df = events(spark, [{"clear_time_ms": ms} for ms in (0, 1, 499, 500)])
    assert rows(alerts.impossible_clear(df), "clear_time_ms") == [(1,), (499,)]


def test_rapid_fire(spark):
    df = events(spark, [{"timestamp": t} for t in [1_000] * 20 + [61_000, 61_001]])
    assert rows(alerts.rapid_fire(df), "detected_at", "event_count") == [(1_000, 20), (61_000, 21)]
    counted = alerts.rapid_fire(df, threshold=2).filter(F.col("detected_at") == 61_001)
    assert rows(counted, "event_count") == [(2,)]


@pytest.mark.parametrize("grid, scores", [
    (None, []), ("", [701]), ("3x3", [501, 601, 701]), ("4x3", [601, 701]), ("5x5", [701]), ("4x5", [701]),
])
def test_score_overflow(spark, grid, scores):
    df = events(spark, [{"grid_size": grid, "score": s} for s in (501, 601, 701)])
    assert rows(alerts.score_overflow(df), "score") == [(s,) for s in scores]


def test_alert_union_and_numbers(spark):
    fast = {"clear_time_ms": 100, "score": 900}
    df = events(spark, [{**fast, "timestamp": i, "event_type": "stage_clear"} for i in range(3)])
    found = alerts.detect_anomalies(df, threshold=3)
    assert rows(found.groupBy("alert_type").count(), "alert_type", "count") == [
        ("IMPOSSIBLE_CLEAR", 3), ("RAPID_FIRE", 1), ("SCORE_OVERFLOW", 3)]
    last = alerts.with_alert_no(found).filter(F.col("detected_at") == 2)
    assert rows(last, "alert_type", "alert_no") == [("IMPOSSIBLE_CLEAR", 5), ("RAPID_FIRE", 6), ("SCORE_OVERFLOW", 7)]
    assert alerts.alert_counts(found).first() == ("u", 7)


def test_retention(spark):
    df = events(spark, [{"timestamp": d * DAY} for d in (0, 1, 3)] + [{"user_key": "user_bot_1"}])
    assert [tuple(r)[1:] for r in game.retention(df).collect()] == [(1, 100.0, 100.0, 0.0)]


def test_streak(spark):
    df = events(spark, [{"event_type": "session_start", "timestamp": d * DAY} for d in (1, 2, 2, 3, 5)])
    assert rows(player.login_streaks(df), "streak_days", "longest") == [(1, 3)]


def test_next_stage(spark):
    cleared = ["1-1", "1-2", "1-4", "2-2", "11", "9-1", "x"] + [f"3-{n}" for n in range(1, 11)]
    df = events(spark, [{"stage_id": s} for s in cleared])
    assert rows(player.next_stages(df), "chapter", "next_stage") == [(1, 3), (2, 3), (3, None), (4, 1), (5, 1)]
    got = rows(player.chapter_progress(df), "chapter", "cleared", "complete", "story_pct")
    assert got[:3] == [(1, 3, False, 30.0), (2, 2, False, 30.0), (3, 10, True, 30.0)]


def _board(spark, entries):
    return spark.createDataFrame(
        [(f"x{i}", user, "time_attack", limit, score, stages, avg, 0, None) for i, (user, limit, score, stages, avg) in enumerate(entries)],
        LEADERBOARD_SCHEMA,
    )


def test_leaderboard(spark):
    board = _board(spark, [
        ("a", 60, 500, 3, 100), ("a", 60, 400, 9, 1), ("b", 60, 500, 3, 100), ("c", 60, 500, 3, None), ("d", 60, 500, 4, 900),
        ("e", 60, 100, 1, 5), ("gone", 60, 999, 9, 1), ("f", 120, 50, 1, None), ("f", 60, 70_000, 1, 1),
    ])
    users = spark.createDataFrame([(u, u.upper()) for u in "abcdef"], "user_key string, nickname string")
    best = serving.best_scores(board, users)
    expected = [("a", 3), ("b", 3), ("c", 4), ("d", 2), ("e", 5), ("f", 1)]
    assert rows(serving.rank_scores(best), "user_key", "rank") == expected
    assert rows(serving.leaderboard_page(best, 100), "user_key", "rank") == expected
    page = serving.leaderboard_page(best, 2, 2).select("user_key", "rank").collect()
    assert [tuple(r) for r in page] == [("a", 3), ("b", 3)]
    for user, rank in expected:
        assert rows(serving.my_rank(best, user), "user_key", "rank") == [(user, rank)]
    assert serving.my_rank(best, "gone").count() == 0
    assert rows(serving.my_rank(serving.best_scores(board, users, time_limit_sec=120), "f"), "rank") == [(1,)]
    with pytest.raises(ValueError):
        serving.leaderboard_page(best, 101)


@pytest.mark.parametrize("version, flat, kept", [
    ("1", False, False), ("2", True, True), ("3", True, False), ("10", False, False), (None, False, False), ("", False, False),
])
def test_version_route(spark, version, flat, kept):
    payload = '{"from": "a", "score": 7, "device_info": {"platform": "ios", "w": [1, 2.5]}, "note": null, "elapsed_ms": 3}'
    body = {"event_type": "x", "session_id": "s", "client_timestamp": 1}
    if version is not None:  # a null is refused, a missing version counts as the first one
        body["schema_version"] = version

    text = json.dumps({"user_key": "u", "events": [{**body, "payload": json.loads(payload)}]})
    got = ingest.ingest_records(spark.createDataFrame([(text,)], "value string"))
    row = got.first().asDict()
    assert (row["payload"] is None) == flat and (row["score"] == 7) == flat and (row["from_screen"] == "a") == flat
    assert row["platform"] == ("ios" if flat else None) and row["app_version"] == "0.1.0"
    if flat:
        assert json.loads(row["extra"]) == {"device_info": {"platform": "ios", "w": [1, 2.5]}, "note": None, "elapsed_ms": 3}
    assert (ingest.only_version(got).count() == 1) == kept


def test_request_limits(spark):

    event = {"event_type": "x", "session_id": "s", "client_timestamp": 1}
    cases = [
        ({"user_key": "u", "events": [event]}, []),
        ({"user_key": "u" * 65, "events": [event]}, ["user_key"]),
        ({"user_key": "u", "events": []}, ["events"]),
        ({"user_key": "u", "events": [event] * 51}, ["events"]),
        ({"user_key": "u", "events": [event, {**event, "schema_version": "12345"}]}, ["event_schema_version"]),
        ({"user_key": "u", "events": [{"session_id": "s"}]}, ["event"]),
        ({"user_key": "u", "app_version": "1" * 21, "events": [event]}, ["app_version"]),
    ]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)] + [(99, "{broken")], "i int, value string")
    got = {r["i"]: r["errors"] for r in ingest.validate_batches(ingest.parse_batches(df)).collect()}
    assert got == {**{i: e for i, (_, e) in enumerate(cases)}, 99: ["user_key", "events"]}


def test_parse_events(spark):
    texts = ['{"event_id":"a","event_type":"x","user_key":"u","z":1}', '{"event_id":"a"', '{"event_id":"a","event_type":"x"}', None]
    parsed = ingest.parse_events(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [r["error"] for r in parsed.collect()] == [None, "json", "field", "json"]
    assert parsed.first()["score"] == 0


def test_latest_by_key(spark):
    feed = spark.createDataFrame(
        [("a", 1, "c", "x"), ("a", 2, "u", "y"), ("b", 1, "c", "x"), ("b", 3, "d", None), ("b", 2, "u", "y")],
        "k string, v int, op string, value string",
    )
    assert rows(rollups.latest_by_key(feed, ["k"], ["v"]), "k", "value") == [("a", "y")]
    later = spark.createDataFrame([("a", 3, "d", None), ("c", 1, "c", "z")], feed.schema)
    state = rollups.latest_by_key(feed, ["k"], ["v"])
    assert rows(rollups.apply_cdc(state, later, ["k"], ["v"]), "k", "value") == [("c", "z")]


def test_upsert_users(spark):
    old = spark.sql("SELECT 'a' user_key, 'old' nickname, timestamp'2024-01-01' created_at, timestamp'2024-01-01' last_seen_at")
    delta = spark.sql(
        "SELECT * FROM VALUES ('a', CAST(NULL AS STRING), timestamp'2024-01-05'), ('b', 'n1', timestamp'2024-01-02'), "
        "('b', NULL, timestamp'2024-01-03') t(user_key, nickname, seen_at)"
    )
    got = serving.upsert_users(old, delta).selectExpr("user_key", "nickname", "CAST(created_at AS date) c", "CAST(last_seen_at AS date) l")
    assert [tuple(map(str, r)) for r in got.orderBy("user_key").collect()] == [
        ("a", "old", "2024-01-01", "2024-01-05"), ("b", "n1", "2024-01-02", "2024-01-03")]


def test_requests_are_checked_by_type(spark):
    """What the contract's types refuse and what they accept in another form."""
    whole = {"event_type": "x", "session_id": "s", "client_timestamp": 5}
    cases = [
        ({}, []), ({"payload": 5}, ["payload"]), ({"payload": "txt"}, ["payload"]), ({"payload": "{}"}, ["payload"]), ({"payload": [1]}, ["payload"]), ({"payload": None}, ["payload"]),
        ({"payload": {}}, []), ({"schema_version": None}, ["version"]), ({"app_version": None}, ["version"]),
        ({"client_timestamp": "77"}, []), ({"client_timestamp": 1.0}, []), ({"client_timestamp": 1.5}, ["event"]), ({"client_timestamp": "x"}, ["event"]),
    ]
    df = spark.createDataFrame(
        [(i, json.dumps({"user_key": "u", "events": [{**whole, **c}]})) for i, (c, _) in enumerate(cases)], "i int, value string")
    checked = ingest.validate_batches(ingest.parse_batches(df))
    assert {r["i"]: r["errors"] for r in checked.collect()} == {i: e for i, (_, e) in enumerate(cases)}
    times = {r["i"]: r["client_timestamp"] for r in ingest.explode_batches(checked, "i").collect()}
    assert (times[9], times[10]) == (77, 1)


def test_payload_values_are_never_lost(spark):
    cases = [
        {"score": 12, "x": 1}, {"score": 12.0}, {"score": "12"}, {"score": 12.7}, {"score": "many"}, {"score": None}, {"score": 10**12},
        {"platform": "ios", "device_info": {"platform": "web"}}, {"device_info": {"platform": "web"}, "platform": "ios"},
        {"from": "a", "from_screen": "b"}, {"device_info": {"platform": "web"}}, {"mode": {"a": 1}}, {"clear_time_ms": 2**31, "taps": 2**31},
    ]
    df = spark.createDataFrame([(i, "2", json.dumps(c)) for i, c in enumerate(cases)], "i int, schema_version string, payload string")
    got = {r["i"]: r for r in ingest.flatten_payload(df).collect()}
    assert [got[i]["score"] for i in range(7)] == [12, 12, 12, None, None, None, None]
    extra = [json.loads(got[i]["extra"]) if got[i]["extra"] else None for i in range(len(cases))]
    assert extra[:7] == [{"x": 1}, None, None, {"score": 12.7}, {"score": "many"}, None, {"score": 10**12}]
    assert [got[i]["platform"] for i in (7, 8, 10)] == ["ios", "ios", "web"] and got[9]["from_screen"] == "b"
    assert got[11]["mode"] == '{"a":1}'
    # Each number is held against the type of its own column.
    assert got[12]["clear_time_ms"] == 2**31 and extra[12] == {"taps": 2**31} and got[12]["taps"] is None


def test_numbers_of_messages(spark):
    base = {"event_id": "a", "event_type": "x", "user_key": "u"}
    values = ["12", 12.7, -3.9, "", None, "many", True, 1_704_067_200_123]
    texts = [json.dumps({**base, "timestamp": v}) for v in values]
    parsed = ingest.parse_events(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert [r["error"] for r in parsed] == [None, None, None, None, None, "json", "json", None]
    assert [r["timestamp"] for r in parsed if r["error"] is None] == [12, 12, -3, 0, 0, 1_704_067_200_123]
    assert ingest.parse_events(spark.createDataFrame([(json.dumps({**base, "score": 10**12}),)], "value string")).first()["error"] == "json"


def test_scores_need_a_mode(spark):
    df = spark.createDataFrame([("u", "time_attack", 1, 1, 0), ("u", None, -1, 1, 0)], "user_key string, mode string, score int, stages_cleared int, universal_used int")
    assert [r["errors"] for r in ingest.validate_scores(df).collect()] == [[], ["mode", "score"]]
