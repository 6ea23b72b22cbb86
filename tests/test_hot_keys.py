"""Random rows with one user (or id) holding a large share, against plain Python replays of the rules."""

import random

import pytest
from frames import events, rows
from pyspark.sql import functions as F

from playtide.operators import alerts, dedup, ordered, quality, sessions
from playtide.plans import serving
from playtide.schema import LEADERBOARD_SCHEMA


def _random_events(seed: int, n: int = 1500, span_ms: int = 8 * 3_600_000) -> list[dict]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        user = "hot" if rng.random() < 0.4 else f"u{rng.randrange(8)}"
        # Bursts with many equal times, and quiet stretches.
        base = rng.choice([0, span_ms // 3, span_ms // 2]) if rng.random() < 0.5 else rng.randrange(span_ms)
        out.append({
            "event_id": f"e{i:05d}", "user_key": user, "timestamp": base + rng.randrange(0, 200_000, 500),
            "seq": rng.randrange(6), "session_id": rng.choice(["s1", "s2", None]),
            "event_type": rng.choice(["stage_clear", "stage_clear", "stage_fail", "navigation"]),
            "mode": rng.choice(["story", "time_attack", ""]), "stage_id": rng.choice(["1-1", "1-2", "ta-1", ""]),
            "score": rng.randrange(100), "clear_time_ms": rng.choice([0, 400, 900]),
        })
    return out


def _by_user(data):
    users = {}
    for row in sorted(data, key=lambda r: (r["timestamp"], r["seq"], r["event_id"])):
        users.setdefault(row["user_key"], []).append(row)
    return users


@pytest.mark.parametrize("seed", [1, 2])
def test_ordered_rules(spark, seed):
    data = _random_events(seed)
    df = events(spark, data, partitions=5)
    numbers, gaps, silences = [], [], []
    for user_rows in _by_user(data).values():
        previous, last = None, None
        for number, row in enumerate(user_rows, start=1):
            numbers.append((row["event_id"], number))
            if last is not None and row["timestamp"] - last > 1_800_000:
                silences.append((row["event_id"], row["timestamp"] - last, number))
            last = row["timestamp"]
            if row["seq"] > 0:
                if previous and previous[0] is not None and previous[0] == row["session_id"] and row["seq"] > previous[1] + 1:
                    gaps.append((row["event_id"], row["seq"] - previous[1] - 1))
                previous = (row["session_id"], row["seq"])
    for slice_ms in (60_000, ordered.HOUR_MS):
        assert rows(quality.with_event_no(df, slice_ms), "event_id", "event_no") == sorted(numbers, key=repr)
        assert rows(quality.seq_gaps(df, slice_ms), "event_id", "missing") == sorted(gaps, key=repr)
    assert rows(quality.inactivity_gaps(df), "event_id", "gap_ms", "event_no") == sorted(silences, key=repr)


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("window_ms, slice_ms", [(60_000, ordered.HOUR_MS), (60_000, 1_000), (3_000_000, 700_000)])
def test_trailing_count(spark, seed, window_ms, slice_ms):
    data = [r for r in _random_events(seed) if r["event_type"] == "stage_clear"]
    expected = []
    for user_rows in _by_user(data).values():
        seen = []
        for row in user_rows:
            seen = [t for t in seen if row["timestamp"] - t <= window_ms] + [row["timestamp"]]
            expected.append((row["event_id"], len(seen)))
    df = events(spark, data, partitions=5)
    counted = ordered.with_trailing_count(df, ["user_key"], "recent", window_ms, slice_ms=slice_ms)
    assert rows(counted, "event_id", "recent") == sorted(expected, key=repr)
    fired = sorted(((e, n) for e, n in expected if n >= 20), key=repr)
    assert rows(alerts.rapid_fire(df, window_ms, 20, slice_ms), "event_id", "event_count") == fired


@pytest.mark.parametrize("gap_ms", [300_000, 1_000])
def test_sessions(spark, gap_ms):
    data = _random_events(5)
    expected = []
    for user, user_rows in _by_user(data).items():
        groups = []
        for row in user_rows:
            if not groups or row["timestamp"] - groups[-1][-1]["timestamp"] > gap_ms:
                groups.append([])
            groups[-1].append(row)
        for group in groups:
            ids = [(r["timestamp"], r["session_id"]) for r in group if r["session_id"] is not None]
            clears = [r for r in group if r["event_type"] == "stage_clear"]
            times = [r["clear_time_ms"] for r in clears if r["clear_time_ms"] > 0]
            modes = [r["mode"] for r in group if r["mode"]]
            expected.append((
                user, min(ids)[1] if ids else "unknown", group[0]["timestamp"], group[-1]["timestamp"], len(group),
                sum(r["score"] for r in clears), max(((modes.count(m), m) for m in modes), default=(0, "unknown"))[1],
                len({r["stage_id"] for r in group if r["stage_id"]}), sum(times) / len(times) if times else 0.0,
            ))
    got = rows(
        sessions.session_summary(events(spark, data, partitions=5), gap_ms), "user_key", "session_id", "session_start",
        "session_end", "total_events", "total_score", "primary_mode", "distinct_stages", "avg_clear_time_ms",
    )
    assert got == sorted(expected, key=repr)


@pytest.mark.parametrize("ttl_ms", [3_600_000, 400_000, 60_000])
def test_dedup(spark, ttl_ms):
    rng = random.Random(ttl_ms)
    data = [
        {"event_id": "hot" if rng.random() < 0.4 else f"e{rng.randrange(150)}", "timestamp": rng.randrange(0, 9 * 3_600_000, 250)}
        for _ in range(1200)
    ]
    expected, last = [], {}
    for row in sorted(data, key=lambda r: r["timestamp"]):
        if row["event_id"] not in last or row["timestamp"] - last[row["event_id"]] >= ttl_ms:
            last[row["event_id"]] = row["timestamp"]
            expected.append((row["event_id"], row["timestamp"]))
    got = rows(dedup.dedup(events(spark, data, partitions=5), ttl_ms=ttl_ms), "event_id", "timestamp")
    assert got == sorted(expected, key=repr)


def test_ranks(spark):
    rng = random.Random(7)
    entries = [
        (f"x{i}", f"u{i:04d}", "time_attack", 60, rng.choice([0, 0, rng.randrange(300_000)]), rng.randrange(3),
         rng.choice([None, rng.randrange(4)]), 0, None)
        for i in range(800)
    ]
    users = spark.createDataFrame([(e[1], "n") for e in entries], "user_key string, nickname string")
    best = serving.best_scores(spark.createDataFrame(entries, LEADERBOARD_SCHEMA), users)

    def result(e):
        return (-e[4], -e[5], e[6] is None, e[6] or 0)

    places = {r: i for i, r in enumerate(sorted({result(e) for e in entries}), start=1)}
    expected = sorted(((e[1], places[result(e)]) for e in entries), key=repr)
    assert rows(serving.rank_scores(best), "user_key", "rank") == expected
    for user, rank in expected[::200]:
        assert rows(serving.my_rank(best, user), "rank") == [(rank,)]
    top = serving.leaderboard_page(best, 50, 100).select("user_key", "rank").collect()
    assert [tuple(r) for r in top] == sorted(expected, key=lambda x: (x[1], x[0]))[100:150]


def test_no_window_over_a_whole_user(spark):
    """A window by user alone only ever reads rows that were aggregated before; raw rows are windowed per slice."""
    df = events(spark, _random_events(9, 50))
    for frame in (
        quality.with_event_no(df), quality.seq_gaps(df), quality.inactivity_gaps(df), alerts.rapid_fire(df),
        sessions.session_summary(df), sessions.sessionize(df),
    ):
        plan = frame._jdf.queryExecution().optimizedPlan()

        def visit(node):
            if node.nodeName() == "Window":
                assert node.partitionSpec().size() > 1 or "Aggregate" in node.toString(), node.toString()
            for child in (node.children().apply(i) for i in range(node.children().size())):
                visit(child)

        visit(plan)


def test_functions_round_both_ways(spark):
    from playtide.functions import rounded

    row = spark.range(1).select(
        rounded(F.lit(2.5)).alias("a"), rounded(F.lit(2.5), 0, "half_up").alias("b"), rounded(F.lit(0.25), 1).alias("c")
    ).first()
    assert tuple(row) == (2.0, 3.0, 0.2)
