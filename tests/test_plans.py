"""How often the plans read raw rows, and which aggregates meet them."""

import random

import pytest
from frames import events, rows
from pyspark.sql import functions as F

from playtide.operators import dedup, ordered, quality, sessions
from playtide.plans import serving
from playtide.schema import LEADERBOARD_SCHEMA


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Events in a file, so that their scans can be told from those of written intermediates."""
    rng = random.Random(11)
    data = [
        {"event_id": f"e{rng.randrange(900)}", "timestamp": rng.randrange(0, 30_000_000, 250), "user_key": f"u{rng.randrange(9)}"}
        for _ in range(1000)
    ]
    path = str(tmp_path_factory.mktemp("raw") / "raw-rows")
    events(spark, data).write.parquet(path)
    return spark.read.parquet(path)


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def _raw_scans(df) -> int:
    return sum("FileScan" in line and "raw-rows" in line for line in _plan(df).splitlines())


def test_dedup_leaves_single_rows_alone(stored):
    """The result reads the raw rows once; only the written copies meet a sort aggregate."""
    for frame in (dedup.dedup(stored), dedup.first_by_key(stored)):
        assert _raw_scans(frame) == 1
        single = _plan(frame).split("FileScan")[1]
        assert "raw-rows" in single and "SortAggregate" not in _plan(frame).split("raw-rows")[0].split("Union")[1].split("Join")[0]


def test_session_summary_reads_written_parts_only(stored):
    assert _raw_scans(sessions.session_summary(stored)) == 0


def test_silences_need_no_sort_of_raw_rows(stored):
    """Aggregates over struct columns run after the join with the silences found; raw rows meet hash aggregates."""
    plan = _plan(quality.inactivity_gaps(stored))
    assert _raw_scans(quality.inactivity_gaps(stored)) == 2
    assert plan.index("SortAggregate") < plan.index("Join") and "SortAggregate" not in plan[plan.index("Join"):]


def test_dedup_without_keys_and_times(spark):
    """Rows without an id count as copies of each other; a missing time comes first."""
    df = spark.createDataFrame(
        [(None, 5), (None, 9), ("a", 7), ("a", None), ("b", None), ("c", 1), ("c", 3_600_001), ("c", 3_600_000)],
        "event_id string, timestamp long")
    expected = sorted([(None, 5), ("a", None), ("b", None), ("c", 1), ("c", 3_600_001)], key=repr)
    assert rows(dedup.dedup(df), "event_id", "timestamp") == expected
    assert rows(dedup.first_by_key(df), "event_id", "timestamp") == sorted(
        [(None, 5), ("a", None), ("b", None), ("c", 1)], key=repr)


def test_silence_with_equal_times(spark):
    """Of events at the same time the first in arrival order ends the silence; a missing user is a user of its own."""
    data = [
        {"user_key": "u", "timestamp": 0}, {"user_key": "u", "timestamp": 2_000_000, "seq": 2, "event_id": "late"},
        {"user_key": "u", "timestamp": 2_000_000, "seq": 1, "event_id": "z"}, {"user_key": "u", "timestamp": 2_000_000, "seq": 1, "event_id": "y"},
        {"user_key": None, "timestamp": 10}, {"user_key": None, "timestamp": 5_000_010, "event_id": "n"},
    ]
    got = rows(quality.inactivity_gaps(events(spark, data)), "user_key", "event_id", "gap_ms", "gap_minutes", "event_no")
    assert got == sorted([("u", "y", 2_000_000, 33, 2), (None, "n", 5_000_000, 83, 2)], key=repr)


def test_running_counts_over_several_spans(spark, monkeypatch):
    """Without a key the counts are carried within spans of slices and from span to span."""
    monkeypatch.setattr(ordered, "SPAN", 4)
    rng = random.Random(5)
    times = sorted(rng.randrange(60_000) for _ in range(300))
    df = events(spark, [{"timestamp": x, "event_id": f"e{i:04d}"} for i, x in enumerate(times)], partitions=4)
    got = rows(ordered.with_running_counts(df, [], {"n": F.lit(True)}, slice_ms=1000), "event_id", "n")
    assert got == [(f"e{i:04d}", i + 1) for i in range(300)]


def test_my_rank_of_nobody(spark):
    board = spark.createDataFrame([("x", "u", "time_attack", 60, 5, 1, None, 0, None)], LEADERBOARD_SCHEMA)
    users = spark.createDataFrame([("u", "n")], "user_key string, nickname string")
    best = serving.best_scores(board, users)
    assert rows(serving.my_rank(best, "u"), "rank") == [(1,)]
    assert rows(serving.my_rank(best, "v"), "rank") == []
