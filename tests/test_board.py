"""The kept-up leaderboard against a plain sort, after each micro-batch and across merges."""

import random
import re

import pytest

from playtide.plans import board as boards
from playtide.plans import serving
from playtide.schema import LEADERBOARD_SCHEMA

NO_TIME = 1 << 40


def result(e):
    return -e[4], -e[5], NO_TIME if e[6] is None else e[6]


def plain(entries):
    """(user, entry, rank) of the whole board in order."""
    best = {}
    for e in sorted(entries, key=lambda e: (result(e), e[0])):
        best.setdefault(e[1], e)
    ranks = {r: i for i, r in enumerate(sorted({result(e) for e in best.values()}), 1)}
    return sorted(((e[1], e[0], ranks[result(e)]) for e in best.values()), key=lambda x: (x[2], x[0].encode()))


def page(board, limit, offset):
    return [(r.user_key, r.entry_id, r.rank) for r in board.page(limit, offset).collect()]


def best_of(spark, entries):
    return serving.best_rows(spark.createDataFrame(entries, LEADERBOARD_SCHEMA))


def some(rng, start, n, users):
    """A third of the entries share one result, others are near it or far."""
    return [
        (f"x{start + i:05d}", rng.choice(["", "é", "日本"]) + f"u{rng.randrange(users)}", "time_attack", 60,
         100_000 if rng.random() < 0.33 else rng.choice([0, 100_001, rng.randrange(-5, 300_000)]), rng.randrange(2), rng.choice([None, 7, 70_000]), 0, None)
        for i in range(n)]


@pytest.mark.parametrize("most_passed", [4096, 3])
def test_pages_and_ranks_after_each_delta(spark, tmp_path, monkeypatch, most_passed):
    monkeypatch.setattr(boards, "MOST_PASSED", most_passed)
    rng, entries = random.Random(most_passed), []
    board = boards.RankedBoard(spark, str(tmp_path / "board"), LEADERBOARD_SCHEMA, buckets=4, fanout=2)
    for number in range(3):
        new = some(rng, len(entries), 120, 90)
        entries += new
        board.commit(best_of(spark, new), number)
        if number == 1:
            board.commit(best_of(spark, new), number)
        expected = plain(entries)
        for offset in (len(expected) // 3, len(expected) - 4):
            assert page(board, 20, offset) == expected[offset:offset + 20]
    assert page(board, 20, len(expected)) == []
    for user, entry, rank in expected[::40]:
        assert [(r.entry_id, r.rank) for r in board.rank_of(user).collect()] == [(entry, rank)]
    assert board.rank_of("nobody").count() == 0


def test_worse_scores_move_nobody_and_counts_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(1)
    first, second = some(rng, 0, 200, 60), some(rng, 200, 200, 60)
    worse = [(f"y{e[0]}", e[1], *e[2:4], -9, 0, None, 0, None) for e in first]
    kept = boards.RankedBoard(spark, str(tmp_path / "kept"), LEADERBOARD_SCHEMA, fanout=2)
    for number, entries in enumerate((first, worse, second)):
        kept.commit(best_of(spark, entries), number)
        if number == 1:
            assert kept.rows.parts()[-1].files == [] and kept.counts.parts()[-1].files == []
    built = boards.RankedBoard(spark, str(tmp_path / "built"), LEADERBOARD_SCHEMA)
    built.commit(best_of(spark, [*first, *worse, *second]), 0)
    counts = lambda b: sorted(map(repr, boards._live(["rows", "results"])(b.counts.read()).collect()))
    assert counts(kept) == counts(built)


def test_deep_page_takes_few_rows(spark, tmp_path, monkeypatch):
    """20,000 users, half of them in one tie: a page in the middle takes no more than it passes over and shows."""
    monkeypatch.setattr(boards, "MOST_PASSED", 100)
    rows = spark.createDataFrame(
        [(f"x{i}", f"u{i:06d}", "time_attack", 60, i if i % 2 else 50_000, 1, None, 0, None) for i in range(20_000)], LEADERBOARD_SCHEMA)
    board = boards.RankedBoard(spark, str(tmp_path / "board"), LEADERBOARD_SCHEMA)
    board.commit(rows, 0)
    shown = board.page(20, 7_000)
    assert [r.user_key for r in shown.collect()] == [f"u{2 * i:06d}" for i in range(7_000, 7_020)]
    plan = shown._jdf.queryExecution().executedPlan().toString()
    limits = [int(x) for x in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", plan)]
    assert limits and max(limits) <= 100 + 20
    assert [(r.user_key, r.rank) for r in board.page(1, 15_000).collect()] == [(f"u{19_999 - 2 * 5_000:06d}", 5_002)]
