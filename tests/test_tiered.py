"""Parts that are merged in tiers: bounded in number, read once each, pruned by key."""

import glob

from frames import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.sources.tiered import File, KeyedState, Part, TieredTable, due, may_hold

SCHEMA = T.StructType().add("kind", "string").add("user", "string").add("n", "long").add("month", "string")


def frame(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def test_a_thousand_micro_batches_leave_few_parts():
    live, written, most = [], 0, 0
    for number in range(1000):
        while (group := due(live, 8)) is not None:
            merged = Part(group[0].first, group[-1].last, group[0].tier + 1)
            written += merged.last - merged.first + 1
            live = sorted([p for p in live if p not in group] + [merged], key=lambda p: p.first)
        live.append(Part(number, number, 0))
        most = max(most, len(live))
        assert [p.first for p in live[1:]] == [p.last + 1 for p in live[:-1]] and live[-1].last == number
    assert most <= 8 * 4 and written <= 4 * 1000


def test_rows_once_through_every_swap(spark, tmp_path):
    """Each manifest shows each row once, also to a reader that began before the last swap, and few files are left."""
    table = TieredTable(spark, str(tmp_path / "t"), SCHEMA, sort=["kind", "user"], partition=["month"], fanout=3)
    everything = []
    for number in range(12):
        items = [(f"k{i % 2}", f"u{(7 * i + number) % 20:02d}", number * 100 + i, f"20240{1 + i % 2}") for i in range(10)]
        begun = table.read() if number else None
        expected = sorted(everything, key=repr)
        table.commit(frame(spark, items), number)
        if begun is not None:
            assert rows(begun, *SCHEMA.names) == expected
        everything += items
        assert rows(table.read(), *SCHEMA.names) == sorted(everything, key=repr)
    live = {f.path for p in table.parts() for f in p.files}
    assert sum(len(p.files) for p in table.parts()) <= 20 and sum(f.rows for p in table.parts() for f in p.files) == 120
    assert len(glob.glob(f"{tmp_path}/t/manifests/*.json")) == 2
    assert len(glob.glob(f"{tmp_path}/t/part=*")) <= 2 * len(table.parts()) and len(live) <= len(glob.glob(f"{tmp_path}/t/part=*/*/*.parquet"))


def test_repeated_micro_batches_change_nothing(spark, tmp_path):
    table = TieredTable(spark, str(tmp_path / "t"), SCHEMA, sort=["kind"], fanout=2)
    for number in (0, 1, 2, 2, 3, 4, 4, 5):
        table.commit(frame(spark, [("k", "u", number, "202401")]), number)
        assert rows(table.read(), "n") == [(i,) for i in range(number + 1)]


def test_only_files_in_range_are_opened(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = TieredTable(spark, str(tmp_path / "t"), SCHEMA, sort=["kind", "user"], partition=["month"], fanout=2)
        for number in range(3):
            table.commit(frame(spark, [(f"k{i % 4}", f"u{i:03d}" if i else None, i, "202401") for i in range(400)]), number)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    whole = table.read().inputFiles()
    some = table.read("k1", "u201")
    assert rows(some, "kind", "user", "n") == [("k1", "u201", 201)] * 3
    assert 0 < len(some.inputFiles()) < len(whole) / 2
    assert table.read("k9").count() == 0 and table.read("k9").inputFiles() == []
    assert table.read("k0", None).count() == 3 and table.read("k1").count() == 300


def test_ranges_with_nulls():
    file = File("f", 1, [None, "b"], ["k", "d"])
    assert may_hold(file, [None]) and may_hold(file, ["a", "z"]) and may_hold(file, ["k", "c"]) and not may_hold(file, ["k", "e"])
    assert not may_hold(file, ["l"]) and not may_hold(file, [None, "a"]) and may_hold(file, [])


def test_keyed_state_writes_touched_keys_only(spark, tmp_path):
    schema = T.StructType().add("user", "string").add("n", "long")
    state = KeyedState(spark, str(tmp_path / "s"), schema, ["user"], buckets=4, fanout=3)
    expected = {}
    for number in range(8):
        touched = {f"u{i}": number for i in range(1000 if number == 0 else 3 + number)} | {None: number}
        rows_ = spark.createDataFrame(list(touched.items()), schema)
        before = {r.user: r.n for r in state.of(rows_, number).collect()}
        assert before == {k: expected[k] for k in touched if k in expected}
        state.commit(rows_, number)
        expected |= touched
        stored = spark.read.parquet(f"{tmp_path}/s/part={number:09d}-{number:09d}-0").count()
        assert stored == len(touched)
    assert {r.user: r.n for r in state.all().collect()} == expected
    assert state.of(spark.createDataFrame([("nobody",)], "user string"), 99).count() == 0
    assert state.table.read().agg(F.count("*")).first()[0] < 1000 + 60
