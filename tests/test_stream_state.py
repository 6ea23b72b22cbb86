"""What streams carry: bounded by what is open or touched, right across late rows, restarts and silence."""

import glob

from frames import events, rows
from pyspark.sql import functions as F

from playtide.operators import alerts, dedup, quality, rollups, sessions
from playtide.schema import EVENT_SCHEMA, SESSION_SCHEMA, names
from playtide.session import shared_dir
from playtide.sources import tables
from playtide.sources.tiered import TieredTable
from playtide.streaming import carried, jobs, metrics, rules

START_MS = 1_704_067_200_000
HOUR = 3_600_000
COLUMNS = names(SESSION_SCHEMA)


def steps(spark, rule, batches):
    """Outputs of a rule without keys over some micro-batches, and the state after each."""
    state, outs, states = spark.createDataFrame([], rule.state), [], []
    for batch in batches:
        out, state = rule.step(state, events(spark, batch), lambda df, name: df.cache())
        state = spark.createDataFrame(state.select(*rule.state.names).collect(), rule.state)
        outs.append(out.collect())
        states.append(state)
    return outs, states


def event(number, user, minute, **more):
    return {"event_id": f"e{number}", "user_key": user, "timestamp": START_MS + int(minute * 60_000), **more}


def test_session_state_does_not_grow_with_events(spark):
    batches = [[event(b * 1000 + i, f"u{i % 2}", b * 3 + i / 500, mode=("story", "puzzle")[i % 3 == 0], stage_id="1-1", session_id="s") for i in range(900)] for b in range(4)]
    outs, states = steps(spark, carried.sessions_rule(), batches)
    assert not any(outs) and all(s.count() == 4 for s in states)
    assert states[-1].agg(F.sum("total_events")).first()[0] == 3600


def test_late_event_joins_two_open_sessions(spark):
    first = [event(i, "u", m, session_id=f"s{int(m)}", stage_id=f"1-{i}") for i, m in enumerate([0, 1, 9, 10, 30])]
    late = [event(10, "u", 5.5, mode="time_attack"), event(11, "v", 20)]
    end = [event(20, "z", 1000, event_type="heartbeat")]
    outs, states = steps(spark, carried.sessions_rule(), [first, late, end])
    assert sorted({(r.run_first - START_MS) // 60_000 for r in states[0].collect()}) == [0, 9, 30]
    assert sorted({(r.run_first - START_MS) // 60_000 for r in states[1].filter("user_key = 'u'").collect()}) == [0, 30]
    expected = sessions.session_summary(events(spark, first + late))
    assert sorted(tuple(r) for r in outs[2]) == rows(expected, *COLUMNS)


def test_sessions_in_any_order_of_arrival(spark):
    """Whatever the micro-batches, the sessions are those of the batch rule."""
    import random

    rng = random.Random(8)
    everything = [event(i, f"u{rng.randrange(6)}", rng.randrange(600), mode=rng.choice(["story", "puzzle", ""]), stage_id=rng.choice(["1-1", "1-2", ""]),
                        session_id=rng.choice([None, "a", "b"]), clear_time_ms=rng.randrange(3) * 700) for i in range(500)]
    batches = [everything[i::7] for i in range(7)] + [[event(999, "z", 100_000, event_type="heartbeat")]]
    outs, _ = steps(spark, carried.sessions_rule(delay_ms=30_000 * 60_000), batches)
    assert sorted(tuple(r) for r in outs[-1]) == rows(sessions.session_summary(events(spark, everything)), *COLUMNS)


def test_silent_users_are_forgotten(spark):
    batches = [[event(i, f"u{i % 50}", i / 100) for i in range(250)], [event(900 + i, "other", 60 * 24 * (1 + i)) for i in range(2)]]
    _, states = steps(spark, carried.rapid_fire_rule(), batches)
    assert states[0].count() > 100 and {r.user_key for r in states[1].collect()} == {"other"}
    quiet = [[event(i, "u", 0) for i in range(5)], [event(99, "w", 500, event_type="heartbeat")]]
    _, states = steps(spark, carried.rapid_fire_rule(), quiet)
    assert states[0].count() == 5 and states[1].count() == 0


def stream_of(spark, path, batches):
    for i, batch in enumerate(batches):
        events(spark, batch).coalesce(1).write.json(f"{path}/b{i:03d}")
    return (
        spark.readStream.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
        .option("pathGlobFilter", "*.json").json(path))


def test_user_state_follows_the_micro_batch(spark, tmp_path):
    """The first micro-batch has a thousand users, the others three each: they write three rows each, and no table stays behind."""
    batches = [[event(i, f"u{i:04d}", 0) for i in range(1000)]] + [
        [event(5000 + 10 * b + i, f"u{(b * 3 + i):04d}", b) for i in range(3)] for b in range(1, 4)]
    before = set(glob.glob(f"{shared_dir(spark)}/*"))
    root = str(tmp_path / "run")
    jobs.start_carried(stream_of(spark, str(tmp_path / "in"), batches), carried.user_quality_rule(), f"{root}/out", f"{root}/work", f"{root}/cp",
                       available_now=True).awaitTermination()
    seen = spark.read.parquet(f"{root}/out")
    everything = events(spark, [r for b in batches for r in b])
    assert rows(seen, "event_id", "event_no") == rows(quality.with_event_no(everything), "event_id", "event_no")
    written = [spark.read.parquet(p).count() for p in sorted(glob.glob(f"{root}/work/state/part=*"))]
    assert written == [1000, 3, 3, 3]
    assert set(glob.glob(f"{shared_dir(spark)}/*")) == before and glob.glob(f"{root}/work/rows/*") == []


def test_dedup_state_expires_and_leaves_nothing_behind(spark, tmp_path):
    """Ids of five hours, an hour a micro-batch; each sent again in the next one, and once more two hours later."""
    ids = lambda b: [event(f"{b}-{i}", "u", 60 * b + i) for i in range(30)]
    batches = [ids(b) + [{**r, "timestamp": r["timestamp"] + HOUR // 2} for r in ids(b - 1)] + [
        {**r, "timestamp": r["timestamp"] + 2 * HOUR} for r in ids(b - 2)] for b in range(10)]
    before = set(glob.glob(f"{shared_dir(spark)}/*"))
    root = str(tmp_path / "run")
    stream = stream_of(spark, str(tmp_path / "in"), batches)
    jobs.start_carried(stream, carried.dedup_rule(EVENT_SCHEMA), f"{root}/out", f"{root}/work", f"{root}/cp", available_now=True).awaitTermination()
    assert set(glob.glob(f"{shared_dir(spark)}/*")) == before
    got = spark.read.parquet(f"{root}/out")
    everything = events(spark, [r for b in batches for r in b])
    assert rows(got, "event_id", "timestamp") == rows(dedup.dedup(everything), "event_id", "timestamp")
    merged = glob.glob(f"{root}/work/state/part=*-1")
    # Eight micro-batches' passes were merged; those of the earlier hours are gone.
    assert merged and spark.read.schema("last_pass long").parquet(*merged).filter(F.col("last_pass") < START_MS + 7 * HOUR).count() == 0


def test_alert_numbers_go_on_after_a_restart(spark, tmp_path):
    batches = [[event(100 * b + i, f"u{i % 3}", 60 * b + i / 10, clear_time_ms=100) for i in range(40)] for b in range(4)]
    root, source = str(tmp_path / "job"), str(tmp_path / "in")
    stream = stream_of(spark, source, batches[:2])
    for restarted in (False, True):
        if restarted:
            for i, batch in enumerate(batches[2:], start=2):
                events(spark, batch).coalesce(1).write.json(f"{source}/b{i:03d}")
        paths = jobs.run_available(stream, root)
        jobs.start_alert_numbers(spark, paths, available_now=True).awaitTermination()
    everything = events(spark, [r for b in batches for r in b])
    expected = alerts.with_alert_no(alerts.detect_anomalies(everything))
    got = spark.read.parquet(paths.table("alert_numbers"))
    assert rows(got, "event_id", "alert_type", "alert_no") == rows(expected, "event_id", "alert_type", "alert_no") and got.count() >= 160
    # The same job clusters its events.
    jobs.start_event_clustering(spark, paths, available_now=True).awaitTermination()
    clustered = tables.clustered_events(spark, paths.table("clustered_events"))
    assert rows(clustered.read("stage_clear"), "event_id") == rows(everything.filter("event_type = 'stage_clear'"), "event_id")


def test_counters_survive_a_restart(spark, tmp_path):
    batches = [[event(i % 7, "u", b, client_timestamp=START_MS - i * 1000) for i in range(10)] for b in range(4)]
    source, root = str(tmp_path / "in"), str(tmp_path / "metrics")
    listener = metrics.StoredMetrics(spark, root)
    spark.streams.addListener(listener)
    try:
        for part in (range(2), range(2, 4)):
            for b in part:
                events(spark, batches[b]).coalesce(1).write.json(f"{source}/b{b:03d}")
            stream = (
                spark.readStream.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
                .option("pathGlobFilter", "*.json").json(source))
            seen = metrics.observe_lateness(metrics.observe_dedup(stream, "seen"), "quality")
            kept = metrics.observe_dedup(rules.dedup_stream(seen), "kept")
            kept.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    everything = events(spark, [r for b in batches for r in b])
    assert rows(metrics.dedup_totals(spark, root, "seen", "kept"), "total", "duplicates", "duplicate_pct") == rows(
        dedup.dedup_stats(everything, dedup.first_by_key(everything)), "total", "duplicates", "duplicate_pct")
    assert rows(metrics.quality_totals(spark, root, "quality"), "total", "normal", "late", "late_rate") == rows(
        quality.quality_stats(everything), "total", "normal", "late", "late_rate")


def test_rows_are_taken_back_from_a_rollup(spark, tmp_path):
    keys = ["day", "user_key", "mode"]
    base = events(spark, [event(i, f"u{i % 4}", i, mode="story") for i in range(40)])
    summarise = lambda rows_: rollups.daily_user_summary(rows_, F.col("sign"))
    schema = summarise(base.withColumn("sign", F.lit(1))).schema
    table = TieredTable(spark, str(tmp_path / "t"), schema, rollups.added_up(keys), fanout=3)
    for number in range(10):
        table.commit(summarise(base.filter(F.col("event_id").substr(2, 9).cast("int") % 10 == number).withColumn("sign", F.lit(1))), number)
    gone = base.filter("user_key = 'u1' OR event_id IN ('e2', 'e4')")
    for number in range(10, 14):
        part = gone if number == 10 else gone.limit(0)
        table.commit(summarise(part.withColumn("sign", F.lit(-1))), number)
    left = base.join(gone.select("event_id"), "event_id", "left_anti")
    assert rows(rollups.settled(table.read(), keys), *keys, "clears", "fails") == rows(rollups.daily_user_summary(left), *keys, "clears", "fails")
    assert len(table.parts()) <= 6


def test_deletes_and_old_versions_across_merges(spark, tmp_path):
    keys, version = ["k"], ["at"]
    schema = "k string, at long, v string, op string"
    changes = [
        [("a", 1, "a1", None), ("b", 1, "b1", None)], [("a", 5, None, "d"), ("c", 2, "c2", None)], [("a", 3, "old", None)], [("b", 9, "b9", None)],
        [("c", 1, "older", None)], [("d", 500, "d", None)], [("e", 600, "e", None)], [("f", 900, None, "d")], [("f", 800, "old", None)], [("g", 901, "g", None)]]
    table = TieredTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, rollups.latest_of(keys, version, 100), fanout=2)
    for number, batch in enumerate(changes):
        table.commit(spark.createDataFrame(batch, schema), number)
        everything = spark.createDataFrame([r for b in changes[:number + 1] for r in b], schema)
        assert rows(rollups.latest_by_key(table.read(), keys, version), "k", "v") == rows(rollups.latest_by_key(everything, keys, version), "k", "v")
    assert table.read().filter("k = 'a'").count() == 0 and table.read().filter("k = 'f'").count() > 0 and len(table.parts()) <= 4
