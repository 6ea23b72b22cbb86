"""Streams over several micro-batches give what the batch rules give."""

import json

from frames import events, rows
from pyspark.sql import functions as F

from playtide.operators import alerts, dedup, quality, sessions
from playtide.schema import ALERT_FACT_SCHEMA, EVENT_SCHEMA, SESSION_FACT_SCHEMA, names
from playtide.sources import tables
from playtide.streaming import carried, jobs, rules, sources

# Streams drop rows at or before the watermark, which starts at time 0.
START_MS = 1_704_067_200_000

def _files(spark, path, batches):
    """One JSON file per batch, in order."""
    for i, batch in enumerate(batches):
        events(spark, batch).coalesce(1).write.json(f"{path}/b{i:03d}")
    return (
        spark.readStream.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
        .option("pathGlobFilter", "*.json").json(path)
    )


def _carried(stream, rule, path):
    jobs.start_carried(stream, rule, f"{path}/out", f"{path}/work", f"{path}/cp", available_now=True).awaitTermination()
    return stream.sparkSession.read.parquet(f"{path}/out")


def _batches():
    """Six batches of two users, ten minutes each, with bursts of clears."""
    out, number = [], 0
    for batch in range(6):
        part = []
        for i in range(60):
            number += 1
            part.append({
                "event_id": f"e{number:05d}", "user_key": "hot" if i % 3 else "cold",
                "timestamp": START_MS + batch * 600_000 + i * (500 if batch % 2 else 9_000), "seq": number % 4,
                "session_id": f"s{batch // 2}", "mode": ("story", "time_attack")[i % 2], "clear_time_ms": 300 + i * 10,
                "event_type": "stage_clear" if i % 4 else "navigation",
            })
        out.append(part)
    return out


def test_rapid_fire_and_quality_across_batches(spark, tmp_path):
    batches = _batches()
    everything = events(spark, [row for batch in batches for row in batch])
    stream = _files(spark, str(tmp_path / "in"), batches)
    found = _carried(stream, carried.rapid_fire_rule(), str(tmp_path / "rapid"))
    columns = ("event_id", "event_count", "description")
    assert rows(found, *columns) == rows(alerts.rapid_fire(everything), *columns) and found.count() > 0

    seen = _carried(stream, carried.user_quality_rule(), str(tmp_path / "quality"))
    assert rows(seen, "event_id", "event_no") == rows(quality.with_event_no(everything), "event_id", "event_no")
    gaps = rows(quality.seq_gaps(everything), "event_id", "missing")
    assert rows(seen.filter("missing IS NOT NULL"), "event_id", "missing") == gaps and gaps


def test_dedup_ttl_across_batches(spark, tmp_path):
    seconds = [0, 1800, 3600, 5000, 7300]
    batches = [[{"event_id": "x", "timestamp": START_MS + s * 1000}, {"event_id": f"y{s}", "timestamp": START_MS + s * 1000}] for s in seconds]
    stream = _files(spark, str(tmp_path / "in"), batches)
    got = _carried(stream, carried.dedup_rule(EVENT_SCHEMA), str(tmp_path / "run"))
    assert rows(got.filter("event_id = 'x'"), "timestamp") == [(START_MS + s * 1000,) for s in (0, 3600, 7300)]
    assert got.count() == 8


def test_job_restarts_from_its_checkpoint(spark, tmp_path):
    """The second run sees only new files; copies of old events are dropped; sessions come out once closed."""
    batches = _batches()
    first, rest = batches[:3], batches[3:]
    root = str(tmp_path / "job")
    stream = _files(spark, str(tmp_path / "in"), first)
    jobs.run_available(stream, root)
    closing = [{"event_id": "end", "user_key": "z", "timestamp": START_MS + 30 * 3_600_000, "event_type": "heartbeat", "mode": "", "stage_id": ""}]
    for i, batch in enumerate([rest[0] + first[2][:5], rest[1], rest[2], closing], start=3):
        events(spark, batch).coalesce(1).write.json(f"{tmp_path}/in/b{i:03d}")
    paths = jobs.run_available(stream, root)

    everything = events(spark, [row for batch in batches for row in batch])
    clean = tables.read_fact(spark, paths.table("events"), EVENT_SCHEMA)
    assert clean.count() == everything.count() + 1
    columns = [c for c in names(SESSION_FACT_SCHEMA) if c != "created_at"]
    got = tables.read_fact(spark, paths.table("sessions"), SESSION_FACT_SCHEMA)
    assert rows(got, *columns) == rows(sessions.session_summary(everything), *columns)
    columns = [c for c in names(ALERT_FACT_SCHEMA) if c != "created_at"]
    got = tables.read_fact(spark, paths.table("alerts"), ALERT_FACT_SCHEMA)
    assert rows(got, *columns) == rows(alerts.detect_anomalies(everything), *columns)


def test_observed_quality(spark, tmp_path):
    late = [{"timestamp": 100_000, "client_timestamp": 0}, {"timestamp": 1, "client_timestamp": 0}]
    stream = _files(spark, str(tmp_path / "in"), [late])
    query = (
        rules.observe_quality(stream).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    metrics = [p["observedMetrics"]["quality"] for p in query.recentProgress if p["observedMetrics"]]
    assert (metrics[0]["total"], metrics[0]["late"]) == (2, 1)


def test_text_stream_to_routed_tables(spark, tmp_path):
    good = {"event_id": "a", "event_type": "x", "user_key": "u", "schema_version": "2"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.txt").write_text("\n".join([json.dumps(good), "{", json.dumps({"event_id": "b"})]))
    stream = sources.read_text_stream(spark, str(tmp_path / "in"))
    from playtide.operators.ingest import parse_events

    ok, dead = str(tmp_path / "ok"), str(tmp_path / "dead")
    jobs.start_routed_sink(parse_events(stream), ok, dead, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert rows(spark.read.parquet(ok), "event_id") == [("a",)]
    assert rows(spark.read.parquet(dead), "error") == [("field",), ("json",)]


def test_console(spark, tmp_path):
    stream = _files(spark, str(tmp_path / "in"), [[{"timestamp": 1}]])
    query = sources.start_console(stream, str(tmp_path / "cp"), "ALERT")
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


def test_fact_table_layout(spark, tmp_path):
    """A month is split over files, files are sorted, and a month range leaves other months unread."""
    df = events(spark, [{"user_key": f"u{i % 50:02d}", "timestamp": 1_704_067_200_000 + i * 86_400_000} for i in range(60)])
    path = str(tmp_path / "facts")
    tables.write_fact_events(df, path, partitions=6)
    january = list((tmp_path / "facts" / "month=202401").glob("*.parquet"))
    assert len(january) > 1 and {p.name for p in (tmp_path / "facts").glob("month=*")} == {"month=202401", "month=202402"}
    stored = tables.read_fact(spark, path, EVENT_SCHEMA)
    pruned = tables.in_months(stored, "timestamp", 1_706_745_600_000, None)
    assert pruned.count() == 29
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(timestamp)" in plan
    kept = tables.apply_retention(stored, F.timestamp_millis(F.lit(1_706_745_600_000 + 182 * 86_400_000)))
    assert kept.agg(F.min("timestamp")).first()[0] >= 1_706_745_600_000


def test_hot_user_in_shuffled_files_equals_batch(spark, tmp_path):
    """One user owns a third of 50,000 rows; rows are shuffled within each of three micro-batches."""
    import random

    rng, batches = random.Random(4), []
    for part in range(3):
        rows_ = [{
            "event_id": f"e{part}-{i}", "user_key": "hot" if i % 3 == 0 else f"u{rng.randrange(300)}",
            "timestamp": START_MS + part * 40_000_000 + rng.randrange(39_000_000), "seq": rng.randrange(5), "session_id": f"s{rng.randrange(3)}",
            "event_type": "stage_clear" if rng.random() < 0.8 else "navigation",
        } for i in range(16_700)]
        rows_ += [{**r, "timestamp": r["timestamp"] + 1_000} for r in rows_[:300]]
        rng.shuffle(rows_)
        batches.append(rows_)
    everything = events(spark, [r for b in batches for r in b]).cache()
    stream = _files(spark, str(tmp_path / "in"), batches)
    got = _carried(stream, carried.dedup_rule(EVENT_SCHEMA), str(tmp_path / "dedup"))
    assert rows(got, "event_id", "timestamp") == rows(dedup.dedup(everything), "event_id", "timestamp")
    found = _carried(stream, carried.rapid_fire_rule(60_000, 10), str(tmp_path / "rapid"))
    batch = alerts.rapid_fire(everything, 60_000, 10)
    assert rows(found, "event_id", "detected_at", "event_count") == rows(batch, "event_id", "detected_at", "event_count") and batch.count() > 1000
    unique = [[r for r in b if not r["event_id"] in seen and not seen.add(r["event_id"])] for b in batches for seen in [set()]]
    everything = events(spark, [r for b in unique for r in b]).cache()
    stream = _files(spark, str(tmp_path / "unique"), unique)
    seen = _carried(stream, carried.user_quality_rule(), str(tmp_path / "quality"))
    assert rows(seen, "event_id", "event_no") == rows(quality.with_event_no(everything), "event_id", "event_no")
    gaps = rows(quality.seq_gaps(everything), "event_id", "missing")
    assert rows(seen.filter("missing IS NOT NULL"), "event_id", "missing") == gaps and gaps


def test_late_rows_arrive_everywhere(spark, tmp_path):
    """Rows nine hours older than the newest reach events, alerts and sessions; a third mode is the primary one."""
    hour = 3_600_000
    base = {"event_type": "stage_clear", "clear_time_ms": 100, "mode": "puzzle"}
    batches = [
        [{"event_id": f"{b}{i}", "user_key": "u", "timestamp": START_MS + (20 - 9 * b) * hour + i * 1000, **base} for i in range(2)] for b in range(3)]
    batches.append([{"event_id": "end", "user_key": "z", "timestamp": START_MS + 40 * hour, "event_type": "heartbeat"}])
    paths = jobs.run_available(_files(spark, str(tmp_path / "in"), batches), str(tmp_path / "job"))
    assert tables.read_fact(spark, paths.table("events"), EVENT_SCHEMA).count() == 7
    assert tables.read_fact(spark, paths.table("alerts"), ALERT_FACT_SCHEMA).count() == 6
    stored = tables.read_fact(spark, paths.table("sessions"), SESSION_FACT_SCHEMA)
    assert sorted((r.session_start, r.total_events, r.primary_mode) for r in stored.collect()) == sorted(
        (START_MS + (20 - 9 * b) * hour, 2, "puzzle") for b in range(3))
