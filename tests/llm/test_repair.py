"""Conversation repair against a plain search over edits, and the contract's damage against plain Python."""

import random
import re
import sys
import zlib
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from playtide.llm import repair

FOLDER = "/root/testdata/sf0.001"
SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), *(T.StructField(c, T.StringType()) for c in ("tree", "chunk", "pos", "n", "fault", "edits"))])
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
sys.setrecursionlimit(20_000)  # the plain search recurses turn by turn
GRAMMAR = re.compile(r"(s?(ua)+)?")


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], SCHEMA).repartition(partitions)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """rows of one conversation; the cheapest edits by a search over (turn, what the grammar wants next)."""
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))

    @lru_cache(None)
    def best(i, state, inserted):
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            cost, audit, turns = best(i + 1, state, 0)
            found.append((3 + cost, "D" + audit, turns))
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                wanted = "a" if state == "u" else "u"
                for role, new in ((rows[i][2], rows[i][2][:1]), ("user", "u"), ("assistant", "a")):
                    kept = role == rows[i][2]
                    if new == wanted or kept and new == "s" and state == "":
                        cost, audit, turns = best(i + 1, new, 0)
                        found.append(((0 if kept else 2) + extra + cost, ("K" if kept else "R") + audit, ((role, rows[i][3]), *turns)))
        if inserted < 4:
            wanted = "a" if state == "u" else "u"
            cost, audit, turns = best(i, wanted, inserted + 1)
            found.append((2 + cost, "I" + audit, (({"u": "user", "a": "assistant"}[wanted], ""), *turns)))
        return min(found, default=(10**9, "", ()))

    cost, audit, turns = best(0, "", 0)
    assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in turns))
    numbers = {r[1] for r in rows} - {None}
    roles = [r[2][:1] for r in rows]
    return (
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit, sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())


def plain(rows):
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append(r)
    return {conv: plain_repair(own) for conv, own in by_conv.items()}


def check(df, rows):
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(df).collect()}
    assert got == plain(rows)


def test_sample_equals_plain_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = repair.op12_conversation_repair(spark, FOLDER)
    nothing = (0, 0, 0, 0, 0, 0, "", sha256().hexdigest())
    expected = {c: nothing for c, *_ in rows} | plain(plain_damage(rows))
    assert {r.conv_id: tuple(r)[1:] for r in got.collect()} == expected
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_random_conversations(spark):
    rng, rows = random.Random(7), []
    for conv in range(150):
        for _ in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 7]), rng.choice(["system", "user", "user", "assistant", "tool", "", "assistant"]),
                         rng.choice(["a.", "b!", "c", " \t", "", "d?", "e.\n", "é"])))
    check(frame(spark, rows), rows)


@pytest.mark.parametrize("chunk", [1, 2, 5])
def test_conversations_of_many_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rng, rows = random.Random(chunk), []
    for conv in range(25):
        for turn in range(rng.randint(1, 30)):
            rows.append((conv, turn + rng.randint(0, 1), rng.choice(["system", "user", "assistant", "x"]), rng.choice(["a.", "b!", "c", "", f"{turn}."])))
    check(frame(spark, rows), rows)


def test_hot_conversation_and_edges(spark):
    rng = random.Random(2)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), f"t{i}" + rng.choice([".", ""])) for i in range(900)]
    rows += [(None, 0, "user", "hi."), (None, None, None, None), (2, 0, "system", "s."), (3, 0, "user", "long " * 50_000 + "."), (4, 5, "user", "x."), (4, 5, "user", "x.")]
    check(frame(spark, rows, 8), rows)
    got = repair.repaired_turns(frame(spark, rows)).filter("conv_id = 4").orderBy("chunk", "place").collect()
    assert [(r.role, r.text) for r in got] == [("user", "x."), ("assistant", "")]
    assert repair.repair(frame(spark, rows).filter("false")).count() == 0


def test_dropped_and_null_rows(spark, tmp_path):
    rows = [(c, t, r, x) for c in range(300) for t, r, x in ((0, "user", "q?"), (1, "assistant", "a.")) if c % 2 or t == 0] + [(None, None, None, None)]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in repair.op12_conversation_repair(spark, str(tmp_path)).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", sha256().hexdigest())
    assert got == {c: nothing for c, *_ in rows} | plain(plain_damage(rows)) and nothing in got.values()


def test_equal_endings_are_one_node(monkeypatch):
    """Each distinct ending is worked out once, however many signatures have it."""
    calls = []
    original = repair.before
    monkeypatch.setattr(repair, "before", lambda symbol, node: calls.append(symbol) or original(symbol, node))
    rng = random.Random(5)
    signatures = {"".join(rng.choice("suaUAx") for _ in range(rng.randint(0, 7))) for _ in range(500)}
    ordered = sorted(signatures, key=lambda x: x[::-1])
    batch = pa.record_batch([pa.array([repair.END] * len(ordered)), pa.array(ordered)], ["end", "signature"])
    list(repair._automaton([batch.slice(0, 100), batch.slice(100)]))
    assert len(calls) == len({s[i:] for s in signatures for i in range(len(s))})
