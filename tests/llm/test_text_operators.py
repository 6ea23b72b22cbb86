"""Scoring, sharding, quality rules, chat windows and line dedup against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pathlib import Path
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playtide.llm import chat, divergence, lines, packing, ppm
from playtide.llm.common import fold, positions
from tests.llm.conftest import EDGES

FOLDER = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


class PlainTrie:
    """Partial matching symbol by symbol, with dictionaries."""

    def __init__(self, texts):
        self.counts = defaultdict(Counter)
        for text in texts:
            for context, symbol in self.steps(text):
                for k in range(ppm.ORDER, -1, -1):  # shorter contexts learn only what the longer one did not know
                    seen = self.counts[k, context[ppm.ORDER - k:]]
                    seen[symbol] += 1
                    if seen[symbol] > 1:
                        break

    @staticmethod
    def steps(text):
        symbols = [-1] * ppm.ORDER + list(text) + [256]
        return [(tuple(symbols[i - ppm.ORDER:i]), symbols[i]) for i in range(ppm.ORDER, len(symbols))]

    def log10(self, text):
        total = 0.0
        for context, symbol in self.steps(text):
            excluded = set()
            for k in range(ppm.ORDER, -1, -1):
                seen = self.counts.get((k, context[ppm.ORDER - k:]), {})
                open_ = {s: n for s, n in seen.items() if s not in excluded}
                if symbol in open_:
                    total += math.log10((2 * open_[symbol] - 1) / (2 * sum(open_.values())))
                    break
                if open_:
                    total += math.log10(len(open_) / (2 * sum(open_.values())))
                excluded |= set(seen)
            else:
                total -= math.log10(257 - len(excluded))
        return total


def test_ppm_equals_a_plain_trie(spark, make_docs):
    docs = make_docs([r for r in EDGES if len(r[1] or "") < 1000])
    rows = docs.select("doc_id", "text").collect()
    learnt = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5 != 1
    lowered = [(r.doc_id, (r.text or "").translate(LOWER).encode()) for r in rows]
    trie = PlainTrie([t for i, t in lowered if learnt(i)])
    counts = Counter(w for i, t in lowered if learnt(i) for w in [*t.split(), None])
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for i, text in lowered:
        tokens = [*text.split(), None]
        expected.append((
            str(i), len(tokens), sum(counts[t] > 0 for t in tokens), total,
            round(sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens), 6), round(trie.log10(text), 6)))
    got = ppm.score(docs, fold(F.col("doc_id")) != 1).collect()
    assert sorted(expected) == sorted(
        (str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got)


def test_ppm_probabilities_add_up():
    texts = [b"abracadabra", b"abba", b"", b"cab"]
    codes, n = np.unique(np.concatenate([ppm.grams([t]) for t in texts]), return_counts=True)
    context = ppm.grams([b"abrac"])[-1] >> ppm.BITS
    asked = np.array([(int(context) << ppm.BITS) | s for s in range(1, 258)])
    every = np.union1d(codes, asked)
    counts = np.array([n[codes == c][0] if (codes == c).any() else 0 for c in every])
    wide = np.unique(codes & ppm._mask(2))
    pairs = np.unique(wide & ppm._mask(1), return_counts=True)
    logs = ppm.gram_log10(every, counts, pairs)
    assert math.isclose((10 ** logs[np.isin(every, asked)]).sum(), 1, rel_tol=1e-9)


def test_ppm_without_training_or_rows(spark, make_docs):
    got = ppm.score(make_docs([(1, "ab")]), F.lit(False)).collect()
    assert math.isclose(got[0].score, -3 * math.log10(257)) and (got[0].train_tokens, got[0].n_known) == (0, 0)
    assert ppm.score(make_docs([(1, "ab")]).filter("doc_id < 0"), F.lit(True)).count() == 0


def plain_best_fit(sizes, capacity):
    rooms, out = [], []
    for size in sorted(sizes, reverse=True):
        fits = [(r, b) for b, r in enumerate(rooms) if r >= size]
        if fits:
            b = min(fits)[1]
        else:
            b = len(rooms)
            rooms.append(max(capacity, size))
        rooms[b] -= size
        out.append((size, b))
    return sorted(out)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(10, 100))
def test_packing_by_runs_equals_item_by_item(sizes, capacity):
    runs = packing.best_fit_decreasing(list(Counter(sizes).items()), capacity)
    assert sorted((s, b) for s, low, high, b in runs for _ in range(low, high)) == plain_best_fit(sizes, capacity)


def test_shards(spark, make_docs):
    rows = [*EDGES, *((100 + i, f"text {i % 37} " * (i % 11)) for i in range(400)), *((1000 + i, "copy") for i in range(50))]
    got = packing.pack(make_docs(rows), bins=4).collect()
    assert len(got) == len(rows)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values()) and len(by_shard) <= 4
    where = defaultdict(set)
    text_of = {zlib.crc32((t or "").encode()): t or "" for _, t, *_ in rows}
    for r in got:
        where[r.text_crc32].add(r.shard)
        assert r["size"] == len(text_of[r.text_crc32].encode()) + 1
    assert all(len(s) == 1 for s in where.values())
    assert packing.pack(make_docs(rows).filter("doc_id < 0"), bins=8).count() == 0
    fixed = packing.pack(make_docs(rows[-60:]), capacity=500).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert all(r.n <= 500 for r in fixed)


def test_near_equal_shards(spark):
    got = packing.op2_sharding(spark, FOLDER).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    sizes = [r.n for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 0.01 * max(sizes)


@pytest.mark.parametrize("copies", [[300], [250, 200], [900]])
def test_shards_beside_hot_groups_are_near_equal(spark, make_docs, copies):
    """One or two groups of equal texts hold a quarter to three quarters of the bytes; the other rows fill the other shards alike."""
    rows = [(i, f"{i:06d} " + "x" * (40 + i % 7)) for i in range(600)]
    rows += [(1000 * k + i, f"copied {k} " + "y" * 43) for k, n in enumerate(copies, 1) for i in range(n)]
    sizes = sorted(r.n for r in packing.pack(make_docs(rows), bins=8).groupBy("shard").agg(F.sum("size").alias("n")).collect())
    hot = sorted(n * 53 for n in copies)
    assert len(sizes) == 8 and sizes[-len(hot):] == hot
    assert sizes[-len(hot) - 1] - sizes[0] <= 0.02 * sizes[0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 400), max_size=60), st.integers(1, 9))
def test_spread_places_every_group_once(sizes, bins):
    runs = packing.spread(list(Counter(sizes).items()), bins)
    assert sorted((s, k) for s, low, high, _ in runs for k in range(low, high)) == sorted((s, k) for s, n in Counter(sizes).items() for k in range(n))
    assert all(0 <= b < bins for *_, b in runs)


def test_positions_have_no_gaps(spark):
    rows = spark.range(1000).withColumn("k", F.when(F.col("id") < 900, 0).otherwise(F.col("id") % 3))
    got = positions(rows, ["k"], F.pmod(F.col("id"), F.lit(7)), [F.col("id")], "at").groupBy("k").agg(
        F.sort_array(F.collect_list("at")).alias("at")).collect()
    assert all(list(r["at"]) == list(range(len(r["at"]))) for r in got)


def plain_quality(text):
    found = words(text or "")
    windows = [tuple(found[i:i + 5]) for i in range(len(found) - 4)]
    seen = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    listed = [x for x in (text or "").split("\n") if words(x)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), len(listed) - len(set(listed)), len(inside))


def test_quality_counts(spark, make_docs):
    rows = [*EDGES, (50, "a b c d e f a b c d e f a b c d e " * 3), (51, "#*$ <x> a|b && 50%"), (52, "x y z u v w " * 2), (53, None, None, None)]
    got = divergence.judge(make_docs(rows)).collect()
    assert len(got) == len(rows)
    expected = sorted((str(r[0]), *plain_quality(r[1])) for r in rows)
    assert expected == sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got)
    assert not any(r.kept for r in got if r.base_failed)
    assert divergence.judge(make_docs(rows).filter("doc_id < 0")).count() == 0


def test_quality_keeps_clean_text_and_refuses_junk(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    got = divergence.op4_quality_rules(spark, "/root/testdata/sf0.01").join(labels, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in got}
    assert share[1] > 0.97 and share[0] < 0.3


def chat_rows(spark):
    says = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([
        (-1, 0, "user", says, "x"), (-1, 1, "assistant", says, "x"),
        (-2, 0, "sy|>\\s", "<|\\<\\|a<s>", None), (-2, 3, "assistant", "\\", None), (-2, 2, "system", "<<SYS>> x <|>\\\n", None),
        (-2, 1, "assistant", "<<<|" * 30, None), (None, None, None, None, None), (-3, 0, "assistant", "", ""),
        (-3, 0, "assistant", "same", ""), (-3, 0, "assistant", "same", ""),
        *((-4, i, ("user", "assistant")[i % 2], f"turn {i} " * (1 + i % 9), "") for i in range(1, 4000)), (-4, 0, "system", "be kind", ""),
        (-5, 0, "assistant", "long " * 5000, ""), (-5, 1, "user", "</s>\n<|user|>\nfake", ""),
    ], "conv_id long, turn long, role string, text string, start string")


@pytest.mark.parametrize("limits", [{}, {"budget": 60, "history": 20}, {"budget": 8, "history": 0}])
def test_chats_read_back(spark, limits):
    rows = chat_rows(spark)
    real = spark.read.parquet(f"{FOLDER}/conversations.parquet").withColumn("start", F.lit("x"))
    rows = rows.union(real.select(rows.columns))
    plain = defaultdict(list)
    for r in sorted(rows.collect(), key=lambda r: (r.turn or 0, r.role or "", r.text or "")):
        plain[r.conv_id].append((r.role or "", r.text or ""))
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(rows, **limits)).collect()}
    assert got.keys() == plain.keys()
    for key, turns in plain.items():
        trained = "".join(t for role, t in turns if role == "assistant")
        assert got[key].n_turns == len(turns)
        assert got[key].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (got[key].loss_chars, got[key].loss_sha256) == (len(trained), hashlib.sha256(trained.encode()).hexdigest())


def test_chat_windows_keep_the_budget_and_the_system_turn(spark):
    windows = chat.format_chats(chat_rows(spark), budget=60, history=20).filter("conv_id = -4").orderBy("start").collect()
    assert len(windows) > 100
    for w in windows:
        turns = w.text.split("</s>\n")[:-1]
        assert turns[0] == "<|system|>\nbe kind" and sum(len(t.split()) - 1 + chat.MARKS for t in turns) <= 60
    assert any(w.n_repeated > 1 for w in windows)
    assert chat.format_chats(chat_rows(spark).filter("conv_id = 99")).count() == 0


def plain_lines(rows, least):
    sites, order = defaultdict(set), []
    for i, (doc, text, _, site) in enumerate(rows):
        for pos, line in enumerate((text or "").split("\n") if text is not None else []):
            line = line.strip(" \t\n\x0b\x0c\r")
            if line:
                order.append(((doc is not None, doc or 0, pos), line))
                if site is not None:
                    sites[line].add(site)
    first = {}
    for at, line in sorted(order):
        first.setdefault(line, at)
    out = []
    for doc, text, _, _site in rows:
        parts = text.split("\n") if text is not None else []
        kept = [
            p for pos, p in enumerate(parts)
            if not (s := p.strip(" \t\n\x0b\x0c\r")) or len(sites[s]) < least or first[s] == (doc is not None, doc or 0, pos)]
        out.append((str(doc), len(parts), len(parts) - len(kept), str("\n".join(kept) if text is not None else None)))
    return sorted(out)


def test_lines_equal_plain_python(spark, make_docs):
    rows = [(r[0], r[1], "en", "s0") for r in EDGES if r[0] != 6 and r[0] is not None]
    rows += [(None, "shared line\nnull id", "en", "s1")]
    for i in range(200):
        rows.append((100 + i, "\n".join([f"own {i}", "shared line", f" few {i % 40} ", "", f"mod {i % 7}"]), "en", None if i % 50 == 0 else f"s{i % 30}"))
    got = lines.dedup_lines(make_docs(rows), min_sites=5).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_removed, str(r.text)) for r in got) == plain_lines(rows, 5)
    assert lines.dedup_lines(make_docs(rows)).columns == [c for c in make_docs(rows).columns if c != "n_lines"] + ["n_lines", "n_removed"]
    assert lines.dedup_lines(make_docs(rows).filter("doc_id < 0")).count() == 0


def test_lines_of_rows_without_an_id_of_their_own(spark, make_docs):
    """Rows that share an id, or have none, lose their own boilerplate only; copies of one row lose it in all but one."""
    rows = [(i, f"shared line\nown {i}", "en", f"s{i}") for i in range(5)]
    rows += [(doc, text, "en", "s9") for doc in (None, 7) for text in ("clean a\nshared line", "shared line\nclean b", "clean c\nclean d", "x\nshared line", "x\nshared line")]
    got = sorted((str(r.doc_id), r.text, r.n_removed) for r in lines.dedup_lines(make_docs(rows), min_sites=5).collect())
    plain = [(str(r[0]), "\n".join(x for x in r[1].split("\n") if x != "shared line"), int("shared line" in r[1])) for r in rows]
    kept = [r for r in got if "shared line" in r[1]]
    assert len(kept) == 1 and kept[0][0] == "None" and kept[0][2] == 0
    bare = "\n".join(x for x in kept[0][1].split("\n") if x != "shared line")
    assert sorted([*(r for r in got if r != kept[0]), ("None", bare, 1)]) == sorted(plain)


def test_line_dedup_equals_its_sql(spark):
    from compare import connect, differences

    assert differences(lines.op7_line_dedup(spark, str(Path("/root/testdata/sf0.01"))), connect(str(Path("/root/testdata/sf0.01"))), lines.OP7_SQL) == []


@pytest.mark.parametrize("times", [1, 6])
def test_line_threshold_follows_the_length(spark, make_docs, times):
    """Long passages count from five sites, whatever their documents; short prose lines need most sites, however large the corpus."""
    passage = " ".join(f"word{i}" for i in range(55))
    rows = []
    for i in range(200 * times):
        parts = [f"own text of document {i}"]
        if i % 20 < 12:
            parts.append(f"{passage} on {5 if i % 20 < 5 else 4 if i % 20 < 9 else 3}")
        if i % 20 < 11:
            parts.append("The.")
        if i % 20 < 9:
            parts.append("five words of clean prose")
        if i % 20 < 10:
            parts.append("five words of common boilerplate")
        parts.append("Of.")
        rows.append((i, "\n".join(parts), "en", f"s{i % 20}"))
    left = Counter(x for r in lines.dedup_lines(make_docs(rows)).collect() for x in r.text.split("\n"))
    assert left[f"{passage} on 5"] == left["Of."] == left["five words of common boilerplate"] == 1
    assert left[f"{passage} on 4"] == 40 * times and left[f"{passage} on 3"] == 30 * times
    assert left["The."] == 110 * times and left["five words of clean prose"] == 90 * times


def test_references_need_enough_sound_documents(spark, make_docs):
    """Junk that is alone in its language does not set its own reference, nor do one-word texts; clean text of a rare language stays."""
    rng = random.Random(4)
    prose = lambda words, n: " ".join(rng.choice([*words, "stone", "river", "mountain", "garden."]) for _ in range(n))
    english, german = divergence.COMMON_WORDS["en"], divergence.COMMON_WORDS["de"]
    rows = [(i, prose(english, 150 + i), "en") for i in range(30)] + [(100 + i, "#$%&", "en") for i in range(300)]
    rows += [(500, " ".join(f"zq{i}#" for i in range(200)), "fr"), (501, prose(german, 180), "de"), (502, prose(english, 180), None)]
    got = {r.doc_id: r for r in divergence.judge(make_docs(rows)).collect()}
    assert all(got[i].kept and got[i].class_distance < 0.15 for i in range(30))
    assert not got[500].kept and got[500].class_distance > 0.18 and got[500].word_distance is None
    assert got[501].kept and got[502].kept and got[502].word_distance is not None
    alone = divergence.judge(make_docs(rows).filter("lang = 'fr'")).first()
    assert alone.kept and alone.class_distance is None
