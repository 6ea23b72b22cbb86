"""Fingerprints, decontamination, tokenizers, classifier and pipeline against plain Python and the tokenizers' own libraries."""

import random
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from playtide.llm import decontaminate, neighbours, orc_tokens, simhash, transducer
from playtide.llm.components import connected_components
from playtide.session import written
from tests.llm.conftest import EDGES

FOLDER = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x


def plain_fingerprint(text, n=3):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate(LOWER).encode())
    shingles = [b" ".join(found[i:i + n]) for i in range(max(1, len(found) - n + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, distance):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= distance:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {p: root(p) for p in prints}


def test_near_duplicates_equal_brute_force(spark, make_docs):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 30
    rows = [*EDGES, *((100 + i, base + f"tail {i % 9}") for i in range(30))]
    got = simhash.near_duplicates(make_docs(rows)).collect()
    prints = {plain_fingerprint(t) for _, t, *_ in rows}
    classes = plain_classes(prints, 2)
    smallest = {}
    for doc, text, *_ in rows:
        if doc is not None:
            c = classes[plain_fingerprint(text)]
            smallest[c] = min(doc, smallest.get(c, doc))
    expected = sorted((str(d), f"{plain_fingerprint(t):016x}", str(smallest.get(classes[plain_fingerprint(t)]))) for d, t, *_ in rows)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected
    assert simhash.near_duplicates(make_docs(rows).filter("doc_id < 0")).count() == 0


@pytest.mark.parametrize("most_paired", [1, 5, 50])
def test_links_connect_all_within_two_bits(spark, most_paired):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(12)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(40)}
    prints |= {rng.getrandbits(64) for _ in range(200)}
    values = written(spark.createDataFrame([(signed(p),) for p in prints], "w0 long"), "prints")
    got = {r.node: r.root for r in connected_components(simhash.links(values, 2, most_paired=most_paired)).collect()}
    expected = plain_classes(prints, 2)
    by_ours, by_theirs = {}, {}
    for p in prints:
        by_ours.setdefault(got.get(signed(p), signed(p)), set()).add(p)
        by_theirs.setdefault(expected[p], set()).add(p)
    assert {frozenset(x) for x in by_ours.values()} == {frozenset(x) for x in by_theirs.values()}


def test_thresholds_are_the_cheapest():
    cost, chosen = simhash.thresholds(1000, [5.0, 5.0, 1e9], [21, 21, 22], 0, 2)
    assert sum(chosen) == 0 and chosen[2] == -1 and sorted(chosen) == [-1, 0, 1]


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.sql("SELECT 1000L, 1000L"))
    got = connected_components(edges).collect()
    assert len(got) == 301 and {r.root for r in got} == {0}
    assert connected_components(edges.filter("a < 0")).count() == 0


@pytest.mark.parametrize("most_paired", [1, 50])
def test_one_of_each_component_stays(spark, make_docs, monkeypatch, most_paired):
    """Of each component by brute force the smallest doc_id, one row of it; hot values of exact and near copies among them."""
    monkeypatch.setattr(simhash.links, "__defaults__", (2, (3, 4), most_paired))
    rng = random.Random(5)
    rows = [*EDGES, (900, None), (901, ""), (903, "twice"), (903, "twice")]
    for g in range(12):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(600)]
        rows += [(1000 + 100 * g + k, " ".join([*base, *(f"v{rng.randint(0, 99)}" for _ in range(k % 5))])) for k in range(60)]
    docs = make_docs(rows)
    kept = simhash.one_of_each(docs)
    classes = plain_classes({plain_fingerprint(t) for _, t, *_ in rows}, 2)
    best = {}
    for doc, text, *_ in rows:
        c = classes[plain_fingerprint(text)]
        best[c] = min(best.get(c, (True, 0)), (doc is None, doc or 0))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(best.values())
    assert 15 < len(best) < 500 and simhash.one_of_each(docs.filter("doc_id < 0")).count() == 0


def test_repeated_phrases_alone_do_not_link(spark, make_docs):
    """Fingerprints of three-word shingles; what differs in more than two bits stays."""
    phrase = "one two three four five "
    rows = [(g, phrase * 4 + " ".join(f"own{g}x{i}" for i in range(300))) for g in range(20)]
    kept = {r.doc_id for r in simhash.one_of_each(make_docs(rows)).collect()}
    classes = plain_classes({plain_fingerprint(t) for _, t in rows}, 2)
    assert len(kept) == len(set(classes.values())) and len(kept) > 10


def test_decontamination(spark, make_docs):
    rng = random.Random(2)
    text = lambda n: [f"t{rng.randint(0, 10**6)}" for _ in range(n)]
    items = [text(35), text(20), text(6), text(3), text(35)]
    every_fifth = [w if i % 6 else "other" for i, w in enumerate(items[0])]
    around = lambda w: " ".join(text(40) + w + text(30))
    rows = [
        (1, around(items[0])), (2, around(every_fifth)), (3, around(items[1]).upper()), (4, around(items[2])), (5, around(items[3])),
        (6, around(items[4][:20])), (7, around(items[4][:8])), (8, around([])), (9, " ".join(items[2])), (10, around(items[0] + items[1])),
        (None, around(items[0])), (11, None), (12, ""), (13, ", ".join(items[1])), *((20 + i, around(items[1])) for i in range(60))]
    bench = spark.createDataFrame(
        [(i, " ".join(w), "x") for i, w in enumerate(items)] + [(7, None, "x"), (8, "", "x"), (None, "no id", "x"), (0, " ".join(items[0]), "x")],
        "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(make_docs(rows), bench).collect()}
    assert got == {(1, 0), (2, 0), (3, 1), (4, 2), (6, 4), (9, 2), (10, 0), (10, 1), (None, 0), (13, 1), *((20 + i, 1) for i in range(60))}
    assert decontaminate.overlaps(make_docs(rows), bench.filter("item_id < 0")).count() == 0
    assert decontaminate.overlaps(make_docs(rows).filter("doc_id < 0"), bench).count() == 0


def test_decontamination_finds_verbatim_items_only(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = {r.doc_id for r in decontaminate.op8_benchmark_decontamination(spark, FOLDER).filter("contaminated").collect()}
    assert got == {i for i, t in docs.items() if any(x in t for x in items)}


ALPHABETS = ["abcde the in ion \n▁.,_-0123456789éßñ中Ж'\x1c\x85 \t  ", "ab  ", "the of and"]


def strange_texts(n):
    rng = random.Random(1)
    return ["".join(rng.choice(rng.choice(ALPHABETS)) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_sentencepiece_equals_the_library(spark, make_docs):
    rows = [*EDGES, *((100 + i, t) for i, t in enumerate(strange_texts(1500)))]
    rows += [(5000 + r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=transducer.model_path())
    got = transducer.decode(transducer.encode(make_docs(rows), transducer.model_path()), transducer.model_path()).collect()
    assert sorted((str(d), tuple(library.encode(t or ""))) for d, t, *_ in rows) == sorted((str(r.doc_id), tuple(r.ids)) for r in got)
    assert sorted((str(d), (t or "").replace("▁", " ")) for d, t, *_ in rows) == sorted((str(r.doc_id), r.decoded) for r in got)
    assert all(r.n_tokens == len(r.ids) for r in got)
    assert transducer.encode(make_docs(rows).filter("doc_id < 0"), transducer.model_path()).count() == 0


def test_sentencepiece_query_and_stage_decode(spark, make_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=transducer.model_path())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = transducer.op6_sentencepiece(spark, FOLDER).collect()
    assert len(got) == len(texts) and all(r.decoded == library.decode(list(r.ids)) == texts[r.doc_id] and r.same for r in got)
    rows = [*EDGES, *((100 + i, t) for i, t in enumerate(strange_texts(300)))]
    got = corpus_pipeline.encoding(spark, make_docs(rows), FOLDER).collect()
    assert sorted((str(d), (t or "").replace("▁", " "), True) for d, t, *_ in rows) == sorted((str(r.doc_id), r.decoded, r.same) for r in got)


def test_orc_tokens_equal_the_library(spark, make_docs, tmp_path):
    rows = [*EDGES, *((100 + i, t) for i, t in enumerate(strange_texts(1500)))]
    marks = ["hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|><|endoftext|> a", "a b<|endoftext|>c  d ", "<|endof text|>", "x\u3000 y\x1c z"]
    rows += [(50 + i, t) for i, t in enumerate(marks)] + [(7, "other text of this id"), (7, "a third one"), (7, "a third one")]
    path = str(tmp_path / "tokens")
    orc_tokens.write_tokens(make_docs(rows), path, orc_tokens.model_path())
    library = Tokenizer.from_file(orc_tokens.model_path())
    plain = {}
    for doc, text, *_ in rows:
        plain.setdefault(doc, []).append([*library.encode(text or "", add_special_tokens=False).ids, 0])
    start = 0
    got = {}
    for r in orc_tokens.token_index(orc_tokens.read_tokens(spark, path)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got.keys() == plain.keys()
    for doc in sorted(plain, key=lambda d: (d is not None, d or 0)):
        found = sorted(got[doc], key=lambda r: r.start)
        crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
        assert sorted((len(i), crc(i)) for i in plain[doc]) == sorted((r.n_tokens, r.ids_crc32) for r in found)
        for r in found:
            assert r.start == start
            start += r.n_tokens
    # What the files hold, in their own order, is at the starts that the index gives.
    stored = orc_tokens.read_tokens(spark, path).orderBy("part", "place").collect()
    begin = np.cumsum([0, *(len(r.ids) for r in stored)])
    assert sorted((str(r.doc_id), int(b), crc(r.ids)) for r, b in zip(stored, begin)) == sorted(
        (str(r.doc_id), r.start, r.ids_crc32) for x in got.values() for r in x)
    one = orc_tokens.read_tokens(spark, path, [105])
    assert [list(r.ids) for r in one.collect()] == plain[105]
    assert "PushedFilters: [In(doc_id" in one._jdf.queryExecution().toString() or "EqualTo(doc_id" in one._jdf.queryExecution().toString()
    orc_tokens.write_tokens(make_docs(rows).filter("doc_id < 0"), f"{path}-none", orc_tokens.model_path())
    assert orc_tokens.token_index(orc_tokens.read_tokens(spark, f"{path}-none")).count() == 0


def counted_tokenizer():
    """The tokenizer of op9, and a list of all units it gives to the library."""
    tok, seen = orc_tokens.ByteTokenizer(orc_tokens.model_path()), []
    encode_many = tok.table.encode_many
    tok.table.encode_many = lambda units: (seen.extend(units), encode_many(units))[1]
    return tok, seen


def library_ids(texts):
    library = Tokenizer.from_file(orc_tokens.model_path())
    return [library.encode(t, add_special_tokens=False).ids for t in texts]


def same_ids(tok, texts):
    ids, lengths = tok.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(lengths))[:-1]] == library_ids(texts)


def test_a_word_is_encoded_once_whatever_follows_it():
    """Punctuation after a word and line feeds around it make no new units of the word (op9's CPU budget)."""
    rng = random.Random(1)
    words = ["".join(rng.choice("aehinrstéß") for _ in range(12)) for _ in range(300)]
    ends = ["", ".", ",", "...", "!)", ".&&&", "\nThe", ".\n"]
    texts = ["A " + " ".join(w + end for w in words) for end in ends]
    tok, seen = counted_tokenizer()
    assert same_ids(tok, texts)
    assert len(seen) < len(words) + 20


def test_cuts_of_op9_follow_the_library():
    """White space in every order, contractions, marks, letters of many scripts, parts of the added token."""
    rng = random.Random(2)
    parts = [
        *"   \n\n\t\r\v.,)_-<|'", "\r\n", "  ", "\xa0", "\u3000", "\u2009", "\x1c", "\x85", "...", "!?", "'s", "'ll", "don't", "foo", "Bar", "é", "e\u0301",
        "ß", "12", "²", "½", "中文", "я", "Ω", "\U0001F600", "<|endoftext|>", "|>", "×", "\u200b", "\ufeff", "ǀ", "ª", "µ", "ʼ", "\0", "\u180e"]
    tok, _ = counted_tokenizer()
    for _ in range(40):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 300))]
        assert same_ids(tok, [t if rng.random() < 0.5 else t.replace("<|endoftext|>", "") for t in texts])


def test_units_that_come_again_are_kept(monkeypatch):
    monkeypatch.setattr(orc_tokens, "HELD_BYTES", 100_000)
    tok, seen = counted_tokenizer()
    common = "In words" + "".join(f" again{chr(97 + i)}" for i in range(26))
    for step in range(10):
        assert same_ids(tok, [common, " ".join(f"once{step}x{i}" for i in range(400))])
        assert tok.table.held < 250_000
    assert len(seen) > 4000 and seen.count(" againc") == 1
    # Where even those are too many, it starts afresh.
    again = " ".join(f"many{i}" for i in range(1000))
    assert all(same_ids(tok, [again]) for _ in range(4)) and seen.count(" many7") > 1


def rows_scanned(df):
    """Rows that the scan hands over, before the filter."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_orc_files_have_stripes_and_skip_rows(spark, tmp_path):
    """Several stripes in a file; a filter on the id reads one group of rows, and none for an absent id within a group's range (Bloom filter)."""
    from pyarrow import orc

    docs = spark.range(200_000).select((2 * F.col("id")).alias("doc_id"), F.concat(F.lit("some words "), "id").alias("text"))
    path = str(tmp_path / "tokens")
    orc_tokens.write_tokens(docs, path, orc_tokens.model_path(), **{"orc.stripe.size": "65536"})
    files = [orc.ORCFile(str(f)) for f in tmp_path.glob("tokens/*.orc")]
    assert max(f.nstripes for f in files) > 2 and max(f.nrows for f in files) > 10_000
    some = 100_000
    assert orc_tokens.read_tokens(spark, path, [some]).count() == 1
    assert 0 < rows_scanned(orc_tokens.read_tokens(spark, path, [some])) <= 1000
    assert rows_scanned(orc_tokens.read_tokens(spark, path, [some + 1])) == 0


def test_one_id_fills_several_files(spark, make_docs, tmp_path):
    """A third of the rows have no id, and half of those one text: no file holds more than its share."""
    rows = [(None if i % 3 == 0 else i, "same text" if i % 6 == 0 else f"text {i}") for i in range(3000)]
    path = str(tmp_path / "tokens")
    orc_tokens.write_tokens(make_docs(rows), path, orc_tokens.model_path(), file_bytes=2000)
    sizes = [r["count"] for r in orc_tokens.read_tokens(spark, path).groupBy("part").count().collect()]
    assert max(sizes) < 700 and sum(sizes) == 3000


def test_classifier_on_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    got = neighbours.op10_quality_classifier(spark, "/root/testdata/sf0.01").filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95
    assert np.mean([r.predicted for r in got if r.quality == 1]) > 0.97


def test_classifier_votes_equal_brute_force():
    rng = np.random.default_rng(0)
    model = {"vectors": rng.standard_normal((60, 5)).astype(np.float32), "labels": (rng.random(60) > 0.5).astype(np.float32)}
    model["vectors"] /= np.linalg.norm(model["vectors"], axis=1, keepdims=True)
    asked = rng.standard_normal((700, 5)).astype(np.float32)
    for vector, score in zip(asked, neighbours.vote(asked, model, 7)):
        cosine = model["vectors"] @ vector
        best = np.argsort(-cosine)[:7]
        weight = np.maximum(cosine[best], 0).astype(float) ** 4
        assert abs(score - (weight * model["labels"][best]).sum() / weight.sum()) < 1e-4


def test_classifier_edges(spark, make_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (7, None), (2, 1), (99, 0)], "doc_id long, quality int")
    docs = make_docs(EDGES)
    got = neighbours.score(docs, labels, F.lit(True))
    assert got.count() == len(EDGES) and set(got.columns) == set(docs.columns)
    assert all(0 <= r.score <= 1 and (r.text or r.score == 0) for r in got.collect())
    assert {r.score for r in neighbours.score(docs, labels.filter("doc_id < 0"), F.lit(True)).collect()} == {0}
    assert neighbours.score(docs.filter("doc_id < 0"), labels, F.lit(True)).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), "stage")
        assert docs.select("doc_id").distinct().count() == docs.count() <= before, name
        assert name == "SentencePiece encoding" or docs.columns == columns
        if name == "SimHash near-dedup":
            prints = [plain_fingerprint(r.text) for r in docs.collect()]
            assert not [1 for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 2]
    final = {(r.doc_id, tuple(r.ids)) for r in docs.collect()}
    assert final == {(r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, FOLDER).collect()}


def test_decontamination_stage_removes_single_rows(spark, make_docs, tmp_path):
    item = "the quick brown fox jumps over the lazy dog and runs away from all the hounds"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(doc, text) for doc in (None, 3) for text in ("clean one", f"before {item} after", "clean two")]
    got = corpus_pipeline.decontamination(spark, make_docs(rows), str(tmp_path))
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted((str(d), t) for d, t in rows if "fox" not in t)


def test_pipeline_stages_on_edges(spark, make_docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and runs away")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = make_docs(EDGES)
    for rows in (docs, docs.filter("doc_id < 0")):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, folder)
            assert out.count() <= rows.count()
            assert "doc_id" in out.columns


def plain_passage(words, item):
    """Whether some alignment of the item, inside the text or over its ends, holds a passage by the operator's rule."""
    found, asked = (decontaminate.word_hashes([" ".join(x).encode()])[0] for x in (words, item))
    return any(decontaminate.agreement(found, asked, shift) for shift in range(-len(asked) + 1, len(found)))


def test_decontamination_finds_substituted_passages(spark, make_docs):
    """Against brute force over all alignments: items of 5 to 35 words with up to a quarter of their words substituted."""
    rng = random.Random(5)
    word = lambda: f"t{rng.randint(0, 10**6)}"
    items = [[word() for _ in range(n)] for n in range(5, 36)]
    rows, planted = [], []
    for number, item in enumerate(items):
        for k in range(len(item) // 4 + 1):
            for _ in range(6):
                changed = set(rng.sample(range(len(item)), k))
                text = [word() for _ in range(20)] + [word() if i in changed else w for i, w in enumerate(item)] + [word() for _ in range(9)]
                rows.append((len(rows), " ".join(text)))
                planted.append((number, plain_passage(text, item)))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(make_docs(rows), bench).collect()}
    expected = {(doc, number) for doc, (number, passage) in enumerate(planted) if passage}
    assert got <= expected
    for low, high in ((5, 12), (13, 16), (17, 35)):
        asked = {(doc, number) for doc, number in expected if low <= len(items[number]) <= high}
        assert len(got & asked) >= (1 if high <= 12 else 0.95) * len(asked) > 0
    # A third of the rows without an id and a third that shares one: their hits are not mixed up.
    hot = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, text) for i, text in rows]
    pairs = {(doc, number) for (doc, _), (number, _), i in zip(hot, planted, range(len(hot))) if (i, number) in got}
    assert {(r.doc_id, r.item_id) for r in decontaminate.overlaps(make_docs(hot), bench).collect()} == pairs


def test_short_masks_meet_every_substitution():
    for n in range(5, 15):
        for changed in combinations(range(n), n // 5):
            assert any(
                all(at + place not in changed for place in mask) for mask in decontaminate.masks_for(n) for at in range(n - mask[-1])), (n, changed)


def test_classifier_takes_one_text_of_a_repeated_id(spark, make_docs):
    rows = [(i % 40, f"text number {i} with words {'x' * (i % 7)}") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    drawn = [neighbours.labelled_sample(make_docs(rows, n), labels, F.lit(True), 15, "doc_id", "text", "quality") for n in (1, 7)]
    assert (drawn[0][0] == drawn[1][0]).all() and (drawn[0][1] == drawn[1][1]).all() and len(drawn[0][0]) == 30
