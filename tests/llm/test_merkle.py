"""The manifest and its proofs against a plain recursive tree."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from playtide.llm import merkle
from tests.llm.conftest import EDGES

FOLDER = "/root/testdata/sf0.001"
NAMES = ["doc_id", "source", "lang", "n_chars", "text"]
H = lambda s: sha256(s.encode()).hexdigest()


def plain_leaf(row, text):
    values = [*(row[c] for c in NAMES[:-1]), text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """The root, and for each node the siblings (left, right) up to it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i // 8 * 8
            paths[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 8])))
        at = [i // 8 for i in at]
        nodes = [H("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain(rows):
    out, langs, subroots, trees = [], sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode())), [], []
    for lang in langs:
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"])))
        root, paths = plain_tree([plain_leaf(r, r["text"]) for r in own])
        subroots.append(root)
        trees.append((own, paths))
    root, above = plain_tree(subroots) if rows else (None, [])
    for (own, paths), subroot, more in zip(trees, subroots, above):
        for r, path in zip(own, paths):
            text, leaf = r["text"], plain_leaf(r, r["text"])
            if zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded = plain_leaf(r, text)
            for left, right in path + more:
                folded = H(left + folded + right)
            out.append((r["doc_id"], leaf, subroot, root, H("".join(a + b for a, b in path + more)), folded, folded == root))
    return sorted(out, key=repr)


def check(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle.op13_merkle_manifest(spark, str(tmp_path))
    rows = [r.asDict() for r in docs.select(*NAMES).collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_sample_equals_plain_trees(spark, tmp_path):
    check(spark, tmp_path, spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_edge_rows(spark, make_docs, tmp_path):
    langs = ["en", None, "", "de"]
    check(spark, tmp_path, make_docs([(d, t, langs[i % 4], None if i % 3 == 0 else "s") for i, (d, t) in enumerate(EDGES)]))


@pytest.mark.parametrize("rows", [0, 1, 2, 9, 64, 65, 513, 1300])
def test_depths(spark, make_docs, tmp_path, rows):
    """One large group whose last runs are short, single leaves, and repeated rows."""
    check(spark, tmp_path, make_docs([(i // 2 if i % 5 else i, f"Text {i // 3}", "en" if i else "fr") for i in range(rows)]))


def test_wanted_leaves_read_their_subtrees_only(spark, make_docs):
    docs = make_docs([(i, f"text {i}") for i in range(3000)])
    manifest = merkle.build(docs, merkle.record_digest([F.col("doc_id"), F.col("text")]))
    assert [level.count() for level in manifest.levels] == [3000, 6, 1]
    wanted = spark.createDataFrame([(5,), (2999,)], "key long")
    some = {r.key: r for r in merkle.proofs(manifest, wanted).withColumn("folded", merkle.folded(F.col("hash"))).collect()}
    full = {r.key: r for r in merkle.proofs(manifest).collect()}
    assert set(some) == {5, 2999}
    for key, row in some.items():
        assert row.folded == row.root and (row.lefts, row.rights) == (full[key].lefts, full[key].rights)


def test_many_groups(spark, make_docs, tmp_path):
    check(spark, tmp_path, make_docs([(i, "x", f"l{i % 700:03d}") for i in range(1500)]))
