"""A Merkle manifest of a data set, stored only at every few levels.

Rows are leaves, in a tree for each group; the groups' roots are the leaves of one more tree. A node is the digest of its up to eight
children, and of a tree only the leaves and every third level are written: an aligned subtree between two stored levels has at most
512 nodes below, so a proof takes them, works out the levels between again, hands out the siblings and forgets the rest. Subtrees
are shared out by (tree, number), so a group may hold any share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import numbered, table
from playtide.session import written

#: Children of a node, and levels from one stored level to the next.
FANOUT, STRIDE = 8, 3
BLOCK = FANOUT ** STRIDE
PATH = "lefts array<string>, rights array<string>, subroot string, root string"


def depth(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def interior(nodes: list[str], n: int) -> list[list[str]]:
    """The nodes of a subtree and of its levels up to the next stored one, or to the top of a tree of ``n`` nodes."""
    levels = [nodes]
    for _ in range(min(STRIDE, depth(n))):
        below = levels[-1]
        levels.append([sha256("".join(below[i:i + FANOUT]).encode()).hexdigest() for i in range(0, len(below), FANOUT)])
    return levels


def record_digest(columns: list[Column]) -> Column:
    """Digest of a record: each value as its length in bytes, a colon and the value, or - for null."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


@dataclass(frozen=True)
class Manifest:
    """What is stored: (tree, pos, n, hash, and columns carried) of the leaves, (tree, pos, n, hash) of each higher stored level, for the
    groups' trees and for the tree over their roots. ``n`` is the number of nodes of the tree at that level."""

    levels: list[DataFrame]
    upper: list[DataFrame]


def _top(rows: pa.Table) -> pa.Table:
    n, nodes = rows["n"][0].as_py(), np.array(rows["hash"].to_pylist())[np.argsort(rows["pos"].to_numpy())]
    return pa.table({
        "tree": rows["tree"][:1], "pos": rows["block"][:1], "n": pa.array([-(-n // BLOCK)], pa.int64()), "hash": interior(list(nodes), n)[-1]})


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.filter("n > 1").withColumn("block", F.floor(F.col("pos") / BLOCK))


def stored_levels(leaves: DataFrame) -> list[DataFrame]:
    """The leaves and every third level above, until all trees have one node."""
    levels = [leaves]
    while levels[-1].filter("n > 1").limit(1).count():
        below = _blocks(levels[-1]).select("tree", "block", "pos", "n", "hash")
        levels.append(written(below.groupBy("tree", "block").applyInArrow(_top, "tree long, pos long, n long, hash string"), "merkle-level"))
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, hash) of each tree's one node."""
    tops = [nodes.filter("n = 1").select("tree", "hash") for nodes in levels]
    out = tops[0]
    for more in tops[1:]:
        out = out.union(more)
    return out


def build(docs: DataFrame, leaf: Column, group: str = "lang", order: str = "doc_id", **carried: Column) -> Manifest:
    """The manifest of ``docs``: a tree for each value of ``group``, its leaves by ``order``, and a tree over the groups in their order.

    Nulls sort first in both; rows of equal order follow by their digest. ``carried`` columns stay beside the leaves. An empty
    table gives a manifest without nodes.
    """
    rows = written(docs.select(
        F.col(group).alias("group"), F.col(order).alias("key"), leaf.alias("hash"), *(c.alias(name) for name, c in carried.items()),
        F.monotonically_increasing_id().alias("row")), "merkle-leaves", compression="zstd")
    levels = stored_levels(numbered(rows, ["group"], ["key", "hash", "row"], "merkle-sorted").drop("row"))
    roots = _roots(levels).withColumnRenamed("tree", "of").withColumn("all", F.lit(0))
    return Manifest(levels, stored_levels(numbered(roots, ["all"], ["of"], "merkle-roots").drop("all")))


def _paths(names: list[str]):
    """Siblings to the left and right of each node of a subtree, level by level, followed by those of the subtree itself."""
    def run(below: pa.Table, above: pa.Table) -> pa.Table:
        below = below.take(np.argsort(below["pos"].to_numpy()))
        levels = interior(below["hash"].to_pylist(), below["n"][0].as_py() if len(below) else 0)
        more_left, more_right = above["lefts"][0].as_py(), above["rights"][0].as_py()
        sides = []
        for nodes in levels[:-1]:
            runs = [nodes[i:i + FANOUT] for i in range(0, len(nodes), FANOUT)]
            sides.append([("".join(run[:i]), "".join(run[i + 1:])) for run in runs for i in range(len(run))])
        steps = [[side[i // FANOUT ** k] for k, side in enumerate(sides)] for i in range(len(below))]
        return pa.table({
            **{c: below[c] for c in names},
            "lefts": pa.array([[*(a for a, _ in x), *more_left] for x in steps], pa.list_(pa.string())),
            "rights": pa.array([[*(b for _, b in x), *more_right] for x in steps], pa.list_(pa.string())),
            "subroot": pa.array([above["subroot"][0].as_py()] * len(below), pa.string()),
            "root": pa.array([above["root"][0].as_py()] * len(below), pa.string())})

    return run


def _prove(levels: list[DataFrame], tops: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """The nodes of the lowest level with their paths; ``tops`` has the path of each tree's one node."""
    paths = None
    for k in reversed(range(len(levels))):
        nodes = levels[k]
        if k == 0 and wanted is not None:  # the other subtrees stay unread
            hit = nodes.join(wanted, "key", "left_semi").select("tree", F.floor(F.col("pos") / BLOCK).alias("_block")).distinct()
            nodes = nodes.withColumn("_block", F.floor(F.col("pos") / BLOCK)).join(hit, ["tree", "_block"], "left_semi").drop("_block")
        found = nodes.filter("n = 1").join(tops, "tree").select(*nodes.columns, "lefts", "rights", "subroot", "root")
        if paths is not None:
            above = paths.select("tree", F.col("pos").alias("block"), "lefts", "rights", "subroot", "root")
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
            blocks = _blocks(nodes).groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
            found = found.unionByName(blocks.applyInArrow(_paths(nodes.columns), f"{fields}, {PATH}"))
        paths = written(found, "merkle-paths", compression="zstd") if k else found
    return paths if wanted is None else paths.join(wanted, "key", "left_semi")


def proofs(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Each leaf (key, hash, carried columns) with its proof: ``lefts`` and ``rights`` hold the digests beside it, joined, for each level
    up to ``root``; ``subroot`` is its group's root.

    ``wanted`` (a column key) asks for some leaves only: of the leaves, just their aligned subtrees are read and hashed again.
    """
    empty = F.array().cast("array<string>")
    whole = _roots(manifest.upper).select("tree", empty.alias("lefts"), empty.alias("rights"), F.col("hash").alias("subroot"), F.col("hash").alias("root"))
    tops = written(_prove(manifest.upper, whole, None).select(
        F.col("of").alias("tree"), "lefts", "rights", F.col("hash").alias("subroot"), "root"), "merkle-tops")
    return _prove(manifest.levels, tops, wanted).drop("tree", "pos", "n")


def folded(leaf: Column) -> Column:
    """The root that a proof gives for a leaf."""
    steps = F.arrays_zip("lefts", "rights")
    return F.aggregate(steps, leaf, lambda at, s: F.sha2(F.concat(s["lefts"], at, s["rights"]).cast("binary"), 256))


def proof_digest() -> Column:
    """Digest of all siblings of a proof, from the leaf to the root."""
    both = F.transform(F.arrays_zip("lefts", "rights"), lambda s: F.concat(s["lefts"], s["rights"]))
    return F.sha2(F.array_join(both, "").cast("binary"), 256)


def op13_merkle_manifest(spark, folder: str) -> DataFrame:
    """Whole documents; a null doc_id counts as empty text where it is drawn for tampering."""
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    drawn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    leaf = record_digest([F.col(c) for c in names])
    tampered = record_digest([F.translate("text", upper, upper.lower()) if c == "text" else F.col(c) for c in names])
    manifest = build(table(spark, folder, "documents"), leaf, claimed=F.when(drawn, tampered).otherwise(leaf))
    found = proofs(manifest).withColumn("folded_root", folded(F.col("claimed")))
    return found.select(
        F.col("key").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", "root", proof_digest().alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
