"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints link if at most ``distance`` bits differ. Their bits are grouped into partitions, correlated bits together. For
thresholds t_i >= -1 with sum(t_i) = distance - partitions + 1, two linked fingerprints differ by at most t_i bits in some partition
(-1: the partition is never probed). Which thresholds are cheapest is found by dynamic programming on candidate counts, which come
from the value counts of each partition; the number of partitions is chosen by the same cost. Then every distinct fingerprint is
probed with the values of up to t_i changed bits, and candidates are verified on all bits.

Fingerprints link without exception: a partition value that many distinct fingerprints share is not paired; its members are linked
through midpoints (two fingerprints are within 2 bits if and only if they share a value within 1 bit of both, so 65 values for each
member replace the pairs). ``near_duplicates`` names the components, ``one_of_each`` keeps one document of each.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from playtide.llm.common import LOWER, release_memory, table, tagged, texts
from playtide.llm.components import connected_components
from playtide.session import written

SEED = 42
#: A partition value with more distinct fingerprints than this is linked through midpoints.
MOST_PAIRED = 50
#: Shingles whose bits are unpacked at once.
STEP = 1 << 15

#: A column of 64 bits and some of its bits.
Group = tuple[str, list[int]]


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each run of ``words`` words, joined by blanks (all words if fewer; nothing without words)."""
    split = text.translate(LOWER).split()
    if not split:
        return np.zeros(0, np.uint64)
    joined = b" ".join(split)
    if len(split) <= words:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(itertools.accumulate(map(len, split)))
    ends = [e + i for i, e in enumerate(ends)]
    starts = [0, *(e + 1 for e in ends)]
    return np.fromiter(
        (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1:])), np.uint64, len(split) - words + 1)


def majority(hashes: np.ndarray) -> np.uint64:
    """64 bits, each set if more than half the hashes have it."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), STEP):
        ones += _bits(hashes[i:i + STEP]).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]


def fingerprints(docs: DataFrame, keys: list[str], text: str, words: int) -> DataFrame:
    """The key columns and w0: 64 bits in a long; a text without words has zeros."""
    def run(batches):
        for batch in batches:
            found = np.array([majority(shingle_hashes(x, words)) for x in texts(batch["_text"])], np.uint64)
            yield pa.record_batch([*(batch[k] for k in keys), pa.array(found.view(np.int64))], [*keys, "w0"])
        release_memory()

    rows = docs.select(*keys, F.col(text).alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*fields, "w0 long"]))


def _bits(column: np.ndarray) -> np.ndarray:
    return np.unpackbits(column.view(np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_groups(values: DataFrame, columns: list[str], parts: int) -> list[Group]:
    """Each 64-bit column in ``parts`` groups of near equal width, correlated bits together.

    The co-occurrence counts of a column's bits over all fingerprints are summed by Spark (65 x 64 cells for each column); each group
    starts with the free bit of most uneven share and takes the bits most correlated with it.
    """
    def count(batches):
        total = np.zeros((len(columns), 65, 64))
        for batch in batches:
            for c, name in enumerate(columns):
                fps = batch[name].to_numpy(zero_copy_only=False)
                for i in range(0, len(fps), STEP):
                    bits = _bits(fps[i:i + STEP]).astype(np.float32)
                    total[c, :64] += bits.T @ bits
                    total[c, 64] += len(bits)
        yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "n"])

    sums = np.zeros(len(columns) * 65 * 64)
    for row in values.select(*columns).mapInArrow(count, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        sums[row["cell"]] = row["n"]
    out: list[Group] = []
    for name, own in zip(columns, sums.reshape(len(columns), 65, 64)):
        both, n = own[:64], max(own[64, 0], 1)
        share = np.diag(both) / n
        spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
        related = np.abs((both / n - np.outer(share, share)) / np.outer(spread, spread))
        free = set(range(64))
        for k in range(parts):
            first = max(free, key=lambda b: (abs(share[b] - 0.5), -b))
            group = sorted(free - {first}, key=lambda b: (-related[first, b], b))[:len(free) // (parts - k) - 1]
            out.append((name, sorted([first, *group])))
            free -= set(out[-1][1])
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _value(group: Group) -> Column:
    return F.col(group[0]).bitwiseAND(F.lit(_signed(sum(1 << b for b in group[1]))))


def _flips(bits: list[int], most: int) -> list[int]:
    """All masks of at most ``most`` of the bits."""
    return [_signed(sum(1 << b for b in c)) for k in range(most + 1) for c in itertools.combinations(bits, k)]


def keyed(values: DataFrame, groups: list[Group], flips: list[int]) -> DataFrame:
    """A row (part, value, and the columns of ``values``) for each group probed: its value with up to ``flips`` bits changed."""
    keys = [
        F.struct(F.lit(i).alias("part"), _value(g).bitwiseXOR(F.lit(m)).alias("value"))
        for i, (g, most) in enumerate(zip(groups, flips)) if most >= 0 for m in _flips(g[1], most)
    ]
    return values.withColumn("_k", F.explode(F.array(*keys))).select("_k.part", "_k.value", *values.columns)


def pair_counts(values: DataFrame, groups: list[Group]) -> tuple[int, list[float]]:
    """How many fingerprints there are, and the pairs of equal values in each group, over all fingerprints."""
    counted = keyed(values, groups, [0] * len(groups)).groupBy("part", "value").count().groupBy("part").agg(
        F.sum("count").alias("n"), F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")).collect()
    pairs = {r["part"]: r["pairs"] for r in counted}
    return max((r["n"] for r in counted), default=0), [pairs.get(i, 0.0) for i in range(len(groups))]


def thresholds(n: int, pairs: list[float], widths: list[int], total: int, most: int) -> tuple[float, list[int]]:
    """The cheapest thresholds of at most ``most`` that add up to ``total``, and their cost: rows probed and candidates expected.

    Candidates at t = 0 are counted; each further changed value is taken to find as many again.
    """
    cost = lambda i, t: 0.0 if t < 0 else (n + pairs[i]) * sum(math.comb(widths[i], k) for k in range(t + 1))
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i in range(len(pairs)):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for t in range(-1, most + 1):
                step[used + t] = min(step.get(used + t, (math.inf, [])), (spent + cost(i, t), [*chosen, t]))
        best = step
    return best[total]


def plan(values: DataFrame, columns: list[str], distance: int, parts: tuple[int, ...], most: int) -> tuple[list[Group], list[int]]:
    """The cheapest grouping (``parts`` groups for each column) and thresholds that find all links within ``distance`` bits."""
    options = [bit_groups(values, columns, k) for k in parts]
    n, pairs = pair_counts(values, [g for groups in options for g in groups])
    best, at = (math.inf, [], []), 0
    for groups in options:
        cost, chosen = thresholds(n, pairs[at:at + len(groups)], [len(g[1]) for g in groups], distance - len(groups) + 1, most)
        best, at = min(best, (cost, chosen, groups), key=lambda x: x[0]), at + len(groups)
    return best[2], best[1]


def differing(names: list[str]) -> Column:
    """Differing bits between the columns ``names`` and their twins named other_…"""
    return reduce(add, (F.bit_count(F.col(c).bitwiseXOR(F.col(f"other_{c}"))) for c in names))


def _candidates(values: DataFrame, groups: list[Group], chosen: list[int], most_paired: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows held by value, rows probing, and the (part, value) that too many probes share."""
    held, probes = keyed(values, groups, [min(t, 0) for t in chosen]), keyed(values, groups, chosen)
    crowded = probes.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most_paired)
    return held, probes, written(crowded.select("part", "value"), "simhash-crowded")


def _verified_pairs(held: DataFrame, probes: DataFrame, crowded: DataFrame, names: list[str], key: str, distance: int) -> DataFrame:
    """(a, b) of keys whose fingerprints meet under a value that is not crowded and are within the distance."""
    probes = probes.join(crowded, ["part", "value"], "left_anti").withColumnsRenamed({c: f"other_{c}" for c in {*names, key}})
    near = (F.col(key) != F.col(f"other_{key}")) & (differing(names) <= distance)
    pairs = held.alias("h").join(probes.alias("p"), (F.col("h.part") == F.col("p.part")) & (F.col("h.value") == F.col("p.value")) & near)
    return pairs.select(F.col(key).alias("a"), F.col(f"other_{key}").alias("b"))


def links(values: DataFrame, distance: int = 2, parts: tuple[int, ...] = (3, 4), most_paired: int = MOST_PAIRED) -> DataFrame:
    """Edges (a, b) between distinct 64-bit fingerprints (column w0) that connect all those within ``distance`` bits, at most 2."""
    if distance > 2:
        raise ValueError("midpoints link fingerprints of at most 2 differing bits")
    groups, chosen = plan(values, ["w0"], distance, parts, distance)
    held, probes, crowded = _candidates(values.select("w0"), groups, chosen, most_paired)
    pairs = _verified_pairs(held, probes, crowded, ["w0"], "w0", distance)
    members = probes.join(crowded, ["part", "value"], "left_semi").select("w0").distinct()
    middles = members.select("w0", F.explode(F.transform(
        F.array(*map(F.lit, _flips(list(range(64)), distance // 2))), lambda m: F.col("w0").bitwiseXOR(m))).alias("middle"))
    stars = middles.groupBy("middle").agg(F.min("w0").alias("a"), F.max("w0").alias("z")).filter("a != z").select("middle", "a")
    starred = middles.join(stars, "middle").filter("w0 != a").select("a", F.col("w0").alias("b"))
    return pairs.union(starred).distinct()


def near_duplicates(
    docs: DataFrame, words: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id reachable) for every row of ``docs``.

    A null text counts as empty; texts without words share fingerprint zero and link like any other. Repeated rows are returned
    each. Rows with a null doc_id take part, and never give a component its id unless all its rows have none. Other columns are
    not read; an empty table gives an empty table.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    prints = written(fingerprints(rows, ["doc_id"], "text", words), "simhash-prints")
    values = written(prints.groupBy("w0").agg(F.min("doc_id").alias("first")), "simhash-values")
    roots = written(connected_components(links(values.select("w0"), distance)), "simhash-roots")
    classes = values.join(roots, values["w0"] == roots["node"], "left").select("w0", "first", F.coalesce("root", "w0").alias("root"))
    smallest = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(classes.join(smallest, "root").select("w0", "component_id"), "w0").select(
        "doc_id", F.lower(F.lpad(F.hex("w0"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without all but one document of each component: the one of smallest doc_id.

    Components are those of :func:`near_duplicates`; texts without words are one. Of rows that share the smallest doc_id one stays; a
    null doc_id stays only in a component that has no other. All columns are returned as they came; an empty table stays empty.
    """
    rows = tagged(docs, "simhash-rows")
    prints = fingerprints(rows.withColumn("_id", F.col(doc_id)), ["_row", "_id"], text, words)
    best = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))).alias("best")
    values = written(prints.groupBy("w0").agg(best), "simhash-values")
    roots = written(connected_components(links(values.select("w0"), distance)), "simhash-roots")
    kept = values.join(roots, values["w0"] == roots["node"], "left").groupBy(F.coalesce("root", "w0").alias("group")).agg(
        F.min("best").alias("best")).select(F.col("best.row").alias("_row"))
    # The kept rows' numbers grow with the documents: one kind of join at every size.
    return rows.join(written(kept, "simhash-kept").hint("merge"), "_row", "left_semi").select(*docs.columns)


def op3_simhash_near_dedup(spark, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
