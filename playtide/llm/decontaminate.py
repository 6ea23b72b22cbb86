"""Benchmark decontamination by spaced seeds.

Fixed masks of word places ignore some of the words under them, so a passage still hits after words were substituted. A bit map of
fixed size over the benchmark's seed hashes goes to every task and drops almost all positions of the corpus there; what passes is
joined with the benchmark's hashes on equality. Around each hit the document and the item are compared word by word along their
alignment. A larger benchmark only lets more positions through to the join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from playtide.llm.common import LOWER, sliced, table, texts
from playtide.session import written

#: Least words of an item, and the masks (places of the words that count) it is searched by. At every length up to 14 words each way to
#: substitute a fifth of the words leaves a seed whole; for longer items the test measures the share found. Shorter items than the
#: first say nothing and are not searched.
MASKS = (
    (5, ((0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 4), (0, 1, 2, 4))),
    (6, ((0, 1, 2, 3), (0, 1, 3, 4))),
    (13, ((0, 1, 2, 4, 7, 8), (0, 2, 3, 5, 6, 9), (0, 1, 4, 5, 8, 10))),
)
#: Words that must agree in the best aligned segment: this many, or SHARE of a shorter item.
OVERLAP, SHARE = 13, 0.8
#: A word that differs costs as much as this many that agree.
PENALTY = 2
MAP_BITS, STEP_BYTES = 24, 2 << 20
STOPS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(docs: list[bytes]) -> list[np.ndarray]:
    """64-bit hashes of each text's words: A-Z lower-cased, ASCII punctuation taken out."""
    split = [x.translate(LOWER, STOPS).split() for x in docs]
    coded = pa.array([w for x in split for w in x], pa.binary()).dictionary_encode()
    distinct = np.fromiter((xxh64_intdigest(w.as_py()) for w in coded.dictionary), np.uint64, len(coded.dictionary))
    flat = distinct[coded.indices.to_numpy()] if len(split) else np.zeros(0, np.uint64)
    return np.split(flat, np.cumsum([len(x) for x in split])[:-1]) if split else []


def seeds(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hash of the masked words at each place where the whole mask fits."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(sum(1 << place for place in mask)), np.uint64)
    for place in mask:
        out = (out ^ words[place:place + n]) * FACTOR
        out ^= out >> np.uint64(31)
    return out


def masks_for(n: int) -> tuple[tuple[int, ...], ...]:
    """The masks by which an item of ``n`` words is searched."""
    return next((masks for least, masks in reversed(MASKS) if n >= least), ())


def _seed_batches(masks_of, bitmap):
    def run(batches):
        keep = bitmap.value if bitmap is not None else None
        for batch in batches:
            for part in sliced(texts(batch["text"]), STEP_BYTES):
                found = word_hashes(texts(batch["text"].slice(part.start, part.stop - part.start)))
                rows: list[list[np.ndarray]] = [[], [], []]
                for i, words in enumerate(found):
                    for mask in masks_of(len(words)):
                        hashes = seeds(words, mask)
                        at = np.arange(len(hashes))
                        if keep is not None and len(hashes):
                            bit = hashes >> np.uint64(64 - MAP_BITS)
                            at = np.nonzero(keep[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1))[0]
                        if len(at):
                            for column, values in zip(rows, (np.full(len(at), part.start + i), at, hashes[at])):
                                column.append(values)
                if rows[0]:
                    row, at, hashes = (np.concatenate(x) for x in rows)
                    row = pa.array(row)
                    yield pa.record_batch([
                        batch["id"].take(row), batch["text_hash"].take(row), pa.array(at.astype(np.int32)),
                        pa.array(hashes.view(np.int64))], ["id", "text_hash", "at", "seed"])

    return run


def seed_rows(rows: DataFrame, masks_of: Callable[[int], Iterable[tuple[int, ...]]], bitmap=None) -> DataFrame:
    """id, text_hash, at and seed of every masked position of (id, text, text_hash) rows that the bit map, if any, lets through.

    ``masks_of(n)`` gives the masks for a text of n words. A seed's hash depends on its mask.
    """
    return rows.mapInArrow(_seed_batches(masks_of, bitmap), "id long, text_hash long, at int, seed long")


def best_segment(agree: np.ndarray) -> int:
    """Words that agree within the aligned segment of highest score (1 for a word that agrees, -PENALTY for one that differs)."""
    if not len(agree):
        return 0
    sums = np.concatenate([[0], np.cumsum(np.where(agree, 1, -PENALTY))])
    lows = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - lows))
    start = int(np.argmin(sums[:end + 1]))
    return int(agree[start:end].sum())


def agreement(words: np.ndarray, item: np.ndarray, shift: int) -> int:
    """Words of the item that the text holds if item word i lies on word i + ``shift``; 0 if that is no passage.

    A passage is a best segment of OVERLAP agreeing words; of an item too short for that, SHARE of its words, wherever they are.
    """
    low, high = max(0, -shift), min(len(item), len(words) - shift)
    if high <= low:
        return 0
    agree = item[low:high] == words[low + shift:high + shift]
    least = SHARE * len(item)
    n = int(agree.sum()) if least < OVERLAP else best_segment(agree)
    return n if n >= min(OVERLAP, least) else 0


def _verified(batches):
    for batch in batches:
        ids, items, matched = [], [], []
        for doc, text, hits in zip(batch["id"].to_pylist(), texts(batch["text"]), batch["hits"].to_pylist()):
            words = word_hashes([text])[0].view(np.int64)
            best: dict[int, int] = {}
            for hit in hits:
                n = agreement(words, np.array(hit["words"], np.int64), hit["shift"])
                if n:
                    best[hit["item"]] = max(n, best.get(hit["item"], 0))
            for item, n in best.items():
                ids.append(doc)
                items.append(item)
                matched.append(n)
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(items, pa.int64()), pa.array(matched, pa.int32())], ["doc_id", "item_id", "matched"])


def overlaps(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, matched): benchmark items of which a document holds a passage, and its agreeing words.

    An item counts if the best aligned segment agrees in OVERLAP words, or the alignment in SHARE of a shorter item's words; words may be
    substituted but not inserted within a segment. Null texts count as empty; items under five words are not searched. Rows
    that share a doc_id (or a null one) are reported together, but searched one text at a time; repeated items count once; other
    columns are not read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    keyed = lambda df, name: df.select(
        F.col(name[0]).cast("long").alias("id"), F.col(name[1]).alias("text"), F.xxhash64(name[1]).alias("text_hash"))
    rows = keyed(docs, (doc_id, text))
    items = keyed(benchmark, (item_id, item_text)).filter("id is not null")

    def hashed(batches):
        for batch in batches:
            words = [w.view(np.int64) for w in word_hashes(texts(batch["text"]))]
            yield pa.record_batch([batch["id"], pa.array(words, pa.list_(pa.int64()))], ["item", "words"])

    words = written(items.mapInArrow(hashed, "item long, words array<long>"), "benchmark-words")
    # The documents are searched by the masks that some item needs: at most one row for each kind in MASKS.
    kind = sum(((F.size("words") >= least).cast("int") for least, _ in MASKS), F.lit(0))
    kinds = [r["kind"] for r in words.select(kind.alias("kind")).distinct().collect()]
    masks = sorted({mask for k in kinds if k for mask in MASKS[k - 1][1]})
    held = written(seed_rows(items, masks_for).select(F.col("id").alias("item"), F.col("at").alias("item_at"), "seed"), "benchmark-seeds")
    # 2^24 bits however large the benchmark is.
    bit = F.shiftrightunsigned("seed", 64 - MAP_BITS)
    cells = held.select(F.shiftright(bit, 6).alias("cell"), (bit.bitwiseAND(63)).cast("int").alias("bit")).groupBy("cell").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    bitmap = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    for row in cells.collect():
        bitmap[row["cell"]] = np.uint64(row["bits"] & (2**64 - 1))
    probes = seed_rows(rows, lambda n: masks, spark.sparkContext.broadcast(bitmap))
    hits = probes.join(held, "seed").select("id", "text_hash", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    hits = written(hits, "benchmark-hits").join(words, "item")
    # Hits meet by text, not by id: a common id (or none) gathers no more than any other, and copies of a text share their hits.
    by_doc = hits.groupBy(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).agg(
        F.collect_list(F.struct("item", "shift", "words")).alias("hits"))
    same = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    checked = rows.join(by_doc, same).select("id", "text", "hits")
    found = checked.mapInArrow(_verified, "doc_id long, item_id long, matched int")
    return found.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))


def op8_benchmark_decontamination(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = overlaps(docs, table(spark, folder, "benchmark")).groupBy(F.col("doc_id").alias("hit_id")).agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("matched").alias("matched"))
    return docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left").select(
        "doc_id", F.col("hit_id").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"), F.coalesce("matched", F.lit(0)).alias("matched"))
