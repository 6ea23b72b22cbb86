"""Language-model scoring by partial matching: a byte-context trie with escapes and symbol exclusion.

The trie is trained on a corpus and then fixed, so a byte's probability depends only on the ``ORDER`` bytes before it. That makes
the model a table keyed by byte grams (context and symbol packed into one long), which Spark aggregates, splits and joins like any
other table: no task and no driver holds the whole trie.

* Blocks: each task packs its documents, compressed, into blocks of some megabytes that are written once and read twice.
* Counting: each block sends its distinct words and grams with their training counts.
* Model: grams are dealt by their two last context bytes. All longer contexts of such a group lie in the group, so one task can
  resolve its escapes down to order 2 by itself; orders 1 and 0 (at most 258 x 257 rows, a fixed bound) go to every task.
* Scoring: each block gets back the log probabilities of its own grams, and the counts of those of its words that other blocks'
  training texts hold too (the rest it has counted itself), next to its documents.

Escapes follow method D: a context with total R and D symbols (both without the symbols excluded by the longer context) gives a
symbol of count c (2c - 1) / 2R and leaves D / 2R to the shorter context. Lower orders count how many longer contexts a symbol was
seen in (update exclusion). Below order 0 all unseen symbols share the rest evenly. 257 symbols: the bytes and the end of the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import LOWER, fold, release_memory, sliced, table, texts
from playtide.session import written

#: Bytes of context. Each symbol takes 9 bits, so a gram of seven symbols still fits a long.
ORDER = 5
BITS, END = 9, 257
#: What an unseen word adds to the base score, before its share of the total.
HALF = math.log10(0.5)
#: Text bytes of a block of documents, and of a step within it.
BLOCK_BYTES, STEP_BYTES = 32 << 20, 1 << 20
#: Rows of a batch that a block sends.
SENT = 100_000
#: Rows taken out of a batch at a time.
PACKED = 500
BLOCK = "block long, ids array<long>, learn array<boolean>, lengths array<long>, steps array<long>, packed array<binary>"


def grams(docs: list[bytes], order: int = ORDER) -> np.ndarray:
    """The packed (context, symbol) of every byte and end of text. Contexts before a text's first byte are zeros."""
    symbols = np.zeros(sum(len(x) + order + 1 for x in docs), np.int64)
    at = 0
    for x in docs:
        at += order
        symbols[at:at + len(x)] = np.frombuffer(x, np.uint8)
        symbols[at:at + len(x)] += 1
        at += len(x) + 1
        symbols[at - 1] = END
    packed = symbols.copy()
    for j in range(1, order + 1):
        packed[j:] |= symbols[:-j] << (BITS * j)
    return packed[symbols > 0]


def _summed(parts: list[tuple], of: pa.DataType) -> tuple[pa.Array, np.ndarray]:
    """Distinct keys of all (keys, counts) and the sums of their counts."""
    keys = pa.chunked_array([pa.array(k, of) for k, _ in parts], of).combine_chunks().dictionary_encode()
    sums = np.bincount(keys.indices.to_numpy(), weights=np.concatenate([n for _, n in parts]), minlength=len(keys.dictionary))
    return keys.dictionary, sums.astype(np.int64)


def _pack(batches):
    """Blocks of whole documents, lower-cased, in the order they come; a block is compressed step by step."""
    ids, learn, docs, size, block = [], [], [], 0, TaskContext.get().partitionId() << 32

    def packed() -> pa.RecordBatch:
        parts = sliced(docs, STEP_BYTES)
        longs = pa.list_(pa.int64())
        return pa.record_batch([
            pa.array([block], pa.int64()), pa.array([ids], longs), pa.array([learn], pa.list_(pa.bool_())),
            pa.array([[len(x) for x in docs]], longs), pa.array([[part.stop for part in parts]], longs),
            pa.array([[zstandard.compress(b"".join(docs[part]), 3) for part in parts]], pa.list_(pa.binary())),
        ], ["block", "ids", "learn", "lengths", "steps", "packed"])

    for batch in batches:
        for i in range(0, len(batch), PACKED):
            some = batch.slice(i, PACKED)
            for doc_id, learnt, text in zip(some["doc_id"].to_pylist(), some["learn"].to_pylist(), texts(some["text"])):
                if size and size + len(text) > BLOCK_BYTES:
                    yield packed()
                    ids, learn, docs, size, block = [], [], [], 0, block + 1
                ids.append(doc_id)
                learn.append(learnt)
                docs.append(text.translate(LOWER))
                size += len(text)
    if ids:
        yield packed()
    del docs
    release_memory()


class _Block:
    """A packed block's texts, unpacked a step at a time."""

    def __init__(self, row: dict):
        self.learn, self.lengths = np.array(row["learn"], bool), np.array(row["lengths"], np.int64)
        borders = [0, *row["steps"]]
        self.parts = [slice(a, b) for a, b in zip(borders, borders[1:])]
        self.packed = dict(zip(borders, row["packed"]))

    def texts(self, part: slice) -> list[bytes]:
        flat, ends = zstandard.decompress(self.packed[part.start]), np.cumsum(self.lengths[part])
        return [flat[a:b] for a, b in zip((ends - self.lengths[part]).tolist(), ends.tolist())]


def _words(docs: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts, dictionary-encoded, and how many each text has."""
    split = [x.split() for x in docs]
    return pa.array([w for x in split for w in x], pa.binary()).dictionary_encode(), np.array([len(x) for x in split])


def _merged(parts: Iterable[tuple], merge) -> tuple:
    """All (keys, counts) merged, a few at a time, so that little more than the distinct keys is held."""
    held: list[tuple] = []
    for part in parts:
        held.append(part)
        if len(held) == 5:
            held = [merge(held)]
    return merge(held)


def _distinct_words(parts: Iterable[tuple[pa.DictionaryArray, np.ndarray]], learn: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """The block's distinct words, and how often its learnt texts have them."""
    return _merged((
        (found.dictionary, np.bincount(found.indices.to_numpy(), weights=np.repeat(learnt, lengths), minlength=len(found.dictionary)))
        for (found, lengths), learnt in zip(parts, learn)), lambda held: _summed(held, pa.binary()))


def _distinct_grams(block: _Block) -> tuple[np.ndarray, np.ndarray]:
    """The block's distinct grams in order, and how often its learnt texts have them."""
    def counted(part: slice) -> tuple[np.ndarray, np.ndarray]:
        places, distinct = pd.factorize(grams(block.texts(part)))
        weights = np.repeat(block.learn[part], block.lengths[part] + 1)
        return distinct, np.bincount(places, weights=weights, minlength=len(distinct))

    def merge(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(at, weights=np.concatenate([n for _, n in held]), minlength=len(keys)).astype(np.int64)

    return _merged(map(counted, block.parts), merge)


def _sent(block: int, word: pa.Array, gram: pa.Array, n: np.ndarray) -> Iterable[pa.RecordBatch]:
    for i in range(0, len(n), SENT):
        part = n[i:i + SENT]
        yield pa.record_batch(
            [pa.array(np.full(len(part), block)), word.slice(i, SENT), gram.slice(i, SENT), pa.array(part)], ["block", "word", "gram", "n"])


def _counts(batches):
    for batch in batches:
        for row in batch.to_pylist():
            block = _Block(row)
            # Each kind is sent in order: rows compress far better then.
            word, n = _distinct_words((_words(block.texts(part)) for part in block.parts), [block.learn[part] for part in block.parts])
            order = pc.sort_indices(word)
            yield from _sent(row["block"], word.take(order), pa.nulls(len(word), pa.int64()), n[order.to_numpy()])
            del word, order, n
            release_memory()
            gram, n = _distinct_grams(block)
            yield from _sent(row["block"], pa.nulls(len(gram), pa.binary()), pa.array(gram), n)
            del block, gram, n
            release_memory()


class _Level:
    """Contexts of one order: totals R, distinct symbols D, and for each the same over the next shorter context's counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, shorter: _Level | None, mask: int):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        self.contexts, at = np.unique(self.keys >> BITS, return_inverse=True)
        self.total = np.bincount(at, weights=self.counts, minlength=len(self.contexts))
        self.distinct = np.bincount(at, minlength=len(self.contexts))
        if shorter is not None:
            below, _ = shorter.lookup(self.keys & mask)
            self.excluded = np.bincount(at, weights=shorter.counts[below] if len(below) else None, minlength=len(self.contexts))

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _find(self.keys, keys)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key and whether it is there (the place is 0 if not)."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    there = sorted_keys[at] == keys
    return np.where(there, at, 0), there


def _mask(order: int) -> int:
    return (1 << BITS * (order + 1)) - 1


def gram_log10(gram: np.ndarray, n: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], order: int = ORDER) -> np.ndarray:
    """log10 of each gram's probability.

    ``gram`` holds all grams, seen in training (n > 0) or not, that share their last two context symbols, or whole such
    groups; ``pairs`` the order-1 grams of the whole corpus and in how many longer contexts each was seen.
    """
    keys, counts = gram[n > 0], n[n > 0]
    raw = {order: (keys, counts)}
    for k in range(order, 2, -1):
        keys, at = np.unique(keys & _mask(k - 1), return_inverse=True)
        raw[k - 1] = (keys, np.bincount(at, minlength=len(keys)))
    raw[1] = pairs
    keys, at = np.unique(pairs[0] & _mask(0), return_inverse=True)
    raw[0] = (keys, np.bincount(at, minlength=len(keys)))
    levels: list[_Level] = []
    for k in range(order + 1):
        levels.append(_Level(*raw[k], levels[-1] if k else None, _mask(k - 1) if k else 0))

    out, open_ = np.zeros(len(gram)), np.ones(len(gram), bool)
    less_total, less_distinct = np.zeros(len(gram)), np.zeros(len(gram))
    for k in range(order, -1, -1):
        level, wanted = levels[k], gram & _mask(k)
        at, known = _find(level.contexts, wanted >> BITS)
        if not len(level.contexts):
            continue
        total, distinct = level.total[at] - less_total, level.distinct[at] - less_distinct
        symbol, hit = level.lookup(wanted)
        hit &= open_ & known
        out[hit] += np.log10((2 * level.counts[symbol[hit]] - 1) / (2 * total[hit]))
        open_ &= ~hit
        escape = open_ & known & (distinct > 0)
        out[escape] += np.log10(distinct[escape] / (2 * total[escape]))
        if k:
            less_total = np.where(known, level.excluded[at], 0)
            less_distinct = np.where(known, level.distinct[at], 0)
    out[open_] -= math.log10(END - len(levels[0].keys))
    return out


def _model_block(pairs: tuple[np.ndarray, np.ndarray]):
    def run(rows: pa.Table) -> pa.Table:
        gram, n = rows["gram"].to_numpy(), rows["n"].to_numpy()
        return pa.table({"gram": gram, "value": gram_log10(gram, n, pairs)})

    return run


def _score_block(key: tuple, packed: pa.Table, lexicon: pa.Table) -> pa.Table:
    row = packed.to_pylist()[0]
    block = _Block(row)
    is_gram = pc.is_valid(lexicon["gram"])
    gram, gram_value = lexicon["gram"].filter(is_gram).to_numpy(), lexicon["value"].filter(is_gram).to_numpy()
    order = np.argsort(gram)
    gram, gram_value = gram[order], gram_value[order]
    del is_gram, order
    # Words of learnt texts, by the block's own count; then those that others hold too, by the whole count.
    split = [_words(block.texts(part)) for part in block.parts]
    words_of = [lengths for _, lengths in split]
    # One dictionary for all steps, so that a word's value is found by its place.
    found = pa.chunked_array([words for words, _ in split]).unify_dictionaries().chunks
    del split
    word, n = found[0].dictionary, 0
    for part, words, lengths in zip(block.parts, found, words_of):
        n = n + np.bincount(words.indices.to_numpy(), weights=np.repeat(block.learn[part], lengths), minlength=len(word))
    word_value, is_word = np.log10(n + 0.5), pc.is_valid(lexicon["word"])
    shared = lexicon["word"].filter(is_word).combine_chunks()
    word_value[pc.index_in(shared, word).to_numpy()] = lexicon["value"].filter(is_word).to_numpy()
    del word, shared, is_word, n
    release_memory()
    n_tokens, n_known, base, scores = [], [], [], []
    # The base score needs N and V, which come later: only the sum of log10(c + 0.5) is taken here.
    for part, words, lengths in zip(block.parts, found, words_of):
        places, distinct = pd.factorize(grams(block.texts(part)))
        logs = gram_value[np.searchsorted(gram, distinct)][places]
        ends = np.cumsum(block.lengths[part] + 1)
        scores.append(np.add.reduceat(logs, np.concatenate([[0], ends[:-1]])))
        got = word_value[words.indices.to_numpy()]
        size = len(lengths)
        owner = np.repeat(np.arange(size), lengths)
        n_tokens.append(lengths + 1)
        n_known.append(np.bincount(owner, weights=got > HALF, minlength=size).astype(np.int64))
        base.append(np.bincount(owner, weights=got, minlength=size))
    scored = pa.table({
        "doc_id": pa.array(row["ids"], pa.int64()), "learn": block.learn, "n_tokens": np.concatenate(n_tokens), "n_known": np.concatenate(n_known),
        "word_log10": np.concatenate(base), "score": np.concatenate(scores),
    })
    del row, block, gram, gram_value, found, words, word_value
    release_memory()
    return scored


def score(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every row of ``docs`` by the model learnt from the rows where ``learn`` holds.

    Returns doc_id, learn, n_tokens (words and one end), n_known (tokens seen in training), train_tokens, base_score (log10 under
    add-half unigram counts of the tokens) and score (log10 the trie gives to the lower-cased text and its end).

    A null text counts as empty and still has its end; a null ``learn`` as false; repeated rows are scored, and learnt from, each;
    other columns are not read. Without training rows every byte has probability 1 / 257. An empty table gives an empty table.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    blocks = written(rows.mapInArrow(_pack, BLOCK), "ppm-blocks")
    needed = written(blocks.mapInArrow(_counts, "block long, word binary, gram long, n long"), "ppm-needed", compression="zstd")
    words = written(needed.filter("word is not null and n > 0").groupBy("word").agg(F.sum("n").alias("total")), "ppm-words")
    gram = written(needed.filter("gram is not null").groupBy("gram").agg(F.sum("n").alias("n")), "ppm-grams")

    # Order-1 grams with the number of order-2 contexts they were seen in: at most 258 x 257 rows.
    wide = gram.filter("n > 0").select(F.col("gram").bitwiseAND(_mask(2)).alias("wide")).distinct()
    pairs = wide.groupBy(F.col("wide").bitwiseAND(_mask(1)).alias("pair")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    pairs = (pairs["pair"].to_numpy(np.int64), pairs["n"].to_numpy(np.int64))
    buckets = max(1, math.ceil(gram.count() / 250_000))
    model = gram.withColumn(
        "bucket", F.pmod(F.xxhash64(F.shiftright("gram", BITS).bitwiseAND(_mask(1))), F.lit(buckets))
    ).groupBy("bucket").applyInArrow(_model_block(pairs), "gram long, value double")

    elsewhere = needed.filter("word is not null").join(words, "word").filter("n != total")
    lexicon = needed.filter("gram is not null").select("block", "gram").join(model, "gram").select(
        "block", F.lit(None).cast("binary").alias("word"), "gram", "value"
    ).union(elsewhere.select("block", "word", F.lit(None).cast("long"), F.log10(F.col("total") + 0.5)))
    scored = blocks.groupBy("block").cogroup(lexicon.groupBy("block")).applyInArrow(
        _score_block, "doc_id long, learn boolean, n_tokens long, n_known long, word_log10 double, score double")
    totals = words.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = rows.agg(F.count_if("learn")).first()[0]
    total, distinct = totals["n"] + ends, totals["v"] + (1 if ends else 0)
    spread = math.log10(total + 0.5 * (distinct + 1))
    return scored.select(
        "doc_id", "learn", "n_tokens",
        (F.col("n_known") + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("word_log10") + F.lit(math.log10(ends + 0.5)) - F.col("n_tokens") * F.lit(spread)).alias("base_score"),
        "score",
    )


def op1_lm_scoring(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = score(docs, fold(F.col("doc_id")) != 1)
    return scored.withColumn("held_out", ~F.col("learn")).drop("learn")
