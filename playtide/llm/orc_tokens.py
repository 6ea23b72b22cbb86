"""Token ids in ORC files: ascending document ids, integer run-length encoding, row indexes and Bloom filters on the id.

Documents are range-partitioned and sorted by id, encoded, and written by Spark's ORC writer, a file for each range. Readers take
stripes in parallel, and a filter on the id skips files, stripes and row groups by their statistics and Bloom filters.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playtide.llm.common import block_count, ranges, release_memory, table
from playtide.llm.units import UNIT_BYTES, UnitTable, in_a_row
from playtide.session import work_path, written

#: Id appended to each document.
END_ID = 0
#: Text bytes of a file, and of a step within a task.
FILE_BYTES, STEP_BYTES = 16 << 20, 4 << 20
#: Units encoded at once.
JOINED = 100
#: Bytes a worker may spend on units it remembers.
HELD_BYTES = 100 << 20
#: What is cut off a word's end, and the letters and digits it must follow there: those that every Unicode version knows as such.
PUNCTUATION = string.punctuation
LETTER_LAST = r"[0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}\x{400}-\x{481}]$"
OPTIONS = {
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.row.index.stride": "1000", "orc.create.index": "true",
    "orc.stripe.size": str(4 << 20), "orc.rows.between.memory.checks": "500", "compression": "zstd",
}
SCHEMA = "doc_id long, part int, place long, ids array<int>"


def strings(column: pa.Array) -> list[str]:
    """``to_pylist`` for texts without nulls, by way of NumPy, several times as fast."""
    return column.to_numpy(zero_copy_only=False).tolist()


class RecentUnits(UnitTable):
    """When too much is remembered, keeps what came again in a later step: most units come once."""

    def _clear(self) -> None:
        super()._clear()
        self.again = np.zeros(0, bool)

    def forget(self) -> None:
        if self.held <= HELD_BYTES:
            return
        names, places = list(self.index), np.nonzero(self.again)[0]
        kept = [names[k] for k in places]
        ids, lengths = self.tokens(places, np.arange(len(places) + 1))
        self._clear()
        size = sum(map(len, kept)) + UNIT_BYTES * len(kept)
        if 2 * size <= HELD_BYTES:
            self.index.update(zip(kept, range(len(kept))))
            self.ids, self.starts, self.lengths = ids, np.cumsum(lengths) - lengths, lengths
            self.held, self.again = size, np.zeros(len(kept), bool)

    def met(self, numbers: np.ndarray, known: int) -> None:
        """Note which units numbered below ``known`` are among ``numbers``."""
        self.again = np.concatenate([self.again, np.zeros(len(self.index) - len(self.again), bool)])
        self.again[numbers[numbers < known]] = True


class ByteTokenizer:
    """A byte-level tokenizer file, applied unit by unit, by what its pattern never joins: a blank or a line feed to a character before it
    that is not white space, punctuation to a letter or digit before it. Of white space before something else only the last character is
    cut off, so two in a row are cut singly.

    Arrow splits most texts before blanks and line feeds and numbers the distinct words of a step; a word stands for itself with a blank
    in front. Its punctuation at the end is a unit of its own. Only units are looked up, only new ones encoded, and a text's ids are
    gathered from those of the step's words. Texts with more white space in a row, or with one of the tokenizer's added tokens, which the
    library cuts out first, are split one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A token's text has one character for each of its bytes.
        self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.bytes_of[number] = len(token)
        self.blank = re.compile(r"(?<=\S)(?= )")
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(f"({'|'.join(map(re.escape, added))})") if added else None
        # All that is white space to any of the libraries at hand.
        space = r"[\p{Z}\t-\r\x1c-\x1f\x{85}]"
        self.special = "|".join([f"{space}{{3}}", rf"{space}{{2}}\z", *(re.escape(t) for t in added)])
        self.table = RecentUnits(lambda text: [text], self.encode_many)

    def units(self, text: str) -> list[str]:
        parts = self.added.split(text) if self.added else [text]
        return [u for i, part in enumerate(parts) for u in ([part] if i % 2 else self.blank.split(part))]

    def encode_many(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units that begin with a blank or a line feed and end without white space keep their borders when joined, so many are encoded
        at once; the tokens' lengths in bytes tell where each unit ends. The others are encoded one by one."""
        lengths = np.zeros(len(units), np.int64)
        joined = np.array([u[:1] in (" ", "\n") and not u[-1].isspace() for u in units], bool)
        places, alone = np.nonzero(joined)[0], np.nonzero(~joined)[0]
        led = units if len(places) == len(units) else [units[k] for k in places]
        ids, _ = self._library(["".join(led[i:i + JOINED]) for i in range(0, len(led), JOINED)])
        ends = np.cumsum(pc.binary_length(pa.array(led, pa.string())).to_numpy(), dtype=np.int64)
        lengths[places] = np.diff(np.searchsorted(np.cumsum(self.bytes_of[ids]), ends), prepend=-1)
        rest, lengths[alone] = self._library([units[k] for k in alone])
        # Back to the order of the units.
        flat, order = np.concatenate([ids, rest]), np.concatenate([places, alone])
        firsts = np.zeros(len(units), np.int64)
        firsts[order] = np.cumsum(lengths[order]) - lengths[order]
        return flat[ranges(firsts, lengths)], lengths

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids without the places in the text, which it would work out too."""
        return in_a_row(self.tokenizer.encode_batch_fast([x], add_special_tokens=False)[0].ids for x in texts)

    def _numbered(self, units: pa.Array) -> np.ndarray:
        found = pc.dictionary_encode(units)
        numbers = np.fromiter(map(self.table.index.__getitem__, strings(found.dictionary)), np.int64, len(found.dictionary))
        return numbers[found.indices.to_numpy()]

    def _cut(self, words: pa.Array) -> np.ndarray:
        """Numbers of the two units of each word: with a blank in front, unless a line feed leads it, and its punctuation at the end."""
        trimmed = pc.utf8_rtrim(words, PUNCTUATION)
        shorter = pc.and_(pc.not_equal(pc.binary_length(trimmed), pc.binary_length(words)), pc.match_substring_regex(trimmed, LETTER_LAST))
        cores = pc.if_else(shorter, trimmed, words)
        led = pc.if_else(pc.starts_with(cores, "\n"), cores, pc.binary_join_element_wise("", cores, " "))
        index = self.table.index
        out = np.full((len(words), 2), index[""], np.int64)
        out[:, 0] = self._numbered(led)
        whole, kept = strings(words.filter(shorter)), strings(trimmed.filter(shorter))
        out[shorter.to_numpy(zero_copy_only=False), 1] = [index[w[len(k):]] for w, k in zip(whole, kept)]
        return out

    def encode(self, docs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts (no nulls) in a row, and how many each has."""
        table = self.table
        table.forget()
        index, known = table.index, len(table.index)
        odd = pc.match_substring_regex(docs, self.special)
        split = pc.split_pattern(pc.replace_substring(docs.filter(pc.invert(odd)), "\n", " \n"), " ")
        counts = np.diff(split.offsets.to_numpy())
        words = pc.dictionary_encode(split.flatten())
        cut = self._cut(words.dictionary)
        # The first word of a text has no blank in front.
        firsts = np.cumsum(counts) - counts
        units = [self.units(x) for x in docs.filter(odd).to_pylist()]
        alone = [index[u] for u in chain(strings(words.take(pa.array(firsts)).cast(pa.string())), *units)]
        table.learn(known)
        numbers = np.concatenate([cut.ravel(), np.array(alone, np.int64)])
        table.met(numbers, known)
        # The step's words and what stands alone, each with its ids in a row.
        borders = np.concatenate([2 * np.arange(len(cut)), 2 * len(cut) + np.arange(len(alone) + 1)])
        found, sizes = table.tokens(numbers, borders)
        flat = np.concatenate([words.indices.to_numpy(), np.arange(len(cut) + len(firsts), len(sizes))])
        flat[firsts] = len(cut) + np.arange(len(firsts))
        lengths = sizes[flat]
        ids = found[ranges((np.cumsum(sizes) - sizes)[flat], lengths)]
        ends = np.cumsum([*counts, *(len(x) for x in units)], dtype=np.int64)
        lengths = np.diff(np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], ends])])
        if not units:
            return ids, lengths
        # Back to the order of the texts.
        mask = odd.to_numpy(zero_copy_only=False)
        order = np.concatenate([np.nonzero(~mask)[0], np.nonzero(mask)[0]])
        starts, counts = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        starts[order], counts[order] = np.cumsum(lengths) - lengths, lengths
        return ids[ranges(starts, counts)], counts


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


def _encoded(path: str, end: int):
    def run(batches):
        known, place = tokenizer(path), 0
        for batch in batches:
            column = pc.fill_null(batch["text"], "")
            for part in sliced_lengths(pc.binary_length(column).to_numpy(zero_copy_only=False), STEP_BYTES):
                count = part.stop - part.start
                ids, lengths = known.encode(column.slice(part.start, count))
                borders = np.concatenate([[0], np.cumsum(lengths + 1)])
                out = np.full(borders[-1], end, np.int32)
                body = np.ones(borders[-1], bool)
                body[borders[1:] - 1] = False
                out[body] = ids
                slice_ = [batch[c].slice(part.start, count) for c in ("doc_id", "part")]
                yield pa.record_batch(
                    [*slice_, pa.array(np.arange(place, place + count)), pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(out))],
                    ["doc_id", "part", "place", "ids"])
                place += count
        release_memory()

    return run


def sliced_lengths(lengths: np.ndarray, most: int) -> list[slice]:
    """Runs of whole texts of at most ``most`` bytes (or one text), to bound a step's memory."""
    out, start, size = [], 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > most:
            out.append(slice(start, i))
            start, size = i, 0
        size += n
    return [*out, slice(start, len(lengths))] if start < len(lengths) else out


def write_tokens(
    docs: DataFrame, path: str, model: str, end: int = END_ID, doc_id: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES,
    **options: str,
) -> None:
    """Encode every text by the tokenizer file ``model``, as the library does when it is loaded, append ``end``, and write ORC below ``path``.

    Files hold ascending ranges of doc_id, numbered by the column part; ``place`` numbers a file's rows. Rows of one id follow as they
    are read, so one id may fill many files. A null text counts as empty and a null id sorts first. Repeated rows are written
    each; other columns are not read; an empty table writes no rows. ``options`` go to the writer.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    files = block_count(rows, F.col("text"), file_bytes)
    told = rows.withColumn("_row", F.monotonically_increasing_id())
    ranged = told.repartitionByRange(files, "doc_id", "_row").sortWithinPartitions("doc_id", "_row")
    parts = ranged.select("doc_id", F.spark_partition_id().alias("part"), "text")
    parts.mapInArrow(_encoded(model, end), SCHEMA).write.options(**{**OPTIONS, **options}).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The written rows; ``doc_ids`` are pushed down to the files' indexes."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


def _measured(batches):
    for batch in batches:
        ids = batch["ids"]
        borders, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4")
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(borders[:-1], borders[1:])]
        yield pa.record_batch([
            batch["doc_id"], batch["part"], batch["place"], pa.array(np.diff(borders).astype(np.int64)), pa.array(crc, pa.int64())],
            ["doc_id", "part", "place", "n_tokens", "ids_crc32"])


def token_index(tokens: DataFrame) -> DataFrame:
    """doc_id, start (ids of all rows before it in the files), n_tokens and ids_crc32, read from the written rows.

    Each file's lengths are summed on their own; a table with one row per file carries what came before.
    """
    rows = written(tokens.mapInArrow(_measured, "doc_id long, part int, place long, n_tokens long, ids_crc32 long"), "token-lengths")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    offsets = sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(offsets, "part").select(
        "doc_id", (F.col("offset") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_token_ids_orc(spark, folder: str) -> DataFrame:
    path = work_path(spark, "token-ids")
    write_tokens(table(spark, folder, "documents"), path, model_path())
    return token_index(read_tokens(spark, path))
