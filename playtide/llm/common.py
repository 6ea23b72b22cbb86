"""What several operators share: words, folds, blocks of documents, prefix sums."""

from __future__ import annotations

import ctypes
import gc
import math
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playtide.session import written

#: White space of the contracts: blank and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
#: Lower-cases A-Z only, as the contracts ask; bytes.split() then splits at exactly SPACE.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tagged(docs: DataFrame, purpose: str) -> DataFrame:
    """``docs`` in a written table, with a number for each row (_row): ids may be missing or repeated."""
    return written(docs.withColumn("_row", F.monotonically_increasing_id()), purpose, compression="zstd")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def block_count(df: DataFrame, text: Column, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` the texts fill; at least two for each core."""
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(math.ceil(total / block_bytes), 2 * df.sparkSession.sparkContext.defaultParallelism)


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def sliced(items: list[bytes], most: int) -> list[slice]:
    """Runs of whole texts of at most ``most`` bytes (or one text), to bound a step's memory."""
    out, start, size = [], 0, 0
    for i, x in enumerate(items):
        if size and size + len(x) > most:
            out.append(slice(start, i))
            start, size = i, 0
        size += len(x)
    return [*out, slice(start, len(items))] if start < len(items) else out


def release_memory() -> None:
    """Give freed memory back to the system: a worker lives on after its task, next to others on the same executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated index ranges [start, start + length)."""
    total = int(lengths.sum())
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - firsts, lengths)


def positions(df: DataFrame, keys: list[str], chunk: Column, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: the row's place from 0 by (chunk, order) within ``keys``.

    Rows are numbered within a chunk; a table with one row per chunk carries how many rows came before. So no task sorts
    more than a chunk, however many rows a key has.
    """
    rows = df.withColumn("_chunk", chunk)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(*order)).cast("long") - 1
    numbered = rows.withColumn("_within", within)
    return numbered.join(offsets, [*keys, "_chunk"]).withColumn(name, F.col("_before") + F.col("_within")).drop(
        "_chunk", "_before", "_within")


def numbered(rows: DataFrame, group: list[str], order: list[str], purpose: str) -> DataFrame:
    """Add ``tree`` (a number for each group, ascending with it), ``pos`` (the row's place from 0 within its group) and ``n`` (its size).

    ``order`` must tell all rows of a group apart. Rows are range-partitioned by (group, order), so a large group is spread over many
    tasks; a written table with one row per group and partition carries how many rows came before. Nulls sort first.
    """
    sorted_ = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    kept = written(sorted_.withColumn("_at", F.monotonically_increasing_id()), purpose, compression="zstd")
    part = F.shiftright("_at", 33)
    runs = kept.groupBy(*(F.col(c).alias(f"_{c}") for c in group), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*(f"_{c}" for c in group))
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(runs.select(
        "*", F.min("_first").over(whole).alias("tree"), F.sum("_n").over(whole).alias("n"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).drop("_n"), f"{purpose}-runs")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group], part == F.col("_part"))
    return kept.join(runs, same).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).select(*rows.columns, "tree", "pos", "n")
