"""Sharding by best-fit-decreasing bin packing of indivisible groups into bins of fixed capacity.

Groups of one size are alike to the packing, so it runs on the histogram of group sizes: all groups of a size go, as many as fit,
into the open bin with the least room that holds one. That is the item-by-item result, in steps that grow with the distinct
sizes (at most the square root of twice the total size) instead of the groups. Which group goes where follows from its rank
among the groups of its size, a join; no task or driver holds the groups.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import positions, table
from playtide.session import written

#: Rows numbered by one task.
CHUNK_ROWS = 100_000


class Rooms:
    """Open bins by (room, bin) in an AVL tree: add, remove, and the tightest bin with at least so much room."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    def _node(self, key, left, right):
        return key, left, right, 1 + max(self._height(left), self._height(right))

    def _balanced(self, key, left, right):
        lean = self._height(left) - self._height(right)
        if lean > 1:
            if self._height(left[1]) < self._height(left[2]):
                middle = left[2]
                left = self._node(middle[0], self._node(left[0], left[1], middle[1]), middle[2])
            return self._node(left[0], left[1], self._node(key, left[2], right))
        if lean < -1:
            if self._height(right[2]) < self._height(right[1]):
                middle = right[1]
                right = self._node(middle[0], middle[1], self._node(right[0], middle[2], right[2]))
            return self._node(right[0], self._node(key, left, right[1]), right[2])
        return self._node(key, left, right)

    def _add(self, node, key):
        if not node:
            return self._node(key, None, None)
        if key < node[0]:
            return self._balanced(node[0], self._add(node[1], key), node[2])
        return self._balanced(node[0], node[1], self._add(node[2], key))

    def _remove(self, node, key):
        if key < node[0]:
            return self._balanced(node[0], self._remove(node[1], key), node[2])
        if key > node[0]:
            return self._balanced(node[0], node[1], self._remove(node[2], key))
        if not node[1] or not node[2]:
            return node[1] or node[2]
        least = node[2]
        while least[1]:
            least = least[1]
        return self._balanced(least[0], node[1], self._remove(node[2], least[0]))

    def add(self, room: int, number: int) -> None:
        self.root = self._add(self.root, (room, number))

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the (room, bin) of least room >= size, the lowest bin among equals."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        if best is not None:
            self.root = self._remove(self.root, best)
        return best


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int, int]] | None:
    """(size, first rank, last rank + 1, bin) of each run of equal groups, for (size, count) pairs.

    None if more than ``most`` bins are needed. A group larger than the capacity gets a bin of its own.
    """
    rooms, bins, out = Rooms(), 0, []
    for size, count in sorted(sizes, reverse=True):
        rank = 0
        while rank < count:
            found = rooms.take(size)
            if found is None:
                found, bins = (max(capacity, size), bins), bins + 1
                if most is not None and bins > most:
                    return None
            room, number = found
            n = min(count - rank, room // size if size else count - rank)
            out.append((size, rank, rank + n, number))
            rooms.add(room - n * size, number)
            rank += n
    return out


def least_capacity(sizes: list[tuple[int, int]], bins: int) -> int:
    """A smallest capacity (by halving) with which ``bins`` bins are enough, so that they fill alike."""
    total = sum(s * n for s, n in sizes)
    low = max(math.ceil(total / bins), max((s for s, _ in sizes), default=1))
    high = low
    while best_fit_decreasing(sizes, high, bins) is None:
        high += max(1, (high - low) or high // 1000)
    while low < high:
        middle = (low + high) // 2
        if best_fit_decreasing(sizes, middle, bins) is None:
            low = middle + 1
        else:
            high = middle
    return high


def spread(sizes: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int, int]]:
    """Runs as of ``best_fit_decreasing`` over at most ``bins`` bins that fill alike, as far as the groups allow.

    A group larger than its bin's even share of what remains has a bin of its own, and does not set the others' capacity.
    """
    left, out = sorted(sizes, reverse=True), []
    rest, alone = sum(s * n for s, n in left), dict.fromkeys((s for s, _ in left), 0)
    for size, count in left:
        while alone[size] < count and bins - len(out) > 1 and size * (bins - len(out)) > rest:
            out.append((size, alone[size], alone[size] + 1, len(out)))
            alone[size] += 1
            rest -= size
        if alone[size] < count:
            break
    first = len(out)
    left = [(s, n - alone[s]) for s, n in left if n > alone[s]]
    runs = best_fit_decreasing(left, least_capacity(left, bins - first))
    return out + [(s, low + alone[s], high + alone[s], number + first) for s, low, high, number in runs]


def pack(
    docs: DataFrame, capacity: int | None = None, bins: int | None = None, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Put documents into shards of at most ``capacity`` bytes, as few as the method finds, or into ``bins`` shards that fill alike.

    Returns doc_id, size (UTF-8 bytes and 1), text_crc32, shard and slot (place within the shard, from 0). Rows with equal text stay
    together; a null text counts as empty. Ranks follow the text's hash, slots the hash of the id; repeated rows each have a
    slot. A group larger than the capacity has a shard of its own. Other columns are not read; an empty table stays empty.
    """
    value = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = written(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(value) + 1).cast("long").alias("size"), F.crc32(value).alias("text_crc32"),
        F.unhex(F.sha2(value, 256)).alias("digest")), "pack-rows")
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("total")), "pack-groups")

    def planned(runs):
        histogram = [(int(s), int(n)) for part in runs for s, n in zip(part["total"], part["count"])]
        runs = best_fit_decreasing(histogram, capacity) if capacity else spread(histogram, bins or 1)
        yield pd.DataFrame(runs, columns=["total", "low", "high", "shard"])

    # The histogram has at most sqrt(2 x total size) rows, and meets in one task.
    plan = written(
        groups.groupBy("total").count().coalesce(1).mapInPandas(planned, "total long, low long, high long, shard int"), "pack-plan")
    chunks = max(1, math.ceil(rows.count() / CHUNK_ROWS))
    ranked = positions(groups, ["total"], F.pmod(F.xxhash64("digest"), F.lit(chunks)), [F.col("digest")], "rank")
    placed = ranked.join(plan, "total").filter("rank >= low and rank < high").select("digest", "shard")
    sharded = written(rows.join(placed, "digest").drop("digest"), "pack-shards")
    return positions(
        sharded, ["shard"], F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(chunks)), [F.col("doc_id"), F.col("text_crc32")], "slot")


def op2_sharding(spark, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), bins=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
