"""A leaderboard that is kept up: pages at any offset and ranks without sorting the rows before them.

A result is six digits of 16 bits. The index counts the rows and the distinct results below each prefix of digits, so "which result holds
row k" and "how many results are better" are answered digit by digit, from at most 65,537 counts each. New scores add signed
counts and rows for the users they move; nothing is built anew.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.plans.serving import DEFAULT_PAGE, MAX_PAGE, best_rows, result_digits
from playtide.session import collected, drop, written
from playtide.sources.tiered import FANOUT, KeyedState, TieredTable

DIGITS = [f"_d{n}{half}" for n in range(3) for half in "ab"]
#: Rows of one result that a page may pass over by taking them; a longer tie is first narrowed by the users' names.
MOST_PASSED = 4096


def _live(columns: list[str]):
    """A merge that adds up the signed ``columns`` of equal rows and forgets what cancels out."""
    def merge(rows: DataFrame, oldest: bool = False) -> DataFrame:
        keys = [c for c in rows.columns if c not in columns]
        summed = rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in columns))
        return summed.filter(reduce(or_, (F.col(c) != 0 for c in columns))).select(*rows.columns)

    return merge


class RankedBoard:
    """The board below ``root``, a folder every executor reaches. ``schema`` is that of the best rows it is fed with."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, buckets: int = 16, fanout: int = FANOUT):
        self.spark, self.schema = spark, schema
        digits = [T.StructField(d, T.LongType()) for d in DIGITS]
        long = lambda *names: [T.StructField(name, T.LongType()) for name in names]
        self.entries = KeyedState(spark, f"{root}/entries", schema, ["user_key"], buckets, fanout)
        self.rows = TieredTable(
            spark, f"{root}/rows", T.StructType([*digits, *schema.fields, *long("n")]), _live(["n"]), [*DIGITS, "user_key"], fanout=fanout)
        self.counts = TieredTable(
            spark, f"{root}/counts", T.StructType([*long("depth"), *digits, *long("rows", "results")]), _live(["rows", "results"]),
            ["depth", *DIGITS], fanout=fanout)

    def commit(self, best: DataFrame, number: int) -> None:
        """Add the scores of micro-batch ``number``; a user's row moves if one of them is better. Repeating a micro-batch changes nothing."""
        columns = self.schema.names
        with collected() as tables:
            fresh = written(best_rows(best.select(*columns)), "board-fresh")
            old = written(self.entries.of(fresh, number), "board-old")
            now = written(best_rows(old.unionByName(fresh)), "board-now")
            signed = old.withColumn("n", F.lit(-1).cast("long")).unionByName(now.withColumn("n", F.lit(1).cast("long")))
            moved = written(_live(["n"])(signed).withColumns(result_digits()), "board-moved")
            leaves = written(moved.groupBy(*DIGITS).agg(F.sum("n").alias("rows")).filter("rows != 0"), "board-results")
            held = self.counts.read(len(DIGITS), before=number).join(leaves.select(*DIGITS), DIGITS, "left_semi")
            held = held.groupBy(*DIGITS).agg(F.sum("rows").alias("held"))
            # A result appears with its first row and goes with its last.
            before = F.coalesce("held", F.lit(0))
            appeared = (before + F.col("rows") > 0).cast("long") - (before > 0).cast("long")
            changes = leaves.join(held, DIGITS, "left").select(
                F.explode(F.array(*(F.lit(i + 1).cast("long") for i in range(len(DIGITS))))).alias("depth"), *DIGITS, "rows", appeared.alias("results"))
            prefixes = changes.withColumns({d: F.when(F.col("depth") > i, F.col(d)) for i, d in enumerate(DIGITS)})
            self.counts.commit(_live(["rows", "results"])(prefixes), number)
            self.rows.commit(moved, number)
            self.entries.commit(now, number)
        for folder in tables:
            drop(self.spark, folder)

    def _holding(self, at: int) -> tuple[list[int], int, int] | None:
        """The digits of the result that holds row ``at`` of the board, the row's place among those of it, and the better results."""
        prefix: list[int] = []
        ahead = 0
        for depth, digit in enumerate(DIGITS, 1):
            counts = self.counts.read(depth, *prefix).groupBy(digit).agg(F.sum("rows").alias("rows"), F.sum("results").alias("results"))
            # One row for each value of a digit, at most 65,537.
            to_here = Window.partitionBy().orderBy(digit).rowsBetween(Window.unboundedPreceding, 0)
            summed = counts.filter("rows > 0").withColumns({"to": F.sum("rows").over(to_here), "seen": F.sum("results").over(to_here)})
            child = summed.filter(F.col("to") > at).orderBy(digit).first()
            if child is None:
                return None
            prefix.append(child[digit])
            at -= child["to"] - child["rows"]
            ahead += child["seen"] - child["results"]
        return prefix, at, ahead

    def _between(self, first: list[int], last: list[int]) -> DataFrame:
        """The live rows with results from ``first`` to ``last``: range conditions on sorted files, which skip the rest."""
        same = next((i for i, (a, b) in enumerate(zip(first, last)) if a != b), len(DIGITS))
        key = F.struct(*DIGITS)
        limit = lambda digits: F.struct(*(F.lit(x).cast("long").alias(d) for d, x in zip(DIGITS, digits)))
        rows = self.rows.read(*first[:same])
        if same < len(DIGITS):
            rows = rows.filter(F.col(DIGITS[same]).between(first[same], last[same])).filter((key >= limit(first)) & (key <= limit(last)))
        return _live(["n"])(rows)

    def page(self, limit: int = DEFAULT_PAGE, offset: int = 0) -> DataFrame:
        """One page with ``rank``, ordered by rank and user; empty beyond the board.

        Both ends of the page are found in the index. Only rows with results between them are read, and no task takes more than
        MOST_PASSED and the page of them, however long the tie that the page begins in.
        """
        if not 0 < limit <= MAX_PAGE or offset < 0:
            raise ValueError(f"limit must be 1 to {MAX_PAGE} and offset not negative")
        start = self._holding(offset)
        if start is None:
            return self.spark.createDataFrame([], self.schema).withColumn("rank", F.lit(0).cast("long"))
        digits, at, ahead = start
        end = self._holding(offset + limit - 1)
        # The last result of the board, where the page is not full.
        last = end[0] if end else [1 << 48] * len(DIGITS)
        rows = self._between(digits, last).withColumn("_name", F.hex(F.encode("user_key", "UTF-8")))
        first = reduce(and_, (F.col(d) == x for d, x in zip(DIGITS, digits)))
        taken = ""
        while at >= MOST_PASSED:
            tied = self._between(digits, digits).withColumn("_name", F.hex(F.encode("user_key", "UTF-8"))).filter(F.col("_name").startswith(taken))
            # Two bytes of the name at a time, so at most 65,793 counts.
            counts = tied.groupBy(F.substring("_name", len(taken) + 1, 4).alias("next")).agg(F.count(F.lit(1)).alias("rows"))
            to_here = Window.partitionBy().orderBy("next").rowsBetween(Window.unboundedPreceding, 0)
            child = counts.withColumn("to", F.sum("rows").over(to_here)).filter(F.col("to") > at).orderBy("next").first()
            taken, at = taken + child["next"], at - (child["to"] - child["rows"])
        top = rows.filter(~first | (F.col("_name") >= taken)).orderBy(*DIGITS, "user_key").limit(at + limit)
        rank = F.dense_rank().over(Window.partitionBy().orderBy(*DIGITS)).cast("long") + F.lit(ahead)
        ranked = top.withColumn("rank", rank).orderBy("rank", "user_key").offset(at).limit(limit)
        return ranked.select(*self.schema.names, "rank")

    def rank_of(self, user_key: str) -> DataFrame:
        """A user's row with its rank, one more than the better results; no row for a user without one."""
        asked = self.spark.createDataFrame([(user_key,)], "user_key string")
        entry = self.entries.of(asked, None)
        found = entry.select(*(c.alias(d) for d, c in result_digits().items())).first()
        if found is None:
            return entry.withColumn("rank", F.lit(0).cast("long"))
        # Better results share the first digits and have a smaller next one.
        better = reduce(or_, (
            (F.col("depth") == i + 1) & reduce(and_, (F.col(d) == found[d] for d in DIGITS[:i]), F.lit(True)) & (F.col(digit) < found[digit])
            for i, digit in enumerate(DIGITS)))
        ahead = self.counts.read().filter(better).agg(F.coalesce(F.sum("results"), F.lit(0))).first()[0]
        return entry.withColumn("rank", F.lit(ahead + 1).cast("long"))
