"""Tables that grow by one part per micro-batch and stay small in number of parts.

A table is a folder of parts and of manifests. A micro-batch writes its part and then one manifest, which lists the parts that are live:
that write is the swap. Parts of a tier are merged by Spark into one part of the next tier as soon as there are ``fanout`` of them, so
after n micro-batches at most fanout * log(n) parts are live, and a row is written again once per tier. What a manifest no longer lists is
deleted one micro-batch later, so a reader that began before a swap still finds its files.

Each micro-batch has its own manifest and reads the one before it. A micro-batch that is repeated after a failure starts from the same
parts and replaces its own, so nothing is written twice. A micro-batch's own part takes part in merges only from the next one on.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.session import drop

#: Parts of a tier that are merged into one of the next tier.
FANOUT = 8


@dataclass(frozen=True)
class File:
    """A live file, its rows, and its least and greatest key; a null in a key is written as None and sorts first."""

    path: str
    rows: int
    least: list[Any]
    most: list[Any]


@dataclass(frozen=True)
class Part:
    """The rows of the micro-batches ``first`` to ``last``; ``files`` are known where the table has a sort key."""

    first: int
    last: int
    tier: int
    files: list[File] = field(default_factory=list)

    @property
    def name(self) -> str:
        return f"part={self.first:09d}-{self.last:09d}-{self.tier}"


def due(parts: Sequence[Part], fanout: int) -> list[Part] | None:
    """The parts to merge next: the lowest full tier, if any."""
    for tier in sorted({p.tier for p in parts}):
        own = [p for p in parts if p.tier == tier]
        if len(own) >= fanout:
            return own
    return None


def _key(values: Sequence[Any]) -> tuple:
    return tuple((v is not None, v) if v is not None else (False, 0) for v in values)


def may_hold(file: File, prefix: Sequence[Any]) -> bool:
    """Whether rows whose key begins with ``prefix`` can be in the file."""
    n = len(prefix)
    return _key(file.least[:n]) <= _key(prefix) <= _key(file.most[:n])


class TieredTable:
    """A table below ``root``, a folder every executor reaches.

    ``merge`` makes the rows of several parts into those of one (the plain union if left out); its second argument tells whether the
    oldest part is among them. ``sort`` clusters merged parts by these columns, over ``spark.sql.shuffle.partitions`` files or as many as adaptive
    execution finds useful, and records the key range of each file. ``partition`` names columns that become folders of a part.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, merge: Callable[[DataFrame, bool], DataFrame] | None = None,
        sort: Sequence[str] = (), partition: Sequence[str] = (), fanout: int = FANOUT,
    ):
        self.spark, self.root, self.schema, self.merge = spark, root.rstrip("/"), schema, merge
        self.sort, self.partition, self.fanout = list(sort), list(partition), fanout

    # Manifests: small text files, written under another name first, so that a reader sees a whole one or none.

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        at, fs = self._fs(f"{self.root}/manifests")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _load(self, number: int) -> list[Part]:
        at, fs = self._fs(f"{self.root}/manifests/{number:09d}.json")
        stream = fs.open(at)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Part(p["first"], p["last"], p["tier"], [File(**f) for f in p["files"]]) for p in json.loads(text)]

    def _store(self, number: int, parts: Sequence[Part]) -> None:
        at, fs = self._fs(f"{self.root}/manifests/{number:09d}.json")
        new, _ = self._fs(f"{self.root}/manifests/{number:09d}.new")
        stream = fs.create(new, True)
        stream.write(bytearray(json.dumps([asdict(p) for p in parts]).encode()))
        stream.close()
        fs.delete(at, False)
        if not fs.rename(new, at):
            raise OSError(f"manifest {number} of {self.root} was not written")

    def parts(self, before: int | None = None) -> list[Part]:
        """The live parts by the newest manifest, or by the newest one of a micro-batch earlier than ``before``."""
        numbers = [n for n in self._numbers() if before is None or n < before]
        return self._load(numbers[-1]) if numbers else []

    # Rows.

    def _read(self, parts: Sequence[Part], prefix: Sequence[Any] = ()) -> DataFrame:
        paths = [f.path for p in parts for f in p.files if may_hold(f, prefix)] if self.sort else [f"{self.root}/{p.name}" for p in parts]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField("part", T.StringType())])
        reader = self.spark.read.schema(stored).option("basePath", self.root)
        return reader.parquet(*paths).select(*self.schema.names)

    def read(self, *prefix: Any, before: int | None = None) -> DataFrame:
        """All rows as of the newest manifest, or as they were before a micro-batch. With values for the first sort columns, rows of these
        only; files whose range cannot hold them are not opened."""
        rows = self._read(self.parts(before), prefix)
        for column, value in zip(self.sort, prefix):
            rows = rows.filter(F.col(column).eqNullSafe(F.lit(value)))
        return rows

    def _write(self, rows: DataFrame, part: Part, cluster: bool) -> Part:
        path = f"{self.root}/{part.name}"
        rows = rows.select(*self.schema.names)
        if cluster and self.sort:
            keys = [*self.partition, *self.sort]
            rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        elif self.partition:
            # A small part: the rows of one folder go to one file.
            rows = rows.repartition(*self.partition).sortWithinPartitions(*self.partition, *self.sort)
        rows.write.mode("overwrite").partitionBy(*self.partition).parquet(path)
        if not self.sort:
            return part
        key = F.struct(*self.sort)
        stored = self.spark.read.schema(self.schema).parquet(path)
        ranges = stored.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(key).alias("least"), F.max(key).alias("most"))
        # One row per file.
        files = [File(r["path"], r["rows"], list(r["least"]), list(r["most"])) for r in ranges.orderBy("path").collect()]
        return Part(part.first, part.last, part.tier, files)

    def commit(self, rows: DataFrame, number: int, alive: Column | None = None) -> None:
        """Add the rows of micro-batch ``number`` and merge what is due; merged parts lose the rows that are not ``alive``."""
        before = self.parts(number)
        live = list(before)
        while (group := due(live, self.fanout)) is not None:
            oldest = group[0].first == min(p.first for p in live)
            merged = self._read(group)
            if alive is not None:
                merged = merged.filter(alive)
            if self.merge is not None:
                merged = self.merge(merged, oldest)
            part = self._write(merged, Part(group[0].first, group[-1].last, group[0].tier + 1), cluster=True)
            live = sorted([p for p in live if p not in group] + [part], key=lambda p: p.first)
        live.append(self._write(rows, Part(number, number, 0), cluster=False))
        self._store(number, live)
        self._clean(number, before, live)

    def _clean(self, number: int, before: Sequence[Part], live: Sequence[Part]) -> None:
        """Delete parts that neither this manifest nor the one before lists, and older manifests."""
        numbers = [n for n in self._numbers() if n < number]
        kept = {p.name for p in [*before, *live]}
        for old in numbers[:-1]:
            for part in self._load(old):
                if part.name not in kept:
                    drop(self.spark, f"{self.root}/{part.name}")
            drop(self.spark, f"{self.root}/manifests/{old:09d}.json")


def newest(keys: Sequence[str], number: str = "_number") -> Callable[[DataFrame, bool], DataFrame]:
    """A merge that keeps, for each key, the row of the latest micro-batch, which the column ``number`` tells."""
    def merge(rows: DataFrame, oldest: bool) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys and c != number]
        last = rows.groupBy(*keys).agg(F.max(F.struct(number, *rest)).alias("_last"))
        return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in rows.columns])

    return merge


class KeyedState:
    """The latest row of each key, as a log of changes: a micro-batch writes the keys it touches, never the others.

    Keys lie in ``buckets`` folders by their hash; a micro-batch opens only those of its own keys. Choose as many as keep one folder of
    the largest part readable by a few tasks.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int = 16, fanout: int = FANOUT):
        self.keys, self.schema, self.buckets = list(keys), schema, buckets
        stored = T.StructType([*schema.fields, T.StructField("_number", T.LongType()), T.StructField("_bucket", T.IntegerType())])
        self.table = TieredTable(spark, root, stored, newest(self.keys), partition=["_bucket"], fanout=fanout)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def of(self, touched: DataFrame, before: int | None) -> DataFrame:
        """The state rows of the distinct keys in ``touched``, as they were before micro-batch ``before`` (None: as they are)."""
        asked = self._bucketed(touched.select(*self.keys).distinct())
        buckets = [r[0] for r in asked.select("_bucket").distinct().collect()]  # at most ``buckets``
        rows = self.table.read(before=before).filter(F.col("_bucket").isin(buckets))
        renamed = asked.select(*[F.col(k).alias(f"_asked_{k}") for k in self.keys], F.col("_bucket").alias("_asked_bucket"))
        same = F.col("_bucket") == F.col("_asked_bucket")
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_asked_{k}"))
        return newest(self.keys)(rows.join(renamed, same, "left_semi"), False).select(*self.schema.names)

    def all(self) -> DataFrame:
        """The whole state."""
        return newest(self.keys)(self.table.read(), True).select(*self.schema.names)

    def commit(self, rows: DataFrame, number: int, alive: Column | None = None) -> None:
        """Store the new rows of the keys that micro-batch ``number`` touched.

        Merged parts lose the rows that are not ``alive``; of a key whose latest row is not, older ones must not be either.
        """
        self.table.commit(self._bucketed(rows.withColumn("_number", F.lit(number).cast("long"))), number, alive)
