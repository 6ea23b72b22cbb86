"""The corpus pipeline: documents in, token ids of the clean, distinct ones out, and the text decoded from them.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written before the next stage is called and reads it; the next
stage begins by deleting the intermediate tables of the one before.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtide.llm import decontaminate, lines, neighbours, simhash, transducer
from playtide.llm.common import fold, table, tagged
from playtide.session import collected, configure, drop, written

_USED: list[str] = []


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark)
        while _USED:
            drop(spark, _USED.pop())
        with collected() as tables:
            out = work(spark, docs, sf_dir)
        _USED.extend(tables)
        return out

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    scored = neighbours.score(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id")) != 0)
    return scored.filter(F.col("score") >= neighbours.CUT).select(*docs.columns)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sites repeat, but for their first occurrence."""
    cleaned = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links by fingerprints of three-word shingles within two bits."""
    return simhash.one_of_each(docs, words=3, distance=2)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    rows = tagged(docs, "benchmark-docs")
    found = decontaminate.overlaps(rows, table(spark, sf_dir, "benchmark"), doc_id="_row").select(F.col("doc_id").alias("_row")).distinct()
    return rows.join(found, "_row", "left_anti").select(*docs.columns)


@stage
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text decoded from them."""
    return transducer.encode_and_decode(docs, transducer.model_path())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]

#: The classifier, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = written(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
