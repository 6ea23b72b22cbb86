"""Toxicity from confirmed toxic texts and unlabelled text, by non-negative positive-unlabelled learning.

Unlabelled text hides toxic texts in a share that is the class prior, so it is never taken for clean: a linear model minimises the
prior-corrected risk prior * R(toxic as toxic) + max(0, R(unlabelled as clean) - prior * R(toxic as clean)), and where the corrected part
turns negative, which only overfitting can do, the step goes the other way. Features are words and their beginnings, chosen by how much
more confirmed texts than unlabelled ones have them; Spark counts them on the executors. What reaches the driver and goes to every task
is bounded by the parameters: the sample's term numbers, and one weight for each chosen term.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import LOWER, fold, release_memory, table, texts
from playtide.session import written

#: Bounds of the fitted sample: confirmed toxic texts, unlabelled texts, chosen terms.
CONFIRMED, UNLABELLED, TERMS = 3000, 9000, 1024
#: Share of toxic texts where the labels do not tell it.
PRIOR = 0.1
#: Bytes of a word's beginnings, and fewest confirmed texts with a term.
BEGINNINGS, LEAST = (4, 5, 6, 7, 8), 3
#: Training rounds, step size, weight decay.
ROUNDS, STEP_SIZE, DECAY = 400, 0.05, 1e-4
CUT = 0.5
#: Words of at most so many bytes are remembered with their terms, at most so many of them.
LONGEST, REMEMBERED = 48, 200_000
_BETWEEN = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+")


def word_terms(word: bytes) -> list[bytes]:
    """The word, marked by a blank, and its beginnings."""
    return [word + b" ", *(word[:k] for k in BEGINNINGS if k <= len(word))]


def words(text: bytes) -> set[bytes]:
    """Distinct lower-case words; digits, marks and white space of ASCII stand between them."""
    found = set(_BETWEEN.split(text.translate(LOWER)))
    found.discard(b"")
    return found


class Terms:
    """Numbers of the chosen terms that texts have."""

    def __init__(self, chosen: list[bytes]):
        self.number = {t: i for i, t in enumerate(chosen)}
        self.of_word: dict[bytes, list[int]] = {}

    def of(self, word: bytes) -> list[int]:
        return [n for t in word_terms(word) if (n := self.number.get(t)) is not None]

    def present(self, text: bytes) -> set[int]:
        out: set[int] = set()
        for word in words(text):
            found = self.of_word.get(word)
            if found is None:
                found = self.of(word)
                if len(word) <= LONGEST:
                    if len(self.of_word) >= REMEMBERED:
                        self.of_word.clear()
                    self.of_word[word] = found
            out.update(found)
        return out


def _sampled(rows: DataFrame, most: int, among: DataFrame | None = None) -> DataFrame:
    """At most ``most`` of the distinct rows (id, text), the least by a hash of both; ``among`` has the ids to choose from.

    The hashes are drawn first, without the texts; a bound on them leaves few to be sorted.
    """
    rows = rows.withColumn("_draw", F.shiftrightunsigned(F.xxhash64(F.lit("draw"), "id", "text"), 1))
    draws = rows.select("id", "_draw") if among is None else rows.select("id", "_draw").join(among, "id", "left_semi")
    bound = min(1.0, (1.2 * most + 200) / max(draws.count(), 1))
    least = draws.filter(F.col("_draw") <= min(int(bound * 2**20) << 43, 2**63 - 1)).select("_draw").distinct().orderBy("_draw").limit(most)
    picked = rows.join(F.broadcast(written(least, "toxic-draws")), "_draw", "left_semi")  # at most ``most`` numbers
    return picked.groupBy("_draw").agg(F.first("id").alias("id"), F.first("text").alias("text")).drop("_draw")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, confirmed in zip(texts(batch["text"]), batch["confirmed"].to_pylist()):
            found = list({t for w in words(text) for t in word_terms(w)})
            yield pa.record_batch([pa.array(found, pa.binary()), pa.array([confirmed] * len(found), pa.bool_())], ["term", "confirmed"])
    release_memory()


def chosen_terms(sample: DataFrame, n_confirmed: int, n_unlabelled: int, most: int) -> list[bytes]:
    """The terms whose share of confirmed texts stands most standard errors above that of unlabelled texts."""
    counts = sample.mapInArrow(_exploded, "term binary, confirmed boolean").groupBy("term").agg(
        F.count_if("confirmed").alias("p"), F.count_if(~F.col("confirmed")).alias("u")).filter(F.col("p") >= min(LEAST, n_confirmed))
    p, u = F.col("p") / max(n_confirmed, 1), (F.col("u") + 1) / (n_unlabelled + 2)
    above = (p - u) / F.sqrt(u * (1 - u) * (1 / max(n_confirmed, 1) + 1 / (n_unlabelled + 2)))
    best = counts.withColumn("above", above).filter("above > 5").orderBy(F.desc("above"), "term").limit(most)
    return [bytes(r["term"]) for r in best.select("term").collect()]


def nn_pu(confirmed: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss, by Adam over all rows."""
    rows = np.concatenate([confirmed, unlabelled]).astype(np.float32)
    rows = np.concatenate([rows, np.ones((len(rows), 1), np.float32)], axis=1)
    n, m = len(confirmed), len(unlabelled)
    theta = np.zeros(rows.shape[1], np.float32)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        margin = rows @ theta
        toxic = 1 / (1 + np.exp(-np.clip(margin, -60, 60)))
        # Slopes of the losses by the margin: of taking rows for clean, corrected by the prior, and of taking confirmed rows for toxic.
        by_margin = np.concatenate([-prior / n * toxic[:n], toxic[n:] / m])
        as_clean = np.logaddexp(0, margin)
        if as_clean[n:].mean() >= prior * as_clean[:n].mean():
            by_margin[:n] -= prior / n * (1 - toxic[:n])
        else:
            by_margin = -by_margin
        gradient = rows.T @ by_margin.astype(np.float32)
        gradient[:-1] += DECAY * theta[:-1]
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta -= STEP_SIZE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1].astype(np.float64), float(theta[-1])


def class_prior(marks: DataFrame, default: float = PRIOR) -> float:
    """Share of label 1 among the learnt labels; the default where they do not have both."""
    row = marks.agg(F.count(F.lit(1)).alias("n"), F.sum("mark").alias("ones")).first()
    return row["ones"] / row["n"] if row["n"] and 0 < row["ones"] < row["n"] else default


def _numbers(chosen: list[bytes]):
    def run(batches):
        terms = Terms(chosen)
        for batch in batches:
            found = [sorted(terms.present(x)) for x in texts(batch["text"])]
            yield pa.record_batch([batch["confirmed"], pa.array(found, pa.list_(pa.int32()))], ["confirmed", "terms"])
        release_memory()

    return run


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, prior: float | None = None, most_confirmed: int = CONFIRMED,
    most_unlabelled: int = UNLABELLED, most_terms: int = TERMS, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
) -> tuple[list[bytes], np.ndarray, float]:
    """The chosen terms, their weights and the bias; without any confirmed text no terms and a bias that scores 0."""
    marks = labels.filter(F.col(label).isin(0, 1)).select(F.col(doc_id).alias(doc_id), F.col(label).alias("mark")).filter(learn)
    marks = written(marks.groupBy(F.col(doc_id).alias("id")).agg(F.max("mark").alias("mark")).filter("id is not null"), "toxic-labels")
    rows = docs.filter(learn).select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter("text is not null")
    confirmed = _sampled(rows, most_confirmed, marks.filter("mark = 1").select("id"))
    sample = written(confirmed.withColumn("confirmed", F.lit(True)).union(_sampled(rows, most_unlabelled).withColumn("confirmed", F.lit(False))), "toxic-sample")
    sizes = {r["confirmed"]: r["count"] for r in sample.groupBy("confirmed").count().collect()}
    if not sizes.get(True) or not sizes.get(False):
        return [], np.zeros(0), -np.inf
    chosen = chosen_terms(sample, sizes[True], sizes[False], most_terms)
    counted = sample.mapInArrow(_numbers(chosen), "confirmed boolean, terms array<int>").groupBy("confirmed", "terms").count().collect()
    counted.sort(key=lambda r: (r["confirmed"], r["terms"]))  # at most a row for each text of the sample
    flags = np.array([r["confirmed"] for r in counted for _ in range(r["count"])], bool)
    present = np.zeros((len(flags), len(chosen)), np.float32)
    for i, numbers in enumerate([r["terms"] for r in counted for _ in range(r["count"])]):
        present[i, numbers] = 1
    weights, bias = nn_pu(present[flags], present[~flags], class_prior(marks) if prior is None else prior)
    return chosen, weights, bias


def score(
    docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", **bounds: float | None,
) -> DataFrame:
    """``docs`` with the column score: 0 to 1, higher where a text is likelier toxic.

    Confirmed texts are those with label 1 among the rows where ``learn`` holds, unlabelled ones any rows where it holds; ``bounds`` are the
    parameters of :func:`fit`. Only the text enters a score. Null and empty texts, and texts without a chosen term, share the lowest score
    of a text without evidence; all score 0 if nothing is confirmed. A row labelled twice counts by its larger label; a null id or label
    confirms nothing. All other rows and columns stay (a column named score is replaced); an empty table stays empty.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, learn, doc_id=doc_id, text=text, label=label, **bounds))

    @F.arrow_udf("double")
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        chosen, weights, bias = model.value
        terms = Terms(chosen)
        for column in columns:
            margins = np.array([bias + weights[list(terms.present(x))].sum() for x in texts(column)], np.float64)
            with np.errstate(over="ignore"):
                yield pa.array(1 / (1 + np.exp(-margins)))
        release_memory()

    return docs.withColumn("score", scored(F.col(text)))


def op11_toxicity(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id")) == 0
    scored = score(docs.select("doc_id", "text"), table(spark, folder, "labels"), ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
