"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

Texts become counts of byte trigrams, hashed to a fixed number of terms, and of how often they repeat themselves. A truncated
singular value decomposition of a bounded, labelled sample gives the latent axes. The sample's vectors, a few megabytes whatever
the corpus, go to every task, which compares each of its documents with all of them, block by block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import LOWER, fold, sliced, table, texts

#: Hashed trigram terms, and terms that say which share of lines and words are repeats.
TERMS, REPEATS = 2048, 16
#: Latent axes, labelled vectors per class (the bound on what is collected and broadcast), neighbours, documents of a block.
AXES, PER_CLASS, NEIGHBOURS, BLOCK = 48, 1500, 15, 512
#: Texts scored 0 to below this are rejected.
CUT = 0.3
STEP_BYTES = 2 << 20


def _repeats(items: list[bytes]) -> float:
    return 1 - len(set(items)) / len(items) if items else 0.0


def term_counts(docs: list[bytes]) -> np.ndarray:
    """One row of term weights per text: 1 + log of the counts, then the repeat terms."""
    lengths = np.array([len(x) for x in docs], np.int64)
    out = np.zeros((len(docs), TERMS + REPEATS), np.float32)
    flat = np.frombuffer(b"".join(docs), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(docs)), lengths)
    if len(flat) > 2:
        whole = owner[:-2] == owner[2:]
        gram = (flat[:-2] << 16 | flat[1:-1] << 8 | flat[2:])[whole]
        term = (gram * 0x9E3779B1 >> 13) % TERMS
        out[:, :TERMS] = np.bincount(owner[:-2][whole] * TERMS + term, minlength=len(docs) * TERMS).reshape(len(docs), TERMS)
        np.log1p(out, out=out)
    half = REPEATS // 2
    for i, text in enumerate(docs):
        norm = float(np.linalg.norm(out[i, :TERMS])) or 1.0
        shares = _repeats([x for x in text.split(b"\n") if x.strip()]), _repeats(text.translate(LOWER).split())
        for k, share in enumerate(shares):
            out[i, TERMS + k * half + min(int(share * half), half - 1)] = norm * share if text else 0.0
    return out


def fit(counts: np.ndarray, labels: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    """Term weights, latent axes and the unit vectors of the sample, from its term counts."""
    weight = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
    weighted = counts * weight
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)
    # Randomised truncated SVD: two power rounds over a random range.
    rng = np.random.default_rng(seed)
    found = weighted.T @ (weighted @ rng.standard_normal((weighted.shape[1], AXES + 16)).astype(np.float32))
    for _ in range(2):
        found, _ = np.linalg.qr(found)
        found = weighted.T @ (weighted @ found)
    basis, _ = np.linalg.qr(found)
    _, _, turn = np.linalg.svd(weighted @ basis, full_matrices=False)
    axes = (basis @ turn.T)[:, :AXES]
    model = {"weight": weight, "axes": axes.astype(np.float32), "labels": labels.astype(np.float32)}
    return model | {"vectors": latent(counts, model)}


def latent(counts: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Unit vectors on the latent axes; a text without terms has the zero vector."""
    vectors = (counts * model["weight"]) @ model["axes"]
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def vote(vectors: np.ndarray, model: dict[str, np.ndarray], neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Mean label of the nearest labelled vectors, weighted by similarity. Zero vectors, which resemble nothing, score 0."""
    out = np.zeros(len(vectors))
    if not len(model["labels"]):
        return out
    k = min(neighbours, len(model["labels"]))
    for i in range(0, len(vectors), BLOCK):
        cosine = vectors[i:i + BLOCK] @ model["vectors"].T
        nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, nearest, 1), 0).astype(np.float64) ** 4
        total = weight.sum(1)
        out[i:i + BLOCK] = np.where(total > 0, (weight * model["labels"][nearest]).sum(1) / np.maximum(total, 1e-12), 0)
    return np.clip(out, 0, 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int, doc_id: str, text: str, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of at most ``per_class`` learnt texts of each label 0 and 1, the least by the hash of their id.

    Null texts are left out; of several texts of one id the least by hash is taken. Only counts, no texts, come to the driver.
    """
    marked = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("label"))
    rows = docs.filter(learn).select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter("text is not null")
    ids = rows.select("id").join(marked, "id")
    chosen = [
        r for value in (0, 1)
        for r in ids.filter(F.col("label") == value).distinct().orderBy(F.xxhash64("id"), "id").limit(per_class).collect()
    ]
    if not chosen:
        return np.zeros((0, TERMS + REPEATS), np.float32), np.zeros(0, np.float32)

    def counted(batches):
        for batch in batches:
            found = texts(batch["text"])
            for s in sliced(found, STEP_BYTES):
                counts = [row.tobytes() for row in term_counts(found[s])]
                yield pa.record_batch([batch["id"][s.start:s.stop], pa.array(counts, pa.binary())], ["id", "counts"])

    # The chosen ids are bounded by 2 x per_class, and so is what is collected: TERMS + REPEATS numbers each.
    picked = rows.filter(F.col("id").isin([r["id"] for r in chosen])).groupBy("id").agg(
        F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    label_of = {r["id"]: r["label"] for r in chosen}
    learnt = sorted(picked.mapInArrow(counted, f"id {kind}, counts binary").collect(), key=lambda r: r["id"])
    counts = np.stack([np.frombuffer(r["counts"], np.float32) for r in learnt])
    return counts, np.array([label_of[r["id"]] for r in learnt], np.float32)


def score(
    docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS,
    doc_id: str = "doc_id", text: str = "text", label: str = "quality",
) -> DataFrame:
    """``docs`` with the column score: 0 to 1, higher where label 1 is likelier.

    The model learns from at most ``per_class`` texts of each label among the rows where ``learn`` holds; only the text enters a
    score. Null and empty texts score 0, as does every text if nothing is labelled. Rows labelled twice count by their larger label. All
    other rows and columns stay (a column named score is replaced); an empty table stays empty.
    """
    sample, marks = labelled_sample(docs, labels, learn, per_class, doc_id, text, label)
    model = docs.sparkSession.sparkContext.broadcast(fit(sample, marks))

    @F.pandas_udf("double")
    def scored(column):
        import pandas as pd

        found = [(x or "").encode() for x in column]
        parts = [vote(latent(term_counts(found[s]), model.value), model.value) for s in sliced(found, STEP_BYTES)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn("score", scored(F.col(text)))


def op10_quality_classifier(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id")) == 0
    scored = score(docs.select("doc_id", "text"), table(spark, folder, "labels"), ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
