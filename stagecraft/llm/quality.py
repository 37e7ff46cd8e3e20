"""Operator 5: quality classifier by compression.

Two raw-content zstandard dictionaries are built from text labelled good and bad. A text is
compressed against both; the difference of the sizes, divided by their sum, is calibrated by a
logistic curve that was fitted on other labelled texts, which gives P(label 1). The curve also
sees the smaller size per byte of text (its logarithm and the square of that): text that
repeats itself shrinks to almost nothing against either dictionary, so the difference alone
says little about it.

Fitting uses a bounded sample: ``per_class`` labelled texts of each label, the ones with the
smallest hash of their id. Every other one of them gives a dictionary a passage from a place that
its hash chooses; the rest calibrate, read as a whole in the tasks. Scoring reads every text as a whole.

Defined results: a null or empty text scores as a text whose features are all 0; without
training texts of both labels every score is the share of label 1 among the training labels
(0.5 without any). A null ``quality`` or a null id is not learned from; repeated labels of one
id count as bad if one of them is; repeated documents are scored alike; other columns of the
inputs are ignored, whatever their names.
"""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagecraft.llm.common import held_out, texts_of
from stagecraft.llm.compression import Sizer, dictionary, passage

THRESHOLD = 0.3
PER_CLASS = 1500
# Characters of a passage (chosen of 600 and 2000 on held-out texts of sf0.01, sf0.1 and check_s); a dictionary cuts the longest so that all of its passages fit.
PASSAGE_CHARS = 2000


@dataclasses.dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # of the features, then the intercept


def features(model: QualityModel, texts) -> np.ndarray:
    """A row for each text: (size against good - size against bad) / their sum, then the
    logarithm of the smaller size per byte, and its square. All 0 for an empty text."""
    good, bad = Sizer(model.good), Sizer(model.bad)
    out = []
    for text in texts:
        g, b = good(text), bad(text)
        ratio = math.log(min(g, b) / len(text)) if len(text) else 0.0
        out.append(((g - b) / (g + b) if g + b else 0.0, ratio, ratio * ratio))
    return np.array(out, dtype=np.float64).reshape(-1, 3)


def probability(model: QualityModel, x: np.ndarray) -> np.ndarray:
    w = np.array(model.weights)
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -700, 700)))


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, ...]:
    """Weights and intercept by Newton steps with a small ridge on the weights."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.diag([1.0] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + ridge @ w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return (*map(float, w[:-1] / scale), float(w[-1]))


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    per_class: int = PER_CLASS,
) -> QualityModel:
    """Learn from ``labels`` (doc_id, quality) of ``documents`` (doc_id, text).

    ``train`` is a condition on ``doc_id`` that a labelled row must meet to be learned from.
    At most ``2 * per_class`` ids are broadcast; as many passages and features reach the driver.
    """
    marked = labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IN (0, 1)")
    if train is not None:
        marked = marked.where(train)
    marked = marked.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    picked = [marked.where(F.col("quality") == q).orderBy(order, "doc_id").limit(per_class) for q in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * per_class rows
    texts = documents.select("doc_id", "text").where("text IS NOT NULL").join(ids, "doc_id")
    found = (
        texts.groupBy("doc_id", "quality")
        .agg(F.min(passage(F.col("text"), F.col("doc_id"), PASSAGE_CHARS)).alias("passage"))
        .collect()
    )
    # Every other one makes the dictionary of its label, the rest calibrate.
    found = sorted(found, key=lambda r: (_spread(r["doc_id"]), r["doc_id"]))
    of = {q: [r for r in found if r["quality"] == q] for q in (0, 1)}
    if min(len(of[0]), len(of[1])) < 2:
        share = min(max(len(of[1]) / len(found) if found else 0.5, 1e-6), 1 - 1e-6)
        return QualityModel(b"", b"", (0.0, 0.0, 0.0, math.log(share / (1 - share))))
    model = QualityModel(*[dictionary([r["passage"].encode() for r in of[q][::2]]) for q in (1, 0)], ())
    apart = documents.sparkSession.createDataFrame([(r["doc_id"],) for q in (0, 1) for r in of[q][1::2]], ids.select("doc_id").schema)
    rows = (
        texts.join(F.broadcast(apart), "doc_id", "left_semi")
        .select("doc_id", F.col("quality").alias("label"), _features_of(model, "text").alias("x"))
        .groupBy("doc_id", "label")
        .agg(F.min("x").alias("x"))
        .orderBy("doc_id")
        .collect()
    )
    x = np.array([r["x"] for r in rows], dtype=np.float64)
    return dataclasses.replace(model, weights=fit_logistic(x, np.array([r["label"] for r in rows], dtype=np.float64)))


def _spread(doc_id) -> int:
    """An order of the sample that has nothing to do with how ids were given."""
    return int.from_bytes(str(doc_id).encode()[::-1], "big") * 0x9E3779B97F4A7C15 % (1 << 64)


def _features_of(model: QualityModel, text: Column | str) -> Column:
    @F.arrow_udf("array<double>")
    def compute(column: pa.Array) -> pa.Array:
        return pa.array(features(model, texts_of(column)).tolist(), pa.list_(pa.float64()))

    return compute(text)


def quality_score(model: QualityModel, text: Column | str = "text") -> Column:
    """P(label 1) of a whole text."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(probability(model, features(model, texts_of(column))))

    return score(text)


def score_quality(documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted (1 if score >= threshold, else 0) of every document."""
    return documents.select("doc_id", quality_score(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def quality_query(spark, sf_dir: str) -> DataFrame:
    """Op 5 over all documents, learning from ids with crc32(doc_id) mod 5 <> 0."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    apart = held_out(F.col("doc_id"), 5, 0)
    model = fit_quality(documents, labels, train=~apart)
    return score_quality(documents, model).select("doc_id", apart.alias("held_out"), "score", "predicted")
