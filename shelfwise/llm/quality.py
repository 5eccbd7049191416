"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a short vector of transformed statistics (logs of sizes,
square roots of smoothed shares). For each class Spark sums the vectors and
their products over every labelled row; the driver turns these few numbers
into a mean and a covariance, shrunk towards the diagonal of the pooled one,
and its Cholesky factor. The score is the logistic of the difference of the
two Gaussian log-densities, whose Mahalanobis terms use the cached factors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, pack_rows, texts_of, unpack_rows

FEATURES = ("log_words", "log_word_length", "longest_word", "repeat_share", "adjacent_share", "line_repeat_share",
            "symbol_share", "upper_share", "digit_share", "shout_share", "stop_share")
SHRINKAGE = 0.05    # part of the pooled diagonal in a class's covariance
THRESHOLD = 0.7     # smallest score of a kept document

# Byte classes: 0 other, 1 upper case, 2 digit, 3 symbol, 4 exclamation or question, 5 other punctuation.
_CLASS = np.zeros(256, np.uint8)
for _n, _chars in ((1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b"0123456789"), (3, b"#*$%&|<>@^~_=+\\{}[]"), (4, b"!?"),
                   (5, b".,;:")):
    _CLASS[list(_chars)] = _n


def statistics(text: bytes) -> list[float]:
    """The features of one whole text; zeros for an empty one."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    lengths = np.fromiter(map(len, words), np.int64, n)
    count = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=6)
    chars = int(lengths.sum())
    adjacent = sum(map(bytes.__eq__, words[1:], words))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    share = lambda k, of, prior: ((k + 0.1) / (of + prior)) ** 0.5
    return [np.log1p(n), np.log((chars + 60) / (n + 10)), np.log1p(int(lengths.max())),
            share(n - len(set(words)), n, 20), share(adjacent, n, 20), share(len(lines) - len(set(lines)), len(lines), 5),
            share(int(count[3]), chars, 60), share(int(count[1]), chars, 60), share(int(count[2]), chars, 60),
            share(int(count[4]), chars, 60), share(int(count[5]), chars, 60)]


def _matrix(column: pa.Array) -> np.ndarray:
    texts = texts_of(column)
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def features(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``(doc_id, features array<double>)`` of every row; null text as empty."""
    kind = docs.schema[id].dataType.simpleString()

    def run(b: pa.RecordBatch) -> dict:
        x = _matrix(b.column(1))
        return {"doc_id": b.column(0),
                "features": pa.FixedSizeListArray.from_arrays(x.ravel(), x.shape[1]).cast(pa.list_(pa.float64()))}

    return map_batches(docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), run,
                       f"doc_id {kind}, features array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log terms of classes 0 and 1."""

    mean: np.ndarray
    whiten: np.ndarray
    const: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of features."""
        d = [c - 0.5 * (((x - m) @ w.T) ** 2).sum(1) for m, w, c in zip(self.mean, self.whiten, self.const)]
        return 1 / (1 + np.exp(-np.clip(d[1] - d[0], -700, 700)))


def fit(labelled: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fit on all rows of ``labelled(features, label)`` with label 0 or 1
    (other labels are left out). One partially aggregated pass; the driver
    gets one row of sums for each class. A class without rows has the pooled
    moments, so without any labels every score is 1/2."""
    k = len(FEATURES)
    x = [F.col("features")[i] for i in range(k)]
    sums = labelled.where("label in (0, 1)").groupBy("label").agg(
        F.count(F.lit(1)), *[F.sum(a) for a in x], *[F.sum(x[i] * x[j]) for i in range(k) for j in range(i + 1)])
    n, first, second = np.zeros(2), np.zeros((2, k)), np.zeros((2, k, k))
    for row in sums.collect():
        c = int(row[0])
        n[c], first[c] = row[1], row[2: 2 + k]
        at = np.tril_indices(k)
        second[c][at] = row[2 + k:]
        second[c].T[at] = row[2 + k:]
    total = max(n.sum(), 1)
    pooled_mean = first.sum(0) / total
    pooled = second.sum(0) / total - np.outer(pooled_mean, pooled_mean)
    ridge = np.diag(np.maximum(np.diag(pooled), 0) + 1e-4)
    mean, whiten, const = np.zeros((2, k)), np.zeros((2, k, k)), np.zeros(2)
    for c in (0, 1):
        mean[c] = first[c] / n[c] if n[c] else pooled_mean
        cov = second[c] / n[c] - np.outer(mean[c], mean[c]) if n[c] else pooled
        low = np.linalg.cholesky((1 - shrinkage) * cov + shrinkage * ridge)
        whiten[c] = np.linalg.inv(low)
        const[c] = np.log((n[c] + 1) / (n.sum() + 2)) - np.log(np.diag(low)).sum()
    return Discriminant(mean, whiten, const)


def held_out(id: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _train(feats: DataFrame, labels: DataFrame, shrinkage: float) -> Discriminant:
    marks = labels.select(F.col("doc_id").alias("l_id"), F.col("quality").alias("label")) \
        .where("l_id is not null and label in (0, 1)")
    return fit(feats.where(~held_out(F.col("doc_id"))).join(marks, F.col("doc_id") == F.col("l_id")), shrinkage)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, shrinkage: float = SHRINKAGE) \
        -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs``.

    Learns from the rows of ``labels(doc_id, quality)`` that are not held
    out; null or other qualities and null ids teach nothing, a document with
    several labels counts once for each. The score uses nothing but the
    text: null and empty texts have the features zero and a score like any
    other, repeated rows score alike, other columns are ignored. An empty
    table gives no rows.
    """
    feats = materialize(features(docs), "features")
    model = _train(feats, labels, shrinkage)

    def run(b: pa.RecordBatch) -> dict:
        x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
        return {"doc_id": b.column(0), "score": model.score(x)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = map_batches(feats, run, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, shrinkage: float = SHRINKAGE) \
        -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more.
    Texts are read twice (to learn, to score) and never shuffled."""
    model = _train(materialize(features(docs), "features"), labels, shrinkage)

    @F.pandas_udf("double")
    def score(text):
        return __import__("pandas").Series(model.score(_matrix(pa.array(text, pa.large_string()))))

    rows = pack_rows(docs, _score=score(F.col("text")))
    return unpack_rows(rows.where(F.col("_score") >= threshold))
