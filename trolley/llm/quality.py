"""Quality classifier: regularised quadratic discriminant analysis.

Every document becomes a vector of transformed statistics (logs of lengths and counts,
logits of shares). Each class is a normal distribution whose covariance is shrunk to
the pooled one and to a multiple of the identity. The score is the logistic of
the difference of the log densities, each from the Mahalanobis distance by a cached
Cholesky factor.

Null and empty texts have the statistics of an empty text and get a score like any
other. Rows with equal ids are scored each for itself. Without usable labels of both
classes all scores are the share of label 1, or 0.5 without labels. Other columns of
the table are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.shared import sigmoid, slices, text_of

STATISTICS = (
    "log_bytes", "log_words", "log_word_bytes", "upper", "digits", "stops", "marks",
    "shouts", "bars", "breaks", "other_bytes", "marked_words", "repeated_words",
    "distinct_words", "repeated_lines", "packed",
)
SIZE = len(STATISTICS)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_HIGH = np.arange(256) >= 128
_MARKS = np.zeros(256, bool)
_MARKS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,!|"]] = True
_WORD_MARKS = _MARKS.copy()
_WORD_MARKS[33] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _logit(part: float, whole: float) -> float:
    """Logit of a share, with half a count added on both sides."""
    return float(np.log((part + 0.5) / (max(whole - part, 0.0) + 0.5)))


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text, in the order of STATISTICS."""
    data = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, words = len(data), data.split()
    lines = [line for line in data.split(b"\n") if line]
    n = len(words)
    letters = size - int(counts[_SPACE].sum())
    place = np.frombuffer(data, np.uint8)
    ends = np.append(_SPACE[place[1:]], True) if size else np.zeros(0, bool)
    marked = int((_WORD_MARKS[place] & ends).sum())
    packed = len(zlib.compress(data, 1)) if data else 0
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        float(np.log((letters + 1.0) / (n + 1.0))),
        _logit(counts[_UPPER].sum(), size),
        _logit(counts[_DIGIT].sum(), size),
        _logit(counts[44] + counts[46], size),
        _logit(counts[_MARKS].sum(), size),
        _logit(counts[33], size),
        _logit(counts[124], size),
        _logit(counts[10], size),
        _logit(counts[_HIGH].sum(), size),
        _logit(marked, n),
        _logit(sum(map(eq, words, words[1:])), n),
        _logit(len(set(words)), n),
        _logit(len(lines) - len(set(lines)), len(lines)),
        float(np.log((packed + 16.0) / (size + 16.0))),
    ]


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(text) for text in texts], float).reshape(-1, SIZE)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors, log determinants and priors of both classes."""

    means: np.ndarray
    inverse_factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = []
        for c in (0, 1):
            z = (x - self.means[c]) @ self.inverse_factors[c].T
            density.append(
                self.log_priors[c] - 0.5 * ((z * z).sum(axis=1) + self.log_dets[c])
            )
        return sigmoid(density[1] - density[0])


def _moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Count, sums and sums of products by label, one row per entry and task."""
    total = np.zeros((2, 1 + SIZE + SIZE * SIZE))
    for frame in frames:
        x = np.stack(frame["x"].to_numpy()) if len(frame) else np.zeros((0, SIZE))
        for c in (0, 1):
            own = x[frame["label"].to_numpy() == c]
            total[c] += np.concatenate(
                [[len(own)], own.sum(axis=0), (own.T @ own).ravel()]
            )
    yield pd.DataFrame(
        {
            "label": np.repeat([0, 1], total.shape[1]),
            "entry": np.tile(np.arange(total.shape[1]), 2),
            "value": total.ravel(),
        }
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the vector of each whole text."""

    def vectors(frames):
        for frame in frames:
            for part in slices(frame):
                yield pd.DataFrame(
                    {"doc_id": part["doc_id"], "x": list(_matrix(part["text"]))}
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(vectors, "doc_id bigint, x array<double>")


def fit(
    known_statistics: DataFrame,
    labels: DataFrame,
    *,
    to_pooled: float = 0.3,
    to_identity: float = 0.05,
) -> Discriminant:
    """Learn from ``document_statistics`` and ``labels`` (doc_id, label 0 or 1).

    The moments are summed by Spark; the driver gets 2 * (1 + d + d * d) numbers. A
    class covariance is mixed with the pooled one (``to_pooled``), and that with the
    identity times its mean variance (``to_identity``).
    """
    known = labels.where(F.col("label").isin(0, 1)).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("label").cast("int").alias("label")
    )
    sums = (
        known_statistics.join(known, "doc_id")
        .select("x", "label")
        .mapInPandas(_moments, "label int, entry int, value double")
        .groupBy("label", "entry")
        .agg(F.sum("value").alias("value"))
    )
    total = np.zeros((2, 1 + SIZE + SIZE * SIZE))
    for row in sums.collect():
        total[row.label, row.entry] = row.value
    return discriminant(total, to_pooled, to_identity)


def discriminant(total: np.ndarray, to_pooled: float, to_identity: float) -> Discriminant:
    counts = total[:, 0]
    empty = np.zeros((0,))
    if min(counts) < 2:
        share = counts[1] / counts.sum() if counts.sum() else 0.5
        return Discriminant(empty, empty, empty, empty, float(share))
    means = total[:, 1 : 1 + SIZE] / counts[:, None]
    scatter = [
        total[c, 1 + SIZE :].reshape(SIZE, SIZE) - counts[c] * np.outer(means[c], means[c])
        for c in (0, 1)
    ]
    pooled = (scatter[0] + scatter[1]) / counts.sum()
    inverse, log_dets = [], []
    for c in (0, 1):
        own = (1 - to_pooled) * scatter[c] / counts[c] + to_pooled * pooled
        level = max(float(np.trace(own)) / SIZE, 1e-6)
        own = (1 - to_identity) * own + to_identity * level * np.eye(SIZE)
        factor = np.linalg.cholesky(own)
        inverse.append(np.linalg.inv(factor))
        log_dets.append(2.0 * np.log(np.diag(factor)).sum())
    priors = np.log(counts / counts.sum())
    return Discriminant(means, np.stack(inverse), np.array(log_dets), priors)


def scored(known_statistics: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score) from ``document_statistics``."""

    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        x = np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, SIZE))
        return pd.Series(model.score(x))

    return known_statistics.select("doc_id", score("x").alias("score"))


def with_quality(
    docs: DataFrame, model: Discriminant, score: str = "quality_score"
) -> DataFrame:
    """All columns of ``docs`` and the score of each text in a column named ``score``.

    Columns of that name, in upper or lower case, are left out for it.
    """
    clashing = [name for name in docs.columns if name.lower() == score.lower()]
    docs = docs.drop(*clashing)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [
                model.score(_matrix(part["text"]))
                for part in slices(texts.to_frame("text"))
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(score, scored(text_of()))
