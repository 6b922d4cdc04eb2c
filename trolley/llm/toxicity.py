"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability from the words it
holds; the document's is their noisy-or: one minus the product of their complements,
with a leak for what no sentence tells. Only documents have labels, so the word weights are
learned from them through the noisy-or, and then locate the offending sentences.

All that is learned comes from a sample of the labelled documents, of about ``most`` rows at
most (a parameter of ``fit``; MOST_DOCUMENTS unless it is given). Spark counts, for hashed words, the
documents of both classes in it that hold them; the words whose counts differ most are the
vocabulary, and the weights are fitted on the places of these. Of several labels of one id the
largest counts; several rows of one id are documents of their own. Null and empty texts have no
sentence and score the leak. Without labels of both classes every score is the share of
label 1, or 0.5. Rows are scored each for itself; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.shared import bounded_sample, sigmoid, slices, text_of

BUCKETS = 1 << 18
VOCABULARY = 1024
#: Standard errors by which the shares of documents that hold a word differ at least.
CONTRAST = 6.0
#: Labelled rows that are learned from, about and at most.
MOST_DOCUMENTS = 20_000
#: A word, or whatever ends a sentence.
_TOKENS = re.compile(r"[^\W_]+|[.!?\n]+")
_ENDS = frozenset(".!?\n")


def _tokens(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Token numbers of all texts in a row, distinct tokens, tokens per text."""
    found = [_TOKENS.findall(text.lower()) for text in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    number: dict[str, int] = {}
    codes = np.fromiter(
        (number.setdefault(token, len(number)) for own in found for token in own),
        np.int64,
        int(counts.sum()),
    )
    return codes, list(number), counts


def _buckets(words: list[str]) -> np.ndarray:
    digest = xxhash.xxh32_intdigest
    values = [digest(word.encode("utf-8", "surrogatepass"), 7) for word in words]
    return np.array(values, np.int64) % BUCKETS


def _holders(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents by label that hold a bucket, for each task; a table of fixed size."""
    totals = np.zeros((2, BUCKETS + 1), np.int64)
    for frame in frames:
        for part in slices(frame):
            labels = part["label"].to_numpy()
            codes, distinct, counts = _tokens(part["text"].tolist())
            bucket = _buckets(distinct)
            for label in (0, 1):
                totals[label, BUCKETS] += (labels == label).sum()
            if len(codes):
                owner = np.repeat(np.arange(len(counts)), counts)
                once = np.unique(owner * BUCKETS + bucket[codes])
                by_label = labels[once // BUCKETS]
                for label in (0, 1):
                    own = once[by_label == label] % BUCKETS
                    totals[label, :BUCKETS] += np.bincount(own, minlength=BUCKETS)
    label, place = np.nonzero(totals)
    yield pd.DataFrame({"label": label, "place": place, "n": totals[label, place]})


@dataclass(frozen=True)
class SentenceModel:
    """Weights of the vocabulary's buckets; ``place`` maps a bucket to its weight or -1."""

    place: np.ndarray
    weights: np.ndarray
    bias: float
    leak: float
    constant: float | None = None

    def sentences(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place in the text, probability) of all sentences that hold a known word."""
        codes, distinct, counts = _tokens(texts)
        if not len(codes) or self.constant is not None:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0)
        text, sentence, place = _known(codes, distinct, counts, self.place)
        pairs, at = np.unique(np.stack([text, sentence], axis=1), axis=0, return_inverse=True)
        sums = np.bincount(at.ravel(), weights=self.weights[place], minlength=len(pairs))
        return pairs[:, 0], pairs[:, 1], sigmoid(sums + self.bias)

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score, place of the worst sentence (-1: none), number of sentences over one half."""
        if self.constant is not None:
            n = len(texts)
            return np.full(n, self.constant), np.full(n, -1), np.zeros(n, np.int64)
        text, sentence, chance = self.sentences(texts)
        clean = np.full(len(texts), np.log1p(-self.leak))
        np.add.at(clean, text, np.log1p(-np.minimum(chance, 1 - 1e-12)))
        worst = np.full(len(texts), -1)
        order = np.lexsort((-sentence, chance, text))
        worst[text[order]] = sentence[order]
        many = np.bincount(text[chance >= 0.5], minlength=len(texts))
        return 1.0 - np.exp(clean), worst, many


def _known(
    codes: np.ndarray, distinct: list[str], counts: np.ndarray, place: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, sentence of the text, vocabulary place) of the known words, each once a sentence."""
    ends = np.fromiter((token[0] in _ENDS for token in distinct), bool, len(distinct))
    own = np.where(ends, -1, place[_buckets(distinct)])
    closed = np.cumsum(ends[codes])
    first = np.cumsum(counts) - counts
    before = np.concatenate([[0], closed])[first]
    hit = np.flatnonzero(own[codes] >= 0)
    text = np.searchsorted(np.cumsum(counts), hit, side="right")
    rows = np.stack([text, closed[hit] - before[text], own[codes[hit]]], axis=1)
    rows = np.unique(rows, axis=0) if len(rows) else rows
    return rows[:, 0], rows[:, 1], rows[:, 2]


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, label) of about ``most`` labelled rows of ``docs`` at most.

    Ids are sampled first, so that few are sent to all tasks, and then rows, if ids that
    repeat have left more than ``most`` of them.
    """
    known = labels.where(F.col("label").isin(0, 1)).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("label").cast("int").alias("label")
    )
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    known = bounded_sample(known, "doc_id", most)
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_of().alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    # About ``most`` ids at most, each once, so texts need not be shuffled.
    rows = texts.join(F.broadcast(known), "doc_id")
    # A tenth more than meant to be is how samples vary, not ids that repeat.
    return bounded_sample(rows, "row", most + most // 10).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_DOCUMENTS) -> SentenceModel:
    """Learn from ``labelled_rows``; ``labels`` has doc_id and label, 0 or 1.

    The driver gets the counts of at most VOCABULARY buckets and, of the sample, the
    places of known words by sentence.
    """
    rows = labelled_rows(docs, labels, most)
    holders = rows.mapInPandas(_holders, "label int, place int, n bigint")
    by_place = (
        holders.groupBy("place")
        .agg(
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("n1"),
            F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("n0"),
        )
    )
    totals = by_place.where(F.col("place") == BUCKETS).first()
    n1, n0 = (totals.n1, totals.n0) if totals else (0, 0)
    none = np.zeros(0)
    if not n1 or not n0:
        return SentenceModel(none, none, 0.0, 0.0, n1 / (n1 + n0) if n1 + n0 else 0.5)
    # Difference of the shares of documents over its standard error.
    share = (F.col("n1") + F.col("n0")) / F.lit(n1 + n0)
    error = F.sqrt(share * (1 - share) * F.lit(1 / n1 + 1 / n0)) + F.lit(1 / (n1 + n0))
    contrast = (F.col("n1") / F.lit(n1) - F.col("n0") / F.lit(n0)) / error
    chosen = (
        by_place.where((F.col("place") < BUCKETS) & (F.col("n1") + F.col("n0") >= 5))
        .select("place", contrast.alias("contrast"))
        .where(F.abs("contrast") > CONTRAST)
        .orderBy(F.desc(F.abs("contrast")), "place")
        .limit(VOCABULARY)
        .toPandas()
    )
    place = np.full(BUCKETS, -1, np.int64)
    place[chosen["place"].to_numpy()] = np.arange(len(chosen))
    held = docs.sparkSession.sparkContext.broadcast(place)

    def bags(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in slices(frame):
                codes, distinct, counts = _tokens(part["text"].tolist())
                if len(codes):
                    text, sentence, word = _known(codes, distinct, counts, held.value)
                else:
                    text = sentence = word = np.zeros(0, np.int64)
                cut = np.searchsorted(text, np.arange(len(part) + 1))
                yield pd.DataFrame(
                    {
                        "label": part["label"],
                        "sentence": [sentence[a:b] for a, b in zip(cut, cut[1:])],
                        "word": [word[a:b] for a, b in zip(cut, cut[1:])],
                    }
                )

    sample = rows.mapInPandas(
        bags, "label int, sentence array<int>, word array<int>"
    ).toPandas()
    weights, bias, leak = _noisy_or(sample, len(chosen))
    return SentenceModel(place, weights, bias, leak)


def _noisy_or(
    sample: pd.DataFrame, size: int, rounds: int = 800, decay: float = 1e-6
) -> tuple[np.ndarray, float, float]:
    """Word weights, bias and leak by gradient steps (Adam) on the noisy-or likelihood."""
    y = sample["label"].to_numpy(float)
    lengths = sample["word"].str.len().to_numpy(np.int64)
    word = np.concatenate([np.zeros(0, np.int64), *sample["word"]]).astype(np.int64)
    sentence = np.concatenate([np.zeros(0, np.int64), *sample["sentence"]]).astype(np.int64)
    doc = np.repeat(np.arange(len(y)), lengths)
    pairs, at = np.unique(np.stack([doc, sentence], axis=1), axis=0, return_inverse=True)
    at, owner = at.ravel(), pairs[:, 0]
    theta = np.zeros(size + 2)
    theta[-2:] = -3.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        z = np.bincount(at, weights=theta[word], minlength=len(pairs)) + theta[-2]
        p, leak = sigmoid(z), sigmoid(theta[-1])
        clean = np.log1p(-leak) + np.bincount(
            owner, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y)
        )
        rest = np.exp(clean)
        # d loss / d log clean, which each sentence's p moves by -p per unit of z.
        slope = np.where(y == 1, rest / np.maximum(1 - rest, 1e-9), -1.0) / len(y)
        by_sentence = -slope[owner] * p
        gradient = np.zeros_like(theta)
        gradient[:size] = np.bincount(word, weights=by_sentence[at], minlength=size)
        gradient[:size] += decay * theta[:size]
        gradient[-2], gradient[-1] = by_sentence.sum(), -(slope * leak).sum()
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:size], float(theta[-2]), float(sigmoid(theta[-1]))


def scored(docs: DataFrame, model: SentenceModel) -> DataFrame:
    """(doc_id, score, worst_start, worst_end, n_toxic) of each whole text.

    The worst sentence is given in code points (null: no sentence holds a known word);
    ``n_toxic`` counts sentences of a probability of one half or more.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in slices(frame):
                values, worst, many = held.value.score(part["text"].tolist())
                spans = [sentence_span(t, n) for t, n in zip(part["text"], worst.tolist())]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"],
                        "score": values,
                        "worst_start": pd.array([a for a, _ in spans], "Int64"),
                        "worst_end": pd.array([b for _, b in spans], "Int64"),
                        "n_toxic": many,
                    }
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(
        score,
        "doc_id bigint, score double, worst_start bigint, worst_end bigint, n_toxic bigint",
    )


_END_RUN = re.compile(r"[.!?\n]+")


def sentence_span(text: str, number: int) -> tuple[int | None, int | None]:
    """Start and end of a sentence by its place in the text; (None, None) for -1."""
    if number < 0:
        return None, None
    start = 0
    for place, match in enumerate(_END_RUN.finditer(text)):
        if place == number:
            return start, match.end()
        start = match.end()
    return start, len(text)
