"""Benchmark decontamination: MinHash containment search partitioned by size.

Test items are partitioned by their number of shingles. For each partition a document
is cut into blocks of the partition's largest size, so a short item is not lost in
a long document: wherever it stands, it shares a large part of one or two blocks. Blocks
and items meet where one of their minhashes is equal (one row per band, as in
an ensemble tuned for containment). Documents with fewer shingles than the
smallest item of a partition needs are left out of it. Each pair found is verified by the
exact share of the item's distinct shingles that the whole document holds.

Words are runs of letters, digits and underscores in lower case, shingles five words.
Items of fewer words are one shingle of that length. Items and texts that are null
or without words match nothing. Items go to the tasks in blocks of at most BLOCK_SHINGLES
shingles (one item at least), with one pass over the documents for each block. Rows
with equal ids give one row with the largest share. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.shared import slices, text_of

SHINGLE = 5
SHARE = 0.8
MINHASHES = 32
BLOCK_SHINGLES = 1_000_000
_WORD = re.compile(r"\w+")
_RANDOM = np.random.default_rng(5)
_FACTORS = _RANDOM.integers(1, 2**63, MINHASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _word_hashes(words: list[str]) -> np.ndarray:
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    digest = xxhash.xxh64_intdigest
    known = [digest(word.encode("utf-8", "surrogatepass"), 1) for word in distinct]
    return np.array(known, np.uint64)[codes]


def _shingle_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` words; runs over the end of a text are cut later."""
    n = len(hashes) - length + 1
    out = np.zeros(max(n, 0), np.uint64)
    for place in range(length if n > 0 else 0):
        out = (out ^ hashes[place : place + n]) * _STEP
        out ^= out >> np.uint64(31)
    return out


def _shingles(words: list[str], length: int) -> set[tuple[str, ...]]:
    return set(zip(*[words[i:] for i in range(length)]))


class Items:
    """The search index of a block of test items."""

    def __init__(self, items: list[tuple[int | None, list[str]]]):
        self.ids = [item for item, _ in items]
        self.lengths = [min(SHINGLE, len(words)) for _, words in items]
        self.shingles = [_shingles(w, n) for (_, w), n in zip(items, self.lengths)]
        parts: dict[tuple[int, int], list[int]] = defaultdict(list)
        for number, (own, length) in enumerate(zip(self.shingles, self.lengths)):
            parts[length, 1 << (len(own) - 1).bit_length()].append(number)
        #: (shingle length, block size, fewest shingles) with sorted minhashes and items
        self.partitions = []
        for (length, size), numbers in sorted(parts.items()):
            least = min(self.needed(number) for number in numbers)
            signatures = np.stack(
                [
                    np.array(
                        [
                            (_shingle_hashes(_word_hashes(items[n][1]), length) * a).min()
                            for n in numbers
                        ]
                    )
                    for a in _FACTORS
                ]
            )
            order = np.argsort(signatures, axis=1)
            self.partitions.append(
                (
                    (length, size, least),
                    np.take_along_axis(signatures, order, axis=1),
                    np.array(numbers)[order],
                )
            )

    def needed(self, number: int) -> int:
        """Fewest shingles that are the required share of an item."""
        return -int(-SHARE * len(self.shingles[number]) // 1)

    def found(self, texts: list[str]) -> list[list[tuple[int | None, float]]]:
        """The items in each text with the share of their shingles it holds."""
        words = [words_of(text) for text in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        out: list[list[tuple[int | None, float]]] = [[] for _ in texts]
        if not counts.sum():
            return out
        hashes = _word_hashes([w for own in words for w in own])
        candidates: set[tuple[int, int]] = set()
        for (length, size, least), signatures, numbers in self.partitions:
            candidates |= _meet(hashes, counts, length, size, least, signatures, numbers)
        held: dict[tuple[int, int], set] = {}
        for text, number in sorted(candidates):
            length, own = self.lengths[number], self.shingles[number]
            if (text, length) not in held:
                held = {k: v for k, v in held.items() if k[0] == text}
                held[text, length] = _shingles(words[text], length)
            common = len(own & held[text, length])
            if common >= self.needed(number):
                out[text].append((self.ids[number], common / len(own)))
        return out


def _meet(
    hashes: np.ndarray,
    counts: np.ndarray,
    length: int,
    size: int,
    least: int,
    signatures: np.ndarray,
    numbers: np.ndarray,
) -> set[tuple[int, int]]:
    """(text, item) pairs of which a block and the item share a minhash."""
    first = np.cumsum(counts) - counts
    runs = counts - length + 1
    texts = np.flatnonzero(runs >= max(least, 1))
    if not len(texts):
        return set()
    runs, first = runs[texts], first[texts]
    shingles = _shingle_hashes(hashes, length)
    place = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    shingles = shingles[np.repeat(first, runs) + place]
    starts = np.flatnonzero(place % size == 0)
    owner = np.repeat(texts, -(-runs // size))
    pairs: set[tuple[int, int]] = set()
    for a, known, items in zip(_FACTORS, signatures, numbers):
        least_of = np.minimum.reduceat(shingles * a, starts)
        left = np.searchsorted(known, least_of, side="left")
        right = np.searchsorted(known, least_of, side="right")
        for block in np.flatnonzero(right > left):
            text = int(owner[block])
            pairs.update((text, int(i)) for i in items[left[block] : right[block]])
    return pairs


def item_blocks(benchmark: DataFrame, most: int = BLOCK_SHINGLES) -> Iterator[Items]:
    """Indexes of the items of ``benchmark`` (item_id, text), block after block."""
    block: list[tuple[int | None, list[str]]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_of().alias("text"))
    for row in rows.toLocalIterator():
        words = words_of(row.text)
        if not words:
            continue
        if block and size + len(words) > most:
            yield Items(block)
            block, size = [], 0
        block.append((row.item_id, words))
        size += len(words)
    if block:
        yield Items(block)


def contained_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, containment) of all items found in ``docs``."""
    schema = "doc_id bigint, item_id bigint, containment double"
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    found = spark.createDataFrame([], schema)
    for items in item_blocks(benchmark):
        held = spark.sparkContext.broadcast(items)

        def search(frames: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for part in slices(frame):
                    hits = [
                        (doc, item, share)
                        for doc, own in zip(
                            part["doc_id"], held.value.found(part["text"].tolist())
                        )
                        for item, share in own
                    ]
                    out = pd.DataFrame(hits, columns=["doc_id", "item_id", "containment"])
                    yield out.astype({"doc_id": "Int64", "item_id": "Int64", "containment": float})

        found = found.unionByName(rows.mapInPandas(search, schema))
    return found.groupBy("doc_id", "item_id").agg(F.max("containment").alias("containment"))


def holds_items(text: Column, items: Items, spark) -> Column:
    """Whether each text holds an item of the block."""
    held = spark.sparkContext.broadcast(items)

    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list[bool] = []
            for part in slices(texts.to_frame("text")):
                out += [bool(own) for own in held.value.found(part["text"].tolist())]
            yield pd.Series(out, dtype=bool)

    return holds(text)


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose texts hold no item."""
    for items in item_blocks(benchmark):
        docs = docs.where(~holds_items(text_of(), items, docs.sparkSession))
    return docs
