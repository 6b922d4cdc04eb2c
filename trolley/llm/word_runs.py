"""Periodic runs of words, by maximal pairs of bounded distance.

A run is a stretch with smallest period q that no neighbouring word extends, at least as long as
``least_words`` and ``least_exponent`` times q. If the places i < j of a text have the same l words
behind them, other words behind these, and other words in front, they are a maximal pair; with
j - i = q the stretch from i on of q + l words has period q and cannot be extended. So every
maximal pair whose distance q fits to its length (q + l at least the two bounds) is a run, and every run
is one; only pairs at a multiple of the period give the same stretch again, and the
smallest distance of a stretch is kept. Nothing is extended word by word.

The words of all texts of a slice become numbers, and one suffix array per text is made of them, all
texts together, with doubled lengths. Only places whose next few words (as many as the shortest pair
has) come again in the same text take part. The LCP-interval tree of a text is gone through bottom up. A
node has its places in ascending order, each with its left word as its class; when a
child joins, the smaller list looks for partners within the distance in the larger one, and only pairs of
different classes are taken. Within that distance all partners of a place on one side
are an arithmetic progression, so on the left only the first can be of another class, and on the
right either all are or none. So the work beside sorting grows with the places and the runs found, also in
a text of one repeated word.

Defined cases: a null text is an empty text: no words, no runs; rows are handled each for itself, whatever
their ids; other columns are not looked at; an empty table gives no rows. A text is held by one task, whole.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.shared import text_of, text_slices

#: Odd factors for the hash that finds places worth sorting; equal hashes are compared exactly later.
FACTOR = 0x9E3779B97F4A7C15
#: A list so many times longer than another takes its places one by one.
FEW = 16


def words_of(text: bytes) -> list[bytes]:
    """What stands between blanks and the control characters from tab to carriage return."""
    return text.split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


# --- suffix arrays of many texts ------------------------------------------------------


def repeated_places(words: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """Places whose next ``length`` words may come again in the same text, ascending."""
    n = len(words) - length + 1
    if n < 2:
        return np.zeros(0, np.int64)
    hashes = text[:n].astype(np.uint64)
    for k in range(length):
        hashes = hashes * np.uint64(FACTOR) + words[k : n + k].astype(np.uint64)
        hashes ^= hashes >> np.uint64(29)
    order = np.argsort(hashes)
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    member = np.zeros(n, bool)
    member[order[1:][same]] = True
    member[order[:-1][same]] = True
    return np.flatnonzero(member)


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of rows by ``keys``, the first one most significant."""
    order = np.lexsort(keys[::-1])
    step = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        step[1:] |= ordered[1:] != ordered[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(step)
    return out


def suffix_order(
    words: np.ndarray, text: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places with a repeated window of ``length`` words, sorted by text and following words,
    and the common length of each with the one before it (0 where fewer than ``length``).

    A text ends with a 0, which no word has, so that equal windows lie within their text.
    """
    active = repeated_places(words, text, length)
    none = np.zeros(0, np.int64)
    if not len(active):
        return none, none
    # What follows a repeated window is compared too.
    places = np.union1d(active, np.minimum(active + length, len(words) - 1))
    padded = np.concatenate([words, np.zeros(length, words.dtype)])
    index = np.full(len(words) + 1, -1, np.int64)
    index[places] = np.arange(len(places))
    ranks = _ranks([text[places], *(padded[places + k] for k in range(length))])
    levels, span = [(length, ranks)], length
    while True:
        shared = np.bincount(ranks)[ranks] > 1
        if not shared.any():
            break
        rest = places[shared]
        # Equal windows have the same words behind them up to here, so these places are known.
        second = ranks[index[rest + span]]
        finer = _ranks([ranks[shared], second])
        # Ranks stay in order: a group starts behind all places of smaller rank, its finer
        # ranks behind the places of the group that come before.
        group = ranks[shared]
        sizes = np.bincount(ranks)
        wide = (np.cumsum(sizes) - sizes)[ranks]
        lowest = np.full(len(sizes), len(finer), np.int64)
        np.minimum.at(lowest, group, finer)
        seen = np.bincount(finer)
        before = np.cumsum(seen) - seen
        wide[shared] += before[finer] - before[lowest[group]]
        ranks = wide
        span *= 2
        levels.append((span, ranks))
    order = np.argsort(ranks)
    first_ranks = levels[0][1][order]
    grouped = np.zeros(len(order), bool)
    grouped[1:] = first_ranks[1:] == first_ranks[:-1]
    keep = grouped.copy()
    keep[:-1] |= grouped[1:]
    order, grouped = order[keep], grouped[keep]
    sorted_places = places[order]
    common = np.zeros(len(order), np.int64)
    pairs = np.flatnonzero(grouped)
    left, right = sorted_places[pairs - 1], sorted_places[pairs]
    for span, ranks in reversed(levels):
        here = common[pairs]
        a, b = index[left + here], index[right + here]
        same = (a >= 0) & (b >= 0)
        same[same] = ranks[a[same]] == ranks[b[same]]
        common[pairs[same]] += span
    for _ in range(length - 1):
        here = common[pairs]
        same = padded[left + here] == padded[right + here]
        same &= padded[left + here] > 0
        pairs, left, right = pairs[same], left[same], right[same]
        common[pairs] += 1
    return sorted_places, common


# --- the tree -------------------------------------------------------------------------


class Pairs:
    """Maximal pairs of bounded distance of one group of places, bottom up."""

    def __init__(self, left: list[int], least_words: int, least_exponent: int):
        self.left = left
        self.least_words, self.least_exponent = least_words, least_exponent
        #: (start, length) of a stretch to its smallest distance.
        self.runs: dict[tuple[int, int], int] = {}

    def _take(self, i: int, j: int, common: int) -> None:
        q = j - i
        size = q + common
        if size >= self.least_words and size >= self.least_exponent * q:
            key = i, size
            known = self.runs.get(key)
            if known is None or q < known:
                self.runs[key] = q

    def joined(self, a: list[int], b: list[int], common: int) -> list[int]:
        """The places of two subtrees whose common length is ``common``, in one list."""
        if len(a) < len(b):
            a, b = b, a
        reach = common // (self.least_exponent - 1)
        left, take = self.left, self._take
        for p in b:
            own = left[p]
            low = bisect_left(a, p - reach)
            high = bisect_left(a, p, low)
            if low < high and left[a[low]] != own:
                take(a[low], p, common)
            if high < len(a) and a[high] <= p + reach and left[a[high]] != own:
                for k in range(high, bisect_right(a, p + reach, high)):
                    take(p, a[k], common)
        if a[-1] < b[0]:
            a += b
        elif len(b) * FEW < len(a):
            for p in b:
                insort(a, p)
        else:
            a += b
            a.sort()  # merges two ascending runs
        return a

    def go_through(self, places: list[int], common: list[int]) -> None:
        """One group of the suffix order; ``common[0]`` is not looked at."""
        stack: list[tuple[int, list[int]]] = []  # (common length, places below)
        node = [places[0]]
        for place, height in zip(places[1:], common[1:]):
            while stack and stack[-1][0] > height:
                depth, held = stack.pop()
                node = self.joined(held, node, depth)
            if stack and stack[-1][0] == height:
                node = self.joined(stack.pop()[1], node, height)
            stack.append((height, node))
            node = [place]
        while stack:
            depth, held = stack.pop()
            node = self.joined(held, node, depth)


def runs_of(
    texts: list[list[bytes]], least_words: int = 6, least_exponent: int = 4
) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start, then period."""
    if least_exponent < 3:
        raise ValueError("partners form a progression from an exponent of 3 on")
    # A pair is shorter than its stretch by the distance: at least this long.
    shortest = min(max(least_words - q, (least_exponent - 1) * q) for q in range(1, least_words + 1))
    number = _Numbers()
    sizes = np.fromiter((len(own) + 1 for own in texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total, np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    inside = np.ones(total, bool)
    inside[ends - 1] = False
    words[inside] = np.fromiter(
        map(number.__getitem__, chain.from_iterable(texts)), np.int64, total - len(texts)
    )
    del number
    places, common = suffix_order(words, text, shortest)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(places):
        return out
    # In front of a text there is a word that is nowhere else.
    left = np.concatenate([[0], words[:-1]]).tolist()
    cuts = np.flatnonzero(common == 0)
    edges = [*cuts.tolist(), len(places)]
    lists = places.tolist(), common.tolist(), text[places[cuts]].tolist()
    finders: dict[int, Pairs] = {}
    for start, stop, own in zip(edges, edges[1:], lists[2]):
        finder = finders.get(own)
        if finder is None:
            finder = finders[own] = Pairs(left, least_words, least_exponent)
        finder.go_through(lists[0][start:stop], lists[1][start:stop])
    begins = (ends - sizes).tolist()
    for own, finder in finders.items():
        first = begins[own]
        found = [(i - first, size, q) for (i, size), q in finder.runs.items()]
        out[own] = sorted(found, key=lambda run: (run[0], run[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that are in no run, or among the first period of all runs they are in."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    start, size, period = np.array(runs, np.int64).T
    np.add.at(change, start + period, 1)
    np.add.at(change, start + size, -1)
    kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
    return b" ".join([words[i] for i in kept.tolist()])


# --- Spark ------------------------------------------------------------------------------

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    docs: DataFrame,
    least_words: int = 6,
    least_exponent: int = 4,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every whole text.

    ``runs`` are (start, length, period) by start, then period, counted in words; ``collapsed`` has
    the words that stay if each run is cut to its first period, joined by blanks. ``prepare`` may
    change the words of a text before. No shuffle: each task goes through its own texts.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                ids = part.column("doc_id").to_pylist()
                texts = [words_of(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
                if prepare:
                    texts = [prepare(i, words) for i, words in zip(ids, texts)]
                runs = runs_of(texts, least_words, least_exponent)
                flat = np.array([run for own in runs for run in own], np.int64).reshape(-1, 3)
                edges = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                structs = pa.StructArray.from_arrays(
                    [pa.array(flat[:, k]) for k in range(3)], fields=list(RUN)
                )
                left = [collapsed(words, own) for words, own in zip(texts, runs)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(words) for words in texts], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(edges), structs),
                        pa.array(left, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(
        find,
        "doc_id bigint, n_words bigint, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string",
    )
