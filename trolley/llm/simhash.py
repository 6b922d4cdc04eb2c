"""SimHash near-dedup by anchor-point covering.

A fingerprint has 64 bits, from the hashes of the word shingles. Two fingerprints that
differ in at most t bits differ in at most t // 2 bits in one of two halves. For each
half the anchors are the words of the perfect Hamming code of 31 bits, of covering radius
1: every half has exactly one nearest anchor. A fingerprint is copied to every anchor
within 1 + t // 2 bits of its half; whatever links to x is at the anchor nearest to x.
Each anchor compares all 64 bits of what it holds, nearest ones against all.

Equal fingerprints are one before anything is compared, so copies cost nothing. An
anchor with more than its share of nearest fingerprints is split by blocks of the
other bits: among t + 1 blocks, one is equal in both. A group of alike fingerprints
gives links that keep it connected, not all its pairs, so nothing grows with the square.

A text without words has fingerprint zero and links like any other. Null texts are
empty texts; rows with the same id and other texts are linked by that id.
A null id cannot be named: such rows give no row. Tables may be empty; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.components import components
from trolley.llm.shared import slices, text_of, written, whole_row

HALF = 31
SHIFTS = (0, 32)
SEED = 42
#: Anchors with more nearest fingerprints are split; at most 2 * CROWDED_PARTS are.
CROWDED, CROWDED_PARTS = 4096, 50_000
_BATCH_PAIRS = 1 << 21


# --- fingerprints --------------------------------------------------------------


def fingerprint(text: str, words_per_shingle: int = 3) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    n = max(1, len(words) - words_per_shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    stops = ends[min(words_per_shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(whole[a:b], SEED) for a, b in zip(starts[:n].tolist(), stops.tolist())),
        np.uint64,
        n,
    )
    counts = np.zeros(64, np.int64)
    for part in range(0, n, 1 << 16):
        rows = hashes[part : part + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed number."""

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = [fingerprint(text, words_per_shingle) for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "fp": np.array(values, np.uint64).view(np.int64),
                }
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.where(F.col("doc_id").isNotNull()).mapInPandas(make, "doc_id bigint, fp bigint")


# --- anchors ---------------------------------------------------------------------


def _syndrome(half: np.ndarray) -> np.ndarray:
    """XOR of the numbers (1 to 31) of the set bits: zero for anchors."""
    out = np.zeros(half.shape, np.int64)
    for bit in range(HALF):
        out ^= np.where(half >> bit & 1, bit + 1, 0)
    return out


def _flip(half: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Flip the bit with this number; none for 0."""
    return np.where(number > 0, half ^ (np.int64(1) << np.maximum(number - 1, 0)), half)


def anchors(half: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest anchor of each half, and those within 1 + ``reach`` bits (columns).

    All words within ``reach`` bits of the half have their nearest anchor among them,
    so the second array is the anchors nearest to these words; repeats are -1.
    """
    numbers = _syndrome(half)
    home = _flip(half, numbers)
    near = [home]
    frontier = [(half, numbers)]
    for _ in range(reach):
        frontier = [
            (word ^ (np.int64(1) << bit), number ^ (bit + 1))
            for word, number in frontier
            for bit in range(HALF)
        ]
        near += [_flip(word, number) for word, number in frontier]
    near = np.sort(np.stack(near, axis=1), axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    return home, near


def _anchor_rows(frames: Iterator[pd.DataFrame], reach: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        fps = frame["fp"].to_numpy(dtype=np.int64)
        for part in range(0, len(fps), 20_000):
            fp = fps[part : part + 20_000]
            for number, shift in enumerate(SHIFTS):
                half = fp >> shift & (1 << HALF) - 1
                home, near = anchors(half, reach)
                row, column = np.nonzero(near >= 0)
                anchor = near[row, column]
                yield pd.DataFrame(
                    {
                        "anchor": anchor | number << HALF,
                        "fp": fp[row],
                        "home": anchor == home[row],
                    }
                )


# --- comparing --------------------------------------------------------------------


def _links_of_group(fps: np.ndarray, homes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that connect what direct links between a home and any other connect.

    Search from home to home; what has been reached is not compared again with homes
    of its own group, so a crowd of alike fingerprints takes few rounds.
    """
    unseen_home = homes.copy()
    linked = np.zeros(len(fps), bool)
    out = []
    stack: list[int] = []
    while True:
        if not stack:
            left = np.flatnonzero(unseen_home)
            if not len(left):
                return out
            stack.append(int(left[0]))
            unseen_home[left[0]] = False
            linked[:] = False
            linked[left[0]] = True
        x = stack.pop()
        open_ = np.flatnonzero(~linked)
        hit = open_[np.bitwise_count(fps[open_] ^ fps[x]) <= most]
        linked[hit] = True
        out.extend((int(fps[x]), int(y)) for y in fps[hit])
        stack.extend(hit[unseen_home[hit]].tolist())
        unseen_home[hit] = False


def _links(frames: Iterator[pd.DataFrame], keys: list[str], most: int) -> Iterator[pd.DataFrame]:
    """Links within runs of equal keys; a run may span several batches."""
    held = None
    for frame in frames:
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        if not len(frame):
            continue
        values = frame[keys].to_numpy()
        cut = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        last = int(cut[-1]) if len(cut) else 0
        held = frame.iloc[last:]
        if last:
            yield _links_of_runs(frame.iloc[:last], cut, most)
    if held is not None and len(held):
        yield _links_of_runs(held, np.array([len(held)]), most)


def _links_of_runs(frame: pd.DataFrame, stops: np.ndarray, most: int) -> pd.DataFrame:
    fps = frame["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    homes = frame["home"].to_numpy(dtype=bool)
    starts = np.concatenate([[0], stops[:-1]])
    sizes = stops - starts
    home_counts = np.add.reduceat(homes.astype(np.int64), starts)
    left, right = [], []
    # Small runs together: homes of a run against all rows of it, as one array.
    small = np.flatnonzero((sizes > 1) & (home_counts > 0) & (sizes <= 64))
    at, per = 0, 64 * 64
    while at < len(small):
        part = small[at : at + _BATCH_PAIRS // per]
        at += len(part)
        rows = np.concatenate([np.arange(starts[i], stops[i]) for i in part])
        rows = rows[homes[rows]]
        run = np.searchsorted(stops, rows, side="right")
        n = sizes[run]
        x = np.repeat(rows, n)
        y = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[run], n)
        ok = (x != y) & (np.bitwise_count(fps[x] ^ fps[y]) <= most)
        left.append(fps[x[ok]])
        right.append(fps[y[ok]])
    for i in np.flatnonzero((home_counts > 0) & (sizes > 64)):
        span = slice(starts[i], stops[i])
        pairs = np.array(_links_of_group(fps[span], homes[span], most), np.uint64).reshape(-1, 2)
        left.append(pairs[:, 0])
        right.append(pairs[:, 1])
    if not left:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    pairs = np.stack([np.concatenate(left), np.concatenate(right)], axis=1)
    pairs = np.unique(np.sort(pairs, axis=1), axis=0).view(np.int64)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def links(distinct: DataFrame, most: int = 3) -> DataFrame:
    """(a, b): links between the fingerprints of ``distinct`` (fp, each once).

    Every pair within ``most`` bits is connected by links, each of them within
    ``most`` bits.
    """
    spark, reach = distinct.sparkSession, most // 2
    rows = distinct.select("fp").mapInPandas(
        lambda frames: _anchor_rows(frames, reach), "anchor bigint, fp bigint, home boolean"
    )
    total = distinct.count()
    least = max(CROWDED, total // CROWDED_PARTS)
    # A nearest anchor takes each fingerprint twice, so fewer than 2 * CROWDED_PARTS rows.
    crowded = [
        row.anchor
        for row in rows.where("home")
        .groupBy("anchor")
        .count()
        .where(F.col("count") > least)
        .collect()
    ]
    held = spark.sparkContext.broadcast(np.sort(np.array(crowded, np.int64)))

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of crowded anchors once for each block of the bits of the other half."""
        width = -(-64 // (most + 1))
        for frame in frames:
            anchor = frame["anchor"].to_numpy(dtype=np.int64)
            many = np.isin(anchor, held.value)
            yield frame[~many].assign(block=np.int64(-1))
            own = frame[many]
            fp = own["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for block in range(most + 1) if len(own) else ():
                bits = fp >> np.uint64(width * block) & np.uint64(2**width - 1)
                yield own.assign(block=bits.astype(np.int64) | block << 32)

    dealt = rows.mapInPandas(split, "anchor bigint, fp bigint, home boolean, block bigint")
    keys = ["anchor", "block"]
    return (
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInPandas(lambda frames: _links(frames, keys, most), "a bigint, b bigint")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, words_per_shingle: int = 3, most: int = 3
) -> DataFrame:
    """(doc_id, fp, component_id), one row per document; the smallest id names a group."""
    known = written(fingerprints(docs, words_per_shingle), "fingerprints")
    classes = written(
        known.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes"
    )
    pairs = links(classes, most)
    ends = (
        pairs.join(classes.withColumnRenamed("fp", "a").withColumnRenamed("first", "u"), "a")
        .join(classes.withColumnRenamed("fp", "b").withColumnRenamed("first", "v"), "b")
        .select("u", "v")
    )
    # An id with several texts joins their classes.
    same = (
        known.groupBy("doc_id")
        .agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        .where(F.col("low") != F.col("high"))
        .select("doc_id")
        .join(known, "doc_id")
        .join(classes, "fp")
        .select(F.col("doc_id").alias("u"), F.col("first").alias("v"))
    )
    groups = components(ends.unionByName(same))
    named = known.join(classes, "fp").join(
        groups.withColumnRenamed("node", "first"), "first", "left"
    )
    return named.select(
        "doc_id", "fp", F.coalesce("component", "first").alias("component_id")
    )


def first_of_each_group(docs: DataFrame, words_per_shingle: int = 3, most: int = 3) -> DataFrame:
    """One row of ``docs`` for each group: the smallest id, by text if it repeats.

    Rows without id are kept, as no group can name them.
    """
    found = near_duplicates(docs, words_per_shingle, most)
    leaders = found.where(F.col("doc_id") == F.col("component_id")).select(
        F.col("component_id").alias("leader")
    ).distinct()
    held = docs.select(whole_row(docs, "row"), F.col("doc_id").cast("bigint").alias("leader"))
    kept = (
        held.join(leaders, "leader", "left_semi")
        .groupBy("leader")
        .agg(F.min_by("row", F.struct(text_of("row.text"))).alias("row"))
    )
    unnamed = held.where(F.col("leader").isNull())
    return kept.select("row").unionByName(unnamed.select("row")).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns]
    )
