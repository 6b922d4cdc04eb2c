"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions, each a node of a tree of 255 nodes. For every node and
every context of up to four preceding bytes, the training texts give counts of both
outcomes and with them the Krichevsky-Trofimov estimate. All depths are mixed by their
posterior weights: a context's weighted probability is half its own estimate and half
the product of its extensions' ones. A text's probability is that of its bytes and of an
end mark (a byte that UTF-8 never has, which also stands before the text). Contexts that
training never met are left out of the mix, so every text has a positive probability.

The model is never whole in one place. Texts are dealt into blocks. A block sends each
distinct run of five bytes with its training count to the shard of the run's last two
context bytes, which holds the whole subtree below them. Pairs with more than an even
share of the runs (MOST_SPLIT of them at most, found on SAMPLED blocks) are split by a third
byte; which ones they are changes no result. What lies above are sums of bounded size (65,280
nodes, and 255 for each split pair), which go through the driver. The shards send the
log probabilities of their runs back to the blocks, which add them up by text. Words
go the same way for the unigram base. Runs and words arrive counted, once per
block, so a frequent one costs no more than others.

Null texts are empty texts; they score the end alone. Rows with equal ids are scored
each for itself; a null id is in the fold of an empty id. Without training texts all
counts are zero and every bit has probability one half. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.shared import slices, text_of, written

DEPTH = 4
BLOCK_CHARS = 6 << 20
LEAST_SHARDS = 64
END = 255
#: Nodes of the contexts of fewer bytes than this are known everywhere.
UPPER = 2
#: A pair of context bytes is split if it has more than one in so many runs.
MOST_SPLIT = 1024
SAMPLED = 32
_DOC_BITS = 24
_LEVELS = np.arange(8)
LN10 = float(np.log(10.0))
END_WORD = b""  # no word is empty, so this one stands for the end of a text


# --- counts of a block ------------------------------------------------------------


def _packed(texts: list[str]) -> tuple[bytes, list[int]]:
    """Texts as compressed bytes, with their sizes."""
    data = [text.encode("utf-8", "surrogatepass") for text in texts]
    return zstandard.ZstdCompressor(level=6).compress(b"".join(data)), list(map(len, data))


def _unpacked(packed: bytes, sizes: np.ndarray) -> list[bytes]:
    whole = zstandard.ZstdDecompressor().decompress(packed)
    ends = np.cumsum(sizes).tolist()
    return [whole[a:b] for a, b in zip([0, *ends], ends)]


def _runs(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of DEPTH + 1 bytes, sorted; where each one starts in the order of
    all runs; the text of each run in that order.

    A run's number is its bytes, the predicted one last.
    """
    pad, end = bytes([END]) * DEPTH, bytes([END])
    whole = b"".join([*[pad + d + end for d in data], bytes(8)])
    sizes = np.fromiter(map(len, data), np.int64, len(data)) + DEPTH + 1
    # Eight bytes from every place on; the last DEPTH places of a text start no run.
    both = np.ndarray(int(sizes.sum()), ">u8", whole, strides=(1,)).astype(np.uint64)
    both >>= np.uint64(64 - 8 * (DEPTH + 1))
    both <<= np.uint64(_DOC_BITS)
    both |= np.repeat(np.arange(len(data), dtype=np.uint64), sizes)
    inside = np.ones(len(both), bool)
    for place in range(1, DEPTH + 1):
        inside[np.cumsum(sizes) - place] = False
    both = both[inside]
    both.sort()
    owner = (both & np.uint64((1 << _DOC_BITS) - 1)).view(np.int64)
    both >>= np.uint64(_DOC_BITS)
    keys = both.view(np.int64)
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], first, owner


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _words(data: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the word of each token, the tokens of each text; the end is one."""
    number = _Numbers()
    codes = []
    for text in data:
        words = text.lower().split()
        words.append(END_WORD)
        codes.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    every = np.concatenate([np.zeros(0, np.int64), *codes])
    return list(number), every, sizes


_DIGEST = np.dtype([("a", "<u8"), ("b", "<u4")])


def _digests(words: list[bytes]) -> np.ndarray:
    data = b"".join([xxhash.xxh3_128_digest(word)[:12] for word in words])
    return np.frombuffer(data, _DIGEST)


def _pair(keys: np.ndarray) -> np.ndarray:
    return keys >> 8 & (1 << 8 * UPPER) - 1


def _run_shard(keys: np.ndarray, shards: int, split: np.ndarray) -> np.ndarray:
    """By the last two context bytes, by three for the pairs in ``split``."""
    three = 8 * (UPPER + 1)
    longer = keys >> 8 & (1 << three) - 1 | 1 << three
    context = np.where(np.isin(_pair(keys), split), longer, _pair(keys)).astype(np.uint64)
    mixed = context * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def _word_shard(digests: np.ndarray, shards: int) -> np.ndarray:
    return (digests["a"] % np.uint64(shards)).astype(np.int64)


def _dealt(shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Order by shard, the shards that occur, and the places of each in the order."""
    order = np.argsort(shard, kind="stable")
    occurring, first = np.unique(shard[order], return_index=True)
    return order, occurring, np.split(order, first[1:])


# --- the tree ----------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers."""
    shift = np.zeros_like(x)
    y = x.astype(float)
    for step in range(8):
        shift += np.log(y + step)
    y = y + 8.0
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - np.log(np.pi)


class Level:
    """The nodes of all contexts of one depth, with counts and mixing weights."""

    def __init__(self, nodes: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray | None):
        self.nodes, self.a, self.b = nodes, a, b
        own = log_kt(a, b)
        if below is None:
            self.own_weight, self.log_weighted = np.ones(len(a)), own
        else:
            self.own_weight = 1.0 / (1.0 + np.exp(np.clip(below - own, -700, 700)))
            self.log_weighted = np.logaddexp(own, below) - np.log(2.0)

    def mixed(self, nodes: np.ndarray, bits: np.ndarray, p: np.ndarray) -> np.ndarray:
        """``p`` of the longer contexts (NaN: none seen) mixed with this depth's estimate."""
        if not len(self.nodes):
            return p
        at = np.minimum(np.searchsorted(self.nodes, nodes), len(self.nodes) - 1)
        seen = self.nodes[at] == nodes
        a, b, w = self.a[at], self.b[at], self.own_weight[at]
        own = (np.where(bits == 1, b, a) + 0.5) / (a + b + 1.0)
        both = np.where(np.isnan(p), own, w * own + (1.0 - w) * p)
        return np.where(seen, both, p)


def _paths(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node and outcome of the eight decisions of each run's last byte."""
    byte = (keys & 255)[:, None]
    return 1 << _LEVELS | byte >> 8 - _LEVELS, byte >> 7 - _LEVELS & 1


def _of_depth(keys: np.ndarray, node: np.ndarray, depth: int) -> np.ndarray:
    context = keys >> 8 & (1 << 8 * depth) - 1
    return (context[:, None] << 8 | node).ravel()


def _level(nodes: np.ndarray, a: np.ndarray, b: np.ndarray, deeper: Level | None, depth: int) -> Level:
    """Sums by node; the log weighted probabilities of the extensions are added up."""
    every, at = np.unique(nodes, return_inverse=True)
    below = None
    if deeper is not None:
        mask = (1 << 8 * depth) - 1
        parent = (deeper.nodes >> 8 & mask) << 8 | deeper.nodes & 255
        below = np.bincount(
            np.searchsorted(every, parent), weights=deeper.log_weighted, minlength=len(every)
        )
    return Level(
        every,
        np.bincount(at, weights=a, minlength=len(every)),
        np.bincount(at, weights=b, minlength=len(every)),
        below,
    )


def lower_levels(keys: np.ndarray, counts: np.ndarray, first: int = UPPER) -> list[Level]:
    """Levels ``first`` to DEPTH of the runs (distinct) with their training counts."""
    keys, counts = keys[counts > 0], counts[counts > 0].astype(float)
    node, bit = _paths(keys)
    ones = (bit * counts[:, None]).ravel()
    zeros = ((1 - bit) * counts[:, None]).ravel()
    out: list[Level] = []
    for depth in range(DEPTH, first - 1, -1):
        out.insert(0, _level(_of_depth(keys, node, depth), zeros, ones, out[0] if out else None, depth))
    return out


def upper_levels(nodes: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray) -> list[Level]:
    """Levels 0 to UPPER - 1 from the sums over the level below them."""
    order = np.argsort(nodes)
    out = [Level(nodes[order], a[order], b[order], below[order])]
    for depth in range(UPPER - 2, -1, -1):
        first = out[0]
        mask = (1 << 8 * depth) - 1
        parent = (first.nodes >> 8 & mask) << 8 | first.nodes & 255
        out.insert(0, _level(parent, first.a, first.b, first, depth))
    return out


def log_probabilities(keys: np.ndarray, levels: list[Level]) -> np.ndarray:
    """Natural log of the probability of each run's last byte after its context."""
    node, bit = _paths(keys)
    bits = bit.ravel()
    p = np.full(len(bits), np.nan)
    for depth in range(DEPTH, -1, -1):
        p = levels[depth].mixed(_of_depth(keys, node, depth), bits, p)
    p = np.where(np.isnan(p), 0.5, p)
    return np.log(p).reshape(-1, 8).sum(axis=1)


# --- Spark ----------------------------------------------------------------------


def text_blocks(docs: DataFrame, is_training: Column) -> DataFrame:
    """(block, doc_id, training, sizes, packed): rows of several whole texts, written."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in slices(frame, chars=BLOCK_CHARS):
                packed, sizes = _packed(part["text"].tolist())
                yield pd.DataFrame(
                    {
                        "doc_id": [part["doc_id"].astype("Int64").tolist()],
                        "training": [part["training"].tolist()],
                        "sizes": [sizes],
                        "packed": [packed],
                    }
                )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        is_training.alias("training"),
        text_of().alias("text"),
    )
    packed = rows.mapInPandas(
        pack,
        "doc_id array<bigint>, training array<boolean>, sizes array<int>, packed binary",
    )
    # Once written, the numbers and the rows of the blocks stay as they are.
    return written(
        packed.withColumn("block", F.monotonically_increasing_id()), "text-blocks"
    )


def _run_counts(data: list[bytes], training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, first, owner = _runs(data)
    weight = training.astype(np.int64)[owner]
    return keys, np.add.reduceat(weight, first) if len(first) else weight


def _word_counts(data: list[bytes], training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, every, sizes = _words(data)
    weight = np.repeat(training, sizes)
    return _digests(words), np.bincount(every[weight], minlength=len(words))


def _sender(counts_of, shard_of, shards: int):
    """Sends distinct keys with training counts to their shards, packed."""

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                block = row.block
                data = _unpacked(row.packed, row.sizes)
                keys, counts = counts_of(data, np.asarray(row.training, bool))
                counts = counts.astype("<i8")
                _, occurring, places = _dealt(shard_of(keys, shards))
                yield pd.DataFrame(
                    {
                        "shard": occurring,
                        "block": block,
                        "keys": [keys[own].tobytes() for own in places],
                        "counts": [counts[own].tobytes() for own in places],
                    }
                )

    return send


SENT = "shard bigint, block bigint, keys binary, counts binary"


def _merged(frame: pd.DataFrame, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a shard with total counts; the key of each entry, entries per row."""
    sizes = frame["counts"].str.len().to_numpy() // 8
    entries = np.frombuffer(b"".join(frame["keys"]), kind)
    counts = np.frombuffer(b"".join(frame["counts"]), "<i8")
    if entries.dtype.names:
        order = np.lexsort((entries["b"], entries["a"]))
        sorted_ = entries[order]
        new = np.ones(len(order), bool)
        new[1:] = (sorted_["a"][1:] != sorted_["a"][:-1]) | (sorted_["b"][1:] != sorted_["b"][:-1])
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        keys = sorted_[new]
    else:
        keys, at = np.unique(entries, return_inverse=True)
    totals = np.bincount(at, weights=counts, minlength=len(keys))
    return keys, totals, at, np.cumsum(sizes)[:-1]


def _reply(frame: pd.DataFrame, values: np.ndarray, cuts: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "block": frame["block"],
            "shard": frame["shard"],
            "reply": [part.tobytes() for part in np.split(values, cuts)],
        }
    )


def _word_replies(frame: pd.DataFrame) -> pd.DataFrame:
    """Total counts for each block; the first row also has the sums of the shard."""
    _, totals, at, cuts = _merged(frame, _DIGEST)
    out = _reply(frame, totals[at].astype("<i8"), cuts)
    first = np.arange(len(out)) == 0
    out["known"] = np.where(first, (totals > 0).sum(), 0)
    out["tokens"] = np.where(first, totals.sum(), 0).astype(np.int64)
    return out


def _sums_above(keys: np.ndarray, totals: np.ndarray, first: int) -> pd.DataFrame:
    """Sums over the subtrees of level ``first``, by the nodes just above them."""
    top = lower_levels(keys, totals, first)[0]
    every, sums = _by_parent(top, first - 1)
    return pd.DataFrame({"depth": first - 1, "node": every} | sums)


def _by_parent(level: Level, depth: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    nodes = (level.nodes >> 8 & (1 << 8 * depth) - 1) << 8 | level.nodes & 255
    every, at = np.unique(nodes, return_inverse=True)
    weights = {"a": level.a, "b": level.b, "below": level.log_weighted}
    return every, {
        name: np.bincount(at, weights=w, minlength=len(every)) for name, w in weights.items()
    }


def levels_above(sums: pd.DataFrame) -> tuple[list[Level], Level]:
    """Levels 0 to UPPER - 1, and of level UPPER the nodes of the pairs that are split."""
    columns = ["node", "a", "b", "below"]
    own = sums[sums["depth"] == UPPER].sort_values("node")
    pairs = Level(*[own[c].to_numpy() for c in columns])
    every, carried = _by_parent(pairs, UPPER - 1)
    rest = pd.concat([sums.loc[sums["depth"] < UPPER, columns], pd.DataFrame({"node": every} | carried)])
    rest = rest.groupby("node", as_index=False).sum()
    return upper_levels(*[rest[c].to_numpy() for c in columns]), pairs


def crowded_pairs(blocks: DataFrame, shards: int) -> np.ndarray:
    """Pairs of context bytes that hold more than an even share of the runs of some blocks.

    There are MOST_SPLIT of them at most. They only say which group holds what.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                keys, _, _ = _runs(_unpacked(row.packed, row.sizes))
                pairs, n = np.unique(_pair(keys), return_counts=True)
                yield pd.DataFrame({"pair": pairs, "n": n})

    order = F.xxhash64("block")
    some = [row.block for row in blocks.select("block").orderBy(order).limit(SAMPLED).collect()]
    counts = (
        blocks.where(F.col("block").isin(some)).select("sizes", "packed")
        .mapInPandas(count, "pair bigint, n bigint")
        .groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    )
    least = max(1 / shards, 1 / MOST_SPLIT)
    return np.sort(counts.loc[counts["n"] > least * counts["n"].sum(), "pair"].to_numpy(np.int64))


def scored(docs: DataFrame, is_training: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte).

    Learns from the rows where ``is_training`` holds, scores all. ``score`` is the log10
    probability of the whole text, ``base_score`` that of its words and the end by
    add-one counts; ``bits_per_byte`` is the code length by the number of bytes and the end.
    """
    spark = docs.sparkSession
    blocks = text_blocks(docs, is_training)
    # As many tasks as blocks, so that what a task reads does not grow with the input.
    tasks = max(1, blocks.count())
    shards = max(LEAST_SHARDS, tasks)
    split = crowded_pairs(blocks, shards)

    def run_shard(keys: np.ndarray, shards: int) -> np.ndarray:
        return _run_shard(keys, shards, split)

    contents = blocks.select("block", "training", "sizes", "packed")
    words = contents.mapInPandas(
        _sender(_word_counts, _word_shard, shards), SENT
    )
    word_replies = written(
        words.repartition(tasks, "shard").groupBy("shard").applyInPandas(
            _word_replies,
            "block bigint, shard bigint, reply binary, known bigint, tokens bigint",
        ),
        "word-replies",
    )
    sums = word_replies.agg(F.sum("known").alias("known"), F.sum("tokens").alias("tokens")).first()
    distinct, tokens = sums["known"] or 0, sums["tokens"] or 0

    runs = written(
        contents.mapInPandas(_sender(_run_counts, run_shard, shards), SENT),
        "byte-runs",
    ).repartition(tasks, "shard")

    def sums_above(frame: pd.DataFrame) -> pd.DataFrame:
        keys, totals, _, _ = _merged(frame, "<i8")
        apart = np.isin(_pair(keys), split)
        parts = ((~apart, UPPER), (apart, UPPER + 1))
        return pd.concat([_sums_above(keys[own], totals[own], first) for own, first in parts])

    above = (
        runs.groupBy("shard")
        .applyInPandas(sums_above, "depth int, node bigint, a double, b double, below double")
        .groupBy("depth", "node")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("below").alias("below"))
        .toPandas()
    )
    held = spark.sparkContext.broadcast(levels_above(above))

    def run_replies(frame: pd.DataFrame) -> pd.DataFrame:
        keys, totals, at, cuts = _merged(frame, "<i8")
        upper, pairs = held.value
        apart = np.isin(_pair(keys), split)
        log_p = np.zeros(len(keys))
        for own, above, first in ((~apart, upper, UPPER), (apart, [*upper, pairs], UPPER + 1)):
            levels = [*above, *lower_levels(keys[own], totals[own], first)]
            log_p[own] = log_probabilities(keys[own], levels)
        return _reply(frame, log_p[at].astype("<f8"), cuts)

    replies = (
        runs.groupBy("shard")
        .applyInPandas(run_replies, "block bigint, shard bigint, reply binary")
        .withColumn("of_words", F.lit(False))
        .unionByName(
            word_replies.select("block", "shard", "reply", F.lit(True).alias("of_words"))
        )
    )

    def add_up(block: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        ids = block["doc_id"].iloc[0]
        data = _unpacked(block["packed"].iloc[0], block["sizes"].iloc[0])
        n = len(data)
        keys, first, owner = _runs(data)
        log_p = _answers(got[~got["of_words"]], run_shard(keys, shards), "<f8")
        each = np.repeat(log_p, np.diff(np.append(first, len(owner))))
        score = np.bincount(owner, weights=each, minlength=n) / LN10
        n_bytes = np.bincount(owner, minlength=n) - 1
        words, every, n_tokens = _words(data)
        shard = _word_shard(_digests(words), shards)
        count = _answers(got[got["of_words"]], shard, "<i8").astype(float)
        cut = np.cumsum(n_tokens) - n_tokens
        logs = np.add.reduceat(np.log10(count + 1.0)[every], cut)
        known = np.add.reduceat((count > 0)[every].astype(np.int64), cut)
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if pd.isna(i) else int(i) for i in ids], "Int64"),
                "n_tokens": n_tokens,
                "n_known": known,
                "train_tokens": np.int64(tokens),
                "base_score": logs - n_tokens * np.log10(tokens + distinct + 1.0),
                "score": score,
                "n_bytes": n_bytes,
                "bits_per_byte": -score * np.log2(10.0) / (n_bytes + 1),
            }
        )

    return (
        blocks.select("block", "doc_id", "sizes", "packed")
        .repartition(tasks, "block")
        .groupBy("block")
        .cogroup(replies.repartition(tasks, "block").groupBy("block"))
        .applyInPandas(
            add_up,
            "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, "
            "base_score double, score double, n_bytes bigint, bits_per_byte double",
        )
    )


def _answers(got: pd.DataFrame, shard: np.ndarray, kind: str) -> np.ndarray:
    """The shards' replies at the places of the keys that were sent."""
    order, occurring, _ = _dealt(shard)
    by_shard = dict(zip(got["shard"], got["reply"]))
    out = np.zeros(len(shard), kind)
    out[order] = np.frombuffer(b"".join([by_shard[s] for s in occurring.tolist()]), kind)
    return out
