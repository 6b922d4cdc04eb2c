"""Line dedup: a sharded minimal perfect hash over the repeated lines.

1. Spark counts, for each 128-bit line hash, how often it occurs and the smallest and
   largest id of the documents that hold it; lines of one document only need no entry.
2. Each shard of these hashes becomes a minimal perfect hash (levels of bit arrays
   with ranks) that places 64-bit fingerprints, counts and owners in dense arrays.
3. Documents send the hashes of their lines, packed by shard, to the arrays and get back
   the places of the lines to drop. Lines that make up more than one in HOT_PARTS of all
   lines are fewer than HOT_PARTS, be it in many documents or in one; their arrays go
   to every task, so that no shard receives more than its even share of lines to look
   up. What these drop is dealt evenly, and rows alike in id and text are sent once a slice.
4. Texts meet their places once and are put together again.

A null text is one empty line. A document without id counts as one with the largest
possible id. Rows with the same id are one document for counting, and each
row loses its own lines. The table may be empty, and other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.shared import slices, text_of, whole_row

HOT_PARTS = 20_000
LINES_PER_SHARD = 100_000
LEAST_SHARDS = 256
LINES_TOGETHER = 64
LEAST_KEY = 10
NO_ID = 2**63 - 1
BLANKS = " \t\n\x0b\f\r"
SECOND = "second"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEED = xxhash.xxh64_intdigest(SECOND.encode(), 42)
_ENTRY = np.dtype([("h1", "<i8"), ("h2", "<i8"), ("n", "<i8"), ("owner", "<i8")])
_PROBE = np.dtype(
    [("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8"), ("row", "<i8"), ("line", "<i4")]
)


# --- minimal perfect hash -----------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (_mix(h1 ^ _mix(h2 + step)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Distinct 128-bit keys to 0..n-1: keys alone in their place stay, others go on.

    ``levels`` are bit arrays; the number of a key is the rank of its bit over all levels.
    """

    def __init__(self, h1: np.ndarray, h2: np.ndarray):
        self.levels: list[np.ndarray] = []
        while len(h1):
            size = 2 * len(h1) + 1
            at = _place(h1, h2, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append(alone)
            rest = ~alone[at]
            h1, h2 = h1[rest], h2[rest]
        self._ranks()

    def _ranks(self) -> None:
        self.ranks, base = [], 0
        for bits in self.levels:
            self.ranks.append(base + np.cumsum(bits, dtype=np.int64) - 1)
            base += int(bits.sum())

    def __call__(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Number of each key; -1 or any number for keys it was not built from."""
        found = np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        for level, bits in enumerate(self.levels):
            if not len(left):
                break
            at = _place(h1[left], h2[left], level, len(bits))
            hit = bits[at]
            found[left[hit]] = self.ranks[level][at[hit]]
            left = left[~hit]
        return found

    def packed(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<i8")
        return sizes.tobytes() + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def unpacked(cls, data: bytes) -> PerfectHash:
        self = cls.__new__(cls)
        count = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", count, 8).tolist()
        at, self.levels = 8 * (count + 1), []
        for size in sizes:
            width = (size + 7) // 8
            bits = np.unpackbits(np.frombuffer(data, np.uint8, width, at), count=size)
            self.levels.append(bits.astype(bool))
            at += width
        self._ranks()
        return self


class LineIndex:
    """Fingerprints, counts and owners of lines at the places of a perfect hash."""

    def __init__(self, entries: np.ndarray):
        h1, h2 = entries["h1"].view("<u8"), entries["h2"].view("<u8")
        self.hash = PerfectHash(h1, h2)
        order = np.argsort(self.hash(h1, h2), kind="stable")
        self.fingerprints = h2[order]
        self.counts = np.minimum(entries["n"][order], 2**31 - 1).astype("<i4")
        self.owners = entries["owner"][order]

    def found(self, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each (h1, h2, doc) is known, and whether it is outside its owner."""
        if not len(self.owners):
            return np.zeros(len(probes), bool), np.zeros(len(probes), bool)
        at = self.hash(probes["h1"], probes["h2"])
        known = (at >= 0) & (self.fingerprints[at] == probes["h2"])
        return known, known & (self.counts[at] >= 2) & (self.owners[at] != probes["doc"])

    def dropped(self, probes: np.ndarray) -> np.ndarray:
        """Whether each (h1, h2, doc) is a repeated line outside its owner."""
        return self.found(probes)[1]

    def packed(self) -> bytes:
        head = self.hash.packed()
        arrays = (self.fingerprints, self.counts, self.owners)
        sizes = np.array([len(self.owners), len(head)], "<i8").tobytes()
        return sizes + head + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def unpacked(cls, data: bytes) -> LineIndex:
        self = cls.__new__(cls)
        n, head = np.frombuffer(data, "<i8", 2).tolist()
        self.hash = PerfectHash.unpacked(data[16 : 16 + head])
        at = 16 + head
        self.fingerprints = np.frombuffer(data, "<u8", n, at)
        self.counts = np.frombuffer(data, "<i4", n, at + 8 * n)
        self.owners = np.frombuffer(data, "<i8", n, at + 12 * n)
        return self


# --- lines ----------------------------------------------------------------------


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _LOWER)


def _key(line: str) -> str:
    return line.strip(BLANKS).translate(_TO_LOWER)


_TO_LOWER = str.maketrans(_UPPER, _LOWER)


def _shard(h1, shards: int):
    return (h1 >> np.uint64(32)) % np.uint64(shards)


def _row_key(doc_id: str, text: Column) -> list[Column]:
    """Id and text hash: rows alike in both lose the same lines."""
    return [
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).alias("row"),
    ]


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(h1, h2, n, owner, shared) of the line keys that occur more than once.

    ``n`` counts occurrences, ``shared`` says whether several documents hold the line.
    """
    lines = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("owner"),
        F.explode(F.transform(F.split(text_of(), "\n"), line_key)).alias("key"),
    ).where(F.length("key") >= LEAST_KEY)
    hashed = lines.select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(SECOND), "key").alias("h2"),
        "owner",
    )
    # Smallest and largest id differ exactly if there are two documents or more.
    return (
        hashed.groupBy("h1", "h2")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("owner").alias("owner"),
            F.max("owner").alias("last"),
        )
        .where(F.col("n") > 1)
        .select("h1", "h2", "n", "owner", (F.col("owner") != F.col("last")).alias("shared"))
    )


def _entries(frame: pd.DataFrame) -> np.ndarray:
    entries = np.zeros(len(frame), _ENTRY)
    for name in _ENTRY.names:
        entries[name] = frame[name].to_numpy()
    return entries


def _probes(part: pd.DataFrame) -> np.ndarray:
    """Hashes of the lines of several texts that are long enough to be dropped."""
    digest, rows, docs, places = xxhash.xxh64_intdigest, [], [], []
    for doc in zip(part["doc"], part["row"], part["text"]):
        text = doc[2]
        for place, line in enumerate(text.split("\n")):
            key = _key(line)
            if len(key) >= LEAST_KEY:
                data = key.encode("utf-8", "surrogatepass")
                rows.append((digest(data, 42), digest(data, _SEED)))
                docs.append(doc[:2])
                places.append(place)
    probes = np.zeros(len(rows), _PROBE)
    if rows:
        both = np.array(rows, np.uint64)
        probes["h1"], probes["h2"] = both[:, 0], both[:, 1]
        probes["doc"], probes["row"] = np.array(docs, np.int64).T
        probes["line"] = places
    return probes


def _targets(probes: np.ndarray, own: LineIndex, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The probes that travel and their shards; below zero: ``own`` drops the line.

    Lines that ``own`` knows and keeps need not travel. Those it drops are dealt by
    document and place, a few neighbouring lines together.
    """
    known, drop = own.found(probes)
    probes, drop = probes[~known | drop], drop[~known | drop]
    to = _shard(probes["h1"], shards).astype(np.int64)
    gone = probes[drop]
    place = (gone["line"] // LINES_TOGETHER).astype(np.uint64)
    mixed = _mix(_mix(gone["doc"].view("<u8") ^ _mix(gone["row"].view("<u8"))) + place)
    to[drop] = -1 - (mixed % np.uint64(shards)).astype(np.int64)
    return probes, to


def _packed_columns(probes: np.ndarray) -> bytes:
    """Column after column, which packs better than row after row."""
    return b"".join(np.ascontiguousarray(probes[name]).tobytes() for name in _PROBE.names)


def _unpacked_columns(data: bytes) -> np.ndarray:
    probes = np.zeros(len(data) // _PROBE.itemsize, _PROBE)
    at = 0
    for name in _PROBE.names:
        kind = _PROBE[name]
        probes[name] = np.frombuffer(data, kind, len(probes), at)
        at += kind.itemsize * len(probes)
    return probes


COUNTS = ("n_lines", "n_dropped")


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with shortened texts and the columns n_lines and n_dropped.

    Columns of ``docs`` with one of these names, in upper or lower case, are left out for them;
    ``with_shorter_texts`` keeps them.
    """
    rows, columns = _dropped(docs)
    own = [column for name, column in zip(docs.columns, columns) if name.lower() not in COUNTS]
    return rows.select(*own, *COUNTS)


def with_shorter_texts(docs: DataFrame) -> DataFrame:
    """``docs``, all of its columns, with shortened texts."""
    rows, columns = _dropped(docs)
    return rows.select(*columns)


def _dropped(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """Rows with the counts of lines, and on them the columns of ``docs`` with shorter texts."""
    spark = docs.sparkSession
    # Three jobs read it; what is lost with an executor is computed again.
    repeated = repeated_lines(docs).persist(StorageLevel.DISK_ONLY)
    occurrences = repeated.agg(F.sum("n")).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-occurrences // LINES_PER_SHARD))
    is_hot = F.col("n") > F.lit(occurrences / HOT_PARTS)
    # Fewer than HOT_PARTS rows, whatever the size of the input.
    hot_rows = repeated.where(is_hot).toPandas()
    hot = spark.sparkContext.broadcast(LineIndex(_entries(hot_rows)).packed())

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        index = LineIndex(_entries(frame)).packed()
        return pd.DataFrame({"shard": [int(frame["shard"].iloc[0])], "arrays": [index]})

    by_shard = F.pmod(F.shiftrightunsigned("h1", 32), F.lit(shards)).cast("int")
    index = (
        repeated.where(~is_hot & F.col("shared"))
        .withColumn("shard", by_shard)
        .groupBy("shard")
        .applyInPandas(build, "shard int, arrays binary")
    )

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Lines packed by shard; those that the hot arrays drop go to shards below zero."""
        own = LineIndex.unpacked(hot.value)
        for frame in frames:
            for part in slices(frame):
                # Rows alike in id and text lose the same lines.
                once = part.drop_duplicates(["doc", "row"])
                probes, to = _targets(_probes(once), own, shards)
                order = np.argsort(to, kind="stable")
                occurring, firsts = np.unique(to[order], return_index=True)
                pieces = np.split(probes[order], firsts[1:])
                if len(to):
                    yield pd.DataFrame(
                        {"shard": occurring, "probes": [_packed_columns(p) for p in pieces]}
                    )

    def probe(sent: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros(0, _PROBE)]
        decided = len(sent) > 0 and sent["shard"].iloc[0] < 0
        own = LineIndex.unpacked(arrays["arrays"].iloc[0]) if len(arrays) else None
        for data in sent["probes"] if decided or own else ():
            probes = _unpacked_columns(data)
            found.append(probes if decided else probes[own.dropped(probes)])
        hits = np.concatenate(found)
        return pd.DataFrame({name: hits[name] for name in ("doc", "row", "line")})

    texts = docs.select(*_row_key("doc_id", text_of()), text_of().alias("text"))
    drops = (
        texts.mapInPandas(send, "shard int, probes binary")
        .groupBy("shard")
        .cogroup(index.groupBy("shard"))
        .applyInPandas(probe, "doc bigint, row bigint, line int")
        .groupBy("doc", "row")
        .agg(F.sort_array(F.collect_set("line")).alias("lines"))
    )
    return _without(docs, drops)


def _without(docs: DataFrame, drops: DataFrame) -> tuple[DataFrame, list[Column]]:
    """Texts without the lines at the places in ``drops`` (doc, row, lines)."""
    held = docs.select(whole_row(docs, "held"), *_row_key("doc_id", text_of()))
    met = held.join(drops, ["doc", "row"], "left")

    @F.pandas_udf("string")
    def kept(texts: pd.Series, places: pd.Series) -> pd.Series:
        out = []
        for text, gone in zip(texts, places):
            if gone is not None:
                gone = set(gone)
                lines = enumerate(text.split("\n"))
                text = "\n".join(line for i, line in lines if i not in gone)
            out.append(text)
        return pd.Series(out, dtype=object)

    text = F.coalesce(F.col("held.text").cast("string"), F.lit(""))
    rest = F.when(F.col("lines").isNull(), F.col("held.text")).otherwise(
        kept(text, F.col("lines"))
    )
    columns = [
        rest.alias(c) if c == "text" else F.col("held").getField(c).alias(c)
        for c in docs.columns
    ]
    counted = met.select(
        "held",
        "lines",
        F.size(F.split(text, "\n")).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
    return counted, columns
