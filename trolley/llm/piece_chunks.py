"""SentencePiece encoding and decoding by a table of distinct chunks.

A chunk is a marked word: the whitespace markers before it and its letters, or its signs. No piece
of the vocabulary has a marker behind a letter, or letters and signs, so no merge crosses from one
chunk into the next, and the ids of a text are those of its chunks in order. (What a piece never has
is read off the vocabulary; where letters and signs do mix, chunks end at markers alone.) Each distinct chunk is therefore segmented
once: Spark counts the chunks of all texts and segments the distinct frequent ones as rows of a
table; a bounded part of it, of short and frequent chunks, goes to the tasks. A task numbers the
chunks of a slice, segments those that the table lacks once each, and joins the ids back by
position. The table decides about speed alone.

The vocabulary file is a parameter and nothing is trained. It has to be a BPE model that leaves
texts as they are (no normalisation, no removal of blanks) and puts one marker in front.

Defined cases: a null text is an empty text, which has the end id alone; rows are encoded each for
itself, whatever their ids; a marker that stands in a text is a blank after decoding, as the library
has it; letters that no piece has become bytes; other columns are not looked at.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.shared import text_of, text_slices, written

MARKER = "▁"
#: Rows of the table that go to the tasks, and code points of the longest chunk in it.
FREQUENT = 1 << 16
LONGEST = 64
#: Distinct chunks that a task counts at once.
COUNTED = 500_000
#: Steps of the histogram of counts for each doubling.
STEPS = 16
#: Longer chunks are merged with a heap.
FEW = 40
UNKNOWN_TEXT = " ⁇ "
#: Symbols from here on are letters that no piece has, by code point; two make a pair.
OTHER = 1 << 20
BASE = 1 << 22
NEVER = 1 << 40


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("trolley_each_byte", _each_byte)


class Pieces:
    """Pieces and scores of a model file; small, and sent to the tasks as it is."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(model.vocab_size())
        names = [model.id_to_piece(i) for i in numbers]
        own = [i for i in numbers if not (
            model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        )]
        self.ids = {names[i]: i for i in own}
        self.scores = {names[i]: model.get_score(i) for i in own}
        self.bytes_at = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.end = model.eos_id()
        self.unknown = model.unk_id()
        self._check(model)
        self.surfaces = [name.replace(MARKER, " ").encode() for name in names]
        for byte, number in enumerate(self.bytes_at):
            self.surfaces[number] = bytes([byte])
        for i in numbers:
            if model.is_control(i):
                self.surfaces[i] = b""
        self.surfaces[self.unknown] = UNKNOWN_TEXT.encode()
        self.controls = {i for i in numbers if model.is_control(i)}
        # A blank in front of these is no marker.
        self.plain = {self.bytes_at[32], self.unknown}
        self.chunk_pattern = re.compile(self._pattern())
        self._pair_up()

    def _check(self, model) -> None:
        for name in self.ids:
            if re.search(f"[^{MARKER}]{MARKER}", name):
                raise ValueError(f"piece {name!r} crosses a whitespace marker")
        if self.unknown in self.bytes_at:
            raise ValueError("a model with all bytes is needed")
        probe = " a  é éﬁ "
        if model.normalize(probe) != (" " + probe).replace(" ", MARKER):
            raise ValueError("a model that leaves texts as they are is needed")

    def _symbol(self, text: str) -> int | None:
        """The number of a piece, or of a letter that is none; other texts are no symbols."""
        number = self.ids.get(text)
        return OTHER + ord(text) if number is None and len(text) == 1 else number

    def _pair_up(self) -> None:
        """All pairs of symbols that make a piece, with the piece and the place of its score."""
        places = {v: i for i, v in enumerate(sorted({*self.scores.values()}, reverse=True))}
        pairs = {}
        for name, number in self.ids.items():
            for k in range(1, len(name)):
                left, right = self._symbol(name[:k]), self._symbol(name[k:])
                if left is not None and right is not None:
                    pairs[left * BASE + right] = places[self.scores[name]], number
        self.pair_keys = np.array(sorted(pairs), np.int64)
        found = [pairs[key] for key in self.pair_keys.tolist()]
        self.pair_places, self.pair_pieces = np.array(found, np.int64).reshape(-1, 2).T.copy()
        self.letters = np.arange(OTHER, OTHER + 0x110000, dtype=np.int32)
        for name, number in self.ids.items():
            if len(name) == 1:
                self.letters[ord(name)] = number
        self.letters[32] = self.letters[ord(MARKER)]

    def _paired(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the score, and piece, of pairs of symbols; the place NEVER if they make none."""
        keys = left * BASE + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_places[at], NEVER), self.pair_pieces[at]

    def _pattern(self) -> str:
        """What a chunk is: blanks and what follows them, up to where no piece goes on.

        That is the next blank; a line feed, if no piece holds one; and the change from letters to other
        signs or back, if no piece has both. Letters that stand next to other signs in some piece
        count as signs.
        """
        others = "" if any("\n" in name for name in self.ids) else "\n"
        bare = [name.lstrip(MARKER) for name in self.ids]
        letters, strange = re.compile(r"[^\W\d_]"), set()
        while True:
            mixed = set()
            for name in bare:
                kinds = [bool(letters.match(c)) and c not in strange for c in name]
                if len({*kinds}) > 1:
                    mixed |= {c for c, letter in zip(name, kinds) if letter}
            if not mixed:
                break
            strange |= mixed
        ends = f"{others}+|" if others else ""
        if len(strange) > 50:  # nothing to gain
            return f"{ends} *[^ {others}]+| +"
        more = re.escape("".join(sorted(strange)))
        return rf"{ends} *[^\W\d_{more}]+| *(?:[^\w {others}]|[\d_{more}])+| +"

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text in order, with blanks as markers."""
        if not text:
            return []
        return self.chunk_pattern.findall(" " + text.replace(MARKER, " "))

    def segmented(self, chunk: str) -> list[int]:
        """Ids of one chunk: always the adjacent pair with the best score, leftmost first."""
        return self.segmented_all([chunk])[0].tolist()

    def segmented_all(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of several chunks in a row, and how many each has."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        long = np.flatnonzero(sizes > FEW).tolist()
        short = chunks if not long else [c if len(c) <= FEW else "" for c in chunks]
        symbols, owners = self._together(short, np.where(sizes > FEW, 0, sizes))
        if long:
            own = [[self._symbol(part) for part in self._many(chunks[i])] for i in long]
            owners = np.concatenate([owners, np.repeat(long, list(map(len, own)))])
            symbols = np.concatenate([symbols, *(np.array(part, np.int64) for part in own)])
        order = np.argsort(owners, kind="stable")
        return self._with_bytes(symbols[order], owners[order], len(chunks))

    def _together(self, chunks: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges, and the chunk of each.

        All chunks take part at once: in each round every chunk merges its best pair, leftmost
        first, and those without one leave.
        """
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols = self.letters[codes].astype(np.int64)
        owners = np.repeat(np.arange(len(chunks)), sizes)
        done = []
        places = np.full(len(symbols), NEVER)
        pieces = np.zeros(len(symbols), np.int64)
        inner = np.flatnonzero(owners[1:] == owners[:-1])
        places[inner], pieces[inner] = self._paired(symbols[inner], symbols[inner + 1])
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))
            lengths = np.diff(np.append(first, len(symbols)))
            best = np.repeat(np.minimum.reduceat(places, first), lengths)
            going = best < NEVER
            if not going.all():
                done.append((symbols[~going], owners[~going]))
                symbols, owners, places = symbols[going], owners[going], places[going]
                pieces, best = pieces[going], best[going]
                if not len(symbols):
                    break
            at = np.flatnonzero(places == best)
            at = at[np.concatenate([[True], owners[at[1:]] != owners[at[:-1]]])]
            symbols[at] = pieces[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owners = symbols[keep], owners[keep]
            places, pieces = places[keep], pieces[keep]
            at = at - np.arange(len(at))  # one symbol has gone from each chunk before
            changed = np.concatenate([at[at > 0] - 1, at])
            changed = changed[changed + 1 < len(symbols)]
            inner = owners[changed] == owners[changed + 1]
            places[at] = NEVER
            changed = changed[inner]
            places[changed], pieces[changed] = self._paired(symbols[changed], symbols[changed + 1])
        none = np.zeros(0, np.int64)
        return (
            np.concatenate([none, *(part for part, _ in done)]),
            np.concatenate([none, *(part for _, part in done)]),
        )

    def _with_bytes(
        self, symbols: np.ndarray, owners: np.ndarray, chunks: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids, with letters that no piece has as their bytes, and the number for each chunk."""
        strange = np.flatnonzero(symbols >= OTHER)
        if len(strange):
            bytes_of = {
                code: [self.bytes_at[b] for b in chr(code).encode("utf-8", "surrogatepass")]
                for code in np.unique(symbols[strange] - OTHER).tolist()
            }
            own = [bytes_of[code] for code in (symbols[strange] - OTHER).tolist()]
            counts = np.ones(len(symbols), np.int64)
            counts[strange] = list(map(len, own))
            symbols, owners = np.repeat(symbols, counts), np.repeat(owners, counts)
            symbols[symbols >= OTHER] = list(chain.from_iterable(own))
        return symbols.astype(np.int32), np.bincount(owners, minlength=chunks)

    def _many(self, chunk: str) -> list[str]:
        """The parts of one long chunk, with a heap and links."""
        symbols = list(chunk.replace(" ", MARKER))
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j < n:
                whole = symbols[i] + symbols[j]
                value = self.scores.get(whole)
                if value is not None:
                    heapq.heappush(heap, (-value, i, len(whole)))

        for i in range(n):
            push(i)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            # Parts only grow, so equal length means the same two parts.
            if not symbols[i] or j >= n or len(symbols[i]) + len(symbols[j]) != size:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [s for s in symbols if s]

    def decoded(self, ids: list[int]) -> str:
        """The text of ids. The marker in front of the first piece is the one put there.

        Bytes that are no UTF-8 become U+FFFD one by one; control pieces have no text, but
        bytes before and after one make no letter together.
        """
        between = [k for k, i in enumerate(ids[:-1]) if i in self.controls]
        edges = [0, *between, len(ids)]
        parts = [
            b"".join(map(self.surfaces.__getitem__, ids[a:b])) for a, b in zip(edges, edges[1:])
        ]
        text = "".join([part.decode("utf-8", "trolley_each_byte") for part in parts])
        first = next((i for i in ids if i not in self.controls), None)
        marked = first is not None and first not in self.plain and text[:1] == " "
        return text[1:] if marked else text


class Numbers(dict):
    """Numbers chunks in the order in which they are first asked for."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number


class Encoder:
    """Encodes the texts of a slice together, each distinct chunk once."""

    def __init__(self, pieces: Pieces, table: dict[str, list[int]] | None = None):
        self.pieces, self.table = pieces, table or {}

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has, the end id with them."""
        number = Numbers()
        codes = [
            np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))
            for chunks in map(self.pieces.chunks, texts)
        ]
        chunks = list(number)
        rows = [*map(self.table.get, chunks)]
        unseen = [i for i, row in enumerate(rows) if row is None]
        ids, counts = self.pieces.segmented_all([chunks[i] for i in unseen])
        held = [row for row in rows if row is not None]
        # First what the table has, then what it lacks; the end of a text is a chunk as well.
        sizes = np.ones(len(rows) + 1, np.int64)
        seen = np.ones(len(rows), bool)
        seen[unseen] = False
        sizes[:-1][seen] = list(map(len, held))
        sizes[unseen] = counts
        known = np.fromiter(chain.from_iterable(held), np.int32, int(sizes[:-1][seen].sum()))
        flat = np.concatenate([known, ids, np.array([self.pieces.end], np.int32)])
        order = np.concatenate([np.flatnonzero(seen), np.array(unseen, np.int64), [len(rows)]])
        starts = np.empty(len(sizes), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        end = np.array([len(rows)])
        every = np.concatenate([part for own in codes for part in (own, end)] or [end[:0]])
        lengths = sizes[every]
        stops = np.cumsum(lengths)
        total = int(stops[-1]) if len(stops) else 0
        place = np.arange(total) + np.repeat(starts[every] - (stops - lengths), lengths)
        text_ends = np.cumsum([len(own) + 1 for own in codes], dtype=np.int64)
        edges = np.concatenate([[0], stops])[text_ends]
        return flat[place], np.diff(edges, prepend=0)


# --- Spark ----------------------------------------------------------------------------


def _counted(docs: DataFrame, pieces) -> DataFrame:
    """(chunk, n): how often short chunks stand in all texts.

    A task keeps COUNTED chunks at most while it counts; what falls out is rare there and
    lacks in the table, which does not change any result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        chunks = pieces.value.chunks
        for batch in batches:
            for part in text_slices(batch):
                for text in part.column("text").to_pylist():
                    counts.update(chunks(text))
                if len(counts) > COUNTED:
                    counts = Counter(dict(counts.most_common(COUNTED // 2)))
        best = [(c, n) for c, n in counts.most_common(FREQUENT) if len(c) <= LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())],
            names=["chunk", "n"],
        )

    rows = docs.select(text_of().alias("text")).mapInArrow(count, "chunk string, n bigint")
    return rows.groupBy("chunk").agg(F.sum("n").alias("n"))


def chunk_table(docs: DataFrame, path: str, most: int = FREQUENT) -> DataFrame:
    """(chunk, n, ids): the ``most`` most frequent distinct chunks at most, each segmented once.

    Blanks stand for markers. A histogram of the logarithms of the counts tells from which count
    on there are few enough rows. The table is written to the shared folder.
    """
    spark = docs.sparkSession
    pieces = spark.sparkContext.broadcast(Pieces(path))
    counted = written(
        _counted(docs, pieces).withColumn("step", F.floor(F.log2("n") * STEPS)), "chunk-counts"
    )
    left, least = most, None
    for step, n in sorted(map(tuple, counted.groupBy("step").count().collect()), reverse=True):
        if n > left:
            break
        left, least = left - n, step

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, counts = pieces.value.segmented_all(batch.column("chunk").to_pylist())
            edges = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            ids = pa.ListArray.from_arrays(edges, pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=["chunk", "n", "ids"])

    frequent = counted.where(F.lit(False) if least is None else F.col("step") >= least)
    return written(
        frequent.select("chunk", "n").mapInArrow(segment, "chunk string, n bigint, ids array<int>"),
        "chunk-table",
    )


def encoded(docs: DataFrame, path: str, most: int = FREQUENT) -> DataFrame:
    """(doc_id, ids, decoded): the ids of each whole text with an end id, and what they decode to.

    The driver and every task hold ``most`` chunks of LONGEST code points at most.
    """
    spark = docs.sparkSession
    pieces = spark.sparkContext.broadcast(Pieces(path))
    rows = chunk_table(docs, path, most).select("chunk", "ids").collect()
    table = spark.sparkContext.broadcast({row.chunk: list(row.ids) for row in rows})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces.value, table.value)
        for batch in batches:
            for part in text_slices(batch):
                flat, counts = encoder.encoded(part.column("text").to_pylist())
                edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                whole = flat.tolist()
                decoded = [
                    pieces.value.decoded(whole[a:b]) for a, b in zip(edges.tolist(), edges[1:].tolist())
                ]
                ids = pa.ListArray.from_arrays(pa.array(edges), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, pa.array(decoded, pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return texts.mapInArrow(encode, "doc_id bigint, ids array<int>, decoded string")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids are no ids, ids out of range raise."""
    pieces = rows.sparkSession.sparkContext.broadcast(Pieces(path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [pieces.value.decoded(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    given = F.coalesce(F.col("ids").cast("array<int>"), F.array().cast("array<int>"))
    kept = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), given.alias("ids"))
    return kept.mapInArrow(decode, "doc_id bigint, text string")
