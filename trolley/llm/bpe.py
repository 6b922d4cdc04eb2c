"""BPE encoding and decoding with a minimal acyclic transducer of frequent words.

The vocabulary file is a parameter; nothing is trained. Spark finds the most frequent words of
all texts, the driver compiles them into a minimal acyclic automaton whose edges
carry numbers: their sum along a word is its place in an array of ids (all words
that end alike share the states of the ending). The arrays are one file, handed
to every executor by Spark and memory-mapped there. The distinct words of a slice walk
the automaton together, step by step; words that it lacks are merged by the rules
one by one, always the pair of lowest rank, leftmost first. So the lexicon
decides about speed alone.

A null text is an empty text without ids; rows are encoded each for itself, whatever their
ids. Texts that hold the special tokens get their ids, as the file says. Other columns are
not looked at.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trolley.llm.shared import shared_file, slices, text_of

FREQUENT_WORDS = 1 << 16
#: Steps of the histogram of counts for each doubling.
STEPS = 16
#: Distinct words that a task counts at once.
COUNTED = 250_000
#: Code points of a string that may be counted, so that what is collected is bounded.
LONGEST = 64
_NONE = 1 << 30
PART_CHARS = 2 << 20
#: The one Latin letter here that has two in lower case.
_DOTTED = "\u0130"
#: Below this letter, lower case and letters are plain ranges.
_LATIN_END = "\u0250"
# Fixed value: how the vocabulary splits texts; white space as Unicode has it.
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
)
# The same for texts that are composed and lower case Latin.
_LATIN_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-\u024f]+|[0-9²³¹¼-¾]"
    r"|[^\t-\r \x85\xa0a-zªµºß-öø-\u024f0-9²³¹¼-¾]+"
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for byte in range(256):
        out.append(chr(byte if byte in printable else extra))
        extra += byte not in printable
    return out


class Vocabulary:
    """Ids, merge ranks and splitting of a word-end BPE file."""

    def __init__(self, path: str):
        content = json.loads(Path(path).read_text(encoding="utf-8"))
        model = content["model"]
        end = model["end_of_word_suffix"]
        ids = model["vocab"]
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + end] for c in letters]
        if len(ids) >= 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.rank_of, self.products = {}, []
        for rank, (a, b) in enumerate(model["merges"]):
            self.rank_of[ids[a] << 16 | ids[b]] = rank
            self.products.append(ids[a + b])
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.special = special
        self.special_pattern = regex.compile("|".join(map(regex.escape, special)))
        strings = {number: token for token, number in [*ids.items(), *special.items()]}
        self.strings = np.array([strings[i] for i in range(len(strings))], dtype=object)
        self.normalizer = Tokenizer.from_file(path).normalizer

    def _pieces(self, text: str) -> list[str]:
        """Composed, lower case, split; other white space splits like a blank."""
        if text.isascii() or (
            max(text) < _LATIN_END
            and _DOTTED not in text
            and unicodedata.is_normalized("NFC", text)
        ):
            return _LATIN_PIECES.findall(text.lower())
        return _PIECES.findall(self.normalizer.normalize_str(text))

    def words(self, text: str) -> list[str]:
        """Words in order; a special token is one word, as it is written."""
        if "<|" not in text or not self.special_pattern.search(text):
            return self._pieces(text)
        out, at = [], 0
        for match in self.special_pattern.finditer(text):
            out += self._pieces(text[at : match.start()])
            out.append(match.group())
            at = match.end()
        return out + self._pieces(text[at:])

    def merged(self, word: str) -> list[int]:
        """Ids of one word by the merge rules."""
        if word in self.special:
            return [self.special[word]]
        data = word.encode("utf-8", "surrogatepass")
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        return self._few(symbols) if len(symbols) <= 40 else self._many(symbols)

    def _few(self, symbols: list[int]) -> list[int]:
        rank_of, products = self.rank_of.get, self.products
        ranks = [rank_of(a << 16 | b, _NONE) for a, b in zip(symbols, symbols[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            symbols[i] = new = products[best]
            del symbols[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(symbols[i - 1] << 16 | new, _NONE)
            if i < len(ranks):
                ranks[i] = rank_of(new << 16 | symbols[i + 1], _NONE)
        return symbols

    def _many(self, symbols: list[int]) -> list[int]:
        """The same with a heap and links, for long words."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            rank = self.rank_of.get(symbols[i] << 16 | symbols[j]) if j < n else None
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[j], self.products[rank]))

        for i in range(n):
            push(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = new, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [s for s in symbols if s >= 0]

    def decoded(self, ids: np.ndarray) -> str:
        """The tokens of the file with a blank between them, as the file names no decoder."""
        return " ".join(self.strings[ids].tolist())


# --- lexicon --------------------------------------------------------------------


class _State:
    __slots__ = ("edges", "final", "number", "paths")

    def __init__(self):
        self.edges: dict[int, _State] = {}
        self.final = False
        self.number = -1
        self.paths = 0

    def key(self):
        return self.final, tuple((b, s.number) for b, s in self.edges.items())


def compile_words(words: Iterable[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of ``words`` (sorted, distinct) as arrays.

    ``keys`` are state * 256 + byte, sorted, with ``targets`` and ``weights``; ``final``
    tells whether a word ends in a state. A word's place is the sum of the weights on its
    way. State 0 is the first one.
    """
    root = _State()
    known: dict[tuple, _State] = {}
    way: list[tuple[_State, int, _State]] = []

    def settle(depth: int) -> None:
        while len(way) > depth:
            parent, byte, child = way.pop()
            same = known.setdefault(child.key(), child)
            if same is child:
                child.number = len(known)
            parent.edges[byte] = same

    previous = b""
    for word in words:
        common = 0
        for a, b in zip(word, previous):
            if a != b:
                break
            common += 1
        settle(common)
        state = way[-1][2] if way else root
        for byte in word[common:]:
            child = _State()
            state.edges[byte] = child
            way.append((state, byte, child))
            state = child
        state.final = True
        previous = word
    settle(0)
    root.number = 0
    states = [root, *known.values()]
    # Numbered from the ends on, so the targets of a state come before it.
    for state in [*states[1:], root]:
        state.paths = state.final + sum(s.paths for s in state.edges.values())
    final = np.zeros(len(states), bool)
    keys, targets, weights = [], [], []
    for state in states:
        final[state.number] = state.final
        before = int(state.final)
        for byte, target in state.edges.items():
            keys.append(state.number << 8 | byte)
            targets.append(target.number)
            weights.append(before)
            before += target.paths
    order = np.argsort(np.array(keys, np.int64))
    return {
        "keys": np.array(keys, np.int64)[order],
        "targets": np.array(targets, np.int64)[order],
        "weights": np.array(weights, np.int64)[order],
        "final": final,
    }


class Lexicon:
    """Words with their ids in one memory-mapped file."""

    PARTS = ("keys", "targets", "weights", "final", "offsets", "ids")

    @staticmethod
    def content(words: list[str], vocabulary: Vocabulary) -> bytes:
        data = sorted({w.encode("utf-8", "surrogatepass") for w in words if w})
        arrays = compile_words(data)
        every = [vocabulary.merged(w.decode("utf-8", "surrogatepass")) for w in data]
        arrays["offsets"] = np.cumsum([0, *map(len, every)])
        arrays["ids"] = np.array(list(chain.from_iterable(every)), np.int64)
        parts = [arrays[name].astype("<i4" if name != "keys" else "<i8") for name in Lexicon.PARTS]
        head = np.array([len(part) for part in parts], "<i8").tobytes()
        return head + b"".join(part.tobytes() for part in parts)

    def __init__(self, path: str):
        whole = np.memmap(path, np.uint8, "r")
        sizes = whole[: 8 * len(self.PARTS)].view("<i8").tolist()
        at = 8 * len(self.PARTS)
        for name, size in zip(self.PARTS, sizes):
            kind = np.dtype("<i8" if name == "keys" else "<i4")
            part = whole[at : at + size * kind.itemsize]
            setattr(self, name, part.view(kind).view(np.ndarray))
            at += size * kind.itemsize

    def found(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First and last place in ``ids`` of each word; -1 for words that it lacks."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        text = np.frombuffer(b"".join(data), np.uint8)
        first = np.cumsum(sizes) - sizes
        state = np.zeros(len(data), np.int64)
        place = np.zeros(len(data), np.int64)
        alive = np.flatnonzero(sizes > 0) if len(self.keys) else np.zeros(0, np.int64)
        known = np.zeros(len(data), bool)
        step = 0
        while len(alive):
            key = state[alive] << 8 | text[first[alive] + step]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[edge] == key
            alive, edge = alive[hit], edge[hit]
            place[alive] += self.weights[edge]
            state[alive] = self.targets[edge]
            step += 1
            done = sizes[alive] == step
            known[alive[done]] = self.final[state[alive[done]]] > 0
            alive = alive[~done]
        place = np.where(known, place, 0)
        starts, stops = self.offsets[place], self.offsets[place + known]
        return np.where(known, starts, -1), np.where(known, stops, -1)


# --- Spark ----------------------------------------------------------------------

_vocabularies: dict[str, Vocabulary] = {}
_lexicons: dict[str, Lexicon] = {}


def vocabulary_of(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _lexicon_of(name: str) -> Lexicon:
    if name not in _lexicons:
        _lexicons[name] = Lexicon(SparkFiles.get(name))
    return _lexicons[name]


def frequent_words(
    docs: DataFrame, path: str, most: int = FREQUENT_WORDS
) -> list[str]:
    """The pieces of what stands most often between blanks in all texts, ``most`` at most.

    Longer strings than LONGEST are not counted: their words are merged where they occur.
    Every task counts all of its texts and sends what is most frequent; Spark adds up. A
    histogram of the logarithms of the counts tells from which count on there are
    at most ``most`` rows, and only these reach the driver, which splits them into words.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for frame in frames:
            for part in slices(frame, chars=PART_CHARS):
                for text in part["text"]:
                    words = text.lower().split()
                    counts.update([word for word in words if len(word) <= LONGEST])
                if len(counts) > COUNTED:
                    counts = Counter(dict(counts.most_common(COUNTED // 2)))
        best = counts.most_common(most)
        if best:
            yield pd.DataFrame({"word": [w for w, _ in best], "n": [n for _, n in best]})

    rows = (
        docs.select(text_of().alias("text"))
        .mapInPandas(count, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .withColumn("step", F.floor(F.log2("n") * STEPS))
        .persist(StorageLevel.DISK_ONLY)  # what is lost with an executor is counted again
    )
    left, least = most, None
    for step, n in sorted(map(tuple, rows.groupBy("step").count().collect()), reverse=True):
        if n > left:
            break
        left, least = left - n, step
    words, vocabulary = Counter(), vocabulary_of(path)
    if least is not None:
        for row in rows.where(F.col("step") >= least).collect():
            for word in vocabulary.words(row.word):
                words[word] += row.n
    rows.unpersist()
    return [word for word, _ in words.most_common(most)]


def shared_lexicon(spark: SparkSession, words: list[str], path: str) -> str:
    """Compile ``words``, put the file into the shared folder and hand it to the executors.

    Returns its name. Spark fetches it on every executor, on new ones as well.
    """
    content = Lexicon.content(words, vocabulary_of(path))
    place = shared_file(spark, content, "lexicon.bin")
    spark.sparkContext.addFile(place)
    return place.rsplit("/", 1)[1]


class Encoder:
    """Encodes the texts of a slice together, so that each distinct word is looked up once."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None = None):
        self.vocabulary, self.lexicon = vocabulary, lexicon

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in a row, and where those of each word start and stop."""
        if self.lexicon is None:
            base, starts = np.zeros(0, np.int32), np.full(len(words), -1)
            stops = starts.copy()
        else:
            base = self.lexicon.ids
            starts, stops = self.lexicon.found(words)
        unseen = np.flatnonzero(starts < 0)
        merged = [self.vocabulary.merged(words[i]) for i in unseen.tolist()]
        sizes = np.fromiter(map(len, merged), np.int64, len(merged))
        stops[unseen] = len(base) + np.cumsum(sizes)
        starts[unseen] = stops[unseen] - sizes
        more = np.fromiter(chain.from_iterable(merged), np.int32, int(sizes.sum()))
        return np.concatenate([base, more]), starts, stops

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        number = _Numbers()
        codes = [
            np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            for words in map(self.vocabulary.words, texts)
        ]
        if not number:
            return [np.zeros(0, np.int32)] * len(texts)
        flat, starts, stops = self._ids(list(number))
        counts = np.fromiter(map(len, codes), np.int64, len(codes))
        every = np.concatenate(codes)
        sizes = (stops - starts)[every]
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) + np.repeat(starts[every] - (ends - sizes), sizes)
        cuts = np.concatenate([[0], ends])[np.cumsum(counts)[:-1]]
        return np.split(flat[place].astype(np.int32), cuts)


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def encoded(docs: DataFrame, path: str, most: int = FREQUENT_WORDS) -> DataFrame:
    """(doc_id, ids, decoded): the ids of each whole text, and what they decode to."""
    spark = docs.sparkSession
    name = shared_lexicon(spark, frequent_words(docs, path, most), path)

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = vocabulary_of(path)
        encoder = Encoder(vocabulary, _lexicon_of(name))
        for frame in frames:
            for part in slices(frame, chars=PART_CHARS):
                ids = encoder.encoded(part["text"].tolist())
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"],
                        "ids": ids,
                        "decoded": [vocabulary.decoded(own) for own in ids],
                    }
                )
            # A worker lives on with other tasks: what a batch has taken goes back.
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(encode, "doc_id bigint, ids array<int>, decoded string")
