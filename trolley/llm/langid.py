"""Language identification by script ranges and a Viterbi path over words.

A word is a run of letters. Its script, from ranges of code points, leaves the languages
that were seen in that script when learning; each of these scores the word by the
log probabilities of its hashed character n-grams. A path over all words of a
text, with a penalty for each change of language, labels spans; the text has the language
with most letters, and its score is the share of letters in spans of that language.

``und`` with score 0 stands for texts that are null or have no letter. Words in a
script that no language was seen in may be of any. Without anything to learn from, all
texts are ``und``. Rows are labelled each for itself, so ids may be null or repeated;
other columns are not looked at. Equal scores go to the first language by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.shared import slices, text_of

UNKNOWN = "und"
BUCKETS = 1 << 15
#: N-grams of one to three code points; their hashes have 15 bits.
ORDERS = (1, 2, 3)
SWITCH = 12.0
#: Slices are larger here, as long texts set the number of steps of a slice.
PART_CHARS = 8 << 20
#: Up to so many texts, words are followed text by text.
FEW = 16
# First code points of scripts, each up to the next entry.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"),
    (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"),
    (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"),
    (0x20000, "han"), (0x32000, "other"),
)
_FIRSTS = np.array([first for first, _ in SCRIPTS])
_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT_OF_RANGE = np.array([_NAMES.index(name) for _, name in SCRIPTS])
_WORDS = re.compile(r"[^\W\d_]+")


def _is_word(run: str) -> bool:
    """A run of nothing but letter-like numbers is none."""
    return run.isalpha() or any(map(str.isalpha, run))


@dataclass(frozen=True)
class _Words:
    """Distinct words: for each order the n-gram buckets and the word of each n-gram."""

    grams: list[np.ndarray]
    owners: list[np.ndarray]
    scripts: np.ndarray
    letters: np.ndarray


def _analysed(words: list[str]) -> _Words:
    """Every word is framed by blanks; an n-gram is one of ORDERS code points in a row."""
    text = "".join([f" {word} " for word in words])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.concatenate([[0], np.cumsum(sizes + 2)[:-1]])
    owner = np.repeat(np.arange(len(words)), sizes + 2)
    grams, owners = [], []
    value = np.zeros(len(points), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        count = len(points) - order + 1
        value = value[:count] * np.uint64(0x100000001B3) + points[order - 1 :] + np.uint64(1)
        inside = owner[:count] == owner[order - 1 :]
        mixed = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        grams.append((mixed[inside] >> np.uint64(49)).astype(np.int64))
        owners.append(owner[:count][inside])
    places = np.searchsorted(_FIRSTS, points[first + 1].astype(np.int64), side="right") - 1
    return _Words(grams, owners, _SCRIPT_OF_RANGE[places], sizes)


def _numbered(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Word numbers of all texts in a row, the distinct words, words per text."""
    found = [_WORDS.findall(text.lower()) for text in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    every = np.array(list(chain.from_iterable(found)), dtype=object)
    if not len(every):
        return np.zeros(0, np.int64), [], counts
    codes, distinct = pd.factorize(every)
    fine = np.fromiter(map(_is_word, distinct), bool, len(distinct))
    if not fine.all():
        keep = fine[codes]
        owner = np.repeat(np.arange(len(counts)), counts)[keep]
        counts = np.bincount(owner, minlength=len(counts))
        codes = (np.cumsum(fine) - 1)[codes[keep]]
        distinct = distinct[fine]
    return codes, list(distinct), counts


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_probs: np.ndarray  # bucket by language
    seen: np.ndarray  # script by language

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known = _analysed(words)
        scores = np.zeros((len(words), len(self.languages)))
        for number in range(len(self.languages)):
            own = np.ascontiguousarray(self.log_probs[:, number])
            for grams, owners in zip(known.grams, known.owners):
                scores[:, number] += np.bincount(
                    owners, weights=own[grams], minlength=len(words)
                )
        candidate = self.seen[known.scripts]
        candidate = candidate | ~candidate.any(axis=1, keepdims=True)
        return np.where(candidate, scores, -1e9), known.letters

    def paths(
        self, texts: list[str], switch: float = SWITCH
    ) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each text the language number and the letters of its words."""
        codes, distinct, counts = _numbered(texts)
        if not distinct or not self.languages:
            none = np.zeros(0, np.int64)
            return [none] * len(texts), [none] * len(texts)
        scores, letters = self.word_scores(distinct)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        states = _best_paths(scores, codes, first, counts, switch)
        cuts = np.cumsum(counts)[:-1]
        return np.split(states, cuts), np.split(letters[codes], cuts)

    def label(self, texts: list[str], switch: float = SWITCH) -> tuple[list[str], list[float]]:
        names, shares = [], []
        for states, letters in zip(*self.paths(texts, switch)):
            if not len(states):
                names.append(UNKNOWN)
                shares.append(0.0)
                continue
            mass = np.bincount(states, weights=letters, minlength=len(self.languages))
            best = int(mass.argmax())
            names.append(self.languages[best])
            shares.append(float(mass[best] / mass.sum()))
        return names, shares

    def spans(self, text: str, switch: float = SWITCH) -> list[tuple[int, int, str]]:
        """(start, end, language) of the spans of one text, in code points."""
        if len(text.lower()) != len(text):
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        else:
            lowered = text.lower()
        at = [
            m.span()
            for m in _WORDS.finditer(lowered)
            if _is_word(m.group())
        ]
        out: list[tuple[int, int, str]] = []
        for (start, end), state in zip(at, self.paths([lowered], switch)[0][0]):
            name = self.languages[state]
            if out and out[-1][2] == name:
                out[-1] = (out[-1][0], end, name)
            else:
                out.append((start, end, name))
        return out


def _best_paths(
    scores: np.ndarray, codes: np.ndarray, first: np.ndarray, counts: np.ndarray, switch: float
) -> np.ndarray:
    """Viterbi paths of all texts at once, word by word; long texts stay to the end."""
    languages = scores.shape[1]
    order = np.argsort(-counts, kind="stable")
    first, counts = first[order], counts[order]
    longest = int(counts[0])
    active = np.searchsorted(-counts, -np.arange(longest), side="left")
    together = int(np.searchsorted(-active, -FEW, side="left"))
    back = np.zeros((len(codes), languages), np.uint8 if languages < 256 else np.uint32)
    states = np.zeros(len(codes), np.int64)
    value = np.zeros((len(counts), languages))
    own = np.arange(languages)
    for step in range(together):
        n = active[step]
        at = first[:n] + step
        now = value[:n]
        if step:
            best = now.argmax(axis=1)
            changed = now[np.arange(n), best] - switch
            stay = now >= changed[:, None]
            back[at] = np.where(stay, own, best[:, None])
            now = np.where(stay, now, changed[:, None])
        value[:n] = now + scores[codes[at]]
    # The few longest texts go on one by one, which is faster for few rows.
    for row in range(int(active[together]) if together < longest else 0):
        span = slice(first[row] + together, first[row] + counts[row])
        value[row] = _go_on(value[row], scores[codes[span]], back[span], switch, together)
    full = counts > 0
    states[(first + counts - 1)[full]] = value[full].argmax(axis=1)
    for row in range(int(active[together]) if together < longest else 0):
        start, stop = first[row] + together, first[row] + counts[row]
        state = int(states[stop - 1])
        steps, path = back[start:stop].tolist(), []
        for options in reversed(steps):
            path.append(state)
            state = options[state]
        states[start:stop] = path[::-1]
        if start > first[row]:
            states[start - 1] = state
    for step in range(min(together, longest) - 1, 0, -1):
        at = first[: active[step]] + step
        states[at - 1] = back[at, states[at]]
    return states


def _go_on(
    value: np.ndarray, scores: np.ndarray, back: np.ndarray, switch: float, step: int
) -> list[float]:
    """The steps of one text from ``step`` on; fills ``back``, returns the last values."""
    now, steps = value.tolist(), []
    places = range(len(now))
    for row in scores.tolist():
        if step:
            top = max(now)
            best, changed = now.index(top), top - switch
            steps.append([k if now[k] >= changed else best for k in places])
            now = [(v if v >= changed else changed) + s for v, s in zip(now, row)]
        else:
            steps.append([0] * len(now))
            now = row
        step += 1
    back[:] = steps
    return now


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of n-gram buckets and of scripts by language, once per task.

    Tables have a fixed size for each language met.
    """
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for frame in frames:
        for part in slices(frame, chars=PART_CHARS):
            for lang, own in part.groupby("lang"):
                codes, distinct, _ = _numbered(own["text"].tolist())
                if not distinct:
                    continue
                grams, scripts = totals.setdefault(
                    lang, (np.zeros(BUCKETS), np.zeros(len(_NAMES)))
                )
                known = _analysed(distinct)
                times = np.bincount(codes, minlength=len(distinct)).astype(float)
                for own_grams, owners in zip(known.grams, known.owners):
                    grams += np.bincount(
                        own_grams, weights=times[owners], minlength=BUCKETS
                    )
                scripts += np.bincount(known.scripts, weights=times, minlength=len(_NAMES))
    for lang, (grams, scripts) in totals.items():
        every = np.concatenate([grams, scripts])
        places = np.flatnonzero(every)
        yield pd.DataFrame({"lang": lang, "place": places, "n": every[places]})


def fit(docs: DataFrame, *, script_share: float = 0.001) -> LanguageModel:
    """Learn from ``docs`` (text, lang); rows without lang teach nothing.

    Spark adds up tables of fixed size, so the driver gets at most BUCKETS numbers and
    one per script for each language. A language is seen in a script that has more
    than ``script_share`` of its words.
    """
    rows = (
        docs.where(F.col("lang").isNotNull())
        .select(F.col("lang").cast("string").alias("lang"), text_of().alias("text"))
        .mapInPandas(_counts, "lang string, place int, n double")
        .groupBy("lang", "place")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(rows["lang"].unique())
    table = np.zeros((BUCKETS + len(_NAMES), len(languages)))
    for number, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        table[own["place"].to_numpy(), number] = own["n"].to_numpy()
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    smoothed = grams + 0.1
    log_probs = np.log(smoothed / smoothed.sum(axis=0, keepdims=True))
    seen = scripts > script_share * scripts.sum(axis=0, keepdims=True)
    return LanguageModel(languages, log_probs, seen)


def labelled(docs: DataFrame, model: LanguageModel, switch: float = SWITCH) -> DataFrame:
    """(doc_id, lang_pred, score, n_spans) of each whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def label(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in slices(frame, chars=PART_CHARS):
                names, shares, spans = [], [], []
                for states, letters in zip(*held.value.paths(part["text"].tolist(), switch)):
                    if not len(states):
                        names.append(UNKNOWN)
                        shares.append(0.0)
                        spans.append(0)
                        continue
                    mass = np.bincount(states, weights=letters)
                    best = int(mass.argmax())
                    names.append(held.value.languages[best])
                    shares.append(float(mass[best] / mass.sum()))
                    spans.append(int((np.diff(states) != 0).sum()) + 1)
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"],
                        "lang_pred": names,
                        "score": shares,
                        "n_spans": spans,
                    }
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(
        label, "doc_id bigint, lang_pred string, score double, n_spans bigint"
    )
