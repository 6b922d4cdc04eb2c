import random

import numpy as np
from support import make_docs  # noqa: F401

from trolley.llm import langid

SYLLABLES = {"aa": ["th", "er", "ing", "on"], "bb": ["ée", "oi", "eau", "ch"], "ru": ["ска", "про", "ни", "ть"]}


def prose(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def learned(make_docs):
    rows = [(i, prose(lang, 80, i), lang) for i, lang in enumerate(sorted(SYLLABLES) * 20)]
    return langid.fit(make_docs(*rows, (900, "no label"), (901, None, "aa"), parts=3))


def test_texts_not_seen_before(make_docs):
    model = learned(make_docs)
    assert model.languages == ["aa", "bb", "ru"]
    rows = [(i, prose(lang, 30, 1000 + i)) for i, lang in enumerate(sorted(SYLLABLES) * 10)]
    odd = [
        (100, None), (101, ""), (102, "12 ²³ -- !?"), (103, "漢字"), (104, "ing"),
        (105, prose("bb", 60_000, 1)), (None, prose("aa", 9, 2)), (104, prose("ru", 9, 3)),
    ]
    found = langid.labelled(make_docs(*rows, *odd), model).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {row.doc_id: row for row in found}
    assert all(by_id[i].lang_pred == lang for i, lang in enumerate(sorted(SYLLABLES) * 10))
    for i in (100, 101, 102):
        assert tuple(by_id[i])[1:] == ("und", 0.0, 0)
    assert by_id[103].lang_pred in model.languages
    assert by_id[105].lang_pred == "bb" and by_id[None].lang_pred == "aa"
    assert all(0 <= row.score <= 1 for row in found)
    assert langid.labelled(make_docs(*rows).limit(0), model).count() == 0


def test_mixed_texts_have_spans(make_docs):
    model = learned(make_docs)
    first, second = prose("aa", 20, 5), prose("bb", 10, 6)
    text = f"{first} — {second}"
    assert model.spans(text) == [
        (0, len(first), "aa"),
        (len(first) + 3, len(text), "bb"),
    ]
    names, shares = model.label([text])
    assert names == ["aa"] and 0.5 < shares[0] < 1


def test_nothing_to_learn_from(make_docs):
    model = langid.fit(make_docs((1, "a b")))
    assert model.label(["some text", ""]) == (["und", "und"], [0.0, 0.0])


def brute_path(scores, switch):
    """All paths, word by word."""
    best = {(k,): s for k, s in enumerate(scores[0])}
    for row in scores[1:]:
        best = {
            (*path, k): value + row[k] - (switch if k != path[-1] else 0)
            for path, value in best.items()
            for k in range(len(row))
        }
    return best


def test_paths_are_the_best_ones():
    rng = np.random.default_rng(0)
    for _ in range(40):
        counts = rng.integers(0, 8, rng.integers(1, 25))
        counts[0] = 8
        scores = rng.normal(size=(30, 3)) * 3
        codes = rng.integers(0, 30, counts.sum())
        first = np.cumsum(counts) - counts
        found = langid._best_paths(scores, codes, first, counts, 2.0)
        for start, count in zip(first, counts):
            if count:
                every = brute_path(scores[codes[start : start + count]], 2.0)
                path = tuple(found[start : start + count].tolist())
                assert np.isclose(every[path], max(every.values()))
