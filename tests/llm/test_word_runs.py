import hashlib
from zlib import crc32

from hypothesis import given, settings
from hypothesis import strategies as st

from trolley.llm import queries
from trolley.llm.word_runs import collapsed, periodic_runs, runs_of, suffix_order, words_of
from support import by_id, make_docs  # noqa: F401

import numpy as np
import re


def slow_runs(words, least_words=6, least_exponent=4):
    """Every stretch of every period, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // least_exponent + 1):
        at = 0
        while at + q < len(words):
            stop = at
            while stop + q < len(words) and words[stop] == words[stop + q]:
                stop += 1
            if stop > at and stop - at + q >= max(least_words, least_exponent * q):
                found.setdefault((at, stop - at + q), q)
            at = stop + 1
    return sorted(((i, size, q) for (i, size), q in found.items()), key=lambda r: (r[0], r[2]))


def slow_collapsed(words, runs):
    dropped = {k for i, size, q in runs for k in range(i + q, i + size)}
    return b" ".join(w for k, w in enumerate(words) if k not in dropped)


block = st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=5), st.integers(1, 9))
text = st.lists(block, max_size=5).map(lambda blocks: [w for base, n in blocks for w in base * n])


@given(st.lists(text, max_size=4), st.sampled_from([(6, 4), (4, 3), (1, 3), (9, 5)]))
@settings(max_examples=300, deadline=None)
def test_runs_are_those_of_brute_force(texts, bounds):
    assert runs_of(texts, *bounds) == [slow_runs(words, *bounds) for words in texts]


@given(text)
@settings(max_examples=100, deadline=None)
def test_collapsed_words(words):
    runs = slow_runs(words)
    assert collapsed(words, runs) == slow_collapsed(words, runs)


@given(st.lists(st.integers(1, 3), max_size=40))
@settings(max_examples=100, deadline=None)
def test_suffix_order_and_common_lengths(letters):
    words = np.array([*letters, 0])
    places, common = suffix_order(words, np.zeros(len(words), np.int64), 2)
    suffixes = sorted(range(len(letters)), key=lambda i: letters[i:])

    def alike(i, j):
        n = 0
        while max(i, j) + n < len(letters) and letters[i + n] == letters[j + n]:
            n += 1
        return n

    heights = [0, *(alike(i, j) for i, j in zip(suffixes, suffixes[1:]))]
    both = [*heights[1:], 0]
    expected = [
        (i, h if h >= 2 else 0) for i, h, b in zip(suffixes, heights, both) if max(h, b) >= 2
    ]
    assert list(zip(places.tolist(), common.tolist())) == expected


def test_long_texts_of_few_words():
    assert runs_of([[b"x"] * 50_000]) == [[(0, 50_000, 1)]]
    turn = [b"%d" % (i % 9_000) for i in range(40_000)]
    assert runs_of([turn]) == [[(0, 40_000, 9_000)]]


def test_a_phrase_with_many_left_words_is_no_quadratic_work():
    rng = np.random.default_rng(1)
    words = []
    for i in rng.permutation(30_000):
        words += [b"l%d" % i, *b"a b c d e f g h".split(), b"r%d" % rng.integers(500)]
    assert runs_of([words]) == [[]]


def test_words_are_cut_at_the_stated_characters_only():
    text = "a\x1cb c　d\x0be\x0cf\rg\x85h"
    assert [w.decode() for w in words_of(text.encode())] == re.findall(r"[^\x20\x09-\x0D]+", text)


def test_edge_rows(spark, make_docs):  # noqa: F811
    long = "la " * 30_000
    docs = make_docs(
        (1, "x y " * 4), (1, "x y " * 4), (2, None), (3, ""), (4, " \n\t "), (None, "a " * 6),
        (5, long), (6, "q" * 300_000),
    )
    rows = periodic_runs(docs)
    assert rows.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed[:9])
        for r in rows.collect()
    )
    assert got == [
        (False, 1, 8, [(0, 8, 2)], "x y"),
        (False, 1, 8, [(0, 8, 2)], "x y"),
        (False, 2, 0, [], ""),
        (False, 3, 0, [], ""),
        (False, 4, 0, [], ""),
        (False, 5, 30_000, [(0, 30_000, 1)], "la"),
        (False, 6, 1, [], "q" * 9),
        (True, 0, 6, [(0, 6, 1)], "a"),
    ]
    assert periodic_runs(docs.limit(0)).count() == 0


def test_query_gives_the_stated_digests(spark, make_docs, tmp_path):  # noqa: F811
    texts = {i: " ".join(f"w{(i * k) % 23}" for k in range(60 + i)) for i in range(60)}
    texts |= {60: "", 61: None, 62: "a b " * 5 + "c " + "d " * 11}
    make_docs(*texts.items()).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path))
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256",
    ]
    planted = 0
    for row in found.collect():
        words = (texts[row.doc_id] or "").encode().split()
        n, g = len(words), crc32(str(row.doc_id).encode())
        if g % 10 == 0 and n:
            g //= 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = slow_runs(words)
        lines = "".join(f"{i},{size},{q}\n" for i, size, q in runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        exponent = None if not runs else 1000 * best[1] // best[2]
        assert tuple(row)[1:] == (
            len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(slow_collapsed(words, runs)).hexdigest(),
        )
    assert planted
