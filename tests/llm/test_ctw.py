import functools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import make_docs  # noqa: F401

from trolley.llm import ctw
from trolley.llm.shared import fold


def decisions(text):
    data = b"\xff" * 4 + text.encode() + b"\xff"
    for i in range(4, len(data)):
        for k in range(8):
            yield data[i - 4 : i], 1 << k | data[i] >> 8 - k, data[i] >> 7 - k & 1


def brute_scores(training, texts):
    """The recursion over all contexts, one decision after the other."""
    counts = {}
    for text in training:
        for context, node, bit in decisions(text):
            for depth in range(5):
                counts.setdefault((context[4 - depth :], node), [0, 0])[bit] += 1
    longer = {}
    for context, node in counts:
        if context:
            longer.setdefault((context[1:], node), []).append((context, node))

    def estimate(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @functools.lru_cache(None)
    def weighted(key):
        own = estimate(*counts[key])
        if len(key[0]) == 4:
            return own
        return np.logaddexp(own, below(key)) - math.log(2)

    def below(key):
        return sum(weighted(k) for k in longer[key])

    out = []
    for text in texts:
        total = 0.0
        for context, node, bit in decisions(text):
            p = None
            for depth in range(4, -1, -1):
                key = (context[4 - depth :], node)
                if key in counts:
                    own = (counts[key][bit] + 0.5) / (sum(counts[key]) + 1)
                    if p is None:
                        p = own
                    else:
                        w = math.exp(-np.logaddexp(0, below(key) - estimate(*counts[key])))
                        p = w * own + (1 - w) * p
            total += math.log10(0.5 if p is None else p)
        out.append(total)
    return out


def brute_base(training, texts):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = lambda t: [*t.translate(table).encode().split(), None]
    counts = {}
    for text in training:
        for token in tokens(text):
            counts[token] = counts.get(token, 0) + 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for text in texts:
        own = tokens(text)
        score = sum(math.log10((counts.get(t, 0) + 1) / (n + v + 1)) for t in own)
        out.append((len(own), sum(t in counts for t in own), n, score))
    return out


TEXTS = [
    "the cat sat on the mat", "The dog sat on the cat", "", None, "éé été\x0bétait", "\x00 odd \x1c",
    "the the the", "zzz never seen", "a", "mat cat " * 400, "日本 text",
]


def rows_of(ids):
    return [(i, TEXTS[n % len(TEXTS)]) for n, i in enumerate(ids)]


@pytest.mark.parametrize("split", ["none", "some", "all"])
def test_equals_brute_force(make_docs, monkeypatch, split):
    pairs = {"none": [], "some": [0x6520, 0x7468, 0xFFFF], "all": range(1 << 16)}[split]
    monkeypatch.setattr(ctw, "crowded_pairs", lambda *_: np.array(pairs, np.int64))
    rows = [*rows_of(range(30)), (None, "the cat"), (4, "another text of four")]
    docs = make_docs(*rows, parts=4)
    rest = fold(F.col("doc_id"), 7)
    found = ctw.scored(docs, rest != 2)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    texts = [text or "" for _, text in rows]
    training = [text or "" for i, text in rows if not held(i)]
    expected = sorted(
        (repr(i), *base, score)
        for (i, _), base, score in zip(rows, brute_base(training, texts), brute_scores(training, texts))
    )
    got = sorted(
        (repr(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
        for r in found.collect()
    )
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert np.allclose([g[4:] for g in got], [e[4:] for e in expected], rtol=1e-9, atol=1e-7)
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[2].n_bytes == 0 and by_id[2].n_tokens == 1
    assert math.isclose(by_id[0].bits_per_byte, -by_id[0].score * math.log2(10) / 23)


def test_probabilities_of_all_bytes_sum_to_one():
    keys, counts = ctw._run_counts([(t or "").encode() for t in TEXTS], np.ones(len(TEXTS), bool))
    context = int(keys[len(keys) // 2]) >> 8 << 8
    every = np.unique(np.concatenate([keys, context + np.arange(256)]))
    totals = np.zeros(len(every), np.int64)
    totals[np.searchsorted(every, keys)] = counts
    lower = ctw.lower_levels(every, totals)
    top = lower[0]
    parent = top.nodes & 0xFFFF
    nodes, at = np.unique(parent, return_inverse=True)
    sums = [np.bincount(at, weights=w) for w in (top.a, top.b, top.log_weighted)]
    levels = [*ctw.upper_levels(nodes, *sums), *lower]
    p = np.exp(ctw.log_probabilities(context + np.arange(256), levels))
    assert math.isclose(p.sum(), 1.0, rel_tol=1e-9)


def test_no_training_text_and_no_text(make_docs):
    docs = make_docs((1, "ab"), (2, ""))
    found = {r.doc_id: r for r in ctw.scored(docs, F.lit(False)).collect()}
    assert math.isclose(found[1].score, 24 * math.log10(0.5))
    assert (found[1].n_known, found[1].train_tokens, found[1].base_score) == (0, 0, 0.0)
    assert ctw.scored(docs.limit(0), F.lit(True)).count() == 0


def test_log_gamma():
    x = np.array([0.5, 1.0, 2.5, 10.0, 1e3, 1e9])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-10)


def crowded(n, seed):
    """Every third byte is followed by the same two."""
    random = np.random.default_rng(seed)
    return "".join(chr(c) + "ab" for c in random.integers(0x23, 0x60, n))


def test_a_pair_with_a_third_of_all_runs_is_split(make_docs, monkeypatch):
    monkeypatch.setattr(ctw, "BLOCK_CHARS", 3000)
    docs = make_docs(*[(i, crowded(800, i)) for i in range(24)], parts=3)
    blocks = ctw.text_blocks(docs, F.lit(True))
    split = ctw.crowded_pairs(blocks, 64)
    assert int.from_bytes(b"ab", "big") in split and len(split) <= ctw.MOST_SPLIT
    data = [crowded(800, i).encode() for i in range(24)]
    keys, _, _ = ctw._runs(data)
    whole, apart = (
        np.bincount(ctw._run_shard(keys, 64, s), minlength=64).max() / len(keys)
        for s in (split[:0], split)
    )
    assert whole > 0.3 and apart < 0.1
    found = {r.doc_id: r.score for r in ctw.scored(docs, F.lit(True)).collect()}
    texts = [d.decode() for d in data]
    assert np.allclose([found[i] for i in range(24)], brute_scores(texts, texts), rtol=1e-9)
