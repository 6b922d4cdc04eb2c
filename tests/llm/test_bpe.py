import random

import numpy as np
import public_tokenizers
import pytest
from support import make_docs  # noqa: F401
from tokenizers import Tokenizer

from trolley.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = [
    *"aAbé ÉßΣσς'sİı\t\n\x1c\x85ǅ日😀½²٣١_-!İẞϴΩﬁ é", "<|endoftext|>", "<|startoftext|>",
    "<|", "'ll", "'VE", "the", "\r\n", " ", "Thing", "thatesti",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def some_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(n)]


def test_encodes_and_decodes_as_the_library(library, vocabulary):
    texts = [*some_texts(3000), "", " ", "x" * 5000, "the " * 3000]
    encoder = bpe.Encoder(vocabulary)
    for text, ids in zip(texts, encoder.encoded(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
        expected = library.decode(ids.tolist(), skip_special_tokens=False)
        assert vocabulary.decoded(ids) == expected


def test_long_words_are_merged_alike(library, vocabulary):
    rng = random.Random(5)
    for n in (1, 2, 39, 40, 41, 300, 4000):
        word = "".join(rng.choices("abcdehinorst", k=n))
        expected = library.encode(word, add_special_tokens=False).ids
        assert vocabulary.merged(word) == expected


def paths(arrays):
    """All words of an automaton with their place."""
    edges = {}
    for key, target, weight in zip(arrays["keys"], arrays["targets"], arrays["weights"]):
        edges.setdefault(int(key) >> 8, []).append((int(key) & 255, int(target), int(weight)))
    out, stack = {}, [(0, b"", 0)]
    while stack:
        state, word, place = stack.pop()
        if arrays["final"][state]:
            out[word] = place
        stack += [(t, word + bytes([b]), place + w) for b, t, w in edges.get(state, [])]
    return out


def test_the_automaton_is_minimal_and_numbers_its_words():
    rng = random.Random(1)
    endings = [b"ing", b"tion", b"ed", b""]
    words = sorted({bytes(rng.choices(b"abcd", k=rng.randint(1, 5))) + e for e in endings for _ in range(80)})
    arrays = bpe.compile_words(words)
    assert paths(arrays) == {word: place for place, word in enumerate(words)}
    # No two states have the same endings.
    tails = {}
    for word in words:
        for cut in range(len(word) + 1):
            tails.setdefault(word[:cut], set()).add(word[cut:])
    assert len(arrays["final"]) == len({frozenset(t) for t in tails.values()})
    assert paths(bpe.compile_words([])) == {}


def test_known_and_unseen_words(vocabulary, tmp_path):
    words = ["thing", "things", "éaux", "a", "<|endoftext|>"]
    path = tmp_path / "words.bin"
    path.write_bytes(bpe.Lexicon.content(words, vocabulary))
    lexicon = bpe.Lexicon(str(path))
    asked = [*words, "thin", "unseen", "", "things1"]
    starts, stops = lexicon.found(asked)
    for word, a, b in zip(asked, starts, stops):
        if word in words:
            assert lexicon.ids[a:b].tolist() == vocabulary.merged(word)
        else:
            assert a == b == -1
    with_it, without = (bpe.Encoder(vocabulary, x) for x in (lexicon, None))
    texts = [*some_texts(300, 9), " ".join(words) + " things thin"]
    for a, b in zip(with_it.encoded(texts), without.encoded(texts)):
        assert np.array_equal(a, b)


def test_documents(make_docs, library):
    rows = [(i, text) for i, text in enumerate(some_texts(60, 4))]
    rows += [(100, None), (101, ""), (None, "no id"), (3, "repeated id"), (102, "long text " * 50_000)]
    for most in (0, 10, bpe.FREQUENT_WORDS):
        found = bpe.encoded(make_docs(*rows, parts=3), PATH, most).collect()
        expected = []
        for i, text in rows:
            ids = library.encode(text or "", add_special_tokens=False).ids
            expected.append((i, ids, library.decode(ids, skip_special_tokens=False)))
        assert sorted((tuple(r) for r in found), key=repr) == sorted(expected, key=repr)
    assert bpe.encoded(make_docs(*rows).limit(0), PATH).count() == 0


def test_frequent_words(make_docs):
    docs = make_docs((1, "the the the, a a b"), (2, "the A c"), parts=2)
    assert bpe.frequent_words(docs, PATH, 9)[:2] == ["the", "a"]
    assert set(bpe.frequent_words(docs, PATH, 3)) <= {"the", "a"}


def test_long_strings_stay_out_of_the_lexicon(make_docs, library):
    long = "abc" * 40
    docs = make_docs((1, f"{long} " * 50 + "the"), (2, "日本語" * 30 + " " + "x" * 64), (3, long))
    assert set(bpe.frequent_words(docs, PATH)) == {"the", "x" * 64}
    for row in bpe.encoded(docs, PATH).join(docs, "doc_id").collect():
        assert row.ids == library.encode(row.text, add_special_tokens=False).ids
