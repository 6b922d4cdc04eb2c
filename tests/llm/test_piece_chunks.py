import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from trolley.llm import queries
from trolley.llm.piece_chunks import Encoder, Pieces, chunk_table, decoded, encoded
from support import make_docs  # noqa: F401

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    "a", "b", "the", "ing", " ", "  ", "   ", "\n", "\t", "é", "日本", "▁", "😀", "́", "<s>",
    "</s>", "<0x41>", "�", "\x00", "　", " th", "1", ".", "\r\n", "ﬁ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return Pieces(PATH)


def test_random_texts_as_the_library_has_them(library, pieces):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(4000)]
    flat, counts = Encoder(pieces).encoded(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        ids = flat[at : at + n].tolist()
        at += n
        assert ids == library.encode(text, add_eos=True), text
        assert pieces.decoded(ids) == library.decode(ids), text
    assert at == len(flat)


def test_random_ids_decode_as_the_library_has_them(library, pieces):
    rng = random.Random(4)
    for _ in range(4000):
        ids = [
            rng.choice([rng.randrange(32000), rng.randrange(3, 259), 35, 259, 28705, 0, 1, 2])
            for _ in range(rng.randint(0, 8))
        ]
        assert pieces.decoded(ids) == library.decode(ids), ids


def test_long_chunks(library, pieces):
    rng = random.Random(5)
    for text in ("".join(rng.choices("abcdeé", k=50_000)), " " * 5000, "\n" * 5000, "ab" * 9000):
        assert Encoder(pieces).encoded([text])[0].tolist() == library.encode(text, add_eos=True)


def test_the_table_changes_no_id(library, pieces):
    texts = ["one two  three", "\ntwo\n three", ""]
    table = {c: pieces.segmented(c) for t in texts[:1] for c in pieces.chunks(t)}
    for known in (None, table):
        flat, counts = Encoder(pieces, known).encoded(texts)
        assert flat.tolist() == sum((library.encode(t, add_eos=True) for t in texts), [])
        assert counts.tolist() == [len(library.encode(t, add_eos=True)) for t in texts]


def test_each_distinct_chunk_is_segmented_once(spark, make_docs, pieces, monkeypatch):  # noqa: F811
    seen = []
    once = Encoder(pieces)
    own = pieces.segmented_all
    monkeypatch.setattr(pieces, "segmented_all", lambda chunks: seen.extend(chunks) or own(chunks))
    once.encoded(["to be or not to be"] * 50)
    assert sorted(seen) == [" be", " not", " or", " to"]


def test_chunk_table_holds_counts_and_ids(spark, make_docs, library):  # noqa: F811
    docs = make_docs((1, "to be or not to be"), (2, "to\nbe"), (3, None), (4, "z" * 100))
    rows = {r.chunk: (r.n, list(r.ids)) for r in chunk_table(docs, PATH).collect()}
    assert rows[" to"] == (3, library.encode("to"))
    assert rows["be"][0] == 1 and rows[" be"][0] == 2
    assert not any(len(c) > 64 for c in rows)
    few = chunk_table(docs, PATH, 2).collect()
    assert {r.chunk for r in few} <= {" to", " be"}


def test_a_piece_across_a_marker_is_refused(pieces):
    class Model:
        def normalize(self, text):
            return (" " + text).replace(" ", "▁")

    broken = object.__new__(Pieces)
    broken.ids, broken.bytes_at, broken.unknown = {"a▁b": 5}, [], 0
    with pytest.raises(ValueError, match="crosses"):
        broken._check(Model())


def test_edge_rows_and_the_query(spark, make_docs, library, tmp_path):  # noqa: F811
    texts = [
        (1, "Same text, twice."), (1, "Same text, twice."), (2, None), (3, ""), (4, " \n "),
        (None, "no id"), (5, "word " * 60_000), (6, "q" * 200_000), (7, "日本語 ▁ é\x00"),
    ]
    docs = make_docs(*texts)
    want = sorted(
        (i is None, i or 0, library.encode(t or "", add_eos=True), library.decode(
            library.encode(t or "", add_eos=True))) for i, t in texts
    )
    rows = encoded(docs, PATH)
    got = sorted((r.doc_id is None, r.doc_id or 0, list(r.ids), r.decoded) for r in rows.collect())
    assert got == want
    again = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in decoded(rows, PATH).collect())
    assert again == [(a, b, text) for a, b, _, text in want]
    assert encoded(docs.limit(0), PATH).count() == 0

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_sentencepiece(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert sorted((r[0] is None, r[0] or 0, *tuple(r)[1:]) for r in found.collect()) == sorted(
        (a, b, len(ids), sha(" ".join(map(str, ids))), sha(text)) for a, b, ids, text in want
    )
