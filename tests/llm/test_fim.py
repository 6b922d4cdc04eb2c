import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trolley.llm import fim, queries
from support import make_docs  # noqa: F401


def slow(doc_id, text):
    """The stated rule, on strings."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return n, "plain", None, None, text
    first, second = sorted((a % (n + 1), b % (n + 1)))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if d % 100 < 20:
        return n, "spm", first, second - first, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", first, second - first, f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = st.text(alphabet="ab<>PSMé日😀\n", max_size=30)


@given(TEXTS, st.integers(0, 30), st.integers(0, 30), st.sampled_from(["psm", "spm"]))
@settings(max_examples=300, deadline=None)
def test_cutting_arranging_and_restoring(text, a, b, form):
    marks = fim.Sentinels()
    if marks.pattern.search(text.encode()):
        return
    first, second = sorted((min(a, len(text)), min(b, len(text))))
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    n = fim.code_points(data)
    assert n == len(text)
    places = fim.byte_places(data, n, (first, second))
    assert [raw[:p].decode() for p in places] == [text[:first], text[:second]]
    parts = fim.cut(fim.Piece(0, 0, len(raw)), *places)
    pieces = fim.arranged(parts, form, marks)
    output = b"".join(fim.stream(pieces, (memoryview(raw), memoryview(marks.buffer))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    assert output.decode() == (
        f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm"
        else f"<S>{suffix}<P>{prefix}<M>{middle}"
    )
    again = fim.restored(output, form, marks)
    assert b"".join(fim.stream(again, (memoryview(output),))) == raw


def test_places_beyond_one_block(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 4)
    text = "aé日b😀" * 5
    data = np.frombuffer(text.encode(), np.uint8)
    assert fim.code_points(data) == len(text)
    for k in range(len(text) + 1):
        assert fim.byte_places(data, len(text), (k, len(text))) == [
            len(text[:k].encode()), len(text.encode())
        ]


def test_an_output_of_another_form_is_refused():
    with pytest.raises(ValueError, match="form"):
        fim.restored(b"<P>a<S>b<M>c", "spm", fim.Sentinels())
    with pytest.raises(ValueError, match="different"):
        fim.Sentinels("<a>", "<a>", "<b>")


def test_query_and_edge_rows(spark, make_docs, tmp_path):  # noqa: F811
    texts = [(i, f"text {i} é日 " * (i % 7 + 1)) for i in range(200)]
    texts += [
        (7, "text 7 again"), (7, "text 7 again"), (300, None), (301, ""), (302, "with <M> inside"),
        (None, "no id"), (303, "long é " * 400_000), (304, "<P"), (305, "<"), (306, " "),
    ]
    docs = make_docs(*texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_fill_in_middle(spark, str(tmp_path))
    assert found.columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    ]
    want = []
    for doc_id, text in texts:
        *head, output = slow(doc_id, text)
        want.append((doc_id, *head, sha(output), sha(text or "")))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))
    assert {row[2] for row in want} == {"plain", "psm", "spm"}
    assert fim.transformed(docs.limit(0)).count() == 0


def test_outputs_and_their_restored_texts(spark, make_docs):  # noqa: F811
    texts = [(i, f"väter {i} " * (i % 5)) for i in range(50)]
    outputs = fim.transformed(make_docs(*texts), with_output=True, marks=("[p]", "[s]", "[m]"))
    rows = {r.doc_id: r.output for r in outputs.collect()}
    for doc_id, text in texts:
        want = slow(doc_id, text)[-1]
        for old, new in (("<P>", "[p]"), ("<S>", "[s]"), ("<M>", "[m]")):
            want = want.replace(old, new)
        assert rows[doc_id] == want
    back = fim.restored_texts(outputs, ("[p]", "[s]", "[m]"))
    assert {r.doc_id: r.text for r in back.collect()} == dict(texts)


def test_no_shuffle(spark, make_docs):  # noqa: F811
    docs = spark.range(5).selectExpr("id AS doc_id", "'x' AS text")
    plan = fim.transformed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
