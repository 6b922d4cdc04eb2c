import random

import numpy as np
import pandas as pd
from support import make_docs, make_table  # noqa: F401

from trolley.llm import toxicity


def document(rng, toxic):
    word = lambda: "".join(rng.choices("abcdefg", k=2))
    sentences = [[word() for _ in range(rng.randint(3, 9))] for _ in range(rng.randint(1, 8))]
    if toxic:
        sentence = rng.choice(sentences)
        sentence[rng.randrange(len(sentence))] = rng.choice(["vile", "nasty"])
    return ". ".join(" ".join(s) for s in sentences) + "."


def learned(make_docs, make_table):
    rng = random.Random(2)
    rows = [(i, document(rng, i % 4 == 0)) for i in range(400)]
    labels = make_table("doc_id bigint, label int", *[(i, int(i % 4 == 0)) for i in range(400)], (9999, 1), (None, 0), (3, None))
    return toxicity.fit(make_docs(*rows, (None, "x")), labels)


def test_new_documents_and_their_sentences(make_docs, make_table):
    model = learned(make_docs, make_table)
    rng = random.Random(77)
    rows = [(i, document(rng, i % 2 == 0)) for i in range(100)]
    odd = [(200, None), (201, ""), (202, "a nasty one"), (203, "ab cd. " * 40_000 + "so vile!"), (None, "vile"), (5, "ab")]
    found = toxicity.scored(make_docs(*rows, *odd, parts=3), model).collect()
    assert len(found) == 106 and all(0 <= row.score <= 1 for row in found)
    texts = dict([*rows[6:], *odd[:4]])
    for row in found:
        if row.doc_id in texts and row.doc_id < 200:
            assert (row.score >= 0.5) == (row.doc_id % 2 == 0)
            if row.doc_id % 2 == 0:
                worst = texts[row.doc_id][row.worst_start : row.worst_end]
                assert "vile" in worst or "nasty" in worst
                assert worst.strip(". ").count(".") == 0 and row.n_toxic == 1
    by_id = {row.doc_id: row for row in found}
    assert by_id[200].score == by_id[201].score < 0.5 and by_id[200].worst_start is None
    assert by_id[202].score > 0.5 and by_id[203].score > 0.5 and by_id[None].score > 0.5
    assert odd[3][1][by_id[203].worst_start : by_id[203].worst_end] == " so vile!"
    assert toxicity.scored(make_docs(*rows).limit(0), model).count() == 0


def test_the_sample_is_bounded_by_rows(make_docs, make_table):
    rows = [(i if i % 3 else 7, f"{i}") for i in range(3000)]
    docs = make_docs(*rows, (None, "x"))
    labels = make_table("doc_id bigint, label int", *[(i, i % 2) for i in range(4000)], (7, 0))
    every = toxicity.labelled_rows(docs, labels, 10_000).collect()
    assert sorted((int(r.text), r.label) for r in every) == [(i, j % 2) for i, (j, _) in enumerate(rows)]
    assert toxicity.labelled_rows(docs, labels, 300).count() < 420
    hot = make_docs(*[(7, f"{i}") for i in range(3000)])
    assert 200 < toxicity.labelled_rows(hot, make_table("doc_id bigint, label int", (7, 1)), 300).count() < 420


def test_a_model_of_a_sample(make_docs, make_table):
    rng = random.Random(2)
    rows = [(i, document(rng, i % 4 == 0)) for i in range(1200)]
    labels = make_table("doc_id bigint, label int", *[(i, int(i % 4 == 0)) for i in range(1200)])
    model = toxicity.fit(make_docs(*rows), labels, most=500)
    scores = model.score([text for _, text in rows])[0]
    assert np.mean((scores >= 0.5) == (np.arange(1200) % 4 == 0)) > 0.99


def test_scores_are_the_noisy_or_of_sentences(make_docs, make_table):
    model = learned(make_docs, make_table)
    text = "vile ab. cd nasty vile! ef gh"
    _, _, chances = model.sentences([text])
    expected = 1 - (1 - model.leak) * np.prod(1 - chances)
    assert np.isclose(model.score([text])[0][0], expected)


def test_the_gradient_fits_the_bags():
    sample = pd.DataFrame(
        {
            "label": [1, 0, 1, 0] * 20,
            "sentence": [[0, 1], [0], [2], []] * 20,
            "word": [[0, 1], [1], [0], []] * 20,
        }
    )
    weights, bias, leak = toxicity._noisy_or(sample, 2)
    assert weights[0] > 3 > weights[1] and leak < 0.1


def test_labels_of_one_class_or_none(make_docs, make_table):
    docs = make_docs((1, "vile"), (2, "fine"))
    for rows, expected in (([(1, 1), (2, 1)], 1.0), ([], 0.5)):
        model = toxicity.fit(docs, make_table("doc_id bigint, label int", *rows))
        assert {row.score for row in toxicity.scored(docs, model).collect()} == {expected}


def test_spans_of_sentences():
    assert toxicity.sentence_span("One. Two?! three", 1) == (4, 10)
    assert toxicity.sentence_span("One. Two?! three", 2) == (10, 16)
    assert toxicity.sentence_span("One", -1) == (None, None)
