import random

import numpy as np

from support import make_docs  # noqa: F401

from trolley.llm import line_dedup

BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(lines, dropped, kept text) of each row, in order."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    number = lambda i: 2**63 - 1 if i is None else i
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(number(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if len(holders.get(key(line), ())) < 2 or min(holders[key(line)]) == number(i)
        ]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def found(docs):
    kept = line_dedup.drop_repeated_lines(docs)
    rows = kept.select("doc_id", "n_lines", "n_dropped", "text").collect()
    return sorted(((r[0], r[1], r[2], r[3] or "") for r in rows), key=repr)


def test_equals_brute_force(make_docs):
    rng = random.Random(4)
    pool = [f"  Line number {i} of the POOL{chr(9) * (i % 3)}" for i in range(40)]
    pool += ["short", "É" * 9, "É" * 10, "é" * 10, "\x0btab and feed line\f", "", "hot line everywhere"]
    rows = []
    for i in range(150):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 8))]
        if i % 3 == 0:
            lines.append("hot line everywhere")
        if i % 4 == 0:
            lines.insert(0, f"only in document {i}")
        rows.append((i, "\n".join(lines)))
    rows += [(None, "hot line everywhere\nonly in document 4"), (None, None), (7, rows[8][1]), (7, "a\nhot line everywhere")]
    rows += [(500, "x" * 300_000 + "\n" + pool[0]), (501, "x" * 300_000), (502, "")]
    docs = make_docs(*rows, parts=5)
    assert found(docs) == sorted(brute(rows), key=repr)
    kept = line_dedup.drop_repeated_lines(docs)
    assert kept.columns == [*docs.columns, "n_lines", "n_dropped"]


def test_hot_lines_take_the_same_way_out(make_docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_PARTS", 3)
    rows = [(i, "the hot line here\n" + f"pair of lines {i // 2}") for i in range(40)]
    assert found(make_docs(*rows)) == sorted(brute(rows), key=repr)


def test_nothing_is_repeated_and_nothing_at_all(make_docs):
    rows = [(1, "first of its kind"), (2, "second of its kind")]
    assert found(make_docs(*rows)) == sorted(brute(rows), key=repr)
    assert found(make_docs(*rows).limit(0)) == []


def test_the_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 50_000):
        h1, h2 = rng.integers(0, 2**64, (2, n), np.uint64)
        h1[: n // 2] = h1[0] if n else 0  # equal first halves are told apart by the second
        built = line_dedup.PerfectHash(h1, h2)
        again = line_dedup.PerfectHash.unpacked(built.packed())
        for hash_ in (built, again):
            assert sorted(hash_(h1, h2)) == list(range(n))


def probes_of(docs, row, lines):
    probes = np.zeros(docs * lines, line_dedup._PROBE)
    probes["doc"] = np.repeat(np.arange(docs), lines)
    probes["row"] = row
    probes["line"] = np.tile(np.arange(lines), docs)
    probes["h1"] = probes["h2"] = probes["line"] + 1
    return probes


def index_of(lines, owner):
    entries = np.zeros(lines, line_dedup._ENTRY)
    entries["h1"] = entries["h2"] = np.arange(lines) + 1
    entries["n"], entries["owner"] = 5000, owner
    return line_dedup.LineIndex(entries)


def test_decided_lines_of_exact_copies_go_to_many_shards():
    probes, to = line_dedup._targets(probes_of(5000, 12345, 4), index_of(4, 0), 50)
    assert len(to) == 4999 * 4 and (to < 0).all()
    assert np.bincount(-1 - to).max() < 2 * len(to) / 50
    # One text of one id: its lines are dealt by their places.
    one = np.unique(line_dedup._targets(probes_of(2, 1, 64_000), index_of(64_000, 0), 50)[1])
    assert len(one) == 50


def test_hot_lines_of_one_id_do_not_travel():
    probes = probes_of(1, 7, 4)
    assert len(line_dedup._targets(probes, index_of(4, 0), 50)[0]) == 0


def test_lines_that_one_document_repeats_are_counted(make_docs, monkeypatch):
    rows = [(3, "a line of one id\nanother line %d" % (i % 2)) for i in range(30)]
    rows += [(1, "often in one document\n" * 20), (2, "often in one document")]
    docs = make_docs(*rows)
    kept = {(r.n, r.shared) for r in line_dedup.repeated_lines(docs).collect()}
    assert kept == {(30, False), (15, False), (21, True)}
    for parts in (3, 10, 20_000):
        monkeypatch.setattr(line_dedup, "HOT_PARTS", parts)
        assert found(docs) == sorted(brute(rows), key=repr)
