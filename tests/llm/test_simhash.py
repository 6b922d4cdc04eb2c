import random

import numpy as np
import xxhash

from support import make_docs, groups_of  # noqa: F401

from trolley.llm import simhash
from trolley.llm.components import components


def brute_fingerprint(text, n=3):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words, word = [], ""
    for c in text.translate(table) + " ":
        if c in " \t\n\x0b\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << bit
        for bit in range(64)
        if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def test_fingerprints():
    for text in ("", " \n", "One", "one two", "One TWO three", "É é\x0bx y z", "a b c d e " * 9):
        assert simhash.fingerprint(text) == brute_fingerprint(text), text


def test_every_pair_within_the_distance_meets_at_an_anchor():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**31, 200)
    home, near = simhash.anchors(x, 1)
    assert all(bin(int(a ^ h)).count("1") <= 1 for a, h in zip(x, home))
    for bit in range(31):
        other, _ = simhash.anchors(x ^ (1 << bit), 1)
        assert all(o in row for o, row in zip(other, near))


def near_groups(values, most=3):
    links = [
        (a, b) for i, a in enumerate(values) for b in values[:i] if bin(a ^ b).count("1") <= most
    ]
    return groups_of(values, links)


def planted(rng, groups, size):
    out = set()
    for _ in range(groups):
        center = rng.getrandbits(64)
        for _ in range(size):
            value = center
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                value ^= 1 << bit
            out.add(value)
    return sorted(out)


def check_links(spark, values):
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    distinct = spark.createDataFrame(signed, "fp bigint").repartition(3)
    found = [
        (a % 2**64, b % 2**64) for a, b in map(tuple, simhash.links(distinct).collect())
    ]
    assert all(bin(a ^ b).count("1") <= 3 for a, b in found)
    assert groups_of(values, found) == near_groups(values)
    return found


def test_links_equal_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    values = sorted({*planted(rng, 6, 60), *[rng.getrandbits(64) for _ in range(300)], 0, 1, 2**64 - 1})
    check_links(spark, values)
    monkeypatch.setattr(simhash, "CROWDED", 10)  # split anchors give the same groups
    found = check_links(spark, values)
    assert len(found) < 40 * len(values)


def test_documents(spark, make_docs):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [
        (5, base), (9, base.upper()), (2, base.replace("w17 ", "v17 ")),
        (11, "something else entirely here"), (4, None), (8, ""), (3, " \n "),
        (None, base), (20, "first text of twenty"), (20, "another text that is here"),
    ]
    docs = make_docs(*rows)
    found = [tuple(row) for row in simhash.near_duplicates(docs).select("doc_id", "component_id").collect()]
    assert len(found) == 9
    groups = dict(found)
    assert groups[5] == groups[9]
    assert groups[4] == groups[8] == groups[3] == 3
    assert groups[11] == 11 and groups[20] == 20
    kept = simhash.first_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = sorted((row.doc_id for row in kept.collect()), key=str)
    expected = {min(i for i, g in groups.items() if g == c) for c in set(groups.values())}
    assert ids == sorted([*expected, None], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.first_of_each_group(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(200)]  # a long path
    links += [(1000, 1000 + i) for i in range(300)]  # a star
    links += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    links += [(5, 5), (None, 3)]
    df = spark.createDataFrame(links, "u bigint, v bigint")
    found = dict(map(tuple, components(df).collect()))
    nodes = {n for link in links if None not in link and link[0] != link[1] for n in link}
    expected = groups_of(sorted(nodes), [link for link in links if None not in link])
    assert found == {n: min(group) for group in expected for n in group}
    assert components(df.limit(0)).count() == 0
