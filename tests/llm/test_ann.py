import numpy as np
import pytest
from pyspark.sql import functions as F

from trolley.llm import ann


def brute(vectors, most, query):
    usable = [
        (i, np.array(x, float))
        for i, x in vectors
        if i is not None and x is not None and None not in x and np.isfinite(x).all() and any(x) and len(x) == 8
    ]
    out = {}
    for i, x in usable:
        if query(i):
            best = {}
            for j, y in usable:
                if j != i:
                    best[j] = max(best.get(j, -np.inf), float((x * y).sum()))
            ranked = sorted(best.items(), key=lambda e: (-e[1], e[0]))[:most]
            out.setdefault(i, ranked)
    return out


def vectors(n=400, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, 8))
    x = centers[rng.integers(0, 12, n)] + rng.normal(size=(n, 8)) * 0.4
    rows = [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # copies
    rows += [
        (2000, None), (2001, [None] * 8), (2002, [0.0] * 8), (2003, [float("nan")] * 8),
        (2020, [float("inf")] * 8), (2021, [1.0] * 3), (None, rows[0][1]), (2022, []),
        (2040, [2.0**-10] * 8), (2041, [50.0] * 8),
    ]
    return rows


def found(spark, rows, most=10, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    df = df.withColumn("bucket", F.lit("x")).withColumn("label", F.lit(1))
    out = {}
    near = ann.nearest(df, F.col("vec_id") % 20 == 0, most, **options)
    for row in near.orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row["rank"] == len(out[row.query_id])
    return out


@pytest.mark.parametrize("block", [1024, 16])
def test_all_buckets_give_the_exact_result(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    rows = vectors()
    exact = brute(rows, 10, lambda i: i % 20 == 0)
    near = found(spark, rows, setting=ann.Setting(1, 1, 1e9, 3))
    assert near.keys() == exact.keys()
    for query, expected in exact.items():
        assert [i for i, _ in near[query]] == [i for i, _ in expected]
        assert np.allclose([s for _, s in near[query]], [s for _, s in expected], rtol=0, atol=1e-9)


def test_recall_of_the_production_parameters(spark):
    rows = vectors(900, 7)
    exact = brute(rows, 20, lambda i: i % 20 == 0)
    near = found(spark, rows, 20)
    hits = sum(len({i for i, _ in near.get(q, [])} & {i for i, _ in e}) for q, e in exact.items())
    assert hits >= 0.9 * sum(map(len, exact.values()))
    for query, expected in exact.items():
        known = dict(expected)
        assert all(np.isclose(s, known[i]) for i, s in near[query] if i in known)


def test_probes_start_at_home_and_go_to_the_nearest_borders():
    hashing = ann.Hashing.make(8, 1.0, ann.Setting(8, 3, 0.8, 20))
    x = np.random.default_rng(3).normal(size=(50, 8))
    cells = hashing.probed(x, 20)
    place = hashing._cells(np.column_stack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros(50)]))
    assert (cells[:, :, 0] == np.floor(place)).all()
    below = place - np.floor(place)
    moved = cells - np.floor(place)[:, :, None, :]
    cost = (np.where(moved < 0, below[:, :, None], np.where(moved > 0, 1 - below[:, :, None], 0)) ** 2).sum(-1)
    assert (np.diff(cost, axis=-1) > -1e-12).mean() > 0.95
    assert abs(moved).max() == 1


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (21, [0.5, 0.5])]
    near = found(spark, rows)
    assert near[0] == [(20, 0.5), (21, 0.5)]
    assert found(spark, rows[:1]) == {}
    assert found(spark, [(1, None)]) == {}


def skewed(kind, n=6000, size=16):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "one long":
        x[7] *= 100
    elif kind == "log-normal":
        x *= np.exp(rng.normal(size=(n, 1)))
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]


def check_recall(near, rows, asked, most=20):
    x, hits = np.array([v for _, v in rows]), 0
    for q in asked:
        scores = x @ x[q]
        scores[q] = -np.inf
        assert len(near[q]) == most
        hits += len({i for i, _ in near[q]} & set(np.argsort(-scores)[:most].tolist()))
    return hits / most / len(asked)


@pytest.mark.parametrize("kind", ["unit", "one long", "log-normal"])
def test_recall_and_number_with_skewed_norms(spark, kind):
    rows = skewed(kind)
    assert check_recall(found(spark, rows, 20), rows, range(0, 6000, 20)) >= 0.9


@pytest.mark.parametrize("kind", ["unit", "one long", "log-normal"])
def test_small_ranges_are_hashed_like_large_ones(spark, kind):
    rows = skewed(kind, 500, 64)
    assert check_recall(found(spark, rows, 20), rows, range(0, 500, 20)) >= 0.9


def clusters(n=20_000, size=32):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, size))[rng.integers(0, 200, n)] + 0.25 * rng.normal(size=(n, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]


def test_few_rows_are_compared_where_vectors_have_clusters(spark, monkeypatch):
    taken = []
    plain = ann.choices
    monkeypatch.setattr(ann, "choices", lambda *a: taken.append(plain(*a)) or taken[-1])
    rows = clusters()
    assert check_recall(found(spark, rows, 20), rows, range(0, 20_000, 20)) >= 0.9
    ((choice,),) = [c.values() for c in taken]
    assert choice.recall >= ann.RECALL and choice.compared < 0.4 and choice.setting != ann.WHOLE


def test_more_rows_ask_for_fewer_compared_ones():
    x = np.array([v for _, v in clusters(4000)])
    near = np.argsort(-(x[:64] @ x.T), axis=1)[:, 1:21].ravel()
    args = 1.0, x[:64], np.repeat(np.arange(64), 20), x[near], x[-512:]
    few, many = (ann.chosen(*args, n, n // 20) for n in (4000, 400_000_000))
    assert many.compared <= few.compared < 1 and min(few.recall, many.recall) >= ann.RECALL


@pytest.mark.parametrize("kind", ["one long", "log-normal"])
def test_small_tables_can_be_searched_exactly(spark, kind):
    rows = skewed(kind, 500, 64)
    assert check_recall(found(spark, rows, 20, whole=1024), rows, range(0, 500, 20)) == 1


def test_queries_whose_buckets_are_empty_meet_all_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)
    rows = skewed("unit", 500, 64)
    near = found(spark, rows, 20, setting=ann.Setting(1, 12, 0.1, 1))
    assert check_recall(near, rows, range(0, 500, 20)) == 1


def test_groups_hold_bounded_numbers_of_queries_and_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    numbers = spark.sparkContext.accumulator(0)
    plain = ann._best

    def counting(queries, own, ids, x, most):
        if len(own) > 200 or len(ids) > 200:
            numbers.add(1)
        return plain(queries, own, ids, x, most)

    monkeypatch.setattr(ann, "_best", counting)
    # One vector everywhere, an id that repeats, and queries in one bucket.
    rows = [(20 * i, [1.0] * 8) for i in range(500)] + [(1, [0.5] * 8)] * 500
    near = found(spark, rows, 5, setting=ann.Setting(1, 1, 1e9, 1))
    assert numbers.value == 0
    assert [i for i, _ in near[0]] == [20, 40, 60, 80, 100]
    assert [i for i, _ in near[40]] == [0, 20, 60, 80, 100]


def test_an_id_that_repeats_takes_one_place(spark):
    rows = [(0, [1.0] * 8)] + [(1, [9.0 - j / 100] * 8) for j in range(50)]
    rows += [(i, [1.0 + i / 100] * 8) for i in range(2, 12)]
    exact = brute(rows, 10, lambda i: i == 0)
    near = found(spark, rows, setting=ann.Setting(1, 1, 1e9, 1))
    assert [i for i, _ in near[0]] == [i for i, _ in exact[0]]


def test_a_block_is_cut_after_rows_of_an_id_are_merged():
    x = np.array([[9.0], [8.0], [7.0], [3.0], [2.0]])
    best = list(ann._best(np.ones((1, 1)), np.array([0]), np.array([1, 1, 1, 2, 3]), x, 2))
    assert [(n, i.tolist(), s.tolist()) for n, i, s in best] == [(0, [1, 2], [9.0, 3.0])]
