import random

import corpus_pipeline
import public_tokenizers
from support import make_docs, make_table  # noqa: F401
from test_decontam import brute as contained
from test_line_dedup import brute as without_lines
from test_simhash import brute_fingerprint, near_groups
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trolley.llm import line_dedup, quality
from trolley.llm.queries import REGISTERED, _learning_labels
from trolley.llm.shared import written


def tables(spark, make_docs, make_table, path):
    rng = random.Random(12)
    pool = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choices(pool, k=n))
    items = [(i, prose(30)) for i in range(5)]
    rows = []
    for i in range(120):
        text = "\n".join(prose(rng.randint(20, 60)) for _ in range(4))
        if i % 10 == 3:
            text = " ".join(w + "***" for w in text.split())
        if i % 15 == 7:
            text += " " + items[i % 5][1]
        if i % 6 == 5:
            text += "\nThe same licence line everywhere"
        rows.append([i, text])
    for i in range(120, 135):
        rows.append([i, rows[i - 100][1] + (" more" if i % 2 else "")])
    rows += [[200, None], [201, ""]]
    docs = make_docs(*map(tuple, rows))
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{path}/documents.parquet")
    make_table("item_id bigint, text string", *items).write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, int(i % 10 != 3), 0) for i in range(100)]
    make_table("doc_id bigint, quality int, toxic int", *labels).write.parquet(f"{path}/labels.parquet")
    return [tuple(row) for row in rows], items


def test_equals_the_stages_one_by_one(spark, make_docs, make_table, tmp_path):
    rows, items = tables(spark, make_docs, make_table, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    labels = _learning_labels(spark, str(tmp_path), "quality")
    model = quality.fit(quality.document_statistics(docs), labels)
    good = [(i, t) for i, t in rows if model.score(quality._matrix([t or ""]))[0] >= 0.3]
    assert 0 < len(rows) - len(good) < 20
    assert {i for i, _ in rows} - {i for i, _ in good} >= {3, 13, 23, 103}
    lines = [(i, text) for i, _, _, text in without_lines(good)]
    prints = {i: brute_fingerprint(text) for i, text in lines}
    groups = near_groups(sorted(set(prints.values())))
    leader = {}
    for group in groups:
        leader.update({fp: min(i for i, own in prints.items() if own in group) for fp in group})
    single = [(i, text) for i, text in lines if leader[prints[i]] == i]
    assert len(single) < len(lines)
    bad = {doc for doc, _ in contained(single, items)}
    assert bad
    left = [(i, text) for i, text in single if i not in bad]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {i: library.encode(text or "", add_special_tokens=False).ids for i, text in left}
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert {row.doc_id: row.ids for row in found.collect()} == expected


def test_stages_keep_the_columns_of_documents(spark, make_docs, make_table, tmp_path):
    tables(spark, make_docs, make_table, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    empty = docs.limit(0)
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).schema.names == docs.columns
        assert stage(spark, empty, str(tmp_path)).count() == 0


CLASHING = (
    "n_lines", "N_DROPPED", "quality_score", "Quality_Score_", "a.b", "x`y", "row", "doc", "held",
    "lines", "leader", "fp", "shard", "key", "n", "score", "line", "u", "v", "h1", "item_id", "ids",
)


def test_extra_columns_of_any_name_stay(spark, make_docs, make_table, tmp_path):
    tables(spark, make_docs, make_table, tmp_path)
    plain = spark.read.parquet(f"{tmp_path}/documents.parquet")
    extra = plain.select("*", *[F.col("doc_id").alias(name) for name in CLASHING])
    folder = tmp_path / "extra"
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    extra.write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, str(folder)), name)
        assert out.columns == docs.columns
        for row in out.collect():
            assert set(tuple(row)[5:]) == {row[0]}
        docs = out
    want = {row.doc_id: row.ids for row in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    got = {row.doc_id: row.ids for row in corpus_pipeline.run(spark, str(folder)).collect()}
    assert got == want


def test_counts_take_the_place_of_columns_of_their_name(spark, make_docs):
    docs = make_docs((1, "one long line\nx"), (2, "one long line\ny"))
    clashing = docs.withColumn("N_LINES", F.lit("mine")).withColumn("a.b", F.lit(5))
    kept = line_dedup.drop_repeated_lines(clashing)
    assert kept.columns == [*docs.columns, "a.b", "n_lines", "n_dropped"]
    rows = {r[0]: (r.text, r["a.b"], r.n_lines, r.n_dropped) for r in kept.collect()}
    assert rows == {1: ("one long line\nx", 5, 2, 0), 2: ("y", 5, 2, 1)}
    whole = line_dedup.with_shorter_texts(clashing)
    assert whole.columns == clashing.columns
    assert {r.N_LINES for r in whole.collect()} == {"mine"}


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in REGISTERED)
    assert numbers == list(range(1, 14))
