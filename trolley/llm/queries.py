"""One query for each corpus operator, over its whole table, and SQL where it has any."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from trolley.llm import ann, bpe, ctw, decontam, fim, langid, line_dedup, piece_chunks, quality
from trolley.llm import secret_scan, simhash, toxicity, word_runs
from trolley.llm.shared import fold, read_table, shipped, written

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def _held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    return fold(F.col(doc_id), folds) == 0


def _learning_labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Labels of the documents that may be learned from."""
    return (
        read_table(spark, sf_dir, "labels")
        .where(~_held_out())
        .select("doc_id", F.col(label).alias("label"))
    )


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    known = written(quality.document_statistics(docs), "document-statistics")
    model = quality.fit(known, _learning_labels(spark, sf_dir, "quality"))
    return quality.scored(known, model).select(
        "doc_id",
        _held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_repeated_lines(docs)
    return kept.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), 3, 3)
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~_held_out()))
    return langid.labelled(docs, model).select(
        "doc_id", _held_out().alias("held_out"), "lang_pred", "score", "n_spans"
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def _tokens(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return _tokens(bpe.encoded(docs, public_tokenizers.path(TOKENIZER)))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _learning_labels(spark, sf_dir, "toxic"))
    return toxicity.scored(docs, model).select(
        "doc_id",
        _held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "worst_start",
        "worst_end",
        "n_toxic",
    )


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(
        read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = fold(F.col("doc_id"), 7)
    scores = ctw.scored(read_table(spark, sf_dir, "documents"), rest != 2)
    others = [name for name in scores.columns if name != "doc_id"]
    return scores.select("doc_id", (rest == 2).alias("held_out"), *others)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scanned(read_table(spark, sf_dir, "documents"))
    base = ("assign", "access", "hex")
    return found.select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(secret_scan.span_text(*base), 256).alias("base_sha256"),
        secret_scan.span_text(*base, "random").alias("spans"),
    )


def made_periodic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One text in ten, by a hash of its id, repeats some of its words from a place on."""
    text = "" if doc_id is None else str(doc_id)
    g, rest = divmod(crc32(text.encode()), 10)
    n = len(words)
    if rest or not n:
        return words
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return words[:start] + [words[start + i % period] for i in range(n - start)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = word_runs.periodic_runs(docs, 6, 4, made_periodic)
    # Greatest length, then smallest start and period.
    best = F.expr(
        "array_min(transform(runs, r -> struct(-r.length AS less, r.start, r.period, r.length)))"
    )
    lines = F.transform(
        "runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    )
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return _tokens(piece_chunks.encoded(docs, public_tokenizers.path(PIECES)))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.transformed(read_table(spark, sf_dir, "documents"))


REGISTERED = {
    query.__name__: shipped(query)
    for query in (
        op1_quality_classifier,
        op2_line_dedup,
        op3_simhash_near_dedup,
        op4_language_id,
        op5_decontamination,
        op6_bpe,
        op7_toxicity,
        op8_nearest_neighbours,
        op9_lm_scoring,
        op10_secret_scan,
        op11_periodic_runs,
        op12_sentencepiece,
        op13_fill_in_middle,
    )
}

LINES = r"""
lines AS (
  SELECT doc_id, place, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
  )
)"""

ORACLE = {
    "op13_fill_in_middle": """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
),
drawn AS (
  SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
    ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS d FROM hashed
),
formed AS (
  SELECT *, least(a, b) AS first, greatest(a, b) AS second,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR c >= 90 THEN 'plain' WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
),
parts AS (
  SELECT *, substring(text, 1, first) AS prefix, substring(text, first + 1, second - first) AS middle,
    substring(text, second + 1) AS suffix FROM formed
),
made AS (
  SELECT *, CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM parts
),
found AS (
  SELECT *, strpos(output, '<P>') AS p, strpos(output, '<S>') AS s, strpos(output, '<M>') AS m
  FROM made
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN first END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN second - first END AS middle_chars,
  sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN substring(output, p + 3, s - p - 3) || substring(output, m + 3)
      || substring(output, s + 3, m - s - 3)
    ELSE substring(output, p + 3, m - p - 3) || substring(output, m + 3)
      || substring(output, s + 3, p - s - 3) END) AS restored_sha256
FROM found
""",
    "op2_line_dedup": f"""
WITH {LINES},
owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
),
marked AS (
  SELECT l.*, o.owner IS NOT NULL AND o.owner <> l.doc_id AS gone
  FROM lines l LEFT JOIN owners o ON l.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), ''))
    AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op5_decontamination": r"""
WITH words AS (
  SELECT 0 AS kind, doc_id AS id,
    regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents
  UNION ALL
  SELECT 1, item_id,
    regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') FROM benchmark
),
sized AS (
  SELECT id, w, least(5, len(w)) AS k FROM words WHERE kind = 1 AND len(w) > 0
),
item_shingles AS (
  SELECT DISTINCT id, k, unnest(
    list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))
  ) AS shingle FROM sized
),
-- An item of fewer words is one shingle of all of them.
doc_shingles AS (
  SELECT DISTINCT id, k, unnest(
    list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))
  ) AS shingle FROM words, (SELECT DISTINCT k FROM sized) WHERE kind = 0
),
sizes AS (SELECT id AS item_id, count(*) AS n FROM item_shingles GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) / any_value(n) AS containment
FROM doc_shingles d JOIN item_shingles i ON d.shingle = i.shingle AND d.k = i.k
JOIN sizes ON sizes.item_id = i.id
GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(n)
""",
}
