"""From raw documents to token ids: filter, drop repeated lines, dedup, decontaminate, encode.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All
but the last return the columns of ``documents``. Each result is written as Parquet to
the shared folder and read again, so lost executors cost tasks and not stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm import bpe, decontam, line_dedup, quality, simhash
from trolley.llm.queries import TOKENIZER, _learning_labels
from trolley.llm.shared import free_name, read_table, shipped, work_path


@shipped
def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns as its query does."""
    labels = _learning_labels(spark, sf_dir, "quality")
    model = quality.fit(quality.document_statistics(docs), labels)
    score = free_name(docs, "quality_score")
    return quality.with_quality(docs, model, score).where(F.col(score) >= 0.3).drop(score)


@shipped
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that another one with a smaller id holds."""
    return line_dedup.with_shorter_texts(docs)


@shipped
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    return simhash.first_of_each_group(docs, 3, 3)


@shipped
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@shipped
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of what is left."""
    encoded = bpe.encoded(docs, public_tokenizers.path(TOKENIZER))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", keep_good_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]

#: Fingerprints, fitted models and token ids are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
