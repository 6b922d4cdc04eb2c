"""Summary documents and text reports as files, one folder a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.document_pieces import document_pieces
from trolley.operators.summaries import report_texts, summary_json


def _write_text(texts: DataFrame, column: str, path: str) -> None:
    (
        texts.select(column, "report_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_date")
        .text(path)
    )


def write_summaries(summaries: DataFrame, path: str, pretty: bool = False) -> None:
    """``report_date=<day>/`` with the JSON document; a day written again is replaced."""
    _write_text(summary_json(summaries, pretty), "document", path)


def write_reports(summaries: DataFrame, path: str) -> None:
    _write_text(report_texts(summaries), "report", path)


def write_summary_pieces(summaries: DataFrame, conversion: DataFrame, path: str) -> None:
    """The pretty documents of ``write_summaries``, for days of any number of categories.

    The pieces are dealt by ranges of day and place, so a large day is written by several
    tasks: its files, in the order of their names, are the document.
    """
    order = ("report_date", "section", "position")
    pieces = document_pieces(summaries, conversion)
    ordered = pieces.repartitionByRange(*order).sortWithinPartitions(*order)
    _write_text(ordered, "piece", path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(report_date, document) of written summaries; a document has to fit into a row."""
    files = spark.read.text(path, wholetext=True)
    parts = F.struct(F.col("_metadata.file_name").alias("name"), "value")
    joined = files.groupBy("report_date").agg(F.array_sort(F.collect_list(parts)).alias("parts"))
    text = F.array_join(F.transform("parts", lambda part: part["value"]), "")
    return joined.select(F.col("report_date").cast("date"), text.alias("document"))
