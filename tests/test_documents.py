"""Summary documents written in pieces."""

import json

from pyspark.sql import functions as F

from trolley.operators.categories import category_conversion
from trolley.operators.document_pieces import document_pieces
from trolley.operators.products import product_views
from trolley.operators.summaries import summary_json, summary_rows
from trolley.operators.users import user_activity
from trolley.sinks.documents import read_documents, write_summaries, write_summary_pieces

STAMP = "2024-01-31T02:00:00.000000"


def parts_of(events):
    conversion = category_conversion(events)
    rows = summary_rows(user_activity(events), product_views(events), conversion, F.lit(STAMP))
    return rows, conversion


def content(folder):
    """The bytes of each day, its files joined in the order of their names."""
    return {
        day.name: b"".join(f.read_bytes() for f in sorted(day.glob("part-*")))
        for day in folder.glob("report_date=*")
    }


def test_small_days_have_the_same_bytes(spark, sample, make_events, tmp_path):
    odd = make_events(
        ("u", "p", 'a "q" \\ \n é', "view", "2024-02-01T00:00:00"),
        ("u", "p", '"conversion_rates_by_category" : { }', "view", "2024-02-01T00:00:00"),
        ("u", "p", None, "purchase", "2024-02-01T00:00:00"),
        ("u", "p", "", "view", "no time"),
        ("u", '"conversion_rates_by_category" : { }', "x", "view", "2024-02-01T00:00:00"),
        ("u", "p", "only in the cart", "add_to_cart", "2024-02-02T00:00:00"),
    )
    rows, conversion = parts_of(sample.unionByName(odd))
    whole, pieces = tmp_path / "whole", tmp_path / "pieces"
    write_summaries(rows, str(whole), pretty=True)
    write_summary_pieces(rows, conversion, str(pieces))
    assert content(pieces) == content(whole)
    assert len(content(whole)) == 4  # three days, and events without one
    read = {str(r.report_date): r.document for r in read_documents(spark, str(pieces)).collect()}
    assert json.loads(read["2024-02-01"])["conversion_rates_by_category"].keys() >= {"unknown"}


def test_nothing_to_write(spark, sample, tmp_path):
    rows, conversion = parts_of(sample.limit(0))
    write_summary_pieces(rows, conversion, str(tmp_path / "none"))
    assert content(tmp_path / "none") == {}


def test_a_day_of_many_categories_is_written_by_several_tasks(spark, make_events, tmp_path):
    n = 1_000_000
    conversion = spark.range(n, numPartitions=8).selectExpr(
        "DATE'2024-01-01' AS report_date", "concat('category ', id) AS category",
        "10L AS views", "id % 7 AS purchases", "CAST(id % 7 * 10 AS DOUBLE) AS conversion_rate",
        "TIMESTAMP'2024-01-01 00:00:00' AS first_seen",
    )
    events = make_events(("u", "p", "c", "view", "2024-01-01T00:00:00"))
    rows, _ = parts_of(events)
    pieces = document_pieces(rows, conversion)
    assert pieces.agg(F.max(F.length("piece"))).first()[0] < 1000
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8MB")
    try:
        write_summary_pieces(rows, conversion, str(tmp_path / "many"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = list((tmp_path / "many").rglob("part-*.txt"))
    assert len(files) > 1
    document = json.loads(content(tmp_path / "many")["report_date=2024-01-01"])
    found = document["conversion_rates_by_category"]
    assert len(found) == n
    ordered = sorted(range(n), key=lambda i: (-(i % 7), f"category {i}"))
    assert list(found) == [f"category {i}" for i in ordered]
    assert summary_json(rows).count() == 1
