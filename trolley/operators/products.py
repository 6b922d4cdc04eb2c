"""Views per product and the most viewed products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley import schemas
from trolley.functions.events import has_text, is_type
from trolley.operators.ranking import first_of_group


def product_views(events: DataFrame) -> DataFrame:
    """Views of each day and product, and when the first one was."""
    return (
        events.where(is_type(schemas.VIEW) & has_text("product_id"))
        .groupBy(F.col("event_date").alias("report_date"), "product_id")
        .agg(
            F.count("*").alias("view_count"),
            F.min("event_timestamp").alias("first_seen"),
        )
    )


def top_viewed_products(views: DataFrame, n: int | None = 5) -> DataFrame:
    """The ``n`` most viewed products of each day with their rank, all for None.

    Ranks are positions: equal counts are ordered by first view, then by id.
    Views without a date are a day of their own.
    """
    order = (
        F.desc("view_count"),
        F.asc_nulls_last("first_seen"),
        F.asc("product_id"),
    )
    ranked = first_of_group(views, ["report_date"], order, "rank", n)
    return ranked.select("report_date", "product_id", "view_count", "rank", "first_seen")
