"""Conversion from views to purchases per product category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley import schemas
from trolley.functions.events import category_or_unknown, is_type
from trolley.functions.rates import conversion_rate


def category_conversion(events: DataFrame) -> DataFrame:
    """Views, purchases and their rate for each day and category.

    Other event types are filtered at the scan, so a category with neither
    views nor purchases does not appear. A missing category is ``unknown``.
    """
    counts = (
        events.where(F.col("event_type").isin(schemas.VIEW, schemas.PURCHASE))
        .groupBy(
            F.col("event_date").alias("report_date"),
            category_or_unknown().alias("category"),
        )
        .agg(
            F.count_if(is_type(schemas.VIEW)).alias("views"),
            F.count_if(is_type(schemas.PURCHASE)).alias("purchases"),
            F.min("event_timestamp").alias("first_seen"),
        )
    )
    rate = conversion_rate(F.col("views"), F.col("purchases"))
    return counts.select(
        "report_date",
        "category",
        "views",
        "purchases",
        rate.alias("conversion_rate"),
        "first_seen",
    )


def category_conversion_ranked(conversion: DataFrame) -> DataFrame:
    """Best rate first within each day; equal rates in order of appearance.

    A global sort: range partitioned, no day has to fit into one task.
    """
    return conversion.orderBy(
        F.asc("report_date"),
        F.desc("conversion_rate"),
        F.asc_nulls_last("first_seen"),
        F.asc("category"),
    )
