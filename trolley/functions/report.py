"""The daily report as text, built from one summary row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts and widths of the report.
NO_DATA = "No data available for summary."
WIDE_RULE = "=" * 60
RULE = "-" * 40
TABLE_RULE = "-" * 45
CATEGORY_HEADER = f"{'Category':<15} {'Views':>10} {'Purchases':>10} {'Rate':>10}"
CATEGORY_LINE = "%-15s %10d %10d %9.2f%%"


def _product_line(product: Column, position: Column) -> Column:
    return F.format_string(
        "%d. %s - %d views", position + 1, product["product_id"], product["views"]
    )


def _category_line(category: Column) -> Column:
    return F.format_string(
        CATEGORY_LINE,
        category["category"],
        category["views"],
        category["purchases"],
        category["conversion_rate"],
    )


def report_text() -> Column:
    """All lines joined; an empty list of products or categories adds none."""
    heading = F.array(
        F.concat(F.lit("Daily E-commerce Summary - "), F.col("report_date").cast("string")),
        F.lit(WIDE_RULE),
        F.lit(""),
        F.concat(F.lit("Total Events: "), F.col("total_events").cast("string")),
        F.lit(""),
        F.lit("USER SEGMENTATION"),
        F.lit(RULE),
        F.concat(F.lit("- Buyers: "), F.col("buyers.count").cast("string")),
        F.concat(
            F.lit("- Window Shoppers: "), F.col("window_shoppers.count").cast("string")
        ),
        F.lit(""),
        F.lit("TOP 5 VIEWED PRODUCTS"),
        F.lit(RULE),
    )
    between = F.array(
        F.lit(""),
        F.lit("CONVERSION RATES BY PRODUCT CATEGORY"),
        F.lit(RULE),
        F.lit(CATEGORY_HEADER),
        F.lit(TABLE_RULE),
    )
    closing = F.array(
        F.lit(""),
        F.lit(WIDE_RULE),
        F.concat(F.lit("Report generated at: "), F.col("generated_at")),
    )
    lines = F.concat(
        heading,
        F.transform("top_products", _product_line),
        between,
        F.transform("categories", _category_line),
        closing,
    )
    return F.array_join(lines, "\n")
