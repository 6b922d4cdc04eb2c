"""Summary documents in pieces, for days whose categories do not fit into one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.operators.ranking import positions
from trolley.operators.summaries import summary_json

RATES = '"conversion_rates_by_category" : {'
PRETTY = {"pretty": "true", "ignoreNullFields": "false"}
HEAD, CATEGORIES, TAIL = range(3)


def category_order() -> list[Column]:
    """Best rate first, then by appearance (no time: last), then by name."""
    return [F.desc("conversion_rate"), F.asc_nulls_last("first_seen"), F.asc("category")]


def document_pieces(summaries: DataFrame, conversion: DataFrame) -> DataFrame:
    """(report_date, section, position, piece): the lines of the pretty document of each day.

    ``summaries`` are the rows of ``summaries.summary_rows``, whose categories are not looked
    at and so need not be collected; ``conversion`` has the categories as rows. They are
    numbered over all tasks and become one piece each, so no row grows with a day. In order,
    joined by line feeds, the pieces are the document.
    """
    none = F.array().cast(summaries.schema["categories"].dataType)
    bare = summary_json(summaries.withColumn("categories", none), pretty=True)
    empty = RATES + " }"
    numbered = positions(conversion, ["report_date"], category_order(), "position")
    sizes = numbered.groupBy(F.col("report_date").alias("_day")).agg(F.count("*").alias("_last"))
    same = F.col("report_date").eqNullSafe(F.col("_day"))
    days = bare.join(sizes, same, "left")
    # Quotes within names are escaped, so the key is found nowhere else.
    head = F.concat(F.substring_index("document", empty, 1), F.lit(RATES))
    tail = F.concat(F.lit("  }"), F.substring_index("document", empty, -1))
    some = F.col("_last").isNotNull()
    frame = days.select(
        "report_date",
        F.explode(
            F.array(
                F.struct(
                    F.lit(HEAD).alias("section"),
                    F.when(some, head).otherwise(F.col("document")).alias("piece"),
                ),
                F.struct(F.lit(TAIL).alias("section"), F.when(some, tail).alias("piece")),
            )
        ).alias("part"),
    ).select("report_date", "part.section", F.lit(0).alias("position"), "part.piece")
    entry = F.to_json(
        F.create_map("category", F.struct("views", "purchases", "conversion_rate")), PRETTY
    )
    # Without the outer braces, one level further in.
    inner = F.regexp_replace(F.substr(entry, F.lit(3), F.length(entry) - 4), "(?m)^", "  ")
    comma = F.when(F.col("position") < F.col("_last"), ",").otherwise("")
    entries = numbered.join(sizes, same).select(
        "report_date",
        F.lit(CATEGORIES).alias("section"),
        "position",
        F.concat(inner, comma).alias("piece"),
    )
    return frame.where(F.col("piece").isNotNull()).unionAll(entries)
