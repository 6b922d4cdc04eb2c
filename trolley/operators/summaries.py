"""Daily figures, the summary document and the text report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley import schemas
from trolley.functions import rates, report
from trolley.functions.events import has_text
from trolley.operators.products import top_viewed_products
from trolley.operators.users import first_users, ids_in_order, user_segments


def daily_summary(activity: DataFrame) -> DataFrame:
    """All events, buyers, window shoppers and their rate for each day.

    Takes ``user_activity``: the events are counted there too, so one shuffle
    of the events serves all figures and the second one moves a row per task
    and day. Events without valid user count as events only.
    """
    segmented = has_text("user_id") & F.col("acted")  # counted only where true
    figures = activity.groupBy("report_date").agg(
        F.sum("events").alias("total_events"),
        F.count_if(segmented & F.col("bought")).alias("buyer_count"),
        F.count_if(segmented & ~F.col("bought")).alias("window_shopper_count"),
    )
    rate = rates.buyer_rate(F.col("buyer_count"), F.col("window_shopper_count"))
    return figures.withColumn("buyer_rate", rates.rate_decimal(rate))


def _same_day(figures: DataFrame, part: DataFrame) -> DataFrame:
    """Left join by day; events without a date are a day of their own."""
    renamed = part.withColumnRenamed("report_date", "_day")
    same = F.col("report_date").eqNullSafe(F.col("_day"))
    return figures.join(renamed, same, "left").drop("_day")


def iso_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def summary_rows(
    activity: DataFrame,
    views: DataFrame,
    conversion: DataFrame,
    generated_at: Column | None = None,
) -> DataFrame:
    """One nested row per day in the form of ``schemas.SUMMARY``.

    The inputs are ``user_activity``, ``product_views`` and
    ``category_conversion``. ``activity`` is used twice; a job over large logs
    stages it. What is collected into a row is short by definition: ten users
    a segment, five products, and the categories of the day.
    """
    ids = (
        first_users(user_segments(activity))
        .groupBy("report_date")
        .agg(
            *[
                ids_in_order(F.col("segment") == segment).alias(segment)
                for segment in (schemas.BUYER, schemas.WINDOW_SHOPPER)
            ]
        )
    )
    ranked = F.struct("rank", "product_id", F.col("view_count").alias("views"))
    top = (
        top_viewed_products(views)
        .groupBy("report_date")
        .agg(F.array_sort(F.collect_list(ranked)).alias("ranked"))
    )
    # Best rate first, then by appearance (no time: last), then by name.
    sortable = F.struct(
        (-F.col("conversion_rate")).alias("descending"),
        F.col("first_seen").isNull().alias("undated"),
        "first_seen",
        "category",
        "views",
        "purchases",
        "conversion_rate",
    )
    categories = conversion.groupBy("report_date").agg(
        F.array_sort(F.collect_list(sortable)).alias("sorted")
    )
    figures = daily_summary(activity)
    joined = figures
    for part in (ids, top, categories):
        joined = _same_day(joined, part)
    no_ids = F.array().cast("array<string>")

    def segment(count: str, name: str) -> Column:
        return F.struct(
            F.col(count).alias("count"), F.coalesce(F.col(name), no_ids).alias("user_ids")
        )

    def picked(column: str, *names: str) -> Column:
        chosen = F.transform(column, lambda entry: F.struct(*[entry[n] for n in names]))
        return F.coalesce(chosen, F.array())

    values = {
        "report_date": F.col("report_date"),
        "total_events": F.col("total_events"),
        "window_shoppers": segment("window_shopper_count", schemas.WINDOW_SHOPPER),
        "buyers": segment("buyer_count", schemas.BUYER),
        "top_products": picked("ranked", "product_id", "views"),
        "categories": picked(
            "sorted", "category", "views", "purchases", "conversion_rate"
        ),
        "generated_at": iso_now() if generated_at is None else generated_at,
    }
    return joined.select(
        *[
            values[field.name].cast(field.dataType).alias(field.name)
            for field in schemas.SUMMARY
        ]
    )


def daily_summary_rows(summaries: DataFrame) -> DataFrame:
    """The rows of the ``daily_summary`` table."""
    buyers, shoppers = F.col("buyers.count"), F.col("window_shoppers.count")
    return summaries.select(
        "report_date",
        "total_events",
        buyers.alias("buyer_count"),
        shoppers.alias("window_shopper_count"),
        rates.round2(rates.buyer_rate(buyers, shoppers)).alias("buyer_rate"),
        F.col("generated_at").try_cast("timestamp").alias("generated_at"),
    )


def product_rows(summaries: DataFrame) -> DataFrame:
    """The rows of the ``product_performance`` table; the place is the rank."""
    return summaries.select(
        "report_date", F.posexplode("top_products").alias("place", "product")
    ).select(
        "report_date",
        "product.product_id",
        F.col("product.views").alias("view_count"),
        (F.col("place") + 1).alias("rank"),
    )


def summary_json(summaries: DataFrame, pretty: bool = False) -> DataFrame:
    """Each summary as a JSON document; categories keep their order as its keys."""
    rates_by_category = F.map_from_entries(
        F.transform(
            "categories",
            lambda entry: F.struct(
                entry["category"],
                F.struct(entry["views"], entry["purchases"], entry["conversion_rate"]),
            ),
        )
    )
    document = F.struct(
        F.col("report_date").cast("string").alias("date"),
        "total_events",
        "window_shoppers",
        "buyers",
        F.col("top_products").alias("top_5_viewed_products"),
        rates_by_category.alias("conversion_rates_by_category"),
        "generated_at",
    )
    options = {"ignoreNullFields": "false", "pretty": str(pretty).lower()}
    return summaries.select("report_date", F.to_json(document, options).alias("document"))


def report_texts(summaries: DataFrame) -> DataFrame:
    """The text report of each day."""
    return summaries.select("report_date", report.report_text().alias("report"))


def report_for(summaries: DataFrame, day: str) -> DataFrame:
    """The report of one day, or a sentence that there is none."""
    wanted = summaries.sparkSession.range(1).select(
        F.lit(day).cast("date").alias("report_date")
    )
    texts = report_texts(summaries.where(F.col("report_date") == F.lit(day).cast("date")))
    return wanted.join(texts, "report_date", "left").select(
        "report_date", F.coalesce("report", F.lit(report.NO_DATA)).alias("report")
    )
