"""Volume of the event stream: mix of types and progress over a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley import schemas
from trolley.functions.events import is_type
from trolley.functions.rates import percent


def event_type_distribution(events: DataFrame) -> DataFrame:
    """Events of each type and their share of all events in percent.

    The total is a scalar subquery over the counts; Spark runs the scan and its
    exchange once for both.
    """
    counts = events.groupBy("event_type").agg(F.count("*").alias("events"))
    total = counts.select(F.sum("events").alias("events")).scalar()
    share = F.call_function(
        "format_number", percent(F.col("events"), total), F.lit("0.0")
    )
    return counts.select(
        "event_type", "events", share.cast("double").alias("share_percent")
    )


def event_throughput(events: DataFrame, every: str = "1 hour") -> DataFrame:
    """How far each day had come after every interval, and at which rate.

    Counts are running totals of the day; the rate divides them by the time
    since its first event and is 0 where none has passed. Running totals are
    taken over the intervals of a day, not over its events.
    """
    intervals = events.groupBy(
        F.col("event_date").alias("report_date"),
        F.window("event_timestamp", every).alias("interval"),
    ).agg(
        F.count("*").alias("events"),
        F.count_if(is_type(schemas.VIEW)).alias("views"),
        F.count_if(is_type(schemas.ADD_TO_CART)).alias("carts"),
        F.count_if(is_type(schemas.PURCHASE)).alias("purchases"),
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
    )
    so_far = (
        Window.partitionBy("report_date")
        .orderBy("interval.start")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = intervals.select(
        "report_date",
        F.col("interval.start").alias("interval_start"),
        *[
            F.sum(name).over(so_far).alias(name)
            for name in ("events", "views", "carts", "purchases")
        ],
        (
            F.unix_micros(F.max("last_event").over(so_far))
            - F.unix_micros(F.min("first_event").over(so_far))
        ).alias("elapsed_micros"),
    )
    rate = F.when(
        F.col("elapsed_micros") > 0,
        F.col("events") * F.lit(1000000.0) / F.col("elapsed_micros"),
    ).otherwise(F.lit(0.0))
    return totals.withColumn("events_per_second", rate)
