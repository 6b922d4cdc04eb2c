"""Sliding windows per product and the alerts drawn from them.

The same functions serve batch and streaming DataFrames.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley import schemas
from trolley.functions.events import flag, is_type

SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
# From this many windows per event on, batch queries count per slide first by default.
PER_SLIDE_FROM = 3


def _seconds(duration: str) -> int | None:
    """Seconds of a duration of one unit; None for any other form."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", duration.lower())
    if not match or match[2] not in SECONDS:
        return None
    return int(match[1]) * SECONDS[match[2]]


def windows_per_event(window: str, slide: str) -> int | None:
    """How many windows each event falls into, None if that varies or is unknown."""
    length, step = _seconds(window), _seconds(slide)
    if not length or not step or length % step:
        return None
    return length // step


def _counts() -> list[Column]:
    return [
        F.sum(flag(is_type(schemas.VIEW))).alias("views"),
        F.sum(flag(is_type(schemas.PURCHASE))).alias("purchases"),
        F.count("*").alias("total_events"),
    ]


def _flat(stats: DataFrame) -> DataFrame:
    return stats.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "product_id",
        "views",
        "purchases",
        "total_events",
    )


def _counts_per_slide(
    events: DataFrame, window: str, slide: str, per_slide: bool | None
) -> bool:
    """What ``per_slide`` says, by default whether that saves rows."""
    overlap = windows_per_event(window, slide)
    if per_slide and (events.isStreaming or not overlap):
        raise ValueError("counts per slide need a batch and a window of whole slides")
    if per_slide is None:
        return not events.isStreaming and (overlap or 0) >= PER_SLIDE_FROM
    return per_slide


def windowed_product_stats(
    events: DataFrame,
    window: str = "10 minutes",
    slide: str = "5 minutes",
    per_slide: bool | None = None,
) -> DataFrame:
    """Views, purchases and all events of each window and product.

    Events without a time are in no window. Views and purchases are NULL where
    no event of the group has a type. Products are taken as they are: NULL and
    '' are groups of their own.

    Spark copies each event once per window it belongs to. With ``per_slide`` a batch
    query counts per slide first and copies only these counts; the result is the
    same. By default it does so from PER_SLIDE_FROM windows per event on.
    """
    if _counts_per_slide(events, window, slide, per_slide):
        slots = events.groupBy(
            F.window("event_timestamp", slide).alias("slot"), "product_id"
        ).agg(*_counts())
        totals = [
            F.sum(name).alias(name) for name in ("views", "purchases", "total_events")
        ]
        in_window = F.window(F.col("slot.start"), window, slide).alias("window")
        return _flat(slots.groupBy(in_window, "product_id").agg(*totals))
    in_window = F.window("event_timestamp", window, slide).alias("window")
    return _flat(events.groupBy(in_window, "product_id").agg(*_counts()))


def flash_sale_alerts(
    stats: DataFrame, views_threshold: int = 100, purchases_threshold: int = 5
) -> DataFrame:
    """Windows in which many looked at a product and few bought it."""
    return stats.where(
        (F.col("views") > views_threshold)
        & (F.col("purchases") < purchases_threshold)
    ).select("window_start", "window_end", "product_id", "views", "purchases")


def sliding_window_counts(
    events: DataFrame,
    window: str = "10 minutes",
    slide: str = "5 minutes",
    per_slide: bool | None = None,
) -> DataFrame:
    """All events of each window, whatever the product; ``per_slide`` as above."""
    if _counts_per_slide(events, window, slide, per_slide):
        slots = events.groupBy(F.window("event_timestamp", slide).alias("slot")).agg(
            F.count("*").alias("total_events")
        )
        in_window = F.window(F.col("slot.start"), window, slide).alias("window")
        counted = slots.groupBy(in_window).agg(F.sum("total_events").alias("total_events"))
    else:
        in_window = F.window("event_timestamp", window, slide).alias("window")
        counted = events.groupBy(in_window).agg(F.count("*").alias("total_events"))
    return (
        counted.select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "total_events",
        )
    )
