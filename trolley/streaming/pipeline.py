"""From messages to windowed statistics and alerts, as streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.operators.windows import flash_sale_alerts, windowed_product_stats
from trolley.settings import Settings
from trolley.sources.decode import parse_events, with_event_time


def events_of(messages: DataFrame) -> DataFrame:
    """Events of a message stream with a binary or text ``value``."""
    return with_event_time(parse_events(messages))


def stats(events: DataFrame, settings: Settings, watermark: str | None) -> DataFrame:
    """Windowed statistics; the watermark bounds the state they keep.

    Without one every window stays in the state store for good, and only the
    update mode is possible. With one, events that come later than the delay
    after the newest event are dropped.
    """
    needed = events.select("event_timestamp", "product_id", "event_type")
    if watermark:
        needed = needed.withWatermark("event_timestamp", watermark)
    return windowed_product_stats(needed, settings.window, settings.slide)


def alerts(events: DataFrame, settings: Settings) -> DataFrame:
    """Alerts on windows as they fill; meant for the update mode.

    An alert comes again whenever its window changes, and is not taken back
    when the purchases reach the threshold later.
    """
    windows = stats(events, settings, settings.watermark)
    return flash_sale_alerts(
        windows, settings.views_threshold, settings.purchases_threshold
    )


def history(events: DataFrame, settings: Settings) -> DataFrame:
    """Closed windows for the history, stamped with the time of processing."""
    if not settings.watermark:
        raise ValueError("the history appends closed windows: set a watermark")
    windows = stats(events, settings, settings.watermark)
    return windows.withColumn("processed_at", F.current_timestamp())
