"""Alerts, their withdrawal and closed windows from one read of the topic and one state.

Events are counted per window and product in every task before they are moved, so a hot
product costs one row for each Arrow batch and window. One stateful processor then keeps the counts of
each open window. It gives a row of these kinds:

* ``alert``: the window changed, has more views and fewer purchases than the thresholds say;
* ``withdrawn``: it had an alert, and its purchases have reached the threshold;
* ``closed``: the watermark has passed its end; its state is removed (a timer does it);
* ``late``: events for a window that is closed already; they are counted and not used.

Without a watermark nothing is ever closed or late. The state of a window then ends when
it has not changed for ``ttl`` of processing time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from trolley import schemas
from trolley.functions.events import flag, is_type

ALERT, WITHDRAWN, CLOSED, LATE = KINDS = ("alert", "withdrawn", "closed", "late")
#: The state of a window: its counts, and whether an alert for it is out.
COUNTS = ("views", "purchases", "total_events")
STATE_NAME = "window"
STATE = T.StructType(
    [*(T.StructField(name, schemas.BIGINT) for name in COUNTS),
     T.StructField("alerted", T.BooleanType())]
)
#: Times are microseconds in the state and its key.
KEY = ("start_us", "end_us", "product_id")
_ROWS = "start_us bigint, end_us bigint, product_id string"
_COUNTS = "views bigint, purchases bigint, total_events bigint"
CHANGE = T.StructType(
    [T.StructField("kind", schemas.STRING),
     *(T.StructField(name, schemas.BIGINT) for name in KEY[:2]),
     T.StructField(KEY[2], schemas.STRING),
     *(T.StructField(name, schemas.BIGINT) for name in COUNTS)]
)


def partial_counts(events: DataFrame, window: str, slide: str) -> DataFrame:
    """Counts per window and product of each Arrow batch; no shuffle.

    As in the batch operator, views and purchases are NULL where no event has a type.
    """
    copies = events.select(
        F.window("event_timestamp", window, slide).alias("window"),
        "product_id",
        flag(is_type(schemas.VIEW)).alias("views"),
        flag(is_type(schemas.PURCHASE)).alias("purchases"),
    ).select(
        F.unix_micros("window.start").alias("start_us"),
        F.unix_micros("window.end").alias("end_us"),
        "product_id",
        "views",
        "purchases",
    )

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            groups = frame.assign(total_events=1).groupby(list(KEY), dropna=False, sort=False)
            yield groups.sum(min_count=1).reset_index()

    return copies.mapInPandas(count, f"{_ROWS}, {_COUNTS}")


def added(total: int | None, more: int | None) -> int | None:
    """The sum of two counts; NULL only if both are."""
    if total is None or more is None:
        return more if total is None else total
    return total + more


def change(kind: str, key: Any, counts: tuple) -> Row:
    return Row(*CHANGE.fieldNames())(kind, *key, *counts)


class WindowProcessor(StatefulProcessor):
    """Counts of one window and product, from the partial counts of each trigger."""

    def __init__(
        self, views_threshold: int, purchases_threshold: int, ttl_ms: int | None = None
    ):
        self.views_threshold, self.purchases_threshold = views_threshold, purchases_threshold
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(STATE_NAME, STATE, self.ttl_ms)

    def handleInputRows(
        self, key: Any, rows: Iterator[Row], timerValues: TimerValues
    ) -> Iterator[Row]:
        new: tuple = (None, None, None)
        for row in rows:
            new = tuple(added(total, row[name]) for total, name in zip(new, COUNTS))
        stored = self.state.get()
        if stored is None and self.ttl_ms is None:
            closing = -(-key[1] // 1000)
            if timerValues.getCurrentWatermarkInMs() >= closing:
                yield change(LATE, key, new)
                return
            self.handle.registerTimer(closing)
        before, alerted = ((None,) * 3, False) if stored is None else (stored[:3], stored[3])
        counts = tuple(added(total, more) for total, more in zip(before, new))
        views, purchases = counts[0] or 0, counts[1] or 0
        alert = views > self.views_threshold and purchases < self.purchases_threshold
        # The counts only grow: an alert ends by purchases alone.
        self.state.update((*counts, alert))
        if alert:
            yield change(ALERT, key, counts)
        elif alerted:
            yield change(WITHDRAWN, key, counts)

    def handleExpiredTimer(
        self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[Row]:
        stored = self.state.get()
        self.state.clear()
        yield change(CLOSED, key, stored[:3])

    def close(self) -> None:
        pass


def window_changes(
    events: DataFrame,
    window: str,
    slide: str,
    watermark: str | None,
    ttl: str | None = None,
    views_threshold: int = 100,
    purchases_threshold: int = 5,
) -> DataFrame:
    """What happens to the windows of a stream, as rows with their ``kind``.

    With a ``watermark`` windows are closed by it; without one their state needs a ``ttl``.
    """
    if not watermark and not ttl:
        raise ValueError("the state of the windows needs a watermark or a time to live")
    needed = events.select("event_timestamp", "product_id", "event_type")
    if watermark:
        needed = needed.withWatermark("event_timestamp", watermark)
    ttl_ms = None if watermark else milliseconds(ttl)
    processor = WindowProcessor(views_threshold, purchases_threshold, ttl_ms)
    changes = (
        partial_counts(needed, window, slide)
        .groupBy(*KEY)
        .transformWithState(
            processor, CHANGE, "Update", "EventTime" if watermark else "ProcessingTime"
        )
    )
    return with_times(changes)


def milliseconds(duration: str) -> int:
    """Milliseconds of a duration such as ``2 days``."""
    delta = pd.Timedelta(duration)
    if pd.isna(delta) or delta.value <= 0:
        raise ValueError(f"not a positive duration: {duration!r}")
    return int(delta.total_seconds() * 1000)


def with_times(rows: DataFrame) -> DataFrame:
    """Microseconds of the key as window times, in place of the first two columns of it."""
    times = {
        "start_us": F.timestamp_micros("start_us").alias("window_start"),
        "end_us": F.timestamp_micros("end_us").alias("window_end"),
    }
    return rows.select(*[times.get(name, F.col(name)) for name in rows.columns])
