"""Events as JSON lines, appended to one folder a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from trolley import schemas

# Missing fields are written as null, not left out.
JSON_OPTIONS = {"ignoreNullFields": "false"}


def log_rows(events: DataFrame) -> DataFrame:
    """The fields of each event and the day whose log it belongs to."""
    return events.select(*schemas.EVENT_FIELDS, "event_date")


def append_event_log(events: DataFrame, path: str, by_time: bool = False) -> None:
    """Add events to the logs of their days.

    The rows of a day are brought together first, large days over several
    tasks; else each task would write a file for each day it has seen. That
    shuffle is left out for input that is ordered ``by_time`` already.
    """
    rows = log_rows(events)
    if not by_time:
        rows = rows.hint("rebalance", "event_date")
    (
        rows.write.mode("append")
        .options(**JSON_OPTIONS)
        .partitionBy("event_date")
        .json(path)
    )


def start_event_log(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """The same for a stream."""
    return (
        log_rows(events)
        .writeStream.queryName("event_log")
        .outputMode("append")
        .format("json")
        .options(**JSON_OPTIONS)
        .partitionBy("event_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )
