"""JSON text to events, the same for log lines and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley import schemas
from trolley.functions.events import event_time
from trolley.session import require_utc


def parse_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """The five event fields from a text or binary JSON column.

    Unknown fields are dropped, missing ones are NULL, and a malformed message
    becomes a row of NULLs, which has no time and thus falls into no window.
    """
    parsed = F.from_json(F.col(value).cast("string"), schemas.EVENT_JSON)
    return messages.select(parsed.alias("data")).select("data.*")


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The event fields and, for malformed lines, the line itself.

    A good line is one JSON object and nothing else: as the only entry of a list it has
    to give a list of one object. Blank lines are no events. The other columns of
    ``lines`` are kept.
    """
    listed = F.concat(F.lit("["), F.col(value), F.lit("]"))
    parsed = F.from_json(listed, T.ArrayType(schemas.EVENT_JSON))
    good = (F.size("_list") == 1) & F.get("_list", F.lit(0)).isNotNull()
    others = [name for name in lines.columns if name != value]
    return (
        lines.where(F.col(value).rlike(r"\S"))
        .select(*others, value, parsed.alias("_list"))
        .select(
            *others,
            F.when(good, F.get("_list", F.lit(0))).alias("_data"),
            F.when(~good | F.col("_list").isNull(), F.col(value)).alias(schemas.CORRUPT),
        )
        .select(*others, "_data.*", schemas.CORRUPT)
    )


def with_event_time(fields: DataFrame, day: Column | None = None) -> DataFrame:
    """Add ``event_timestamp`` and ``event_date``.

    The date is ``day`` where the source tells it, else that of the time, in UTC.
    """
    require_utc(fields.sparkSession)
    timed = fields.withColumn("event_timestamp", event_time())
    date = F.to_date("event_timestamp") if day is None else day
    return timed.withColumn("event_date", date).select(*schemas.EVENT.fieldNames())
