"""Expressions over one event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trolley import schemas


def has_text(column: str) -> Column:
    """Neither NULL nor empty. NULL for NULL, so only to be used as a filter or
    in an aggregate; kept this plain, it is pushed down to the scan."""
    return F.col(column) != ""


def is_type(event_type: str) -> Column:
    """The event has this type; NULL where the type is NULL."""
    return F.col("event_type") == event_type


def flag(condition: Column) -> Column:
    """1 or 0, and NULL for an unknown condition.

    A sum of these is NULL for a group in which nothing is known, which is what
    the windowed statistics report.
    """
    return condition.cast("int")


def event_time(text: str | Column = "timestamp") -> Column:
    """ISO-8601 text to a timestamp, NULL where it is none.

    A plain cast would fail the whole job on the first bad row in ANSI mode.
    """
    column = F.col(text) if isinstance(text, str) else text
    return column.try_cast("timestamp")


def category_or_unknown(column: str = "product_category") -> Column:
    return F.coalesce(F.col(column), F.lit(schemas.UNKNOWN_CATEGORY))


def category_of_product(product_id: str | Column = "product_id") -> Column:
    """Category by product number: ``product_<n>`` belongs to category n mod 8.

    Ids without a whole number after the first underscore get the fallback.
    """
    column = F.col(product_id) if isinstance(product_id, str) else product_id
    number = F.get(F.split(column, "_"), F.lit(1)).try_cast("bigint")
    names = F.array(*[F.lit(name) for name in schemas.PRODUCT_CATEGORIES])
    # pmod: negative numbers count from the end of the list. The index is an
    # INT because arrays refuse a BIGINT one.
    index = F.pmod(number, F.lit(len(schemas.PRODUCT_CATEGORIES))).cast("int")
    return F.coalesce(F.get(names, index), F.lit(schemas.FALLBACK_CATEGORY))


def event_json(*names: str) -> Column:
    """One event as JSON text with its fields in schema order; NULLs are kept."""
    fields = names or schemas.EVENT_FIELDS
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
