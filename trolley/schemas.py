"""Schemas of events, windowed statistics, serving tables and documents.

Every reader and writer takes its schema from here; none is ever inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


STRING = T.StringType()
BIGINT = T.LongType()
TIMESTAMP = T.TimestampType()
RATE = T.DecimalType(5, 2)


def struct(**columns: T.DataType) -> T.StructType:
    """A struct of nullable columns."""
    return T.StructType([T.StructField(*column) for column in columns.items()])


# --- events -----------------------------------------------------------------

# The JSON form: five strings, each may be missing.
EVENT_FIELDS = (
    "user_id",
    "product_id",
    "product_category",
    "event_type",
    "timestamp",
)
EVENT_JSON = T.StructType([T.StructField(name, STRING) for name in EVENT_FIELDS])
CORRUPT = "_corrupt_record"

# The form all operators take: the five strings, the parsed time and the day.
EVENT = T.StructType(
    [
        *EVENT_JSON,
        T.StructField("event_timestamp", TIMESTAMP),
        T.StructField("event_date", T.DateType()),
    ]
)

# Event types and segment names.
VIEW = "view"
ADD_TO_CART = "add_to_cart"
PURCHASE = "purchase"
BUYER = "buyer"
WINDOW_SHOPPER = "window_shopper"
UNKNOWN_CATEGORY = "unknown"

# The categories, in the order the product number selects them.
PRODUCT_CATEGORIES = (
    "smartphones",
    "laptops",
    "tablets",
    "headphones",
    "smartwatches",
    "cameras",
    "gaming",
    "accessories",
)
FALLBACK_CATEGORY = "accessories"

# --- speed layer ------------------------------------------------------------

WINDOWED_STATS = struct(
    window_start=TIMESTAMP,
    window_end=TIMESTAMP,
    product_id=STRING,
    views=BIGINT,
    purchases=BIGINT,
    total_events=BIGINT,
    processed_at=TIMESTAMP,
)

# --- serving tables ---------------------------------------------------------


@dataclass(frozen=True)
class ServingTable:
    """Columns, key and rules of one serving table.

    ``updated`` columns take the new value when a stored key comes again,
    ``stamp`` keeps the value of the first insert (``None``: no such column).
    """

    name: str
    columns: T.StructType
    key: tuple[str, ...]
    updated: tuple[str, ...]
    partition: str
    stamp: str | None = None
    not_null: tuple[str, ...] = ()
    max_length: tuple[tuple[str, int], ...] = ()
    decimals: tuple[str, ...] = ()
    one_of: tuple[tuple[str, tuple[str, ...]], ...] = ()


DAILY_SUMMARY = ServingTable(
    name="daily_summary",
    columns=struct(
        total_events=BIGINT,
        buyer_count=BIGINT,
        window_shopper_count=BIGINT,
        buyer_rate=RATE,
        generated_at=TIMESTAMP,
        report_date=T.DateType(),
    ),
    key=("report_date",),
    updated=(
        "total_events",
        "buyer_count",
        "window_shopper_count",
        "buyer_rate",
        "generated_at",
    ),
    partition="report_date",
    not_null=("report_date", "total_events", "buyer_count", "window_shopper_count"),
    decimals=("buyer_rate",),
)

USER_SEGMENTS = ServingTable(
    name="user_segments",
    columns=struct(
        user_id=STRING,
        segment=STRING,
        created_at=TIMESTAMP,
        report_date=T.DateType(),
    ),
    key=("report_date", "user_id"),
    updated=("segment",),
    partition="report_date",
    stamp="created_at",
    not_null=("report_date", "user_id", "segment"),
    max_length=(("user_id", 50), ("segment", 20)),
    one_of=(("segment", (BUYER, WINDOW_SHOPPER)),),
)

PRODUCT_PERFORMANCE = ServingTable(
    name="product_performance",
    columns=struct(
        product_id=STRING,
        view_count=BIGINT,
        rank=T.IntegerType(),
        created_at=TIMESTAMP,
        report_date=T.DateType(),
    ),
    key=("report_date", "product_id"),
    updated=("view_count", "rank"),
    partition="report_date",
    stamp="created_at",
    not_null=("report_date", "product_id", "view_count"),
    max_length=(("product_id", 50),),
)

CATEGORY_CONVERSION = ServingTable(
    name="category_conversion",
    columns=struct(
        category=STRING,
        views=BIGINT,
        purchases=BIGINT,
        conversion_rate=RATE,
        created_at=TIMESTAMP,
        report_date=T.DateType(),
    ),
    key=("report_date", "category"),
    updated=("views", "purchases", "conversion_rate"),
    partition="report_date",
    stamp="created_at",
    not_null=("report_date", "category", "views", "purchases", "conversion_rate"),
    max_length=(("category", 50),),
    decimals=("conversion_rate",),
)

FLASH_SALE_ALERTS = ServingTable(
    name="flash_sale_alerts",
    columns=struct(
        window_start=TIMESTAMP,
        window_end=TIMESTAMP,
        product_id=STRING,
        views=BIGINT,
        purchases=BIGINT,
        detected_at=TIMESTAMP,
        window_hour=STRING,
    ),
    key=("window_hour", "window_start", "window_end", "product_id"),
    updated=("views", "purchases"),
    # By the hour, so that a trigger rewrites open windows and not the whole day.
    partition="window_hour",
    stamp="detected_at",
    not_null=("window_start", "window_end", "product_id", "views", "purchases"),
    max_length=(("product_id", 50),),
)

SERVING_TABLES = (
    DAILY_SUMMARY,
    USER_SEGMENTS,
    PRODUCT_PERFORMANCE,
    CATEGORY_CONVERSION,
    FLASH_SALE_ALERTS,
)

# --- summary document -------------------------------------------------------

# One row a day. Categories stay an ordered array here; they become a JSON
# object only when the document is written.
SEGMENT = struct(count=BIGINT, user_ids=T.ArrayType(STRING))
SUMMARY = struct(
    report_date=T.DateType(),
    total_events=BIGINT,
    window_shoppers=SEGMENT,
    buyers=SEGMENT,
    top_products=T.ArrayType(struct(product_id=STRING, views=BIGINT)),
    categories=T.ArrayType(
        struct(
            category=STRING,
            views=BIGINT,
            purchases=BIGINT,
            conversion_rate=T.DoubleType(),
        )
    ),
    generated_at=STRING,
)
