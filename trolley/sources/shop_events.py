"""The ``events`` table of the benchmark data as shop events.

``user_id`` is a number, ``props`` holds ``{"k": 0..99}`` and ``ts`` has no time
zone; users, products and times are made from them. Clicks are cart additions;
sign-ups and errors stay as they are, types the reports do not know.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley import schemas
from trolley.functions.events import category_of_product
from trolley.session import require_utc

EVENT_TABLE = schemas.struct(
    event_id=schemas.BIGINT,
    ts=T.TimestampNTZType(),
    user_id=schemas.BIGINT,
    event_type=schemas.STRING,
    value=T.DoubleType(),
    props=schemas.STRING,
)


# Types that are called otherwise in the table.
RENAMED = {schemas.ADD_TO_CART: "click"}


def from_event_table(
    table: DataFrame, event_types: Sequence[str] | None = None
) -> DataFrame:
    """Works on batch and streaming reads of the table alike.

    ``event_types`` limits the rows to these types; the filter is on the stored
    names, so it reaches the scan. ``timestamp``, the text form of the time, is
    only made where it is used.
    """
    if event_types is not None:
        stored = [RENAMED.get(name, name) for name in event_types]
        table = table.where(F.col("event_type").isin(stored))
    # A pattern reads the one number several times faster than a JSON parser.
    number = F.regexp_extract("props", r'"k"\s*:\s*(-?\d+)', 1).try_cast("int") + 1
    product = F.concat(F.lit("product_"), number.cast("string"))
    event_type = F.col("event_type")
    for name, stored_name in RENAMED.items():
        event_type = F.when(
            F.col("event_type") == stored_name, F.lit(name)
        ).otherwise(event_type)
    time = F.col("ts").cast("timestamp")
    return table.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        product.alias("product_id"),
        category_of_product(product).alias("product_category"),
        event_type.alias("event_type"),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
        time.alias("event_timestamp"),
        F.to_date("ts").alias("event_date"),
    )


def read_shop_events(
    spark: SparkSession, sf_dir: str, event_types: Sequence[str] | None = None
) -> DataFrame:
    table = require_utc(spark).read.schema(EVENT_TABLE).parquet(f"{sf_dir}/events.parquet")
    return from_event_table(table, event_types)


def stream_shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A file stream takes a folder or a pattern; the table may be one file.
    path = f"{sf_dir}/events.[p]arquet"
    table = require_utc(spark).readStream.schema(EVENT_TABLE).parquet(path)
    return from_event_table(table)
