"""Reads of the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley import schemas
from trolley.schemas import ServingTable


def table_path(root: str, table: ServingTable) -> str:
    return f"{root.rstrip('/')}/{table.name}"


def read_table(spark: SparkSession, root: str, table: ServingTable) -> DataFrame:
    return spark.read.schema(table.columns).parquet(table_path(root, table))


def _day(value: str | Column) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def summary_by_date(spark: SparkSession, root: str, day: str) -> DataFrame:
    """The stored summary of one day: one row or none, read from one partition."""
    return (
        read_table(spark, root, schemas.DAILY_SUMMARY)
        .where(F.col("report_date") == _day(day))
        .select(
            F.col("report_date").cast("string").alias("date"),
            "total_events",
            F.struct(F.col("buyer_count").alias("count")).alias("buyers"),
            F.struct(F.col("window_shopper_count").alias("count")).alias(
                "window_shoppers"
            ),
            F.coalesce(F.col("buyer_rate").cast("double"), F.lit(0.0)).alias(
                "buyer_rate"
            ),
            F.col("generated_at").cast("string").alias("generated_at"),
        )
    )


def conversion_trends(
    spark: SparkSession, root: str, days: int = 7, as_of: str | None = None
) -> DataFrame:
    """Rates of the last ``days`` days before ``as_of`` (today), and later ones.

    Newest day first, best rate first. The bound prunes partitions.
    """
    today = F.current_date() if as_of is None else _day(as_of)
    return (
        read_table(spark, root, schemas.CATEGORY_CONVERSION)
        .where(F.col("report_date") >= F.date_sub(today, int(days)))
        .orderBy(F.desc("report_date"), F.desc("conversion_rate"), F.asc("category"))
        .select(
            F.col("report_date").cast("string").alias("date"),
            "category",
            F.col("conversion_rate").cast("double").alias("conversion_rate"),
        )
    )


def conversion_trends_as_of(
    spark: SparkSession, root: str, calendar: DataFrame, days: int = 7
) -> DataFrame:
    """Rates of the last ``days`` days before each date ``as_of`` of ``calendar``, and of it.

    (as_of, date, category, conversion_rate) of all dates in one job. The days that the calendar
    asks for prune the partitions while the query runs, if it is small and filtered.
    """
    before = F.sequence(F.date_sub("as_of", int(days)), F.col("as_of"))
    wanted = calendar.select("as_of", F.explode(before).alias("report_date"))
    stored = read_table(spark, root, schemas.CATEGORY_CONVERSION)
    return stored.join(wanted, "report_date").select(
        F.col("as_of").cast("string").alias("as_of"),
        F.col("report_date").cast("string").alias("date"),
        "category",
        F.col("conversion_rate").cast("double").alias("conversion_rate"),
    )


def rejected_path(root: str) -> str:
    return f"{root.rstrip('/')}/{schemas.FLASH_SALE_ALERTS.name}_rejected"


def read_rejected_alerts(spark: SparkSession, root: str) -> DataFrame:
    """The newest row of each window and product that the alerts table does not take."""
    rows = spark.read.parquet(rejected_path(root))
    key = ("window_start", "window_end", "product_id")
    values = F.struct("views", "purchases")
    newest = rows.groupBy(*key).agg(F.max_by(values, "batch_id").alias("_newest"))
    return newest.select(*key, "_newest.*")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Closed windows; ``window_date``, their day, prunes what is read."""
    folders = schemas.struct(window_date=T.DateType(), batch_id=schemas.BIGINT)
    known = T.StructType([*schemas.WINDOWED_STATS, *folders])
    return spark.read.schema(known).parquet(path).drop("batch_id")
