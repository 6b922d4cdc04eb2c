"""Serving tables laid out by bucket of their key, for upserts that leave stored rows in place.

A catalog table is partitioned by day and cut into buckets of the rest of the key. A merge joins
each bucket with the new rows of it: only these are moved, not the stored ones, and the merged
rows are where the files of their buckets are written. Each day has one file a bucket, however
often it is merged. For tables whose days are much larger than what an upsert brings.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.constraints import conform
from trolley.operators.merge import merge_upsert
from trolley.schemas import ServingTable
from trolley.session import remove, scratch_path
from trolley.sinks.tables import breaks, check, counting_breaks, days_in
from trolley.sources.serving import table_path

logger = logging.getLogger(__name__)

#: Joins use the buckets although the day is a part of the key as well, scans keep them.
LAYOUT = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


@contextmanager
def set_for(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the block. They change plans and no results."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def bucket_columns(table: ServingTable) -> list[str]:
    columns = [name for name in table.key if name != table.partition]
    if not columns:
        raise ValueError(f"{table.name} has no key besides its day")
    return columns


def create_bucketed(
    spark: SparkSession, root: str, database: str, table: ServingTable, buckets: int
) -> str:
    """Make the table, if it does not exist, and give its name in the catalog.

    The number of buckets stays: choose it for a bucket of the largest day to fit a task.
    """
    name = f"{database}.{table.name}_by_key"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    _create(spark, name, table, buckets, f"{table_path(root, table)}_by_key")
    return name


def _create(
    spark: SparkSession, name: str, table: ServingTable, buckets: int, path: str
) -> None:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.columns)
    by = ", ".join(bucket_columns(table))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({table.partition}) CLUSTERED BY ({by}) SORTED BY ({by}) "
        f"INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )


def buckets_of(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type)


def merged_buckets(
    rows: DataFrame, name: str, table: ServingTable, days: list, now: Column | None = None
) -> DataFrame:
    """The stored ``days`` with ``rows`` merged into them; the stored rows are not moved."""
    stored = rows.sparkSession.table(name).where(F.col(table.partition).isin(days))
    return merge_upsert(stored, rows, table.key, table.updated, table.stamp, now)


def upsert_bucketed(
    rows: DataFrame, name: str, table: ServingTable, now: Column | None = None
) -> None:
    """As ``tables.upsert`` for a table of ``create_bucketed``; ``rows`` come from a staged result.

    The merged days are a table of the same buckets in the scratch folder first. It stays there if
    the last step fails; nothing is replaced if a row breaks a rule.
    """
    spark = rows.sparkSession
    days = days_in(rows, table.partition)
    if not days:
        logger.warning("no rows for %s, nothing to store", name)
        return
    path = scratch_path(spark, f"{table.name}-buckets")
    passing = f"{name.split('.')[0]}.merging_{uuid.uuid4().hex}"
    counted, seen = counting_breaks(rows, table)
    with set_for(spark, LAYOUT):
        _create(spark, passing, table, buckets_of(spark, name), path)
        try:
            merged = merged_buckets(conform(counted, table), name, table, days, now)
            try:
                merged.select(*table.columns.fieldNames()).write.insertInto(passing)
            except Exception:
                check(rows, table)
                raise
            if breaks(seen):
                check(rows, table)
            for day in days:
                _replace_day(spark, passing, name, table, day)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {passing}")
    remove(spark, path)


def _replace_day(spark: SparkSession, source: str, name: str, table: ServingTable, day) -> None:
    """One day by its name: which others stay does not depend on any setting."""
    column = table.partition
    others = ", ".join(field for field in table.columns.fieldNames() if field != column)
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION ({column} = '{day}') "
        f"SELECT {others} FROM {source} WHERE {column} = '{day}'"
    )
