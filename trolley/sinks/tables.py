"""Serving tables: Parquet folders partitioned by day, with keyed upserts."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from typing import Any

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trolley import schemas
from trolley.operators.constraints import conform, constraint_violations, row_rules
from trolley.operators.merge import merge_upsert
from trolley.schemas import ServingTable
from trolley.session import exists, remove, scratch_path, stage, written
from trolley.sources.serving import read_table, table_path

logger = logging.getLogger(__name__)

SHOWN_VIOLATIONS = 20


class ConstraintViolation(ValueError):
    """Rows that break a rule of their table; nothing was stored."""


def together(step: Callable[[Any], Any], tables: Iterable[Any]) -> list[Any]:
    """Run the jobs of several tables at once; the first error is raised.

    The tables are independent and most are short, so one after the other they
    would leave the cluster idle.
    """
    with ThreadPoolExecutor(max_workers=len(schemas.SERVING_TABLES)) as pool:
        return list(pool.map(step, tables))


def create_tables(
    spark: SparkSession,
    root: str,
    tables: Sequence[ServingTable] = schemas.SERVING_TABLES,
) -> None:
    """Make the folders that do not exist yet."""

    def create(table: ServingTable) -> None:
        empty = spark.createDataFrame([], table.columns)
        empty.write.mode("ignore").partitionBy(table.partition).parquet(
            table_path(root, table)
        )

    together(create, tables)


def register_tables(
    spark: SparkSession,
    root: str,
    database: str,
    tables: Sequence[ServingTable] = schemas.SERVING_TABLES,
) -> None:
    """Make the tables known to the catalog, with the partitions there are now."""
    create_tables(spark, root, tables)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in tables:
        columns = ", ".join(
            f"{field.name} {field.dataType.simpleString()}" for field in table.columns
        )
        name = f"{database}.{table.name}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"PARTITIONED BY ({table.partition}) LOCATION '{table_path(root, table)}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {name}")


def check(rows: DataFrame, table: ServingTable) -> None:
    """Raise if rows break a rule of their table.

    All that is wrong is written to the scratch folder; the error counts it, says where
    it is and shows some of it.
    """
    found = constraint_violations(rows, table)
    if found.isEmpty():
        return
    path = scratch_path(rows.sparkSession, f"{table.name}-violations")
    kept = written(found, path)
    listed = "; ".join(str(row.asDict()) for row in kept.take(SHOWN_VIOLATIONS))
    raise ConstraintViolation(
        f"{table.name}: {kept.count()} violations, all of them in {path}: {listed}"
    )


def counting_breaks(rows: DataFrame, table: ServingTable) -> tuple[DataFrame, Observation]:
    """``rows``, and how many of them break a rule for single rows.

    They are counted as the rows pass to wherever they are written, without a job of their own.
    """
    seen = Observation()
    counts = [
        F.count_if(broken).alias(f"rule_{i}") for i, broken in enumerate(row_rules(table).values())
    ]
    return rows.observe(seen, F.count("*").alias("rows"), *counts), seen


def breaks(seen: Observation) -> bool:
    """Whether some row broke a rule, or that is not known."""
    try:
        counts = seen.get
    except Py4JError:
        # Spark counts nothing where it finds while running that there are no rows.
        return True
    return any(value for name, value in counts.items() if name != "rows")


def staged(rows: DataFrame, table: ServingTable) -> DataFrame:
    """``rows`` computed once, checked and in the types of the table.

    Whether a key comes twice is seen when they are merged.
    """
    counted, seen = counting_breaks(rows, table)
    kept = stage(counted, f"{table.name}-rows")
    if breaks(seen):
        check(kept, table)
    return conform(kept, table)


def publish(staged_rows: DataFrame, root: str, table: ServingTable) -> None:
    """Replace the days in ``staged_rows``, leave all others as they are.

    AQE splits large days over several files and joins the rows of small ones.
    The mode is set on the write and not on the session: a session in static
    mode would drop the other days.
    """
    (
        staged_rows.hint("rebalance", table.partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(table.partition)
        .parquet(table_path(root, table))
    )


def add_partitions(
    spark: SparkSession, root: str, database: str, table: ServingTable, days: Iterable[Any]
) -> None:
    """Make the days just written known to the catalog, without listing the whole table.

    Days that the catalog has are left as they are, and those whose last row has gone leave it.
    """
    name, column = f"{database}.{table.name}", table.partition
    days = sorted({*days})
    if not days:
        return
    folders = {day: f"{table_path(root, table)}/{column}={day}" for day in days}
    there = {day: exists(spark, folder) for day, folder in folders.items()}
    added = " ".join(
        f"PARTITION ({column} = '{day}') LOCATION '{folders[day]}'" for day in days if there[day]
    )
    gone = ", ".join(f"PARTITION ({column} = '{day}')" for day in days if not there[day])
    if added:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {gone}")
    spark.catalog.refreshTable(name)


def days_in(rows: DataFrame, column: str) -> list[date]:
    return [row[0] for row in rows.select(column).distinct().collect()]


@dataclass
class Merged:
    """The days of a table as they will be, staged and checked, not yet in place."""

    rows: DataFrame
    path: str
    root: str
    table: ServingTable
    days: list
    drop_empty: bool

    def put(self) -> None:
        """Replace the stored days; the staged ones are removed if that has worked."""
        spark, table = self.rows.sparkSession, self.table
        try:
            publish(self.rows, self.root, table)
        except Exception:
            logger.error(
                "%s: days may be incomplete, publish again from %s", table.name, self.path
            )
            raise
        if self.drop_empty:
            # A day without rows is not written, so its old rows would stay.
            for day in sorted({*self.days} - {*days_in(self.rows, table.partition)}):
                remove(spark, f"{table_path(self.root, table)}/{table.partition}={day}")
        remove(spark, self.path)


def merged_days(
    rows: DataFrame,
    root: str,
    table: ServingTable,
    now: Column | None = None,
    days: Sequence[date] | None = None,
    replace_days: bool = False,
    removed: DataFrame | None = None,
) -> Merged | None:
    """Check ``rows`` and stage the days they belong to, merged; see ``upsert``.

    The rules are counted by the same job. Only if one is broken, or a key comes twice, are the
    rows read again, to say what is wrong. Without rows and days there is nothing to do: None.
    """
    spark = rows.sparkSession
    if days is None:
        named = rows.select(table.partition)
        if removed is not None:
            named = named.unionAll(removed.select(table.partition))
        days = days_in(named, table.partition)
    days = list(days)
    if not days:
        logger.warning("no rows for %s, nothing to store", table.name)
        return None
    # A comparison with a bare list of literals prunes partitions while planning.
    touched = read_table(spark, root, table).where(F.col(table.partition).isin(days))
    if replace_days:
        key = list(table.key)
        touched = touched.join(rows.select(*key), key, "left_semi")
    if removed is not None:
        touched = touched.join(removed.select(*table.key), list(table.key), "left_anti")
    counted, seen = counting_breaks(rows, table)
    source = conform(counted, table)
    merged = merge_upsert(touched, source, table.key, table.updated, table.stamp, now)
    path = scratch_path(spark, f"{table.name}-merged")
    try:
        kept = written(merged, path)
    except Exception:
        check(rows, table)
        raise
    if breaks(seen):
        check(rows, table)
    return Merged(kept, path, root, table, days, replace_days or removed is not None)


def upsert(
    rows: DataFrame,
    root: str,
    table: ServingTable,
    now: Column | None = None,
    days: Sequence[date] | None = None,
    replace_days: bool = False,
    removed: DataFrame | None = None,
    database: str | None = None,
) -> None:
    """Merge rows into the stored days they belong to, if they keep all rules.

    ``rows`` is read more than once, so it should come from a staged result.
    Only the days in it are read and written back; ``days`` names them if they
    are known. The list of days is all that reaches the driver. The merged days
    are staged before the old ones are replaced: if the last step fails, the
    staged folder is kept and ``publish`` can be run again from it.
    ``replace_days`` drops stored rows without a new one; with ``days``, also
    all rows of a day that has no new row at all. ``removed`` has the key and the day of stored
    rows to drop; ``rows`` must not have the same keys. ``database`` is the one in which the
    table is registered, if its catalog is to know the days.
    """
    merged = merged_days(rows, root, table, now, days, replace_days, removed)
    if merged:
        merged.put()
        if database:
            add_partitions(rows.sparkSession, root, database, table, merged.days)


def upsert_all(
    batches: Mapping[ServingTable, DataFrame],
    root: str,
    now: Column | None = None,
    days: Sequence[date] | None = None,
    replace_days: bool = False,
    database: str | None = None,
) -> None:
    """Upsert into several tables, touching none unless all rows are valid.

    The batches come from staged results. All tables are merged and checked in the scratch
    folder before the first one is replaced. A failure between two of these last steps is repaired
    by running the job again, as merging the same rows twice gives the same table.
    """
    merged = together(
        lambda table: merged_days(batches[table], root, table, now, days, replace_days), batches
    )
    changed = [one for one in merged if one]
    together(Merged.put, changed)
    if database:
        for one in changed:
            add_partitions(one.rows.sparkSession, root, database, one.table, one.days)
