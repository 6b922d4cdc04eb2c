"""Event logs: one JSON-lines file a day, or a folder partitioned by day."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley import schemas
from trolley.sources.decode import parse_lines, with_event_time

# The name of a daily log is prefix, ISO date, suffix.
LOG_PREFIX = "clickstream_"
LOG_SUFFIX = ".jsonl"
ISO_DATE_LENGTH = 10

logger = logging.getLogger(__name__)

NAME = re.compile(rf"{LOG_PREFIX}(\d{{4}}-\d{{2}}-\d{{2}}){re.escape(LOG_SUFFIX)}")
LINES = schemas.struct(value=schemas.STRING, event_date=T.DateType())


def yesterday() -> str:
    return (date.today() - timedelta(days=1)).isoformat()


def report_day(requested: object | None = None) -> str:
    """The day to report on as ISO text: a date, a longer text, or yesterday."""
    if requested is None:
        return yesterday()
    if isinstance(requested, date):
        return requested.strftime("%Y-%m-%d")
    return str(requested)[:ISO_DATE_LENGTH]


def _logs_in(spark: SparkSession, root: str) -> dict[str, str]:
    """Day and path of the daily logs in a folder; names without a date are left out."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(
        f"{root.rstrip('/')}/{LOG_PREFIX}*{LOG_SUFFIX}"
    )
    store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, str] = {}
    for status in store.globStatus(pattern) or []:
        path = status.getPath()
        match = NAME.fullmatch(path.getName())
        if match:
            found[match[1]] = path.toString()
        else:
            logger.warning("%s has no date in its name and is not read", path.getName())
    return found


def _log_lines(
    spark: SparkSession, root: str, days: Sequence[str] | None
) -> DataFrame:
    """Lines with the day of their log; a day without a log is warned of."""
    logs = _logs_in(spark, root)
    if days is not None:
        wanted = [report_day(day) for day in days]
        for day in wanted:
            if day not in logs:
                logger.warning("there is no log of %s in %s", day, root)
        logs = {day: logs[day] for day in wanted if day in logs}
    elif not logs:
        logger.warning("there are no daily logs in %s", root)
    if not logs:
        return spark.createDataFrame([], LINES)
    # The log of a day may be a file or a folder of parts.
    day = F.regexp_extract("_metadata.file_path", f"{NAME.pattern}(?:/|$)", 1)
    lines = spark.read.option("recursiveFileLookup", True).text(sorted(logs.values()))
    return lines.select("value", day.try_cast("date").alias("event_date"))


def _good(parsed: DataFrame) -> DataFrame:
    return with_event_time(
        parsed.where(F.col(schemas.CORRUPT).isNull()), F.col("event_date")
    )


def _bad(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(schemas.CORRUPT).isNotNull()).select(
        "event_date", F.col(schemas.CORRUPT).alias("line")
    )


def read_daily_logs(
    spark: SparkSession, root: str, days: Sequence[str] | None = None
) -> DataFrame:
    """Events of the logs of ``days`` (all for None); a missing log is a warning.

    The day is that of the file name, also for events without a usable time.
    Malformed lines are left out here and found by ``malformed_lines``.
    """
    return _good(parse_lines(_log_lines(spark, root, days)))


def malformed_lines(
    spark: SparkSession, root: str, days: Sequence[str] | None = None
) -> DataFrame:
    """Day and text of each line that is no JSON object, for quarantine."""
    return _bad(parse_lines(_log_lines(spark, root, days)))


def _partitioned_lines(spark: SparkSession, path: str) -> DataFrame:
    # As text: folders written by a stream refuse a date in their text schema.
    # A comparison with the cast still prunes folders.
    lines = spark.read.schema(
        schemas.struct(value=schemas.STRING, event_date=schemas.STRING)
    ).text(path)
    return lines.withColumn("event_date", F.col("event_date").try_cast("date"))


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Events written by ``trolley.sinks.event_logs``.

    A filter on ``event_date`` prunes the folders that are read.
    """
    return _good(parse_lines(_partitioned_lines(spark, path)))


def malformed_lines_of(spark: SparkSession, path: str) -> DataFrame:
    """The malformed lines of the same folder."""
    return _bad(parse_lines(_partitioned_lines(spark, path)))
