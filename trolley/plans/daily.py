"""The daily job: logs to summary document, serving tables and text report.

    spark-submit trolley/plans/daily.py --date 2024-01-01
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley import schemas
from trolley.operators.categories import category_conversion
from trolley.operators.products import product_views
from trolley.operators.summaries import (
    daily_summary_rows,
    product_rows,
    report_for,
    summary_rows,
)
from trolley.operators.users import user_activity, user_segments
from trolley.session import build_session, job_scratch, stage
from trolley.settings import Settings
from trolley.sinks.documents import write_reports, write_summaries
from trolley.sinks.tables import create_tables, days_in, upsert_all
from trolley.sources.event_logs import read_daily_logs, read_event_log, report_day

logger = logging.getLogger(__name__)


class DailyResults(NamedTuple):
    """Summaries and category rows are staged, segments a projection of what is."""

    summaries: DataFrame
    segments: DataFrame
    conversion: DataFrame


def daily_results(events: DataFrame, generated_at: Column | None = None) -> DailyResults:
    """The results of all days in ``events``.

    The activity of all users is the only large intermediate result. It is
    written once and read for the summaries, the samples and the segments. The
    category rows are written too: the document takes them as one array a day, as it
    has to, and the serving table takes the rows.
    """
    activity = stage(user_activity(events), "user-activity")
    conversion = stage(category_conversion(events), "category-conversion")
    summaries = summary_rows(activity, product_views(events), conversion, generated_at)
    return DailyResults(stage(summaries, "summaries"), user_segments(activity), conversion)


def store(
    results: DailyResults,
    root: str,
    now: Column | None = None,
    with_segments: bool = True,
    replace_days: bool = False,
) -> None:
    """Upsert summaries, products, categories and, unless left out, user segments.

    Events without a date belong to no day of the tables; their number is logged and
    the other days are stored. ``replace_days`` drops stored rows of the days
    at hand that have no new one.
    """
    summaries = results.summaries
    dated = F.col("report_date").isNotNull()
    undated = summaries.where(~dated).first()
    if undated:
        logger.warning("%d events without a date are not stored", undated.total_events)
    create_tables(summaries.sparkSession, root)
    batches = {
        schemas.DAILY_SUMMARY: daily_summary_rows(summaries),
        schemas.PRODUCT_PERFORMANCE: product_rows(summaries),
        schemas.CATEGORY_CONVERSION: results.conversion,
    }
    if with_segments:
        batches[schemas.USER_SEGMENTS] = results.segments
    batches = {table: rows.where(dated) for table, rows in batches.items()}
    days = days_in(summaries.where(dated), "report_date")
    upsert_all(batches, root, now, days, replace_days)


def read_logs(
    spark: SparkSession, settings: Settings, days: Sequence[str], by_folder: bool = False
) -> DataFrame:
    """Events of these days from daily files, or from folders a stream has filled.

    Events without a usable time are in the folder of no day; their number is logged.
    """
    root = settings.require("raw_logs_path")
    if not by_folder:
        return read_daily_logs(spark, root, days)
    events = read_event_log(spark, root)
    undated = events.where(F.col("event_date").isNull()).count()
    if undated:
        logger.warning("%d events without a date in %s belong to no day", undated, root)
    wanted = [F.lit(day).cast("date") for day in days]
    return events.where(F.col("event_date").isin(wanted))


def run(
    logs: DataFrame,
    settings: Settings,
    report: Callable[[DataFrame], None] | None = None,
    replace_days: bool = False,
) -> DataFrame:
    """Summarize these events, write what is configured, return the summaries.

    Without events there is nothing to store and the result is empty. The logs
    are text, so they are parsed once into columns and then read with only the
    columns each figure needs. ``report`` is given the summaries before they are
    stored, so a report is there even if storing fails.
    """
    columns = ("user_id", "product_id", "product_category", "event_type")
    events = stage(logs.select(*columns, "event_timestamp", "event_date"), "events")
    results = daily_results(events)
    if settings.output_path:
        write_summaries(results.summaries, f"{settings.output_path}/summaries", pretty=True)
        write_reports(results.summaries, f"{settings.output_path}/reports")
    if report is not None:
        report(results.summaries)
    if settings.tables_path:
        store(results, settings.tables_path, replace_days=replace_days)
    return results.summaries


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--date", help="day to process (default: yesterday)")
    parser.add_argument(
        "--by-folder",
        action="store_true",
        help="the logs are folders event_date=<day>, not daily files",
    )
    parser.add_argument(
        "--replace",
        action="store_true",
        help="drop stored rows of the day that have no new one",
    )
    options = parser.parse_args(arguments)
    day = report_day(options.date)
    settings = Settings.from_env()
    spark = build_session(settings)

    def show(summaries: DataFrame) -> None:
        print(report_for(summaries, day).select("report").first()[0])

    with job_scratch(spark):
        logs = read_logs(spark, settings, [day], options.by_folder)
        run(logs, settings, show, options.replace)


if __name__ == "__main__":
    main()
