"""One query per operator, over the whole ``events`` table.

Results are given in plain types (text, bigint, double), so that another engine
can be compared without regard to its dates, decimals and nested values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.prepare import prepared
from trolley import schemas
from trolley.functions import events as expr
from trolley.functions import rates
from trolley.operators import action_bits, categories, constraints, merge, products, summaries
from trolley.operators import traffic, users, windows
from trolley.operators.ranking import GROUP_LIMIT_SETTING
from trolley.plans.daily import daily_results, store
from trolley.session import scratch_path, stage
from trolley.settings import Settings
from trolley.sinks import bucketed, kafka
from trolley.sinks.documents import read_documents, write_summary_pieces
from trolley.sinks.event_logs import append_event_log, start_event_log
from trolley.sinks.tables import create_tables, staged, upsert
from trolley.sources import decode, serving
from trolley.sources.event_logs import malformed_lines_of, read_daily_logs
from trolley.sources.event_logs import read_event_log
from trolley.sources.shop_events import read_shop_events, stream_shop_events
from trolley.streaming import metrics, pipeline, state, watch
from trolley.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# The first load of a table sees what had arrived by then, the second sees all.
FIRST_LOAD = "2024-01-20 12:00:00"
SECOND_LOAD = "2024-01-31 02:00:00"
UNDATED_DAY = "2024-01-03"
GENERATED_AT = "2024-01-31T02:00:00.000000"
# The data is too thin for the default thresholds and windows.
ALERT_WINDOW, ALERT_SLIDE = "2 days", "1 day"
ALERT_VIEWS, ALERT_PURCHASES = 2, 1

REGISTERED: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTERED[query.__name__] = prepared(query)
    return query


def plain(df: DataFrame) -> DataFrame:
    """Dates, times, arrays and decimals in comparable types."""

    def value(field: T.StructField) -> Column:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.TimestampType):
            return F.date_format(column, TIME_FORMAT)
        if isinstance(kind, T.DateType):
            return column.cast("string")
        if isinstance(kind, T.DecimalType):
            return column.cast("double")
        if isinstance(kind, T.IntegralType):
            return column.cast("bigint")
        if isinstance(kind, T.ArrayType):
            return F.array_join(column, ",")
        return column

    return df.select(*[value(field).alias(field.name) for field in df.schema])


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def arrived_early(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_timestamp") < moment(FIRST_LOAD))


# --- projections ------------------------------------------------------------


def _messages(events: DataFrame, *others: Column) -> DataFrame:
    """Messages as the topic carries them; those of errors are cut off."""
    whole = expr.event_json()
    text = F.when(F.col("event_type") == "error", F.left(whole, F.lit(30))).otherwise(
        whole
    )
    return events.select(text.cast("binary").alias("value"), *others)


@register
def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary JSON messages to columns; malformed ones are rows of NULLs."""
    return plain(decode.parse_events(_messages(read_shop_events(spark, sf_dir))))


@register
def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to time; error events carry no usable text."""
    events = read_shop_events(spark, sf_dir)
    text = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(
        F.col("timestamp")
    )
    fields = events.select(*schemas.EVENT_FIELDS[:-1], text.alias("timestamp"))
    timed = decode.with_event_time(fields)
    return plain(
        timed.select("user_id", "product_id", "event_timestamp", "event_date")
    )


@register
def category_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per category where sign-ups and errors carry none."""
    events = read_shop_events(spark, sf_dir)
    carried = F.when(
        ~F.col("event_type").isin("signup", "error"), F.col("product_category")
    )
    return (
        events.withColumn("product_category", carried)
        .groupBy(expr.category_or_unknown().alias("category"))
        .agg(F.count("*").alias("events"))
    )


@register
def product_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category of product ids in regular and irregular forms."""
    number = F.split("product_id", "_")[1]
    form = (
        F.when(F.col("event_type") == "add_to_cart", F.concat(F.lit("product_-"), number))
        .when(F.col("event_type") == "purchase", F.concat("product_id", F.lit("_x")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("p"), number))
        .when(F.col("event_type") == "error", F.concat(F.lit("product_x"), number))
        .otherwise(F.col("product_id"))
    )
    ids = read_shop_events(spark, sf_dir).select(form.alias("product_id"))
    return (
        ids.groupBy("product_id")
        .agg(F.count("*").alias("events"))
        .withColumn("category", expr.category_of_product())
    )


@register
def buyer_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of buyers of each day, from counted segments."""
    segments = users.user_segments(
        users.user_activity(read_shop_events(spark, sf_dir))
    )
    counted = segments.groupBy("report_date").agg(
        F.count_if(F.col("segment") == schemas.BUYER).alias("buyers"),
        F.count_if(F.col("segment") == schemas.WINDOW_SHOPPER).alias("shoppers"),
    )
    rate = rates.buyer_rate(F.col("buyers"), F.col("shoppers"))
    return plain(counted.withColumn("buyer_rate", rates.rate_decimal(rate)))


@register
def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON value published for each event."""
    return kafka.event_messages(read_shop_events(spark, sf_dir))


# --- users ------------------------------------------------------------------


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.user_activity(read_shop_events(spark, sf_dir))


@register
def user_action_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(users.user_action_sets(read_shop_events(spark, sf_dir)))


@register
def user_action_sets_of_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of types as bits; the dictionary has three, so others overflow."""
    events = read_shop_events(spark, sf_dir)
    dictionary = action_bits.frequent_types(events, 3)
    return plain(action_bits.user_action_sets(events, dictionary))


def _listed_buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buyers of one day, as a filter on the table of all segments."""
    segments = stage(users.user_segments(_activity(spark, sf_dir)), "segments")
    day = F.lit(UNDATED_DAY).cast("date")
    return users.buyers(segments).where(F.col("report_date") == day)


def _per_day_and_type(events: DataFrame) -> DataFrame:
    return plain(
        events.groupBy("event_date", "event_type").agg(F.count("*").alias("events"))
    )


@register
def events_of_buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users on a list: a semi join."""
    listed = _listed_buyers(spark, sf_dir)
    return _per_day_and_type(users.events_of(read_shop_events(spark, sf_dir), listed))


@register
def events_without_buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users that are not on a list: an anti join."""
    listed = _listed_buyers(spark, sf_dir)
    return _per_day_and_type(users.events_without(read_shop_events(spark, sf_dir), listed))


@register
def user_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = users.user_segments(_activity(spark, sf_dir))
    return plain(segments.select("report_date", "user_id", "segment"))


@register
def buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = users.buyers(users.user_segments(_activity(spark, sf_dir)))
    return plain(found.select("report_date", "user_id"))


@register
def window_shoppers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = users.window_shoppers(users.user_segments(_activity(spark, sf_dir)))
    return plain(found.select("report_date", "user_id"))


@register
def segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = users.user_segments(_activity(spark, sf_dir))
    return plain(
        users.segment_rows(users.buyers(segments), users.window_shoppers(segments))
    )


@register
def segment_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        users.segment_samples(users.user_segments(_activity(spark, sf_dir)))
    )


# --- products and categories ------------------------------------------------


VIEWS = (schemas.VIEW,)
VIEWS_AND_PURCHASES = (schemas.VIEW, schemas.PURCHASE)


def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.product_views(read_shop_events(spark, sf_dir, VIEWS))


@register
def product_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_views(spark, sf_dir))


@register
def top_viewed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top five of each day."""
    return plain(products.top_viewed_products(_views(spark, sf_dir)).drop("first_seen"))


def _partly_undated(events: DataFrame) -> DataFrame:
    """Events of which those of one day have lost their time."""
    dated = F.col("event_date") != F.lit(UNDATED_DAY).cast("date")
    return events.withColumns(
        {name: F.when(dated, F.col(name)) for name in ("event_timestamp", "event_date")}
    )


@register
def top_viewed_products_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top forty of each day, and of what has no day; ranked by a sort of all rows."""
    events = _partly_undated(read_shop_events(spark, sf_dir, [schemas.VIEW]))
    limit = spark.conf.get(GROUP_LIMIT_SETTING)
    spark.conf.set(GROUP_LIMIT_SETTING, "10")
    try:
        top = products.top_viewed_products(products.product_views(events), 40)
    finally:
        spark.conf.set(GROUP_LIMIT_SETTING, limit)
    return plain(top.drop("first_seen"))


@register
def summary_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the summaries of the same rows hold."""
    events = _partly_undated(read_shop_events(spark, sf_dir))
    found = daily_results(events, F.lit(GENERATED_AT)).summaries
    sizes = {
        "listed_buyers": F.size("buyers.user_ids"),
        "listed_shoppers": F.size("window_shoppers.user_ids"),
        "listed_products": F.size("top_products"),
        "listed_categories": F.size("categories"),
    }
    return plain(
        found.select(
            "report_date",
            "total_events",
            F.col("buyers.count").alias("buyers"),
            F.col("window_shoppers.count").alias("shoppers"),
            *[size.alias(name) for name, size in sizes.items()],
        )
    )


@register
def product_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank of every product viewed on a day."""
    ranked = products.top_viewed_products(_views(spark, sf_dir), None)
    return plain(ranked.drop("first_seen"))


@register
def category_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_shop_events(spark, sf_dir, VIEWS_AND_PURCHASES)
    conversion = categories.category_conversion(events)
    return plain(conversion.drop("first_seen"))


@register
def category_conversion_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_shop_events(spark, sf_dir, VIEWS_AND_PURCHASES)
    conversion = categories.category_conversion(events)
    return plain(categories.category_conversion_ranked(conversion))


# --- volume and windows -----------------------------------------------------


@register
def event_type_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(traffic.event_type_distribution(read_shop_events(spark, sf_dir)))


@register
def event_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(traffic.event_throughput(read_shop_events(spark, sf_dir)))


@register
def windowed_product_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(windows.windowed_product_stats(read_shop_events(spark, sf_dir)))


@register
def windowed_product_stats_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve windows per event: counted per slide first."""
    events = read_shop_events(spark, sf_dir)
    return plain(windows.windowed_product_stats(events, "1 hour", "5 minutes"))


@register
def sliding_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(windows.sliding_window_counts(read_shop_events(spark, sf_dir)))


@register
def flash_sale_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = windows.windowed_product_stats(
        read_shop_events(spark, sf_dir), ALERT_WINDOW, ALERT_SLIDE
    )
    return plain(windows.flash_sale_alerts(stats, ALERT_VIEWS, ALERT_PURCHASES))


# --- summaries --------------------------------------------------------------


@register
def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(summaries.daily_summary(_activity(spark, sf_dir)))


def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_results(read_shop_events(spark, sf_dir), F.lit(GENERATED_AT)).summaries


@register
def daily_summary_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(summaries.summary_json(_summaries(spark, sf_dir)))


@register
def daily_summary_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written piece by piece and read again, without their blanks."""
    events = read_shop_events(spark, sf_dir)
    conversion = categories.category_conversion(events)
    rows = summaries.summary_rows(
        users.user_activity(events),
        products.product_views(events),
        conversion,
        F.lit(GENERATED_AT),
    )
    path = scratch_path(spark, "summary-pieces")
    write_summary_pieces(rows, conversion, path)
    found = read_documents(spark, path)
    return plain(
        found.select("report_date", F.regexp_replace("document", r"\s+", "").alias("document"))
    )


@register
def daily_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(summaries.report_texts(_summaries(spark, sf_dir)))


# --- serving tables ---------------------------------------------------------


def _product_rows(events: DataFrame) -> DataFrame:
    top = products.top_viewed_products(products.product_views(events))
    return top.select("report_date", "product_id", "view_count", "rank")


def _category_rows(events: DataFrame) -> DataFrame:
    return categories.category_conversion(events)


def _summary_rows(events: DataFrame, generated_at: str) -> DataFrame:
    figures = summaries.daily_summary(users.user_activity(events))
    return figures.withColumn("generated_at", moment(generated_at))


def _segment_rows(events: DataFrame) -> DataFrame:
    return users.user_segments(users.user_activity(events))


@register
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top products of all events merged into those of the early ones."""
    events = read_shop_events(spark, sf_dir, [schemas.VIEW])
    early = _product_rows(arrived_early(events)).withColumn(
        "created_at", moment(FIRST_LOAD)
    )
    table = schemas.PRODUCT_PERFORMANCE
    return plain(
        merge.merge_upsert(
            early,
            _product_rows(events),
            table.key,
            table.updated,
            table.stamp,
            moment(SECOND_LOAD),
        )
    )


def _loaded_twice(
    spark: SparkSession, table: schemas.ServingTable, first: DataFrame, second: DataFrame
) -> DataFrame:
    root = scratch_path(spark, "tables")
    create_tables(spark, root, [table])
    for rows, now in ((first, FIRST_LOAD), (second, SECOND_LOAD)):
        upsert(staged(rows, table), root, table, moment(now))
    return plain(serving.read_table(spark, root, table))


@register
def upsert_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_shop_events(spark, sf_dir)
    return _loaded_twice(
        spark,
        schemas.DAILY_SUMMARY,
        _summary_rows(arrived_early(events), FIRST_LOAD),
        _summary_rows(events, SECOND_LOAD),
    )


@register
def upsert_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_shop_events(spark, sf_dir, [schemas.VIEW])
    return _loaded_twice(
        spark,
        schemas.PRODUCT_PERFORMANCE,
        _product_rows(arrived_early(events)),
        _product_rows(events),
    )


@register
def upsert_category_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_shop_events(spark, sf_dir, VIEWS_AND_PURCHASES)
    return _loaded_twice(
        spark,
        schemas.CATEGORY_CONVERSION,
        _category_rows(arrived_early(events)),
        _category_rows(events),
    )


@register
def upsert_user_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_shop_events(spark, sf_dir)
    return _loaded_twice(
        spark,
        schemas.USER_SEGMENTS,
        _segment_rows(arrived_early(events)),
        _segment_rows(events),
    )


@register
def upsert_segments_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a table by bucket of the user, whose stored rows stay where they are."""
    table = schemas.USER_SEGMENTS
    events = read_shop_events(spark, sf_dir)
    root = scratch_path(spark, "bucketed-tables")
    database = f"checks_{uuid.uuid4().hex}"
    name = bucketed.create_bucketed(spark, root, database, table, 4)
    early, whole = _segment_rows(arrived_early(events)), _segment_rows(events)
    for rows, now in ((early, FIRST_LOAD), (whole, SECOND_LOAD)):
        bucketed.upsert_bucketed(stage(rows, "segments"), name, table, moment(now))
    return plain(spark.table(name))


@register
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment rows made straight from events: repeated, missing, wrong, long."""
    kind = F.col("event_type")
    segment = (
        F.when(kind == "purchase", F.lit(schemas.BUYER))
        .when(kind == "view", F.lit(schemas.WINDOW_SHOPPER))
        .when(kind == "error", F.repeat("user_id", 8))
        .when(kind == "add_to_cart", kind)
    )
    user = F.when(kind == "error", F.repeat("user_id", 8)).otherwise(F.col("user_id"))
    rows = read_shop_events(spark, sf_dir).select(
        F.col("event_date").alias("report_date"),
        user.alias("user_id"),
        segment.alias("segment"),
    )
    return plain(constraints.constraint_violations(rows, schemas.USER_SEGMENTS))


@register
def constraint_violations_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category rows with a rate that may exceed its column."""
    events = read_shop_events(spark, sf_dir, VIEWS_AND_PURCHASES)
    conversion = categories.category_conversion(events)
    product = F.col("views") * F.col("purchases") * 500
    rows = conversion.withColumn("conversion_rate", product.cast("double"))
    return plain(constraints.constraint_violations(rows, schemas.CATEGORY_CONVERSION))


def _stored(spark: SparkSession, sf_dir: str) -> str:
    """All tables filled by the daily job."""
    root = scratch_path(spark, "tables")
    results = daily_results(read_shop_events(spark, sf_dir), F.lit(GENERATED_AT))
    store(results, root, moment(SECOND_LOAD))
    return root


@register
def summary_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = serving.summary_by_date(spark, _stored(spark, sf_dir), "2024-01-15")
    return found.select(
        "date",
        "total_events",
        F.col("buyers.count").alias("buyers"),
        F.col("window_shoppers.count").alias("window_shoppers"),
        "buyer_rate",
        "generated_at",
    )


@register
def conversion_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stored(spark, sf_dir)
    return serving.conversion_trends(spark, root, days=7, as_of="2024-01-30")


@register
def conversion_trends_of_sundays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trends as of every Sunday with events, in one job."""
    table = schemas.CATEGORY_CONVERSION
    root = scratch_path(spark, "trend-tables")
    events = read_shop_events(spark, sf_dir)
    create_tables(spark, root, [table])
    upsert(staged(_category_rows(events), table), root, table, moment(GENERATED_AT))
    dates = events.select(F.col("event_date").alias("as_of")).distinct()
    calendar = stage(dates, "calendar").where(F.dayofweek("as_of") == 1)
    return serving.conversion_trends_as_of(spark, root, calendar, days=7)


# --- logs -------------------------------------------------------------------


@register
def daily_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events appended to the daily logs and read back."""
    path = scratch_path(spark, "event-log")
    append_event_log(read_shop_events(spark, sf_dir), path)
    return plain(read_event_log(spark, path).drop("timestamp"))


def _damaged_log(spark: SparkSession, sf_dir: str) -> str:
    """Daily logs with damaged lines.

    Those of error events are cut off; of the sign-ups some stand twice on a line, some
    have something after them, and some are nothing but a tab.
    """
    path = scratch_path(spark, "event-log")
    events = read_shop_events(spark, sf_dir)
    value, kind = F.col("value"), F.col("event_type")
    part = F.split("product_id", "_")[1].cast("int") % 4
    damaged = (
        F.when(kind == "error", F.left(value, F.lit(30)))
        .when((kind == "signup") & (part == 0), F.concat(value, value))
        .when((kind == "signup") & (part == 1), F.concat(value, F.lit(" junk")))
        .when((kind == "signup") & (part == 2), F.lit("\t"))
        .otherwise(value)
    )
    lines = events.select("*", expr.event_json().alias("value"))
    lines.select(damaged.alias("value"), "event_date").write.partitionBy(
        "event_date"
    ).text(path)
    return path


@register
def daily_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same logs under the names of daily logs, each a folder of parts."""
    root = _damaged_log(spark, sf_dir)
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.globStatus(path(f"{root}/event_date=*")):
        day = status.getPath().getName().split("=")[1]
        store.rename(status.getPath(), path(f"{root}/clickstream_{day}.jsonl"))
    return plain(read_daily_logs(spark, root).drop("timestamp"))


@register
def jsonl_daily_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily logs with malformed lines: the good rows are all there."""
    return plain(read_event_log(spark, _damaged_log(spark, sf_dir)).drop("timestamp"))


@register
def jsonl_malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other lines of the same logs."""
    return plain(malformed_lines_of(spark, _damaged_log(spark, sf_dir)))


# --- streaming --------------------------------------------------------------

ALL_NOW = {"availableNow": True}


@register
def stream_stats_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows closed by the watermark, appended to Parquet by a stream."""
    settings = Settings()
    path = scratch_path(spark, "history")
    rows = pipeline.history(stream_shop_events(spark, sf_dir), settings)
    query = streams.start_history(
        rows, settings, path, scratch_path(spark, "checkpoint"), ALL_NOW
    )
    query.awaitTermination()
    found = serving.read_history(spark, path)
    return plain(found.drop("processed_at", "window_date"))


@register
def stream_flash_sale_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts merged into their table by a stream."""
    settings = Settings(
        window=ALERT_WINDOW,
        slide=ALERT_SLIDE,
        views_threshold=ALERT_VIEWS,
        purchases_threshold=ALERT_PURCHASES,
    )
    root = scratch_path(spark, "tables")
    alerts = pipeline.alerts(stream_shop_events(spark, sf_dir), settings)
    query = streams.start_alerts(
        alerts, settings, root, scratch_path(spark, "checkpoint"), ALL_NOW
    )
    query.awaitTermination()
    found = serving.read_table(spark, root, schemas.FLASH_SALE_ALERTS)
    return plain(found.drop("detected_at", "window_hour"))


def _watched(
    spark: SparkSession, settings: Settings, events: DataFrame, checkpoint: str
) -> None:
    """The job over a bounded stream until nothing is left."""
    changes = watch.window_changes(
        events,
        settings.window,
        settings.slide,
        settings.watermark,
        settings.state_ttl,
        settings.views_threshold,
        settings.purchases_threshold,
    )
    query = streams.start_windows(
        metrics.observe_windows(changes),
        settings,
        settings.tables_path,
        settings.history_path,
        checkpoint,
        ALL_NOW,
    )
    query.awaitTermination()


def _alert_settings(spark: SparkSession, **values) -> Settings:
    return Settings(
        window=ALERT_WINDOW,
        slide=ALERT_SLIDE,
        views_threshold=ALERT_VIEWS,
        purchases_threshold=ALERT_PURCHASES,
        tables_path=scratch_path(spark, "watched-tables"),
        **values,
    )


@register
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts in their table and closed windows in the history, from one read and one state."""
    settings = _alert_settings(spark, history_path=scratch_path(spark, "watched-history"))
    checkpoint = scratch_path(spark, "windows-checkpoint")
    _watched(spark, settings, stream_shop_events(spark, sf_dir), checkpoint)
    key = ("window_start", "window_end", "product_id", "views", "purchases")
    alerts = serving.read_table(spark, settings.tables_path, schemas.FLASH_SALE_ALERTS)
    closed = serving.read_history(spark, settings.history_path)
    # An alert has no number of all events; 0 stands for it.
    return plain(
        alerts.select(F.lit("alert").alias("kind"), *key, F.lit(0).alias("total_events")).unionAll(
            closed.select(F.lit("closed").alias("kind"), *key, "total_events")
        )
    )


@register
def stream_state_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that a stopped stream holds, read from the state in its checkpoint."""
    settings = _alert_settings(spark, history_path=scratch_path(spark, "watched-history"))
    checkpoint = scratch_path(spark, "state-checkpoint")
    _watched(spark, settings, stream_shop_events(spark, sf_dir), checkpoint)
    return plain(state.open_windows(spark, checkpoint).drop("alerted", "expires_at"))


@register
def stream_trigger_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and malformed messages of each trigger, as a listener has written them.

    The messages come in folders of ten days; the job runs once for each, and goes on from
    its checkpoint.
    """
    events = read_shop_events(spark, sf_dir)
    written, folder = scratch_path(spark, "thirds"), scratch_path(spark, "messages")
    third = F.floor((F.dayofmonth("event_date") - 1) / 10).alias("third")
    # The date is no part of a message; it only deals the rows to folders.
    _messages(events, third).write.partitionBy("third").parquet(written)
    kept = schemas.struct(value=T.BinaryType(), third=T.IntegerType())
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path(folder))
    settings = _alert_settings(spark, watermark="60 days")
    checkpoint = scratch_path(spark, "metrics-checkpoint")
    figures = scratch_path(spark, "trigger-metrics")
    listener = metrics.TriggerMetrics(spark, figures)
    spark.streams.addListener(listener)
    try:
        for status in store.globStatus(path(f"{written}/third=*")):
            arrived = status.getPath()
            store.rename(arrived, path(f"{folder}/{arrived.getName()}"))
            messages = spark.readStream.schema(kept).parquet(folder)
            observed = metrics.observe_events(pipeline.events_of(messages))
            _watched(spark, settings, observed, checkpoint)
        # Progress comes a moment after the query has ended.
        spark._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
        listener.flush()
    found = metrics.read_metrics(spark, figures).where("events > 0")
    return found.select("events", "malformed", "undated", "late_events", "newest_event")


@register
def stream_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily logs written by a stream."""
    path = scratch_path(spark, "event-log")
    query = start_event_log(
        stream_shop_events(spark, sf_dir),
        path,
        scratch_path(spark, "checkpoint"),
        ALL_NOW,
    )
    query.awaitTermination()
    return plain(read_event_log(spark, path).drop("timestamp"))
