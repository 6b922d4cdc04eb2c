"""Starting the queries. Each has a name and a checkpoint of its own."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from trolley.operators.constraints import conform, keeps_rules
from trolley.schemas import FLASH_SALE_ALERTS, WINDOWED_STATS
from trolley.session import ROCKSDB_STATE_STORE, STATE_STORE, passing_scratch, written
from trolley.settings import Settings
from trolley.sinks.tables import create_tables, upsert
from trolley.sources.serving import rejected_path
from trolley.streaming import watch

Trigger = dict[str, Any]
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
HEAP_STATE_STORE = "HDFSBackedStateStoreProvider"
WINDOW_COLUMNS = ("window_start", "window_end", "product_id", *watch.COUNTS)
ALERT_COLUMNS = ("window_start", "window_end", "product_id", "views", "purchases")


def _writer(
    df: DataFrame, name: str, mode: str, checkpoint: str | None, trigger: Trigger
) -> DataStreamWriter:
    writer = df.writeStream.queryName(name).outputMode(mode).trigger(**trigger)
    # Without a location of its own a query uses the root of the session.
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer


@contextmanager
def _set(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session in the block; a query that is started there keeps them."""
    before = {name: spark.conf.get(name) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def make_history(spark: SparkSession, path: str) -> None:
    """The folder of the history, so that it can be read before anything is in it."""
    spark.createDataFrame([], WINDOWED_STATS).write.mode("ignore").parquet(path)


def append_history(closed: DataFrame, path: str, number: int, files: int) -> None:
    """Write the windows closed by one batch; a batch that runs again replaces its folders.

    The few closed windows are dealt anew: the state is computed by all its partitions, and
    at most ``files`` tasks write, so there are a few files of each day.
    """
    (
        closed.withColumn("window_date", F.to_date("window_start"))
        .withColumn("batch_id", F.lit(number))
        .repartition(files)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("window_date", "batch_id")
        .parquet(path)
    )


def start_history(
    history: DataFrame,
    settings: Settings,
    path: str,
    checkpoint: str | None = None,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Closed windows as Parquet files, in folders by day and batch.

    ``sources.serving.read_history`` reads them.
    """
    make_history(history.sparkSession, path)

    def store(batch: DataFrame, number: int) -> None:
        append_history(batch, path, number, settings.history_files)

    trigger = trigger or {"processingTime": settings.history_trigger}
    writer = _writer(history, "stats_history", "append", checkpoint, trigger)
    return writer.foreachBatch(store).start()


def _with_hour(rows: DataFrame) -> DataFrame:
    return rows.withColumn("window_hour", F.date_format("window_start", "yyyy-MM-dd-HH"))


def _store(
    rows: DataFrame, root: str, batch_id: int, withdrawn: DataFrame | None = None
) -> None:
    """Merge staged alerts into their table, and take those of ``withdrawn`` windows out."""
    valid = keeps_rules(FLASH_SALE_ALERTS)
    rejected = rows.where(~valid)
    if not rejected.isEmpty():
        rejected.write.mode("overwrite").parquet(f"{rejected_path(root)}/batch_id={batch_id}")
    stored = conform(rows.where(valid), FLASH_SALE_ALERTS)
    upsert(stored, root, FLASH_SALE_ALERTS, removed=withdrawn)


def store_alerts(alerts: DataFrame, root: str, batch_id: int = 0) -> None:
    """Merge alerts into their table; ``detected_at`` stays that of the first.

    The stream knows events without product, the table takes none. Such rows
    must not stop the stream: they are kept next to the table in a folder of their batch,
    which a repeated batch replaces. ``sources.serving.read_rejected_alerts``
    gives the newest of each window.
    """
    with passing_scratch(alerts.sparkSession, "alerts") as path:
        _store(written(_with_hour(alerts), path), root, batch_id)


def show(rows: DataFrame, number: int, most: int, name: str = "changed alerts") -> None:
    """Print the number of staged rows, and the first of them in full width."""
    print(f"batch {number}: {rows.count()} {name}")
    rows.orderBy("window_start", "product_id").show(most, False)


def start_alerts(
    alerts: DataFrame,
    settings: Settings,
    root: str | None = None,
    checkpoint: str | None = None,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Changed alerts into the ``flash_sale_alerts`` table, or onto the console.

    Keyed by window and product: a batch that runs again after a failure, or an
    alert that comes again, changes its row and adds none. Without a table, or if
    the settings ask for it, the first ``console_rows`` of each batch are shown
    in full width, with their number; one query serves both.
    """
    if root:
        create_tables(alerts.sparkSession, root, [FLASH_SALE_ALERTS])
    shown = settings.alerts_console or not root

    def take(batch: DataFrame, number: int) -> None:
        # The state is computed once, by the write; all else reads what it has written.
        with passing_scratch(batch.sparkSession, "alerts") as path:
            rows = written(_with_hour(batch), path)
            if root:
                _store(rows, root, number)
            if shown:
                show(rows.drop("window_hour"), number, settings.console_rows)

    trigger = trigger or {"processingTime": settings.alert_trigger}
    writer = _writer(alerts, "alerts", "update", checkpoint, trigger)
    return writer.foreachBatch(take).start()


def start_windows(
    changes: DataFrame,
    settings: Settings,
    root: str | None = None,
    history_path: str | None = None,
    checkpoint: str | None = None,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Alerts into their table or onto the console, closed windows into the history.

    ``changes`` are those of ``watch.window_changes``. They are computed once in each
    trigger, by the write to the scratch folder, and read from there. An alert that is
    withdrawn leaves the table. A batch that runs again gives the same tables. The state
    is in RocksDB, also in a session with Spark's default store.
    """
    spark = changes.sparkSession
    if root:
        create_tables(spark, root, [FLASH_SALE_ALERTS])
    if history_path:
        make_history(spark, history_path)
    shown = settings.alerts_console or not root

    def take(batch: DataFrame, number: int) -> None:
        with passing_scratch(batch.sparkSession, "windows") as path:
            rows = written(_with_hour(batch), path)
            of_kind = {kind: rows.where(F.col("kind") == kind) for kind in watch.KINDS}
            alerts = of_kind[watch.ALERT].select(*ALERT_COLUMNS, "window_hour")
            withdrawn = of_kind[watch.WITHDRAWN].select(*ALERT_COLUMNS, "window_hour")
            if root:
                _store(alerts, root, number, withdrawn)
            if history_path:
                closed = of_kind[watch.CLOSED].select(*WINDOW_COLUMNS)
                closed = closed.withColumn("processed_at", F.current_timestamp())
                append_history(closed, history_path, number, settings.history_files)
            if shown:
                show(alerts.drop("window_hour"), number, settings.console_rows)
                show(withdrawn.drop("window_hour"), number, settings.console_rows, "withdrawn")

    trigger = trigger or {"processingTime": settings.alert_trigger}
    writer = _writer(changes, "windows", "update", checkpoint, trigger).foreachBatch(take)
    conf = {}
    if spark.conf.get(STATE_STORE).endswith(HEAP_STATE_STORE):
        # The default store of a session knows one kind of state only: no timers beside the
        # counts, no time to live.
        conf[STATE_STORE] = ROCKSDB_STATE_STORE
    if not settings.watermark and {"availableNow", "once"} & {*trigger}:
        # State that ends by time is looked for in empty batches, without end: a query
        # that is to stop by itself must not make any.
        conf[EMPTY_BATCHES] = "false"
    with _set(spark, conf):
        return writer.start()
