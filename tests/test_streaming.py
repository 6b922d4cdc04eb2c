import json
import os

import pytest
from pyspark.sql import functions as F

from trolley import schemas
from trolley.operators.windows import windowed_product_stats
from trolley.settings import Settings
from trolley.sinks import tables
from trolley.sinks.event_logs import start_event_log
from trolley.sources.decode import parse_events, with_event_time
from trolley.sources.event_logs import read_event_log
from trolley.sources.serving import read_history, read_rejected_alerts, read_table
from trolley.sources.serving import rejected_path
from trolley.streaming import job, pipeline, queries

NOW = {"availableNow": True}
LOW = Settings(views_threshold=1, purchases_threshold=1)


class Feed:
    """A folder of message files; each call adds one file, one micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        folder.mkdir()

    def add(self, *events):
        lines = [
            event
            if isinstance(event, str)
            else json.dumps(
                dict(zip(("product_id", "event_type", "timestamp"), event), user_id="u")
            )
            for event in events
        ]
        self.files += 1
        path = self.folder / f"{self.files:03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        # Files are taken in the order of their times.
        os.utime(path, (1_700_000_000 + self.files,) * 2)

    def messages(self):
        return (
            self.spark.readStream.option("maxFilesPerTrigger", 1)
            .option("maxFileAge", "10000d")
            .text(str(self.folder))
            .select(F.col("value").cast("binary").alias("value"))
        )

    def events(self):
        return pipeline.events_of(self.messages())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def at(minute, hour=10):
    return f"2024-01-01T{hour:02d}:{minute:02d}:00+00:00"


def in_order(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def start_text(column="window_start"):
    return F.date_format(column, "HH:mm")


def run_history(feed, tmp_path, settings=Settings()):
    path, checkpoint = str(tmp_path / "history"), str(tmp_path / "history-checkpoint")
    query = queries.start_history(
        pipeline.history(feed.events(), settings), settings, path, checkpoint, NOW
    )
    query.awaitTermination()
    return read_history(feed.spark, path), query


def test_history_holds_each_closed_window_once(spark, feed, tmp_path):
    feed.add(("a", "view", at(1)), ("a", "purchase", at(6)), ("b", "view", at(7)))
    feed.add("{", "", ("a", "view", "no time"))
    stats, _ = run_history(feed, tmp_path)
    assert stats.count() == 0
    # The watermark only passes these windows with a later event.
    feed.add(("a", "view", at(59)))
    stats, query = run_history(feed, tmp_path)
    columns = (start_text(), "product_id", "views", "purchases", "total_events")
    expected = [
        ("09:55", "a", 1, 0, 1),
        ("10:00", "a", 1, 1, 2),
        ("10:00", "b", 1, 0, 1),
        ("10:05", "a", 0, 1, 1),
        ("10:05", "b", 1, 0, 1),
    ]
    assert in_order(stats, *columns) == expected
    assert stats.where("processed_at is null").count() == 0
    # A restart from the checkpoint reads nothing twice; late events are dropped.
    feed.add(("a", "view", at(2)))
    stats, query = run_history(feed, tmp_path)
    assert in_order(stats, *columns) == expected
    dropped = [
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    ]
    assert sum(dropped) == 2  # one event, in two windows


def test_history_equals_the_batch_result(spark, feed, tmp_path):
    rows = [
        (f"p{i % 3}", ("view", "purchase", "add_to_cart")[i % 4 % 3], at(i % 50))
        for i in range(120)
    ]
    for start in range(0, 120, 40):
        feed.add(*rows[start : start + 40])
    feed.add(("sentinel", "view", at(0, hour=20)))
    # A delay that covers all of it, and a sentinel after it.
    stats, _ = run_history(feed, tmp_path, Settings(watermark="2 hours"))
    batch = windowed_product_stats(
        with_event_time(parse_events(spark.read.text(str(feed.folder))))
    ).where("product_id <> 'sentinel'")
    columns = (start_text(), "product_id", "views", "purchases", "total_events")
    assert in_order(stats, *columns) == in_order(batch, *columns)


def test_history_needs_a_watermark(feed):
    feed.add(("a", "view", at(1)))
    with pytest.raises(ValueError, match="watermark"):
        pipeline.history(feed.events(), Settings(watermark=None))


@pytest.mark.parametrize("watermark", [None, "10 minutes"])
def test_alerts_come_with_each_change(spark, feed, tmp_path, watermark):
    settings = Settings(views_threshold=1, purchases_threshold=1, watermark=watermark)
    alerts = pipeline.alerts(feed.events(), settings)
    feed.add(("a", "view", at(1)), ("a", "view", at(2)), ("b", "view", at(2)))
    feed.add(("b", "purchase", at(3)), ("b", "view", at(3)))
    feed.add(("a", "view", at(3)))
    feed.add(("a", "purchase", at(4)))
    name = f"alerts_{watermark is None}"
    query = (
        alerts.writeStream.queryName(name)
        .outputMode("update")
        .format("memory")
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    found = in_order(spark.table(name), start_text(), "product_id", "views", "purchases")
    # Two windows each; the purchase takes nothing back and alerts no more.
    assert found == [
        ("09:55", "a", 2, 0),
        ("09:55", "a", 3, 0),
        ("10:00", "a", 2, 0),
        ("10:00", "a", 3, 0),
    ]


def test_alert_table_is_keyed_by_window_and_product(spark, feed, tmp_path):
    root, checkpoint = str(tmp_path / "tables"), str(tmp_path / "alerts-checkpoint")

    def run():
        alerts = pipeline.alerts(feed.events(), LOW)
        query = queries.start_alerts(alerts, LOW, root, checkpoint, NOW)
        query.awaitTermination()
        return read_table(spark, root, schemas.FLASH_SALE_ALERTS)

    no_product = json.dumps({"event_type": "view", "timestamp": at(1)})
    feed.add(("a", "view", at(1)), ("a", "view", at(2)), no_product, no_product)
    first = run()
    columns = (start_text(), "product_id", "views", "purchases")
    assert in_order(first, *columns) == [("09:55", "a", 2, 0), ("10:00", "a", 2, 0)]
    detected = in_order(first, start_text(), "detected_at")
    feed.add(("a", "view", at(2)))
    second = run()
    assert in_order(second, *columns) == [("09:55", "a", 3, 0), ("10:00", "a", 3, 0)]
    assert in_order(second, start_text(), "detected_at") == detected
    rejected = read_rejected_alerts(spark, root)
    assert in_order(rejected, start_text(), "product_id", "views") == [
        ("09:55", None, 2),
        ("10:00", None, 2),
    ]
    # The same batch again, as after a failure, changes nothing.
    expected = in_order(second, *columns)
    queries.store_alerts(second.drop("detected_at", "window_hour"), root, 1)
    again = read_table(spark, root, schemas.FLASH_SALE_ALERTS)
    assert in_order(again, *columns) == expected


def test_rejected_alerts_are_kept_once_per_batch(spark, feed, tmp_path):
    root = str(tmp_path / "tables")
    no_product = json.dumps({"event_type": "view", "timestamp": at(1)})
    for number in range(3):
        feed.add(*[no_product] * 2)
    alerts = pipeline.alerts(feed.events(), LOW)
    query = queries.start_alerts(alerts, LOW, root, str(tmp_path / "cp"), NOW)
    query.awaitTermination()
    newest = read_rejected_alerts(spark, root)
    expected = [("09:55", None, 6), ("10:00", None, 6)]
    assert in_order(newest, start_text(), "product_id", "views") == expected
    every = spark.read.parquet(rejected_path(root))
    assert every.count() == 6
    # The last batch again, as after a failure.
    batch = newest.select("window_start", "window_end", "product_id", "views", "purchases")
    queries.store_alerts(batch, root, 2)
    assert spark.read.parquet(rejected_path(root)).count() == 6


def test_a_trigger_rewrites_the_hours_of_open_windows(spark, tmp_path):
    root = str(tmp_path / "tables")

    def alert(hour):
        return spark.sql(
            f"SELECT TIMESTAMP'2024-01-01 {hour}:00:00' AS window_start, "
            f"TIMESTAMP'2024-01-01 {hour}:10:00' AS window_end, 'p' AS product_id, "
            "3L AS views, 0L AS purchases"
        )

    tables.create_tables(spark, root, [schemas.FLASH_SALE_ALERTS])
    queries.store_alerts(alert("10"), root, 0)
    first = set(read_table(spark, root, schemas.FLASH_SALE_ALERTS).inputFiles())
    queries.store_alerts(alert("11"), root, 1)
    assert first < set(read_table(spark, root, schemas.FLASH_SALE_ALERTS).inputFiles())


def test_history_has_few_files_and_reads_by_day(spark, feed, tmp_path):
    for hour in range(10, 14):
        feed.add(*[(f"p{i}", "view", at(i, hour)) for i in range(40)])
    stats, _ = run_history(feed, tmp_path, Settings(history_files=1))
    files = list((tmp_path / "history").rglob("*.parquet"))
    batches = list((tmp_path / "history").rglob("batch_id=*"))
    day_files = [path for path in files if "batch_id" in str(path)]
    assert batches and len(day_files) == len(batches)
    pruned = stats.where("window_date = DATE'2024-01-02'")
    assert pruned.count() == 0 and stats.count() > 0


def test_state_is_computed_by_all_its_partitions(spark, feed, tmp_path):
    feed.add(*[(f"p{i}", "view", at(i % 30)) for i in range(40)], ("p", "view", at(59)))
    _, query = run_history(feed, tmp_path, Settings(history_files=1))
    partitions = {
        operator.numShufflePartitions
        for progress in query.recentProgress
        for operator in progress.stateOperators
    }
    assert partitions == {int(spark.conf.get("spark.sql.shuffle.partitions"))}
    tasks = [
        int(progress.stateOperators[0].numStateStoreInstances)
        for progress in query.recentProgress
        if progress.stateOperators
    ]
    assert tasks and min(tasks) == max(partitions)


def test_table_and_console_take_one_copy(spark, feed, tmp_path, capsys):
    settings = Settings(views_threshold=1, purchases_threshold=1, alerts_console=True)
    feed.add(("a", "view", at(1)), ("a", "view", at(2)))
    counted = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            counted.add(len(frame))
            yield frame

    messages = feed.messages().mapInPandas(count, "value binary")
    alerts = pipeline.alerts(pipeline.events_of(messages), settings)
    root = str(tmp_path / "tables")
    queries.start_alerts(alerts, settings, root, str(tmp_path / "cp"), NOW).awaitTermination()
    assert "2 changed alerts" in capsys.readouterr().out
    assert read_table(spark, root, schemas.FLASH_SALE_ALERTS).count() == 2
    assert counted.value == 2


def test_alerts_on_the_console(spark, feed, tmp_path, capsys):
    feed.add(("a", "view", at(1)), ("a", "view", at(2)))
    alerts = pipeline.alerts(feed.events(), LOW)
    query = queries.start_alerts(alerts, LOW, None, str(tmp_path / "cp"), NOW)
    query.awaitTermination()
    assert "2 changed alerts" in capsys.readouterr().out


def test_event_log_of_a_stream(spark, feed, tmp_path):
    feed.add(("a", "view", at(1)), ("b", "view", "2024-01-02T10:00:00"))
    path = str(tmp_path / "log")
    query = start_event_log(feed.events(), path, str(tmp_path / "cp"), NOW)
    query.awaitTermination()
    found = read_event_log(spark, path)
    assert in_order(found, "product_id", F.col("event_date").cast("string")) == [
        ("a", "2024-01-01"),
        ("b", "2024-01-02"),
    ]


def test_the_job_starts_one_query(spark, feed, tmp_path):
    feed.add(("a", "view", at(1)), ("a", "view", at(2)))
    feed.add(("a", "view", at(59)))
    settings = Settings(
        views_threshold=1,
        purchases_threshold=1,
        tables_path=str(tmp_path / "tables"),
        history_path=str(tmp_path / "history"),
        alert_trigger="1 second",
    )
    before = len(spark.streams.active)
    query = job.start(spark, feed.messages(), settings, str(tmp_path / "checkpoints"))
    try:
        assert query.name == "windows" and len(spark.streams.active) == before + 1
        query.processAllAvailable()
    finally:
        query.stop()
    alerts = read_table(spark, settings.tables_path, schemas.FLASH_SALE_ALERTS)
    assert in_order(alerts, start_text(), "views") == [("09:55", 2), ("10:00", 2)]
    history = read_history(spark, settings.history_path)
    assert in_order(history, start_text(), "views") == [("09:55", 2), ("10:00", 2)]
