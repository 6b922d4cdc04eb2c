"""The one stateful processor: alerts, withdrawals, closed and late windows, its state, figures."""

import time

import pytest
from pyspark.sql import functions as F

from trolley import schemas
from trolley.operators.windows import flash_sale_alerts, windowed_product_stats
from trolley.settings import Settings
from trolley.sources.decode import parse_events, with_event_time
from trolley.sources.serving import read_history, read_table
from trolley.streaming import job, metrics, pipeline, queries, state, watch
from tests.test_streaming import LOW, NOW, Feed, at, in_order, start_text



def columns():
    return start_text(), "product_id", "views", "purchases", "total_events"


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def settings_at(tmp_path, **values):
    return Settings(
        **{
            "views_threshold": 1,
            "purchases_threshold": 1,
            "tables_path": str(tmp_path / "tables"),
            "history_path": str(tmp_path / "history"),
            **values,
        }
    )


def run_job(feed, tmp_path, **values):
    """The job until nothing is left: the stored alerts, the history and the query."""
    settings = settings_at(tmp_path, **values)
    query = job.start(feed.spark, feed.messages(), settings, str(tmp_path / "cp"), NOW)
    query.awaitTermination()
    alerts = read_table(feed.spark, settings.tables_path, schemas.FLASH_SALE_ALERTS)
    return alerts, read_history(feed.spark, settings.history_path), query


def batch_events(feed):
    return with_event_time(parse_events(feed.spark.read.text(str(feed.folder))))


def test_same_rows_as_the_two_queries(spark, feed, tmp_path):
    kinds = ("view", "view", "purchase", "add_to_cart", None)
    for start in range(0, 90, 30):
        feed.add(
            *[
                (("a", "b", None, "")[i % 4], kinds[i * 7 % 5], at(i % 55, 10 + i // 60))
                for i in range(start, start + 30)
            ],
            "{",
        )
    feed.add(("later", "view", at(0, 20)))
    settings = settings_at(tmp_path, watermark="3 hours")
    alerts, history, query = run_job(feed, tmp_path, watermark="3 hours")
    assert len({p.batchId for p in query.recentProgress}) >= 4

    own = tmp_path / "own"
    queries.start_history(
        pipeline.history(feed.events(), settings), settings, str(own / "h"), str(own / "hc"), NOW
    ).awaitTermination()
    queries.start_alerts(
        pipeline.alerts(feed.events(), settings), settings, str(own / "t"), str(own / "tc"), NOW
    ).awaitTermination()
    closed = [tuple(row) for row in history.select(*columns()).collect()]
    assert sorted(map(str, closed)) == sorted(
        str(tuple(row)) for row in read_history(spark, str(own / "h")).select(*columns()).collect()
    )
    assert len(closed) > 50 and any(row[2] is None for row in closed)
    # Alerts are those of the whole: the two queries leave the withdrawn ones in the table.
    whole = flash_sale_alerts(windowed_product_stats(batch_events(feed)), 1, 1)
    names = (start_text(), "product_id", "views", "purchases")
    expected = in_order(whole.where("product_id IS NOT NULL"), *names)
    assert in_order(alerts, *names) == expected
    kept = read_table(spark, str(own / "t"), schemas.FLASH_SALE_ALERTS)
    assert set(expected) <= set(in_order(kept, *names))
    assert len(expected) < kept.count()


def test_an_alert_is_withdrawn_by_purchases(spark, feed, tmp_path):
    names = (start_text(), "product_id", "views", "purchases")
    feed.add(("a", "view", at(1)), ("a", "view", at(2)), ("b", "view", at(31)), ("b", "view", at(31)))
    alerts, _, _ = run_job(feed, tmp_path)
    stamps = {tuple(r) for r in alerts.select("product_id", "window_start", "detected_at").collect()}
    assert in_order(alerts, *names) == [
        ("09:55", "a", 2, 0), ("10:00", "a", 2, 0), ("10:25", "b", 2, 0), ("10:30", "b", 2, 0)
    ]
    feed.add(("a", "purchase", at(31)), ("a", "purchase", at(32)), ("b", "view", at(32)))
    feed.add(("b", "purchase", at(26)))
    alerts, _, _ = run_job(feed, tmp_path)
    assert in_order(alerts, *names) == [
        ("09:55", "a", 2, 0), ("10:00", "a", 2, 0), ("10:30", "b", 3, 0)
    ]
    same = {tuple(r) for r in alerts.select("product_id", "window_start", "detected_at").collect()}
    assert same <= stamps
    # Without its last alert an hour has no folder.
    queries._store(
        queries._with_hour(alerts.limit(0).select(*queries.ALERT_COLUMNS)),
        str(tmp_path / "tables"),
        9,
        queries._with_hour(alerts.where("hour(window_start) = 9").select(*queries.ALERT_COLUMNS)),
    )
    left = read_table(spark, str(tmp_path / "tables"), schemas.FLASH_SALE_ALERTS)
    assert in_order(left, *names) == [("10:00", "a", 2, 0), ("10:30", "b", 3, 0)]
    assert not list((tmp_path / "tables").rglob("window_hour=2024-01-01-09"))


def test_restarts_and_late_events(spark, feed, tmp_path):
    feed.add(("a", "view", at(1)), ("a", "view", at(2)))
    _, history, _ = run_job(feed, tmp_path)
    assert history.count() == 0
    feed.add(("a", "view", at(59)))
    _, history, _ = run_job(feed, tmp_path)
    expected = [("09:55", "a", 2, 0, 2), ("10:00", "a", 2, 0, 2)]
    assert in_order(history, *columns()) == expected
    feed.add(("a", "view", at(3)), ("a", "view", at(3)), ("a", "view", at(58)))
    alerts, history, query = run_job(feed, tmp_path)
    assert in_order(history, *columns()) == expected  # closed windows stay as they were
    late = [p.observedMetrics[metrics.WINDOWS]["late_events"] for p in query.recentProgress]
    assert sum(late) == 4  # two events, in two closed windows each
    assert in_order(alerts, start_text(), "views") == [
        ("09:55", 2), ("10:00", 2), ("10:50", 2), ("10:55", 2)
    ]


def test_idle_windows_leave_a_state_without_watermark(spark, feed, tmp_path):
    values = {"watermark": None, "history_enabled": False, "state_ttl": "4 seconds"}
    feed.add(("a", "view", at(1)), ("b", "view", at(1)))

    def run():
        settings = settings_at(tmp_path, **values)
        query = job.start(spark, feed.messages(), settings, str(tmp_path / "cp"), NOW)
        query.awaitTermination()
        return state.open_windows(spark, str(tmp_path / "cp" / "windows"))

    held = run()
    assert in_order(held, start_text(), "product_id", "views") == [
        ("09:55", "a", 1), ("09:55", "b", 1), ("10:00", "a", 1), ("10:00", "b", 1)
    ]
    assert held.where("expires_at IS NULL").count() == 0
    time.sleep(5)
    feed.add(("c", "view", at(1, 12)))
    held = run()
    # One batch finds the old windows ended, and takes them out of the store.
    assert in_order(held, start_text(), "product_id") == [("11:55", "c"), ("12:00", "c")]
    operators = state.state_operators(spark, str(tmp_path / "cp" / "windows"))
    assert operators.select("numPartitions").distinct().count() == 1


def test_the_job_needs_an_end_of_its_state(feed, tmp_path):
    with pytest.raises(ValueError, match="watermark"):
        job.start(feed.spark, feed.messages(), settings_at(tmp_path, watermark=None))
    with pytest.raises(ValueError, match="time to live"):
        watch.window_changes(feed.events(), "10 minutes", "5 minutes", None, None)
    with pytest.raises(ValueError, match="duration"):
        watch.milliseconds("-1 day")


def test_open_windows_are_the_rest_of_the_batch_result(spark, feed, tmp_path):
    for k in range(3):
        feed.add(*[(f"p{i % 4}", ("view", "purchase")[i % 2], at(20 * k + i)) for i in range(15)])
    _, history, query = run_job(feed, tmp_path)
    held = state.open_windows(spark, str(tmp_path / "cp" / "windows"))
    names = ("window_start", "window_end", *columns()[1:])
    every = in_order(windowed_product_stats(batch_events(feed)), *names)
    assert sorted(in_order(held, *names) + in_order(history, *names)) == every
    # Newest event 10:54, delay of ten minutes.
    assert min(in_order(held, F.date_format("window_end", "HH:mm"))) == ("10:45",)
    assert held.where("expires_at IS NOT NULL").count() == 0
    first = state.open_windows(spark, str(tmp_path / "cp" / "windows"), 0)
    assert first.agg(F.max("window_start")).first()[0].minute == 10


def test_figures_of_each_trigger(spark, feed, tmp_path):
    path = str(tmp_path / "figures")
    listener = metrics.TriggerMetrics(spark, path, every=2)
    spark.streams.addListener(listener)
    try:
        feed.add(("a", "view", at(1)), ("a", "view", at(2)), "{", "no json", ("b", "view", "never"))
        feed.add(("a", "view", at(59)))
        # A window that nothing is held of, behind the watermark.
        feed.add(("z", "view", at(3)), ("a", "purchase", at(58)), ("a", "view", at(58)))
        _, _, query = run_job(feed, tmp_path)
        deadline = time.time() + 20
        wanted = len(query.recentProgress)
        while metrics.read_metrics(spark, path).count() < wanted and time.time() < deadline:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    listener.flush()
    found = metrics.read_metrics(spark, path).where("events > 0").orderBy("batch_id")
    rows = [
        (r.query, r.events, r.input_rows, r.malformed, r.undated, r.late_events, r.alerts,
         (r.newest_event or "")[11:16])
        for r in found.collect()
    ]
    assert rows == [
        ("windows", 5, 5, 2, 3, 0, 2, "10:02"),
        ("windows", 1, 1, 0, 0, 0, 0, "10:59"),
        ("windows", 3, 3, 0, 0, 2, 0, "10:58"),
    ]
    assert found.where("events_per_second <= 0 OR duration_ms <= 0").count() == 0
    assert metrics.read_metrics(spark, path).agg(F.sum("closed")).first()[0] == 2


def test_partial_counts_of_a_hot_product(spark):
    rows = 50_000
    events = spark.range(rows, numPartitions=4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('p', id % 50) END AS product_id",
        "CASE WHEN id % 5 = 0 THEN NULL ELSE 'view' END AS event_type",
        "TIMESTAMP'2024-01-01 10:01:00' AS event_timestamp",
    )
    partial = watch.partial_counts(events, "10 minutes", "5 minutes")
    assert partial.agg(F.sum("total_events")).first()[0] == 2 * rows
    assert partial.agg(F.sum("views")).first()[0] == 2 * rows * 4 // 5
    # A row for each Arrow batch and window, whatever the number of events.
    assert partial.where("product_id = 'hot'").count() <= 2 * 4 * (2 * rows // 4 // 10_000 + 1)


def test_counts_are_null_only_without_types():
    assert watch.added(None, None) is None
    assert watch.added(None, 3) == 3 and watch.added(2, None) == 2 and watch.added(2, 3) == 5
