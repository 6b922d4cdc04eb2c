"""Stateful queries in a session that names no state store, as one that was made elsewhere."""

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tests.test_streaming import NOW, Feed, at, in_order, start_text
from trolley.session import STATE_STORE
from trolley.settings import Settings
from trolley.sources.shop_events import EVENT_TABLE
from trolley.streaming import job, state
from trolley.streaming.queries import EMPTY_BATCHES


@pytest.fixture
def plain(spark):
    """The session with Spark's own state store; a query has to leave its settings as they were."""
    named = spark.conf.get(STATE_STORE)
    spark.conf.unset(STATE_STORE)
    before = spark.conf.get(STATE_STORE), spark.conf.get(EMPTY_BATCHES)
    yield spark
    after = spark.conf.get(STATE_STORE), spark.conf.get(EMPTY_BATCHES)
    spark.conf.set(STATE_STORE, named)
    assert after == before and before[0] != named


@pytest.fixture
def tables(plain, tmp_path):
    """A month of events of three products, the last of which is only looked at."""
    types = F.array(*map(F.lit, ("view", "click", "view", "purchase", "view", "error", "signup")))
    number = F.col("id") % 3
    in_turn = F.element_at(types, (F.col("id") % 7 + 1).cast("int"))
    time = F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 6_300_000_001)
    rows = plain.range(400).select(
        F.col("id").alias("event_id"),
        time.cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 11).alias("user_id"),
        F.when(number == 2, "view").otherwise(in_turn).alias("event_type"),
        F.lit(1.5).alias("value"),
        F.format_string('{"k": %d}', number).alias("props"),
    )
    rows.to(EVENT_TABLE).write.parquet(str(tmp_path / "events.parquet"))
    return tmp_path


def found_and_expected(spark, folder, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    cursor = connection.execute(oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    rows = queries()[name](spark, str(folder)).select(*names).collect()
    return sorted(map(repr, map(tuple, rows))), sorted(map(repr, cursor.fetchall()))


def test_alerts_and_closed_windows(plain, tables):
    found, expected = found_and_expected(plain, tables, "stream_windows")
    assert found == expected
    assert {row[:3] for row in found} == {"('a", "('c"}  # alerts and closed windows


def test_a_state_that_ends_by_time(plain, tmp_path):
    feed = Feed(plain, tmp_path / "feed")
    settings = Settings(watermark=None, history_enabled=False, views_threshold=0)
    for minute in (1, 2):  # the second run goes on from the state of the first
        feed.add(("a", "view", at(minute)))
        job.start(plain, feed.messages(), settings, str(tmp_path), NOW).awaitTermination()
    held = state.open_windows(plain, str(tmp_path / "windows"))
    assert in_order(held, start_text(), "product_id", "views") == [("09:55", "a", 2), ("10:00", "a", 2)]
    assert held.where("expires_at IS NULL").count() == 0


def test_open_windows(plain, tables):
    found, expected = found_and_expected(plain, tables, "stream_state_windows")
    assert found == expected and found


def test_figures_of_triggers(plain, tables):
    found, expected = found_and_expected(plain, tables, "stream_trigger_metrics")
    assert found == expected and len(found) > 1
