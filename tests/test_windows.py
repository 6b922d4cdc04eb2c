import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trolley.operators import windows

UTC = datetime.timezone.utc
KEYS = ("window_start", "window_end", "product_id")


def epoch(value):
    # Spark hands out naive local times; the tests compare seconds.
    return int(value.timestamp())


def collected(stats):
    return {
        tuple(row[:3]): tuple(row[3:])
        for row in stats.select(
            F.unix_seconds("window_start"),
            F.unix_seconds("window_end"),
            "product_id",
            "views",
            "purchases",
            "total_events",
        ).collect()
    }


def counted(events, length, slide):
    """Brute force: every window of every event."""
    found = {}
    for product, kind, second in events:
        start = second // slide * slide
        while start > second - length:
            entry = found.setdefault((start, start + length, product), Counter())
            entry["all"] += 1
            entry[kind] += 1
            start -= slide
    return {
        key: (entry["view"], entry["purchase"], entry["all"])
        for key, entry in found.items()
    }


@pytest.fixture
def many(make_events):
    rng = random.Random(5)
    base = int(datetime.datetime(2024, 1, 1, tzinfo=UTC).timestamp())
    raw = [
        (
            rng.choice(["a", "a", "a", "b", "c"]),
            rng.choice(["view", "view", "purchase", "add_to_cart"]),
            base + rng.randrange(20000),
        )
        for _ in range(1500)
    ]
    events = make_events(
        *[
            ("u", product, None, kind, datetime.datetime.fromtimestamp(s, UTC).isoformat())
            for product, kind, s in raw
        ]
    )
    return raw, events


@pytest.mark.parametrize(
    ("window", "slide", "length", "step"),
    [
        ("10 minutes", "5 minutes", 600, 300),
        ("5 minutes", "5 minutes", 300, 300),
        ("7 minutes", "5 minutes", 420, 300),
        ("1 hour", "10 minutes", 3600, 600),
        ("30 minutes", "90 seconds", 1800, 90),
    ],
)
def test_windows_equal_brute_force(many, window, slide, length, step):
    raw, events = many
    stats = windows.windowed_product_stats(events, window, slide)
    assert collected(stats) == counted(raw, length, step)
    per_window = {
        row[0]: row[1]
        for row in windows.sliding_window_counts(events, window, slide)
        .select(F.unix_seconds("window_start"), "total_events")
        .collect()
    }
    expected = Counter()
    for (start, _, _), (_, _, total) in counted(raw, length, step).items():
        expected[start] += total
    assert per_window == dict(expected)


def test_how_many_windows_an_event_is_in():
    assert windows.windows_per_event("10 minutes", "5 minutes") == 2
    assert windows.windows_per_event("1 day", "1 hour") == 24
    assert windows.windows_per_event("7 minutes", "5 minutes") is None
    assert windows.windows_per_event("1 hour 30 minutes", "5 minutes") is None


@pytest.mark.parametrize("window", ["10 minutes", "1 hour"])
def test_unknown_types_events_without_time_and_without_product(make_events, window):
    time = "2024-01-01T10:01:00"
    events = make_events(
        ("u", "untyped", None, None, time),
        ("u", "mixed", None, None, time),
        ("u", "mixed", None, "view", time),
        ("u", None, None, "purchase", time),
        ("u", "", None, "stare", time),
        ("u", "lost", None, "view", "no time"),
    )
    stats = windows.windowed_product_stats(events, window, "5 minutes")
    found = {key[2]: counts for key, counts in collected(stats).items()}
    assert found == {
        "untyped": (None, None, 1),
        "mixed": (1, 0, 2),
        None: (0, 1, 1),
        "": (0, 0, 1),
    }
    alerts = windows.flash_sale_alerts(stats, 0, 1)
    assert {row.product_id for row in alerts.collect()} == {"mixed"}


def test_both_alert_bounds_are_strict(spark):
    stats = spark.createDataFrame(
        [("a", 100, 4), ("b", 101, 4), ("c", 101, 5), ("d", None, 0)],
        "product_id string, views bigint, purchases bigint",
    ).withColumns({name: F.current_timestamp() for name in ("window_start", "window_end")})
    assert [row.product_id for row in windows.flash_sale_alerts(stats).collect()] == ["b"]
