"""A third of all rows share one user, product, category and window."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trolley.operators import categories, products, summaries, users, windows
from trolley.operators.constraints import constraint_violations
from trolley import schemas

ROWS = 30_000


@pytest.fixture(scope="module")
def raw():
    rng = random.Random(11)
    kinds = ("view", "view", "view", "add_to_cart", "purchase")
    rows = []
    for i in range(ROWS):
        second = rng.randrange(2 * 86400)
        if i % 3 == 0:
            user, product, second = "hot", "product_8", 36_000 + second % 300
        else:
            user, product = f"u{rng.randrange(2000)}", f"product_{rng.randrange(5000)}"
        rows.append((user, product, f"c{int(product[8:]) % 8}", rng.choice(kinds), second))
    return rows


@pytest.fixture(scope="module")
def skewed(spark, raw):
    start = F.unix_timestamp(F.lit("2024-01-01 00:00:00"))
    df = spark.createDataFrame(
        raw, "user_id string, product_id string, product_category string, "
        "event_type string, second bigint",
    ).repartition(8)
    time = F.timestamp_seconds(start + F.col("second"))
    return df.withColumn("event_timestamp", time).withColumn(
        "event_date", F.to_date("event_timestamp")
    ).cache()


def day(second):
    return 1 + second // 86400


def test_segments_and_totals(skewed, raw):
    activity = users.user_activity(skewed)
    bought = {(day(s), u) for u, _, _, kind, s in raw if kind == "purchase"}
    seen = {(day(s), u) for u, _, _, _, s in raw}
    found = {
        (row.report_date.day, row.user_id): row.segment
        for row in users.user_segments(activity).collect()
    }
    assert found == {
        key: "buyer" if key in bought else "window_shopper" for key in seen
    }
    totals = Counter(day(s) for *_, s in raw)
    for row in summaries.daily_summary(activity).collect():
        assert row.total_events == totals[row.report_date.day]


def test_full_ranking_of_products(skewed, raw):
    counts, first = Counter(), {}
    for _, product, _, kind, second in raw:
        if kind == "view":
            key = (day(second), product)
            counts[key] += 1
            first[key] = min(first.get(key, second), second)
    expected = {}
    for number in (1, 2):
        keys = [key for key in counts if key[0] == number]
        keys.sort(key=lambda key: (-counts[key], first[key], key[1]))
        expected.update({key: (counts[key], i) for i, key in enumerate(keys, 1)})
    views = products.product_views(skewed)
    for n in (None, 1500, 7):
        found = {
            (row.report_date.day, row.product_id): (row.view_count, row.rank)
            for row in products.top_viewed_products(views, n).collect()
        }
        assert found == {
            key: value for key, value in expected.items() if n is None or value[1] <= n
        }


def test_conversion(skewed, raw):
    counts = Counter((day(s), category, kind) for _, _, category, kind, s in raw)
    for row in categories.category_conversion(skewed).collect():
        key = (row.report_date.day, row.category)
        views, bought = counts[*key, "view"], counts[*key, "purchase"]
        assert (row.views, row.purchases) == (views, bought)
        assert row.conversion_rate == round(bought / views * 100, 2)


@pytest.mark.parametrize("window", ["10 minutes", "1 hour"])
def test_hot_window(skewed, raw, window):
    stats = windows.windowed_product_stats(skewed, window, "5 minutes")
    hottest = stats.orderBy(F.desc("total_events")).first()
    expected = Counter(kind for _, p, _, kind, s in raw if p == "product_8" and 36_000 <= s < 36_300)
    assert hottest.product_id == "product_8"
    assert hottest.total_events >= sum(expected.values()) >= ROWS // 3
    overlap = windows.windows_per_event(window, "5 minutes")
    assert stats.agg(F.sum("total_events")).first()[0] == overlap * ROWS


def test_repeated_keys(skewed, raw):
    rows = skewed.select(
        F.col("event_date").alias("report_date"), "user_id", F.lit("buyer").alias("segment")
    )
    found = {
        (row.report_date.day, row.user_id): row.rows
        for row in constraint_violations(rows, schemas.USER_SEGMENTS).collect()
    }
    counts = Counter((day(s), u) for u, *_, s in raw)
    assert found == {key: n for key, n in counts.items() if n > 1}
