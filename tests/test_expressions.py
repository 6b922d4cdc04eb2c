import random

import pytest
from pyspark.sql import functions as F

from trolley.functions import events as expr
from trolley.functions import rates


# The categories, in the order the product number selects them.
CATEGORIES = (
    "smartphones",
    "laptops",
    "tablets",
    "headphones",
    "smartwatches",
    "cameras",
    "gaming",
    "accessories",
)


def category(number):
    return CATEGORIES[number % len(CATEGORIES)]


@pytest.mark.parametrize(
    ("product_id", "expected"),
    [
        ("product_0", category(0)),
        ("product_1", category(1)),
        ("product_100", category(100)),
        ("product_-3", category(-3)),
        ("product_+4", category(4)),
        ("product_7_x", category(7)),
        ("other_9", category(9)),
        ("p", "accessories"),
        ("", "accessories"),
        ("product_", "accessories"),
        ("product_x", "accessories"),
        ("product_7.5", "accessories"),
        ("product_99999999999999999999", "accessories"),
        (None, "accessories"),
    ],
)
def test_category_of_product(spark, product_id, expected):
    row = spark.createDataFrame([(product_id,)], "product_id string")
    assert row.select(expr.category_of_product()).first()[0] == expected


def test_rates_round_as_python_does(spark):
    rng = random.Random(3)
    # The first denominators give exact and near ties in the third decimal.
    pairs = [
        (p, v)
        for v in (32, 160, 800, 4000, 20000, 100000)
        for p in [*range(0, 300), *rng.sample(range(300, 2 * v + 600), 200)]
    ]
    pairs += [(rng.randrange(10**9), rng.randrange(1, 10**9)) for _ in range(5000)]
    pairs += [(p, v) for v in range(60) for p in range(2 * v + 2)]
    df = spark.createDataFrame(pairs, "purchases bigint, views bigint")
    rate = rates.conversion_rate(F.col("views"), F.col("purchases"))
    for row in df.withColumn("rate", rate).collect():
        exact = row.purchases / row.views * 100 if row.views > 0 else 0.0
        assert row.rate == round(exact, 2), row


def test_rate_decimal_is_null_beyond_its_column(spark):
    df = spark.createDataFrame([(999.99,), (999.995,), (1000.0,)], "x double")
    found = [row[0] for row in df.select(rates.rate_decimal(F.col("x"))).collect()]
    assert [None if x is None else str(x) for x in found] == ["999.99", None, None]


def test_event_time(spark):
    texts = [
        ("2024-01-01T10:00:00", "2024-01-01 10:00:00"),
        ("2024-01-01T10:00:00.123456+00:00", "2024-01-01 10:00:00.123456"),
        ("2024-01-01T10:00:00+02:00", "2024-01-01 08:00:00"),
        ("yesterday", None),
        ("", None),
        (None, None),
    ]
    df = spark.createDataFrame(texts, "timestamp string, expected string")
    for row in df.withColumn("found", expr.event_time().cast("string")).collect():
        assert row.found == row.expected


def test_missing_category_is_unknown_and_an_empty_one_stays(spark):
    df = spark.createDataFrame([(None,), ("",), ("tablets",)], "product_category string")
    found = [row[0] for row in df.select(expr.category_or_unknown()).collect()]
    assert found == ["unknown", "", "tablets"]


def test_event_json_keeps_missing_fields(sample):
    text = sample.orderBy(F.desc("event_timestamp")).select(expr.event_json()).first()[0]
    assert text == (
        '{"user_id":"cid","product_id":"rug","product_category":null,'
        '"event_type":"purchase","timestamp":"2023-11-07T11:40:00"}'
    )
