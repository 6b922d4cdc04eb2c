import datetime

import pytest
from pyspark.sql import functions as F

from trolley import schemas
from trolley.operators.constraints import constraint_violations
from trolley.operators.merge import merge_upsert
from trolley.plans.daily import daily_results, store
from trolley.sinks import tables
from trolley.sources import serving

TABLE = schemas.PRODUCT_PERFORMANCE
FIRST, SECOND = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


def at(text):
    return F.lit(text).cast("timestamp")


def day(number):
    return datetime.date(2024, 1, number)


@pytest.fixture
def products(spark):
    def make(*rows):
        return spark.createDataFrame(
            list(rows), "report_date date, product_id string, view_count bigint, rank int"
        )

    return make


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tables")


def stored(spark, root, table=TABLE):
    return sorted(
        tuple(row)
        for row in serving.read_table(spark, root, table)
        .select(
            "report_date",
            "product_id",
            "view_count",
            "rank",
            F.date_format("created_at", "dd"),
        )
        .collect()
    )


def load(rows, root, now, **options):
    tables.upsert(tables.staged(rows, TABLE), root, TABLE, at(now), **options)


def test_merge_keeps_updates_and_inserts(spark, products):
    target = products((day(1), "old", 5, 1), (day(1), "both", 4, 2)).withColumn(
        "created_at", at(FIRST)
    )
    source = products((day(1), "both", 9, None), (day(2), "new", 1, 1))
    merged = merge_upsert(target, source, TABLE.key, TABLE.updated, TABLE.stamp, at(SECOND))
    found = {
        row.product_id: (row.report_date, row.view_count, row.rank, row.created_at.day)
        for row in merged.collect()
    }
    assert found == {
        "old": (day(1), 5, 1, 1),
        "both": (day(1), 9, None, 1),
        "new": (day(2), 1, 1, 2),
    }
    assert merged.columns == target.columns


def test_a_key_twice_in_one_batch_is_an_error(spark, products):
    target = products().withColumn("created_at", at(FIRST))
    source = products((day(1), "p", 1, 1), (day(1), "p", 2, 2))
    merged = merge_upsert(target, source, TABLE.key, TABLE.updated, TABLE.stamp)
    with pytest.raises(Exception, match="key comes twice"):
        merged.collect()


def test_upserts_touch_only_the_days_they_bring(spark, products, root):
    tables.create_tables(spark, root, [TABLE])
    assert stored(spark, root) == []
    load(products((day(1), "a", 1, 1), (day(2), "b", 2, 1)), root, FIRST)
    untouched = sorted(
        path for path in serving.read_table(spark, root, TABLE).inputFiles() if "01-01" in path
    )
    second = products((day(2), "b", 7, 2), (day(2), "c", 8, 1), (day(3), "d", 1, 1))
    for _ in range(2):
        load(second, root, SECOND)
        assert stored(spark, root) == [
            (day(1), "a", 1, 1, "01"),
            (day(2), "b", 7, 2, "01"),
            (day(2), "c", 8, 1, "02"),
            (day(3), "d", 1, 1, "02"),
        ]
    assert untouched == sorted(
        path for path in serving.read_table(spark, root, TABLE).inputFiles() if "01-01" in path
    )


def test_replaced_days_lose_rows_without_a_new_one(spark, products, root):
    tables.create_tables(spark, root, [TABLE])
    load(products((day(1), "a", 1, 1), (day(1), "b", 2, 2), (day(2), "c", 1, 1)), root, FIRST)
    load(products((day(1), "b", 3, 1)), root, SECOND, replace_days=True)
    assert stored(spark, root) == [(day(1), "b", 3, 1, "01"), (day(2), "c", 1, 1, "01")]


def test_named_days_without_a_new_row_are_cleared(spark, products, root):
    tables.create_tables(spark, root, [TABLE])
    load(products((day(1), "a", 1, 1), (day(2), "b", 2, 1), (day(3), "c", 1, 1)), root, FIRST)
    new = products((day(2), "d", 3, 1))
    load(new, root, SECOND, days=[day(1), day(2)], replace_days=True)
    assert stored(spark, root) == [(day(2), "d", 3, 1, "02"), (day(3), "c", 1, 1, "01")]
    tables.upsert_all({TABLE: products()}, root, at(SECOND), [day(3)], replace_days=True)
    assert stored(spark, root) == [(day(2), "d", 3, 1, "02")]


def test_all_violations_are_written_and_counted(spark, products, root):
    rows = products(*[(day(1), "p" * 60 + str(i), 1, 1) for i in range(50)])
    with pytest.raises(tables.ConstraintViolation, match="50 violations") as error:
        tables.check(rows, TABLE)
    path = str(error.value).split("all of them in ")[1].split(": ")[0]
    assert spark.read.parquet(path).count() == 50


def test_days_with_many_categories_are_stored(spark, make_events, root):
    many = spark.range(100_000).selectExpr(
        "'u' AS user_id", "'p' AS product_id", "concat('c', id) AS product_category",
        "'view' AS event_type", "TIMESTAMP'2024-01-01 10:00:00' AS event_timestamp",
        "DATE'2024-01-01' AS event_date",
    )
    results = daily_results(many)
    plan = results.conversion._jdf.queryExecution().toString()
    assert "collect_list" not in plan
    store(results, root, at(FIRST))
    assert serving.read_table(spark, root, schemas.CATEGORY_CONVERSION).count() == 100_000


def test_events_without_a_date_are_not_stored(spark, make_events, root, caplog):
    events = make_events(
        ("u", "p", "c", "view", "2024-01-01T10:00:00"), ("u", "p", "c", "view", "soon")
    )
    store(daily_results(events), root, at(FIRST))
    assert serving.read_table(spark, root, schemas.DAILY_SUMMARY).count() == 1
    assert "1 events without a date are not stored" in caplog.text


def test_an_empty_batch_changes_nothing(spark, products, root):
    tables.create_tables(spark, root, [TABLE])
    load(products((day(1), "a", 1, 1)), root, FIRST)
    load(products(), root, SECOND)
    assert stored(spark, root) == [(day(1), "a", 1, 1, "01")]


def test_tables_are_created_once(spark, products, root):
    tables.create_tables(spark, root)
    load(products((day(1), "a", 1, 1)), root, FIRST)
    tables.create_tables(spark, root)
    assert len(stored(spark, root)) == 1
    for table in schemas.SERVING_TABLES:
        found = serving.read_table(spark, root, table)
        assert found.schema == table.columns


def test_tables_in_the_catalog(spark, products, root):
    tables.create_tables(spark, root)
    load(products((day(1), "a", 3, 1)), root, FIRST)
    for _ in range(2):
        tables.register_tables(spark, root, "shop")
    try:
        found = spark.sql(
            "SELECT product_id, view_count FROM shop.product_performance "
            "WHERE report_date = DATE'2024-01-01'"
        )
        assert [tuple(row) for row in found.collect()] == [("a", 3)]
    finally:
        spark.sql("DROP DATABASE shop CASCADE")


def test_broken_rules(spark):
    rows = spark.createDataFrame(
        [
            (day(1), "fine", "buyer"),
            (day(1), "twice", "buyer"),
            (day(1), "twice", "window_shopper"),
            (day(1), "x" * 50, "buyer"),
            (day(1), "y" * 51, "buyer"),
            (day(1), "odd", "visitor"),
            (day(1), "none", None),
            (day(1), None, "buyer"),
            (day(1), None, "buyer"),
            (None, "undated", "buyer"),
        ],
        "report_date date, user_id string, segment string",
    )
    found = sorted(
        (str(row.user_id), row.rule, row.rows)
        for row in constraint_violations(rows, schemas.USER_SEGMENTS).collect()
    )
    assert found == [
        ("None", "user_id is missing", 2),
        ("none", "segment is missing", 1),
        ("odd", "segment is not allowed", 1),
        ("twice", "key is not unique", 2),
        ("undated", "report_date is missing", 1),
        ("y" * 51, "user_id is longer than 50", 1),
    ]


def test_nothing_is_stored_if_any_row_is_invalid(spark, products, root):
    tables.create_tables(spark, root)
    rates = spark.createDataFrame(
        [(day(1), "c", 1, 10, 1000.0)],
        "report_date date, category string, views bigint, purchases bigint, "
        "conversion_rate double",
    )
    batches = {TABLE: products((day(1), "a", 1, 1)), schemas.CATEGORY_CONVERSION: rates}
    with pytest.raises(tables.ConstraintViolation, match="conversion_rate is out of range"):
        tables.upsert_all(batches, root)
    assert stored(spark, root) == []


def test_the_daily_results_are_stored_and_read(spark, sample, root):
    results = daily_results(sample, F.lit("2024-01-02T02:00:00"))
    for _ in range(2):
        store(results, root, at(FIRST))
        summary = serving.summary_by_date(spark, root, "2023-11-07").first().asDict(True)
        assert summary == {
            "date": "2023-11-07",
            "total_events": 10,
            "buyers": {"count": 2},
            "window_shoppers": {"count": 3},
            "buyer_rate": 40.0,
            "generated_at": "2024-01-02 02:00:00",
        }
        trend = serving.conversion_trends(spark, root, as_of="2023-11-14").collect()
        assert [tuple(row) for row in trend] == [
            ("2023-11-07", "unknown", 200.0),
            ("2023-11-07", "light", 20.0),
        ]
        assert serving.read_table(spark, root, schemas.USER_SEGMENTS).count() == 5
        assert [row[1:4] for row in stored(spark, root)] == [
            ("bulb", 2, 2),
            ("lamp", 3, 1),
            ("rug", 1, 3),
        ]
    assert serving.summary_by_date(spark, root, "2024-01-02").count() == 0


def test_trends_include_their_first_day_and_later_ones(spark, root):
    tables.create_tables(spark, root)
    table = schemas.CATEGORY_CONVERSION
    rows = spark.createDataFrame(
        [
            (day(1), "early", 1, 1, 100.0),
            (day(3), "bound", 1, 1, 100.0),
            (day(10), "low", 2, 1, 50.0),
            (day(10), "high", 1, 1, 100.0),
            (day(12), "future", 1, 0, 0.0),
        ],
        "report_date date, category string, views bigint, purchases bigint, "
        "conversion_rate double",
    )
    tables.upsert(tables.staged(rows, table), root, table)
    found = serving.conversion_trends(spark, root, days=7, as_of="2024-01-10")
    assert [row.category for row in found.collect()] == ["future", "high", "low", "bound"]
    # Seen from today, all of it is long ago.
    assert serving.conversion_trends(spark, root).count() == 0


def test_a_missing_rate_reads_as_zero(spark, root):
    tables.create_tables(spark, root)
    table = schemas.DAILY_SUMMARY
    rows = spark.createDataFrame(
        [(day(1), 3, 0, 0, None, None)],
        "report_date date, total_events bigint, buyer_count bigint, "
        "window_shopper_count bigint, buyer_rate double, generated_at timestamp",
    )
    tables.upsert(tables.staged(rows, table), root, table)
    row = serving.summary_by_date(spark, root, "2024-01-01").first()
    assert (row.buyer_rate, row.generated_at) == (0.0, None)


def test_clean_rows_are_not_read_again_for_their_rules(spark, products, root, monkeypatch):
    tables.create_tables(spark, root, [TABLE])

    def never(*_):
        raise AssertionError("read again")

    rows = products((day(1), "a", 1, 1), (day(2), "b", 2, 1))
    with monkeypatch.context() as patched:
        patched.setattr(tables, "check", never)
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("plain", "")
        tables.stage(rows, "plain")
        spark.sparkContext.setJobGroup("checked", "")
        kept = tables.staged(rows, TABLE)
        plain, checked = (len(tracker.getJobIdsForGroup(g)) for g in ("plain", "checked"))
        assert plain == checked
        tables.upsert(kept, root, TABLE, at(FIRST))
        tables.upsert_all({TABLE: rows}, root, at(SECOND))
        with pytest.raises(AssertionError, match="read again"):
            tables.staged(products((day(1), None, 1, 1)), TABLE)
    spark.sparkContext.setJobGroup("", "")
    assert [row[:2] for row in stored(spark, root)] == [(day(1), "a"), (day(2), "b")]


def test_a_key_twice_is_named_and_no_table_is_touched(spark, products, root):
    tables.create_tables(spark, root)
    good = spark.sql(
        "SELECT DATE'2024-01-01' AS report_date, 5L AS total_events, 1L AS buyer_count, "
        "1L AS window_shopper_count, CAST(50 AS DECIMAL(5,2)) AS buyer_rate, "
        "TIMESTAMP'2024-01-02 00:00:00' AS generated_at"
    )
    twice = products((day(1), "p", 1, 1), (day(1), "p", 2, 2))
    with pytest.raises(tables.ConstraintViolation, match="key is not unique"):
        tables.upsert_all({schemas.DAILY_SUMMARY: good, TABLE: twice}, root, at(FIRST))
    assert serving.read_table(spark, root, schemas.DAILY_SUMMARY).count() == 0
    assert stored(spark, root) == []


def test_new_days_are_in_the_catalog_without_a_repair(spark, products, root):
    tables.register_tables(spark, root, "by_day", [TABLE])

    def known():
        return [row[0] for row in spark.sql(f"SHOW PARTITIONS by_day.{TABLE.name}").collect()]

    try:
        load(products((day(1), "a", 1, 1), (day(2), "b", 1, 1)), root, FIRST, database="by_day")
        assert known() == ["report_date=2024-01-01", "report_date=2024-01-02"]
        load(products((day(3), "c", 1, 1)), root, FIRST)
        assert len(known()) == 2  # not told
        tables.upsert_all({TABLE: products((day(2), "d", 2, 2))}, root, database="by_day")
        found = spark.sql(f"SELECT product_id FROM by_day.{TABLE.name} ORDER BY 1").collect()
        assert [row[0] for row in found] == ["a", "b", "d"]
        # A day whose rows have all gone.
        load(products(), root, SECOND, days=[day(1)], replace_days=True, database="by_day")
        assert known() == ["report_date=2024-01-02"]
    finally:
        spark.sql("DROP DATABASE by_day CASCADE")
