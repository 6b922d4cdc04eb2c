"""What the plans of the queries must and must not contain."""

import datetime
import re

import pytest

from checks.queries import REGISTERED
from conftest import TESTDATA
from trolley.operators.merge import merge_upsert
from trolley.operators import action_bits, users
from trolley.schemas import CATEGORY_CONVERSION, PRODUCT_PERFORMANCE
from trolley.session import BLOOM_FILTER
from trolley.sinks.tables import create_tables, staged, upsert
from trolley.sources.serving import conversion_trends_as_of, read_table
from trolley.sources.shop_events import read_shop_events

SF = str(TESTDATA / "sf0.001")
# These run jobs while they are built; the others only describe a result.
BUILT_BY_JOBS = {
    name
    for name in REGISTERED
    if name.startswith(("upsert_", "stream_", "jsonl_", "daily_summary_doc", "daily_report"))
} | {
    "summary_by_date",
    "conversion_trends",
    "conversion_trends_of_sundays",
    "daily_summary_pieces",
    "daily_event_log",
    "daily_files_scan",
    "product_rank",
    "summary_undated",
    "top_viewed_products_undated",
}


def plan_of(spark, name):
    df = REGISTERED[name](spark, SF)
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", sorted(set(REGISTERED) - BUILT_BY_JOBS))
def test_no_plan_crosses_or_leaves_the_jvm(spark, name):
    plan = plan_of(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow", "MapInPandas"):
        assert operator not in plan


@pytest.mark.parametrize(
    ("name", "columns", "pushed"),
    [
        ("category_conversion", "ts event_type props", "In(event_type, [purchase,view])"),
        ("product_view_counts", "ts event_type props", "EqualTo(event_type,view)"),
        ("user_segments", "ts user_id event_type", None),
        ("event_type_distribution", "event_type", None),
        ("merge_upsert", "ts event_type props", "EqualTo(event_type,view)"),
        ("sliding_window_counts", "ts", "IsNotNull(ts)"),
        ("windowed_product_stats", "ts event_type props", "IsNotNull(ts)"),
    ],
)
def test_scans_read_what_is_needed(spark, name, columns, pushed):
    plan = plan_of(spark, name)
    read = re.search(r"ReadSchema: struct<(.*)>", plan)[1]
    assert re.findall(r"(\w+):", read) == columns.split()
    if pushed:
        assert pushed in plan


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("category_conversion", 1),
        ("user_segments", 1),
        ("product_view_counts", 1),
        ("windowed_product_stats", 1),
        ("flash_sale_alerts", 1),
        ("constraint_violations", 1),
        ("daily_summary", 2),
        ("top_viewed_products", 2),
        ("segment_samples", 2),
    ],
)
def test_number_of_shuffles(spark, name, shuffles):
    assert len(re.findall(r"^\(\d+\) Exchange", plan_of(spark, name), re.M)) == shuffles


@pytest.mark.parametrize("name", ["top_viewed_products", "segment_samples"])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert len(re.findall(r"^\(\d+\) WindowGroupLimit", plan, re.M)) == 2


def test_a_merge_shuffles_each_side_once(spark, tmp_path):
    table = PRODUCT_PERFORMANCE
    create_tables(spark, str(tmp_path), [table])
    first = spark.createDataFrame(
        [(datetime.date(2024, 1, day), "p", 1, 1) for day in (1, 2, 3)],
        "report_date date, product_id string, view_count bigint, rank int",
    )
    upsert(staged(first, table), str(tmp_path), table)
    stored = read_table(spark, str(tmp_path), table)
    first_days = stored.where("report_date IN (DATE'2024-01-01', DATE'2024-01-02')")
    rows = stored.drop("created_at")
    merged = merge_upsert(first_days, rows, table.key, table.updated, table.stamp)
    plan = merged._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 2
    assert "SortAggregate" not in plan
    assert len(re.findall(r"^\(\d+\) Sort\b", plan, re.M)) == 2
    assert "PartitionFilters: [report_date" in plan and " IN (2024-01-01,2024-01-02)" in plan


def optimized(spark, df):
    # Filters that are made while optimizing are in this form of the plan.
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_list_of_users_filters_the_scan(spark, tmp_path):
    users_path, events_path = str(tmp_path / "users"), str(tmp_path / "events")
    spark.range(2000).selectExpr(
        "concat('user_', id) AS user_id", "id % 7 AS kind"
    ).write.parquet(users_path)
    spark.range(50_000).selectExpr(
        "concat('user_', id % 5000) AS user_id", "id"
    ).write.parquet(events_path)
    settings = {
        f"{BLOOM_FILTER}.applicationSideScanSizeThreshold": "1KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        events = spark.read.parquet(events_path)
        listed = spark.read.parquet(users_path).where("kind = 3")
        kept = users.events_of(events, listed)
        plan = optimized(spark, kept)
        scan = plan.index("might_contain")
        assert plan.index("LeftSemi") < scan
        wanted = {f"user_{i}" for i in range(2000) if i % 7 == 3}
        assert {row[0] for row in kept.select("user_id").distinct().collect()} == wanted
        rest = users.events_without(events, listed)
        assert "LeftAnti" in optimized(spark, rest)
        assert kept.count() + rest.count() == 50_000
        assert rest.join(listed, "user_id").count() == 0
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_events_without_a_user_are_on_no_list(spark):
    events = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "user_id string, n int")
    listed = spark.createDataFrame([("a", 1), (None, 1), ("a", 2)], "user_id string, n int")
    assert [r.n for r in users.events_of(events, listed).collect()] == [1]
    assert sorted(r.n for r in users.events_without(events, listed).collect()) == [2, 3]


def test_a_calendar_prunes_the_days_while_running(spark, tmp_path):
    root, table = str(tmp_path / "tables"), CATEGORY_CONVERSION
    create_tables(spark, root, [table])
    rows = spark.range(1, 29).selectExpr(
        "make_date(2024, 1, CAST(id AS INT)) AS report_date", "'c' AS category",
        "10L AS views", "1L AS purchases", "CAST(10 AS DECIMAL(5,2)) AS conversion_rate",
    )
    upsert(staged(rows, table), root, table)
    path = str(tmp_path / "calendar")
    spark.sql(
        "SELECT make_date(2024, 1, d) AS as_of, d AS number FROM VALUES (5), (6), (20) AS t(d)"
    ).write.parquet(path)
    calendar = spark.read.parquet(path).where("number < 10")
    found = conversion_trends_as_of(spark, root, calendar, days=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    got = sorted((r.as_of[-2:], r.date[-2:]) for r in found.collect())
    assert got == [
        ("05", "03"), ("05", "04"), ("05", "05"), ("06", "04"), ("06", "05"), ("06", "06")
    ]


def test_sets_of_bits_collect_nothing(spark):
    events = read_shop_events(spark, SF)
    dictionary = action_bits.frequent_types(events)
    assert dictionary.complete and dictionary.types == tuple(sorted(dictionary.types))
    plan = action_bits.user_action_sets(events, dictionary)._jdf.queryExecution().toString()
    for name in ("collect_set", "collect_list", "ObjectHashAggregate", "SortAggregate"):
        assert name not in plan
    assert plan.count("hashpartitioning") >= 1


def test_sets_of_bits_with_types_beyond_the_dictionary(spark):
    rows = [
        (u, t, None if u == "u2" else datetime.date(2024, 1, 1))
        for u in ("u0", "u1", "u2", "", None)
        for t in ("view", "purchase", "x" * 100, "é", "", None, "a", "Z")
        if not (u == "u1" and t not in ("view", "a"))
    ]
    events = spark.createDataFrame(rows * 3, "user_id string, event_type string, event_date date")
    plain = users.user_action_sets(events).collect()
    want = sorted((str(r.report_date), r.user_id, r.actions) for r in plain)
    for most in (0, 1, 2, 5, 62):
        dictionary = action_bits.frequent_types(events, most)
        assert not dictionary.complete and len(dictionary.types) <= most
        found = action_bits.user_action_sets(events, dictionary).collect()
        assert sorted((str(r.report_date), r.user_id, r.actions) for r in found) == want
    with pytest.raises(ValueError, match="bit"):
        action_bits.frequent_types(events, 63)
    assert action_bits.frequent_types(events.limit(0)) == ((), True)
