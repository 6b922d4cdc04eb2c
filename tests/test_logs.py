import datetime
import json
from pathlib import Path

import pytest

from trolley import session
from trolley.plans import daily
from trolley.settings import Settings
from trolley.sinks import kafka as kafka_sink
from trolley.sinks.event_logs import append_event_log
from trolley.sinks.tables import ConstraintViolation
from trolley.sources import event_logs, kafka
from trolley.sources.decode import parse_events

GOOD = {
    "user_id": "ann",
    "product_id": "lamp",
    "event_type": "view",
    "timestamp": "2023-11-07T08:02:11",
}

BAD = [
    '{"user_id": "dot", ',
    "5",
    "null",
    "[]",
    "[" + json.dumps(GOOD) + "]",
    json.dumps(GOOD) + json.dumps(GOOD),
    json.dumps(GOOD) + "," + json.dumps(GOOD),
    json.dumps(GOOD) + " junk",
    "junk " + json.dumps(GOOD),
]


@pytest.fixture
def logs(tmp_path):
    """A daily log with good, blank and malformed lines, and one of the next day."""
    first = [
        json.dumps(GOOD),
        "",
        "   ",
        "\t",
        json.dumps({**GOOD, "user_id": "bo", "timestamp": "soon", "extra": 1}),
        *BAD,
        "  " + json.dumps({**GOOD, "user_id": "cid", "product_category": "tablets"}) + " ",
    ]
    (tmp_path / "clickstream_2024-01-05.jsonl").write_text("\n".join(first) + "\n")
    (tmp_path / "clickstream_2024-01-06.jsonl").write_text(json.dumps(GOOD))
    (tmp_path / "other_2024-01-05.jsonl").write_text(json.dumps(GOOD))
    return str(tmp_path)


def test_the_log_of_a_day(spark, logs):
    events = event_logs.read_daily_logs(spark, logs, ["2024-01-05"])
    found = sorted(
        tuple(row)
        for row in events.select(
            "user_id", "product_category", "event_date", "event_timestamp"
        ).collect()
    )
    assert [row[0] for row in found] == ["ann", "bo", "cid"]
    assert [row[1] for row in found] == [None, None, "tablets"]
    assert {row[2] for row in found} == {datetime.date(2024, 1, 5)}
    assert found[0][3] is not None and found[1][3] is None


def test_malformed_lines_are_kept_apart(spark, logs):
    lines = event_logs.malformed_lines(spark, logs, ["2024-01-05"]).collect()
    assert sorted(row.line for row in lines) == sorted(BAD)


def test_logs_of_several_days(spark, logs):
    for days in (None, ["2024-01-05", "2024-01-06", "2024-01-07"]):
        events = event_logs.read_daily_logs(spark, logs, days)
        found = {row.event_date.day: row["count"] for row in events.groupBy("event_date").count().collect()}
        assert found == {5: 3, 6: 1}


def test_a_log_may_be_a_folder_of_parts(spark, logs, tmp_path):
    events = event_logs.read_daily_logs(spark, logs, ["2024-01-06"]).repartition(3)
    folder = tmp_path / "clickstream_2024-01-07.jsonl"
    kept = events.drop("event_timestamp", "event_date")
    kept.unionByName(kept).write.json(str(folder))
    found = event_logs.read_daily_logs(spark, logs, ["2024-01-06", "2024-01-07"])
    counts = {r.event_date.day: r["count"] for r in found.groupBy("event_date").count().collect()}
    assert counts == {6: 1, 7: 2}


def test_names_without_a_date_are_left_out(spark, logs, tmp_path, caplog):
    (tmp_path / "clickstream_backup.jsonl").write_text(json.dumps(GOOD))
    assert event_logs.read_daily_logs(spark, logs).count() == 4
    assert "clickstream_backup.jsonl has no date" in caplog.text


def test_a_missing_log_is_a_warning(spark, logs, caplog):
    events = event_logs.read_daily_logs(spark, logs, ["2020-01-01"])
    assert events.count() == 0
    assert "there is no log of 2020-01-01" in caplog.text
    assert events.schema == event_logs.read_daily_logs(spark, logs, ["2024-01-05"]).schema
    assert event_logs.read_daily_logs(spark, logs).where("false").count() == 0


def test_the_day_to_report():
    yesterday = (datetime.date.today() - datetime.timedelta(days=1)).isoformat()
    assert event_logs.report_day() == yesterday
    assert event_logs.report_day(datetime.datetime(2024, 3, 4, 5)) == "2024-03-04"
    assert event_logs.report_day("2024-03-04T05:06:07Z") == "2024-03-04"


def test_appended_logs_are_read_back(spark, sample, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):
        append_event_log(sample, path)
    found = event_logs.read_event_log(spark, path)
    assert found.count() == 20
    assert found.distinct().exceptAll(sample).count() == 0
    assert (tmp_path / "log" / "event_date=2023-11-07").is_dir()


def test_messages(spark, sample):
    messages = kafka_sink.event_messages(sample)
    back = parse_events(messages.selectExpr("cast(value AS binary) AS value"))
    assert back.exceptAll(sample.select(*back.columns)).count() == 0
    broken = spark.createDataFrame([("{",), ("",), (None,)], "value string")
    assert [set(row) for row in parse_events(broken).collect()] == [{None}] * 3


def test_topic_options():
    settings = Settings(kafka_servers="broker:1", kafka_topic="shop")
    assert kafka.source_options(settings) == {
        "kafka.bootstrap.servers": "broker:1",
        "subscribe": "shop",
        "startingOffsets": "latest",
    }
    bounded = Settings.from_env({"KAFKA_MAX_OFFSETS_PER_TRIGGER": "1000"})
    assert kafka.source_options(bounded)["maxOffsetsPerTrigger"] == "1000"
    assert kafka_sink.sink_options(settings) == {
        "kafka.bootstrap.servers": "broker:1",
        "topic": "shop",
    }


def test_the_daily_job(spark, logs, tmp_path):
    settings = Settings(
        raw_logs_path=logs,
        output_path=str(tmp_path / "out"),
        tables_path=str(tmp_path / "tables"),
    )
    days = ["2024-01-05"]
    (row,) = daily.run(daily.read_logs(spark, settings, days), settings).collect()
    assert row.total_events == 3 and row.window_shoppers["count"] == 3
    (written,) = spark.read.text(
        str(tmp_path / "out" / "summaries"), wholetext=True
    ).collect()
    assert json.loads(written.value)["total_events"] == 3
    reports = spark.read.text(str(tmp_path / "out" / "reports"))
    assert reports.where("value = 'Total Events: 3'").count() == 1
    nothing = daily.read_logs(spark, settings, ["2020-01-01"])
    assert daily.run(nothing, settings).count() == 0
    # A day without events leaves what is stored alone.
    assert spark.read.parquet(str(tmp_path / "tables" / "daily_summary")).count() == 1


def test_the_daily_job_over_folders(spark, sample, tmp_path):
    settings = Settings(raw_logs_path=str(tmp_path / "log"))
    append_event_log(sample, settings.raw_logs_path)
    for day, days in (("2023-11-07", 1), ("2023-11-08", 0)):
        logs = daily.read_logs(spark, settings, [day], by_folder=True)
        assert daily.run(logs, settings).count() == days
    plan = logs._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [(cast" in plan, plan


def test_undated_events_in_folders_are_counted(spark, sample, make_events, tmp_path, caplog):
    settings = Settings(raw_logs_path=str(tmp_path / "log"))
    append_event_log(sample, settings.raw_logs_path)
    append_event_log(make_events(("u", "p", "c", "view", "soon")), settings.raw_logs_path)
    logs = daily.read_logs(spark, settings, ["2023-11-07"], by_folder=True)
    assert logs.count() == 10
    assert "1 events without a date" in caplog.text


def scratch_files(spark):
    folder = Path(session.shared_folder(spark)) / "trolley"
    return {path.name for path in folder.glob("job-*")}


def test_the_report_comes_before_a_failed_store(spark, tmp_path, monkeypatch, capsys):
    rows = [{**GOOD, "event_type": kind} for kind in ["view"] + ["purchase"] * 20]
    logs = tmp_path / "clickstream_2024-01-05.jsonl"
    logs.write_text("\n".join(map(json.dumps, rows)))
    monkeypatch.setenv("RAW_LOGS_PATH", str(tmp_path))
    monkeypatch.setenv("TABLES_PATH", str(tmp_path / "tables"))
    before = scratch_files(spark)
    with pytest.raises(ConstraintViolation, match="conversion_rate is out of range"):
        daily.main(["--date", "2024-01-05"])
    assert "Total Events: 21" in capsys.readouterr().out
    assert len(scratch_files(spark) - before) == 1


def test_the_command_replaces_days(spark, logs, tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("RAW_LOGS_PATH", logs)
    monkeypatch.setenv("TABLES_PATH", str(tmp_path / "tables"))
    daily.main(["--date", "2024-01-06"])
    other = {**GOOD, "product_id": "rug"}
    (tmp_path / "clickstream_2024-01-06.jsonl").write_text(json.dumps(other))
    for options, expected in (([], ["lamp", "rug"]), (["--replace"], ["rug"])):
        daily.main(["--date", "2024-01-06", *options])
        found = spark.read.parquet(str(tmp_path / "tables" / "product_performance"))
        assert sorted(row.product_id for row in found.collect()) == expected


def test_the_command_prints_the_report(spark, logs, monkeypatch, capsys):
    monkeypatch.setenv("RAW_LOGS_PATH", logs)
    before = scratch_files(spark)
    daily.main(["--date", "2024-01-06"])
    assert scratch_files(spark) == before
    assert "Total Events: 1" in capsys.readouterr().out
    daily.main(["--date", "2020-01-01"])
    assert "No data available for summary." in capsys.readouterr().out
