from pathlib import Path
from types import SimpleNamespace

import pytest

from trolley import session
from trolley.sources.decode import parse_events, with_event_time


class Conf(dict):
    def set(self, name, value):
        self[name] = value


def fake(master, **conf):
    return SimpleNamespace(
        conf=Conf(conf), sparkContext=SimpleNamespace(master=master)
    )


def test_scratch_lies_in_the_shared_folder():
    spark = fake("yarn", **{"spark.checkpoint.dir": "hdfs:/shared/"})
    first, second = (session.scratch_path(spark, "rows") for _ in range(2))
    assert first.startswith("hdfs:/shared/trolley/rows-") and first != second


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(fake("yarn"), "rows")


def test_one_machine_needs_one_too():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(fake("local[2]"), "rows")


def test_dates_are_only_cut_in_utc(spark, tmp_path):
    line = '{"user_id": "ann", "timestamp": "2023-11-07T02:00:00+00:00"}'
    lines = spark.createDataFrame([(line,)], "value string")
    (row,) = with_event_time(parse_events(lines)).collect()
    assert str(row.event_date) == "2023-11-07"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="has to be UTC"):
            with_event_time(parse_events(lines))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_the_scratch_of_a_job_is_removed_unless_it_fails(spark):
    with session.job_scratch(spark) as folder:
        rows = session.stage(spark.range(3), "rows")
        assert rows.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(folder.lstrip("/"))
    assert not Path(folder).exists()
    with pytest.raises(RuntimeError):
        with session.job_scratch(spark) as folder:
            session.stage(spark.range(3), "rows")
            raise RuntimeError
    assert Path(folder).exists()


def test_passing_scratch_stays_only_after_a_failure(spark):
    def exists(path):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)

    with session.passing_scratch(spark, "rows") as path:
        assert session.written(spark.range(3), path).count() == 3
    assert not exists(path)
    with pytest.raises(RuntimeError):
        with session.passing_scratch(spark, "rows") as path:
            session.written(spark.range(3), path)
            raise RuntimeError
    assert exists(path)
