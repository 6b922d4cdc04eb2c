"""What the queries need of a session that somebody else has made."""

from __future__ import annotations

import functools
import tempfile

from pyspark.sql import DataFrame, SparkSession

from trolley.session import JOB_SCRATCH, shared_folder


def prepared(query):
    """``query`` in a session that is in UTC and has a scratch folder.

    Only a session on one machine that names no shared folder, as in a trial run, gets
    a folder made for it.
    """

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        if not shared_folder(spark) and not spark.conf.get(JOB_SCRATCH, None):
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a shared folder")
            spark.conf.set(JOB_SCRATCH, tempfile.mkdtemp(prefix="trolley-"))
        return query(spark, sf_dir)

    return run
