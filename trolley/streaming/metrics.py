"""Figures of each trigger of the running queries, as rows of a table.

Counts are observed while the events pass, so they cost no job. Of each trigger there is
one row, also of those without input.
"""

from __future__ import annotations

import logging
import threading
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from trolley import schemas
from trolley.streaming import watch

logger = logging.getLogger(__name__)

EVENTS, WINDOWS = "trolley_events", "trolley_windows"
TRIGGER = schemas.struct(
    query=schemas.STRING,
    run_id=schemas.STRING,
    batch_id=schemas.BIGINT,
    triggered_at=schemas.STRING,
    duration_ms=schemas.BIGINT,
    input_rows=schemas.BIGINT,
    events_per_second=T.DoubleType(),
    events=schemas.BIGINT,
    malformed=schemas.BIGINT,
    undated=schemas.BIGINT,
    newest_event=schemas.STRING,
    late_events=schemas.BIGINT,
    alerts=schemas.BIGINT,
    withdrawn=schemas.BIGINT,
    closed=schemas.BIGINT,
    dropped_by_watermark=schemas.BIGINT,
    state_rows=schemas.BIGINT,
)


def observe_events(events: DataFrame) -> DataFrame:
    """Count events, messages without any field (malformed ones) and those without a time."""
    fields = [F.col(name).isNull() for name in schemas.EVENT_FIELDS]
    empty = fields[0]
    for field in fields[1:]:
        empty = empty & field
    newest = F.date_format(F.max("event_timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return events.observe(
        EVENTS,
        F.count("*").alias("events"),
        F.count_if(empty).alias("malformed"),
        F.count_if(F.col("event_timestamp").isNull()).alias("undated"),
        newest.alias("newest_event"),
    )


def observe_windows(changes: DataFrame) -> DataFrame:
    """Count the changes of ``watch.window_changes`` by kind; late ones by their events.

    An event is late once for each closed window that it falls into.
    """
    late = F.when(F.col("kind") == watch.LATE, F.col("total_events"))
    return changes.observe(
        WINDOWS,
        F.coalesce(F.sum(late), F.lit(0)).alias("late_events"),
        F.count_if(F.col("kind") == watch.ALERT).alias("alerts"),
        F.count_if(F.col("kind") == watch.WITHDRAWN).alias("withdrawn"),
        F.count_if(F.col("kind") == watch.CLOSED).alias("closed"),
    )


def trigger_row(progress: Any) -> tuple:
    """The figures of one trigger in the order of TRIGGER; NULL for what is not observed."""
    found: dict[str, Any] = {}
    for row in progress.observedMetrics.values():
        found |= row.asDict()
    millis = progress.durationMs.get("triggerExecution", progress.batchDuration)
    rate = progress.numInputRows * 1000 / millis if millis else 0.0
    operators = progress.stateOperators
    given = {
        "query": progress.name,
        "run_id": str(progress.runId),
        "batch_id": progress.batchId,
        "triggered_at": progress.timestamp,
        "duration_ms": millis,
        "input_rows": progress.numInputRows,
        "events_per_second": rate,
        "dropped_by_watermark": sum(o.numRowsDroppedByWatermark for o in operators),
        "state_rows": sum(o.numRowsTotal for o in operators),
        **found,
    }
    return tuple(given.get(name) for name in TRIGGER.fieldNames())


class TriggerMetrics(StreamingQueryListener):
    """Writes a row for each trigger of all queries of a session to ``path``.

    Rows are kept until there are ``every`` of them, or a query ends, so there are few files;
    what a driver that is lost has kept is lost with it. Failing to write is logged and
    stops no query.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self.spark, self.path, self.every = spark, path, every
        self.kept: list[tuple] = []
        self.lock = threading.Lock()
        empty = spark.createDataFrame([], TRIGGER)
        empty.write.mode("ignore").parquet(path)

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        with self.lock:
            self.kept.append(trigger_row(event.progress))
            full = len(self.kept) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event: Any) -> None:
        self.flush()

    def flush(self) -> None:
        """Write what is kept, as one file."""
        with self.lock:
            rows, self.kept = self.kept, []
        if not rows:
            return
        try:
            table = self.spark.createDataFrame(rows, TRIGGER).coalesce(1)
            table.write.mode("append").parquet(self.path)
        except Exception:
            logger.exception("figures of %d triggers are not written", len(rows))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row of each trigger, also where a batch was tried twice in a run."""
    rows = spark.read.schema(TRIGGER).parquet(path)
    return rows.dropDuplicates(["run_id", "batch_id", "triggered_at"])
