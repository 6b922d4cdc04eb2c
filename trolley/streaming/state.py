"""What a stopped or running query holds in its state, read from the checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.streaming import watch


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row for each stateful operator: its name, partitions, first and last batch."""
    return spark.read.format("state-metadata").load(checkpoint)


def open_windows(
    spark: SparkSession, checkpoint: str, batch_id: int | None = None
) -> DataFrame:
    """The windows whose counts ``watch.window_changes`` still holds.

    (window_start, window_end, product_id, views, purchases, total_events, alerted, expires_at);
    the last one is NULL where a watermark ends the windows. ``batch_id`` reads the state behind
    an earlier batch, as far back as the query keeps it. Each state partition is one task.
    """
    reader = spark.read.format("statestore").option("stateVarName", watch.STATE_NAME)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    rows = reader.load(checkpoint)
    expiring = "ttlExpirationMs" in rows.schema["value"].dataType.fieldNames()
    counts = "value.value" if expiring else "value"
    expires = F.timestamp_millis("value.ttlExpirationMs") if expiring else F.lit(None)
    return watch.with_times(
        rows.select("key.*", f"{counts}.*", expires.cast("timestamp").alias("expires_at"))
    )
