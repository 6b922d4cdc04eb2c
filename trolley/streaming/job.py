"""The streaming job: alerts and history from the event topic.

    spark-submit --packages <Kafka connector> trolley/streaming/job.py
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trolley.session import build_session, shared_folder
from trolley.settings import Settings
from trolley.sources.kafka import read_topic
from trolley.streaming import metrics, pipeline, queries, watch


def start(
    spark: SparkSession,
    messages: DataFrame,
    settings: Settings,
    checkpoints: str | None = None,
    trigger: queries.Trigger | None = None,
) -> StreamingQuery:
    """Start the query that serves alerts and history from one read of the messages.

    Its checkpoint lies in the folder of the settings, else in ``checkpoints``, by default the shared
    folder. Without a watermark
    windows are never closed: there is no history, and idle windows leave the state.
    """
    if settings.history_enabled and not settings.watermark:
        raise ValueError("the history appends closed windows: set a watermark")
    events = metrics.observe_events(pipeline.events_of(messages))
    changes = watch.window_changes(
        events,
        settings.window,
        settings.slide,
        settings.watermark,
        settings.state_ttl,
        settings.views_threshold,
        settings.purchases_threshold,
    )
    folder = checkpoints or shared_folder(spark)
    return queries.start_windows(
        metrics.observe_windows(changes),
        settings,
        settings.tables_path,
        settings.require("history_path") if settings.history_enabled else None,
        settings.history_checkpoint or (f"{folder.rstrip('/')}/windows" if folder else None),
        trigger,
    )


def main() -> None:
    settings = Settings.from_env()
    spark = build_session(settings)
    listener = None
    if settings.metrics_path:
        listener = metrics.TriggerMetrics(spark, settings.metrics_path, settings.metrics_every)
        spark.streams.addListener(listener)
    query = start(spark, read_topic(spark, settings), settings)
    try:
        # Also ends when the query fails.
        query.awaitTermination()
    finally:
        query.stop()
        if listener:
            listener.flush()
        spark.stop()


if __name__ == "__main__":
    main()
