"""Publishing events. Needs the Kafka connector package of the Spark version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from trolley.functions.events import event_json
from trolley.settings import Settings


def event_messages(events: DataFrame) -> DataFrame:
    """One JSON ``value`` per event, as the topic carries it."""
    return events.select(event_json().alias("value"))


def sink_options(settings: Settings) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": settings.kafka_servers,
        "topic": settings.kafka_topic,
    }


def publish_events(events: DataFrame, settings: Settings) -> None:
    event_messages(events).write.format("kafka").options(**sink_options(settings)).save()


def start_publishing(
    events: DataFrame, settings: Settings, checkpoint: str
) -> StreamingQuery:
    return (
        event_messages(events)
        .writeStream.queryName("event_messages")
        .format("kafka")
        .options(**sink_options(settings))
        .option("checkpointLocation", checkpoint)
        .start()
    )
