"""The event topic. Needs the Kafka connector package of the Spark version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trolley.settings import Settings

CONNECTOR = "org.apache.spark:spark-sql-kafka-0-10_2.13"


def source_options(settings: Settings) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": settings.kafka_servers,
        "subscribe": settings.kafka_topic,
        "startingOffsets": settings.starting_offsets,
    }
    if settings.max_offsets_per_trigger:
        # Bounds a micro-batch, above all the first one after a standstill.
        options["maxOffsetsPerTrigger"] = str(settings.max_offsets_per_trigger)
    return options


def read_topic(spark: SparkSession, settings: Settings) -> DataFrame:
    """The topic as a stream; its binary ``value`` goes to ``parse_events``."""
    return (
        spark.readStream.format("kafka").options(**source_options(settings)).load()
    )
