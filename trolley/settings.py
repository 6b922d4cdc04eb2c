"""Job settings, read from environment variables once and then immutable."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


def _whole_number(env: Mapping[str, str], name: str, default: int) -> int:
    text = env.get(name, str(default))
    try:
        return int(text)
    except ValueError as error:
        raise ValueError(f"{name} must be an integer, got {text!r}") from error


def _flag(env: Mapping[str, str], name: str, default: bool) -> bool:
    return env.get(name, str(default)).strip().lower() == "true"


@dataclass(frozen=True)
class Settings:
    """Defaults for the alert rule, the windows and the locations.

    ``master`` stays ``None`` unless set, so that the master given to
    ``spark-submit`` is used. Locations have no default: on a cluster they have
    to name shared storage.
    """

    app_name: str = "trolley"
    master: str | None = None
    batch_partitions: int = 0
    kafka_servers: str = "localhost:9092"
    kafka_topic: str = "clickstream-events"
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int = 0
    window: str = "10 minutes"
    slide: str = "5 minutes"
    watermark: str | None = "10 minutes"
    state_ttl: str = "2 days"
    views_threshold: int = 100
    purchases_threshold: int = 5
    alert_trigger: str = "30 seconds"
    history_trigger: str = "60 seconds"
    history_files: int = 4
    alerts_console: bool = False
    console_rows: int = 20
    history_enabled: bool = True
    history_path: str | None = None
    history_checkpoint: str | None = None
    metrics_path: str | None = None
    metrics_every: int = 20
    raw_logs_path: str | None = None
    output_path: str | None = None
    tables_path: str | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        return cls(
            app_name=env.get("SPARK_APP_NAME", cls.app_name),
            master=env.get("SPARK_MASTER"),
            batch_partitions=_whole_number(
                env, "BATCH_PARTITIONS", cls.batch_partitions
            ),
            kafka_servers=env.get("KAFKA_BOOTSTRAP_SERVERS", cls.kafka_servers),
            kafka_topic=env.get("KAFKA_TOPIC", cls.kafka_topic),
            starting_offsets=env.get("KAFKA_STARTING_OFFSETS", cls.starting_offsets),
            max_offsets_per_trigger=_whole_number(
                env, "KAFKA_MAX_OFFSETS_PER_TRIGGER", cls.max_offsets_per_trigger
            ),
            window=env.get("WINDOW_DURATION", cls.window),
            slide=env.get("SLIDE_DURATION", cls.slide),
            # An empty value switches the watermark of the alerts off.
            watermark=env.get("WATERMARK_DELAY", cls.watermark) or None,
            state_ttl=env.get("STATE_TTL", cls.state_ttl),
            views_threshold=_whole_number(env, "VIEWS_THRESHOLD", cls.views_threshold),
            purchases_threshold=_whole_number(
                env, "PURCHASES_THRESHOLD", cls.purchases_threshold
            ),
            alerts_console=_flag(env, "ALERTS_CONSOLE", cls.alerts_console),
            console_rows=_whole_number(env, "CONSOLE_ROWS", cls.console_rows),
            history_enabled=_flag(env, "ENABLE_PARQUET_SINK", cls.history_enabled),
            history_files=_whole_number(env, "HISTORY_FILES", cls.history_files),
            history_path=env.get("PARQUET_OUTPUT_PATH"),
            history_checkpoint=env.get("PARQUET_CHECKPOINT_PATH"),
            metrics_path=env.get("STREAM_METRICS_PATH"),
            metrics_every=_whole_number(env, "STREAM_METRICS_EVERY", cls.metrics_every),
            raw_logs_path=env.get("RAW_LOGS_PATH"),
            output_path=env.get("OUTPUT_PATH"),
            tables_path=env.get("TABLES_PATH"),
        )

    def require(self, name: str) -> str:
        """The location ``name``, or an error that says it is not set."""
        value = getattr(self, name)
        if not value:
            raise ValueError(f"setting {name} is required for this job")
        return value
