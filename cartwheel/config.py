"""Parameters of the stream and the batch jobs (no module-level globals read at run time)."""

from __future__ import annotations

from dataclasses import dataclass, field

from cartwheel import constants as C


@dataclass(frozen=True)
class StreamSettings:
    """Window, watermark and alert thresholds of the real-time path."""

    window: str = C.WINDOW_DURATION
    slide: str = C.SLIDE_DURATION
    watermark: str = C.WATERMARK_DELAY
    min_views: int = C.FLASH_SALE_MIN_VIEWS
    max_purchases: int = C.FLASH_SALE_MAX_PURCHASES
    alert_message: str = C.ALERT_MESSAGE


@dataclass(frozen=True)
class KafkaSettings:
    """Kafka source/sink options."""

    bootstrap_servers: str = "localhost:9092"
    topic: str = "clickstream-events"
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    # records per micro-batch at most; None: a batch takes all that has arrived. Set it for a replay
    # from the earliest offsets or a backlog, so that they arrive as a sequence of bounded batches
    max_offsets_per_trigger: int | None = None
    extra: dict = field(default_factory=dict)

    def source_options(self, starting_offsets: str | None = None) -> dict:
        opts = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": starting_offsets or self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        opts.update(self.extra)
        return opts

    def sink_options(self) -> dict:
        # producer settings: acks=all, retries=3, linger 5 ms, batch 16384
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "topic": self.topic,
            "kafka.acks": "all",
            "kafka.retries": "3",
            "kafka.linger.ms": "5",
            "kafka.batch.size": "16384",
        }
