"""Options of the ranking job. ``None`` (and a blank sink URI) means the default."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from datetime import timedelta

from hotrank.functions.decay import decay_rate, millis

# Client settings Spark's Kafka reader decides itself and refuses to take.
_MANAGED_BY_SPARK = {
    "auto.offset.reset", "enable.auto.commit", "group.id", "client.id",
    "key.deserializer", "value.deserializer", "interceptor.classes",
    "partition.discovery.interval.ms", "bootstrap.servers", "security.protocol",
}


def _fill_defaults(obj) -> None:
    for f in fields(obj):
        if getattr(obj, f.name) is None:
            default = f.default_factory() if callable(f.default_factory) else f.default
            object.__setattr__(obj, f.name, default)


@dataclass(frozen=True)
class KafkaSourceOptions:
    """One Kafka input.

    ``auto_offset_reset`` never moves the start: only ``start_from_earliest`` does.
    ``partition_discovery_interval`` is accepted for completeness; Spark lists partitions in
    every micro-batch and reads new ones from their beginning. ``properties`` are passed to
    the client, except those the job or Spark itself fixes. ``group_id`` names the consumer
    groups: each query takes one of its own that starts with it, since queries that share a group
    may each read a part of the topics only. ``fixed_group=True`` takes it as it is.
    """

    bootstrap_servers: str
    topics: Sequence[str]
    group_id: str
    auto_offset_reset: str = "latest"
    start_from_earliest: bool = False
    client_id_prefix: str = "hotrank"
    partition_discovery_interval: timedelta = timedelta(minutes=1)
    bounded: bool = False
    security_protocol: str = "PLAINTEXT"
    properties: Mapping[str, str] = field(default_factory=dict)
    reader_options: Mapping[str, str] = field(default_factory=dict)
    fixed_group: bool = False

    def __post_init__(self):
        if isinstance(self.topics, str):
            raise TypeError("topics is a sequence of names, not one text")
        if not self.bootstrap_servers or not self.group_id:
            raise ValueError("bootstrap_servers and group_id are required")
        if not self.topics or any(not t or "," in t for t in self.topics):
            raise ValueError("topics needs at least one plain topic name")
        _fill_defaults(self)

    @property
    def starting_offsets(self) -> str:
        return "earliest" if self.start_from_earliest else "latest"

    def client_settings(self) -> dict[str, str]:
        """Reader options of the client; fixed settings win over ``properties``."""
        extra = {k: v for k, v in self.properties.items() if k not in _MANAGED_BY_SPARK}
        fixed = {
            "bootstrap.servers": self.bootstrap_servers,
            "security.protocol": self.security_protocol,
            "client.id": self.client_id_prefix,
        }
        group = "kafka.group.id" if self.fixed_group else "groupIdPrefix"
        return {f"kafka.{k}": str(v) for k, v in {**extra, **fixed}.items()} | {
            group: self.group_id
        }


@dataclass(frozen=True)
class RankingOptions:
    creation_source: KafkaSourceOptions
    action_source: KafkaSourceOptions
    window_size: timedelta = timedelta(minutes=5)
    score_half_life: timedelta = timedelta(minutes=10)
    window_half_life: timedelta = timedelta(minutes=10)
    sink_uri: str = "redis://localhost:6379"
    board_size: int = 100
    on_malformed: str = "quarantine"
    trigger_interval: timedelta = timedelta(seconds=100)

    def __post_init__(self):
        if self.creation_source is None or self.action_source is None:
            raise ValueError("both sources are required")
        if self.sink_uri is not None and not self.sink_uri.strip():
            object.__setattr__(self, "sink_uri", None)
        _fill_defaults(self)
        if millis(self.window_size) <= 0:
            raise ValueError("window_size must be positive")
        decay_rate(self.score_half_life)
        decay_rate(self.window_half_life)
        if self.board_size < 1:
            raise ValueError("board_size must be at least 1")
        if self.on_malformed not in ("quarantine", "fail"):
            raise ValueError("on_malformed is 'quarantine' or 'fail'")
