"""Parameters of the operators. A value that is not positive raises ValueError."""

from __future__ import annotations

from dataclasses import dataclass, fields


def _require_positive(obj) -> None:
    for f in fields(obj):
        value = getattr(obj, f.name)
        if isinstance(value, int) and not isinstance(value, bool) and value <= 0:
            raise ValueError(f"{f.name} must be positive, got {value}")


@dataclass(frozen=True)
class QuotaPolicy:
    """Fixed-window quota of each tenant.

    `lease` = 1 is the strict policy. A larger lease takes that many tokens at a time and
    keeps the unused ones for later windows. `idle_ttl_sec`, when set, makes a tenant that
    was idle for longer than that lose them.
    """

    limit: int = 10_000
    lease: int = 1
    window_sec: int = 1
    idle_ttl_sec: int | None = None

    def __post_init__(self) -> None:
        _require_positive(self)


@dataclass(frozen=True)
class Capacity:
    """Bounded intake per interval: `shards` buffers of equal size."""

    shards: int = 32
    buffer: int = 131_072
    min_per_shard: int = 1024

    def __post_init__(self) -> None:
        _require_positive(self)

    @property
    def per_shard(self) -> int:
        return max(self.buffer // self.shards, self.min_per_shard)

    @property
    def total(self) -> int:
        return self.shards * self.per_shard


@dataclass(frozen=True)
class TopicSettings:
    """The publishing side: the topic of records that name none, how many records share a
    publishing batch, and how long the producer waits to fill one."""

    topic: str = "events"
    publish_batch: int = 128
    producer_timeout_ms: int = 5

    def __post_init__(self) -> None:
        _require_positive(self)


@dataclass(frozen=True)
class FlushSettings:
    """When a stream hands a micro-batch to its sink: on size or on time."""

    batch_size: int = 1000
    batch_timeout_ms: int = 50

    def __post_init__(self) -> None:
        _require_positive(self)


@dataclass(frozen=True)
class SampleSettings:
    """Systematic latency sample: every `step`-th call of a worker, at most `cap` kept."""

    step: int = 10
    cap: int = 10_000

    def __post_init__(self) -> None:
        _require_positive(self)
