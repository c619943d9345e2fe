"""Option contract of a queue source (all values arrive as strings).

Parsing follows the consumer's documented contract: booleans and most
integers fall back to their default on a bad value, the queue-policy
integers and ``maxMessagesPerPartition`` raise, ``ackType`` accepts any
string.  Unknown option names are rejected instead of silently ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Mapping

# --- fixed values: option names and defaults of the consumer contract ---------
QUEUE_NAME = "queueName"
ROUTING_KEYS = "routingKeys"
EXCHANGE_NAME = "exchangeName"
EXCHANGE_TYPE = "exchangeType"
TOPOLOGY_KEYS = (QUEUE_NAME, ROUTING_KEYS, EXCHANGE_NAME, EXCHANGE_TYPE)

HOSTS = "hosts"
CONNECTION_KEYS = (HOSTS, "virtualHost", "userName", "password", "codeClose")

DURABLE, EXCLUSIVE, AUTO_DELETE = "durable", "exclusive", "autoDelete"
ACK_TYPE, FAIR_DISPATCH, PREFETCH_COUNT = "ackType", "fairDispatch", "prefetchCount"
QUEUE_PROPERTY_KEYS = (DURABLE, EXCLUSIVE, AUTO_DELETE, ACK_TYPE, FAIR_DISPATCH, PREFETCH_COUNT)

X_MAX_LENGTH = "x-max-length"
X_MESSAGE_TTL = "x-message-ttl"
X_EXPIRES = "x-expires"
X_MAX_LENGTH_BYTES = "x-max-length-bytes"
X_DEAD_LETTER_EXCHANGE = "x-dead-letter-exchange"
X_DEAD_LETTER_ROUTING_KEY = "x-dead-letter-routing-key"
X_MAX_PRIORITY = "x-max-priority"
POLICY_KEYS = (
    X_MAX_LENGTH,
    X_MESSAGE_TTL,
    X_EXPIRES,
    X_MAX_LENGTH_BYTES,
    X_DEAD_LETTER_EXCHANGE,
    X_DEAD_LETTER_ROUTING_KEY,
    X_MAX_PRIORITY,
)
POLICY_INT_KEYS = (X_MAX_LENGTH, X_MESSAGE_TTL, X_EXPIRES, X_MAX_LENGTH_BYTES, X_MAX_PRIORITY)

MAX_MESSAGES_PER_PARTITION = "maxMessagesPerPartition"
LEVEL_PARALLELISM = "levelParallelism"
MAX_RECEIVE_TIME = "maxReceiveTime"
REMEMBER_DURATION = "rememberDuration"
STORAGE_LEVEL = "storageLevel"
CONSUMER_KEYS = (
    MAX_MESSAGES_PER_PARTITION,
    LEVEL_PARALLELISM,
    MAX_RECEIVE_TIME,
    STORAGE_LEVEL,
    REMEMBER_DURATION,
)

DEFAULT_DURABLE = True
DEFAULT_EXCLUSIVE = False
DEFAULT_AUTO_DELETE = False
DEFAULT_FAIR_DISPATCH = False
DEFAULT_ACK_TYPE = "basic"
BASIC_ACK, AUTO_ACK = "basic", "auto"
DEFAULT_HOST = "localhost"
DEFAULT_PREFETCH_COUNT = 1
DEFAULT_CODE_CLOSE = "320"
DEFAULT_LEVEL_PARALLELISM = 1
DEFAULT_STORAGE_LEVEL = "MEMORY_ONLY"
DEFAULT_MAX_RECEIVE_TIME = 0  # 0 = a share of the batch interval
DEFAULT_RECEIVE_SHARE = 0.9
DEFAULT_MIN_REMEMBER_SECONDS = 60
STORAGE_LEVELS = (
    "NONE",
    "DISK_ONLY",
    "DISK_ONLY_2",
    "DISK_ONLY_3",
    "MEMORY_ONLY",
    "MEMORY_ONLY_2",
    "MEMORY_ONLY_SER",
    "MEMORY_ONLY_SER_2",
    "MEMORY_AND_DISK",
    "MEMORY_AND_DISK_2",
    "MEMORY_AND_DISK_SER",
    "MEMORY_AND_DISK_SER_2",
    "OFF_HEAP",
)
# -----------------------------------------------------------------------------

KNOWN_KEYS = frozenset(
    TOPOLOGY_KEYS + CONNECTION_KEYS + QUEUE_PROPERTY_KEYS + POLICY_KEYS + CONSUMER_KEYS
)

_INT_RE = re.compile(r"[+-]?\d+")
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1
_LONG_MIN, _LONG_MAX = -(2**63), 2**63 - 1


class OptionError(ValueError):
    """A queue option has an unknown name or a value that must parse but does not."""


def _strict_int(value: str, lo: int, hi: int) -> int:
    if value is None or not _INT_RE.fullmatch(value):
        raise OptionError(f"not an integer: {value!r}")
    number = int(value)
    if not lo <= number <= hi:
        raise OptionError(f"out of range: {value!r}")
    return number


def parse_int(value: str | None, default: int) -> int:
    """32-bit integer; a missing or bad value gives ``default``."""
    try:
        return _strict_int(value, _INT_MIN, _INT_MAX)
    except OptionError:
        return default


def parse_long(value: str | None, default: int | None) -> int | None:
    """64-bit integer; a missing or bad value gives ``default``."""
    try:
        return _strict_int(value, _LONG_MIN, _LONG_MAX)
    except OptionError:
        return default


def parse_bool(value: str | None, default: bool) -> bool:
    """``true``/``false`` in any case; anything else gives ``default``."""
    if value is not None and value.lower() in ("true", "false"):
        return value.lower() == "true"
    return default


def validate_names(options: Mapping[str, str]) -> None:
    unknown = sorted(set(options) - KNOWN_KEYS)
    if unknown:
        raise OptionError(f"unknown option name(s): {', '.join(unknown)}")


OPTION_GROUPS = {
    "topology": TOPOLOGY_KEYS,
    "connection": CONNECTION_KEYS,
    "queue": QUEUE_PROPERTY_KEYS,
    "policy": POLICY_KEYS,
    "consumer": CONSUMER_KEYS,
}


def group_options(options: Mapping[str, str]) -> dict[str, dict[str, str]]:
    """Split a flat option map into its groups (unknown names are rejected)."""
    validate_names(options)
    return {g: {k: v for k, v in options.items() if k in keys} for g, keys in OPTION_GROUPS.items()}


@dataclass(frozen=True)
class QueueOptions:
    """Parsed view of a flat ``str -> str`` option map."""

    raw: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        validate_names(self.raw)
        # values that must parse raise right away, as the consumer would
        self.policy_arguments()
        self.max_messages_per_partition
        self.storage_level

    def get(self, key: str, default=None):
        return self.raw.get(key, default)

    @property
    def queue_name(self) -> str | None:
        return self.raw.get(QUEUE_NAME)

    @property
    def hosts(self) -> str:
        return self.raw.get(HOSTS, DEFAULT_HOST)

    @property
    def durable(self) -> bool:
        return parse_bool(self.raw.get(DURABLE), DEFAULT_DURABLE)

    @property
    def exclusive(self) -> bool:
        return parse_bool(self.raw.get(EXCLUSIVE), DEFAULT_EXCLUSIVE)

    @property
    def auto_delete(self) -> bool:
        return parse_bool(self.raw.get(AUTO_DELETE), DEFAULT_AUTO_DELETE)

    @property
    def ack_type(self) -> str:
        return self.raw.get(ACK_TYPE, DEFAULT_ACK_TYPE)

    @property
    def auto_ack(self) -> bool:
        return self.ack_type == AUTO_ACK

    @property
    def sends_basic_ack(self) -> bool:
        return self.ack_type == BASIC_ACK

    @property
    def fair_dispatch(self) -> bool:
        return parse_bool(self.raw.get(FAIR_DISPATCH), DEFAULT_FAIR_DISPATCH)

    @property
    def prefetch_count(self) -> int:
        return parse_int(self.raw.get(PREFETCH_COUNT), DEFAULT_PREFETCH_COUNT)

    @property
    def parallelism(self) -> int:
        return parse_int(self.raw.get(LEVEL_PARALLELISM), DEFAULT_LEVEL_PARALLELISM)

    @property
    def max_receive_time_ms(self) -> int:
        return parse_long(self.raw.get(MAX_RECEIVE_TIME), DEFAULT_MAX_RECEIVE_TIME)

    @property
    def remember_seconds(self) -> int | None:
        return parse_long(self.raw.get(REMEMBER_DURATION), None)

    @property
    def max_messages_per_partition(self) -> int | None:
        value = self.raw.get(MAX_MESSAGES_PER_PARTITION)
        return None if value is None else _strict_int(value, _INT_MIN, _INT_MAX)

    @property
    def storage_level(self) -> str:
        level = self.raw.get(STORAGE_LEVEL, DEFAULT_STORAGE_LEVEL)
        if level not in STORAGE_LEVELS:
            raise OptionError(f"unknown storage level: {level!r}")
        return level

    def batch_storage_level(self) -> str:
        """A batch can be consumed only once upstream, so NONE is lifted to MEMORY_ONLY."""
        level = self.storage_level
        return DEFAULT_STORAGE_LEVEL if level == "NONE" else level

    def policy_arguments(self) -> dict:
        out = {}
        for key in POLICY_KEYS:
            if key in self.raw:
                value = self.raw[key]
                out[key] = _strict_int(value, _INT_MIN, _INT_MAX) if key in POLICY_INT_KEYS else value
        return out

    def receive_time_ms(self, slide_ms: int) -> int:
        """Receive window of one batch: the option, or ceil(0.9 x slide) when it is 0."""
        value = self.max_receive_time_ms
        if value == 0:
            import math

            return int(math.ceil(slide_ms * DEFAULT_RECEIVE_SHARE))
        return value

    def remember_batches(self, slide_ms: int) -> int:
        """Number of batches to keep: ceil(remember / slide); 60 s when unset."""
        import math

        seconds = self.remember_seconds
        seconds = DEFAULT_MIN_REMEMBER_SECONDS if seconds is None else seconds
        return max(1, int(math.ceil(seconds * 1000 / slide_ms)))

    def merged(self, override: Mapping[str, str] | None) -> "QueueOptions":
        """Per-source options win over the stream-wide ones."""
        return QueueOptions({**self.raw, **(override or {})})


@dataclass(frozen=True)
class SourceKey:
    """One source: queue, its exchange/routing declaration and its own options."""

    queue: str
    exchange: str | None = None
    exchange_type: str | None = None
    routing_keys: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def __repr__(self) -> str:
        return (
            f"SourceKey(queue={self.queue}, exchange={self.exchange}, "
            f"type={self.exchange_type}, routing={self.routing_keys})"
        )


def source_keys(options: QueueOptions, keys: list[SourceKey] | None = None) -> list[SourceKey]:
    """Explicit keys, or one key built from ``queueName``; no queue name -> no source."""
    if keys:
        return list(keys)
    if options.queue_name is None:
        return []
    connection = {k: v for k, v in options.raw.items() if k in CONNECTION_KEYS}
    return [
        SourceKey(
            queue=options.queue_name,
            exchange=options.get(EXCHANGE_NAME),
            exchange_type=options.get(EXCHANGE_TYPE),
            routing_keys=options.get(ROUTING_KEYS),
            options=connection,
        )
    ]
