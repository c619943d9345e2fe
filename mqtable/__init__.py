"""mqtable: message-queue analytics as Spark DataFrame transformations.

A replayable message log (Parquet, partitioned by queue, dense per-queue
``delivery_tag``) stands in for a broker queue.  Every operator is a pure
``f(DataFrame, ...) -> DataFrame`` that Catalyst plans and Spark executes.

Entry points (imported lazily, so ``import mqtable`` needs no session)::

    from mqtable import create_stream, create_distributed_stream, publish, route
"""

from mqtable.schema import (
    BINDING_SCHEMA,
    MESSAGE_SCHEMA,
    POLICY_SCHEMA,
    SOURCE_SCHEMA,
)

_LAZY = {
    "create_stream": ("mqtable.streaming.api", "create_stream"),
    "create_distributed_stream": ("mqtable.streaming.api", "create_distributed_stream"),
    "read_slice": ("mqtable.streaming.api", "read_slice"),
    "publish": ("mqtable.sources.messagelog", "publish"),
    "read_log": ("mqtable.sources.messagelog", "read_log"),
    "route": ("mqtable.operators.routing", "route"),
    "unroutable": ("mqtable.operators.routing", "unroutable"),
    "topology_bindings": ("mqtable.operators.routing", "topology_bindings"),
    "QueueOptions": ("mqtable.options", "QueueOptions"),
    "SourceKey": ("mqtable.options", "SourceKey"),
}


def __getattr__(name):
    if name in _LAZY:
        import importlib

        module, attr = _LAZY[name]
        return getattr(importlib.import_module(module), attr)
    raise AttributeError(name)


__all__ = ["BINDING_SCHEMA", "MESSAGE_SCHEMA", "POLICY_SCHEMA", "SOURCE_SCHEMA", *_LAZY]
