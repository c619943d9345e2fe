"""Stream factories with the consumer's option contract, over the message log.

``create_stream`` (one queue) and ``create_distributed_stream`` (several queues / sources) return
streaming DataFrames.  Without a handler the body is decoded to text (the string variants); with one,
each whole message goes through it in Arrow batches, and a failure marks the row ``failed`` instead
of dropping it.  ``read_slice`` is the bounded batch read of one source.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mqtable.functions.text import decode_body
from mqtable.operators.handler import Delivery, handled_by
from mqtable.options import OptionError, QueueOptions, SourceKey, source_keys
from mqtable.sources import messagelog
from mqtable.streaming.consumer import retain_batches_conf


def with_handler(df: DataFrame, handler: Callable[[Delivery], object] | None, return_type: T.DataType) -> DataFrame:
    if handler is None:
        return df.withColumn("body", decode_body("body"))
    return handled_by(df, handler, return_type)


def create_distributed_stream(
    spark: SparkSession,
    log: str,
    keys: Sequence[SourceKey] | None,
    params: Mapping[str, str],
    handler: Callable[[Delivery], object] | None = None,
    return_type: T.DataType = T.StringType(),
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    slide_ms: int = 1_000,
) -> DataFrame:
    """One stream over every source; with no keys, one source from
    ``queueName``; with neither there is nothing to read (an empty, static
    DataFrame, not an error).

    A streaming DataFrame is bounded by files or bytes a batch.  Sources with ``maxMessagesPerPartition`` need
    ``capped.CappedStream``; here that option raises instead of being ignored."""
    opts = QueueOptions(dict(params))
    resolved = source_keys(opts, list(keys or []))
    limits = {"max_files_per_trigger": max_files_per_trigger, "max_bytes_per_trigger": max_bytes_per_trigger}
    if not resolved:
        empty = spark.createDataFrame([], messagelog.LOG_SCHEMA)
        return with_handler(empty, handler, return_type)
    for key in resolved:
        merged = opts.merged(key.options)  # the source's own options win
        merged.policy_arguments()  # bad values raise
        if merged.max_messages_per_partition is not None:
            raise OptionError("maxMessagesPerPartition: use mqtable.streaming.capped.CappedStream")
    if "rememberDuration" in params:
        retain_batches_conf(spark, opts.remember_batches(slide_ms))
    # a queue that several sources name is delivered to each of them
    indexes: dict[str, list[int]] = {}
    for i, key in enumerate(resolved):
        indexes.setdefault(key.queue, []).append(i)
    of = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for pair in indexes.items() for x in pair])
    stream = messagelog.stream_queues(spark, log, list(indexes), **limits)
    return with_handler(stream.withColumn("source_index", F.explode(F.try_element_at(of, F.col("queue")))), handler, return_type)


def create_stream(
    spark: SparkSession,
    log: str,
    params: Mapping[str, str],
    handler: Callable[[Delivery], object] | None = None,
    return_type: T.DataType = T.StringType(),
    **limits,
) -> DataFrame:
    """The stream of the queue named by ``queueName`` (required)."""
    if "queueName" not in params:
        raise OptionError("queueName is required for a single-queue stream")
    return create_distributed_stream(spark, log, None, params, handler, return_type, **limits)


def read_slice(
    spark: SparkSession,
    log: str,
    key: SourceKey,
    first_tag: int | None = None,
    last_tag: int | None = None,
    handler: Callable[[Delivery], object] | None = None,
    return_type: T.DataType = T.StringType(),
) -> DataFrame:
    """A bounded slice of one source as a batch DataFrame."""
    df = messagelog.read_queue(spark, log, key.queue, first_tag, last_tag)
    return with_handler(df, handler, return_type)
