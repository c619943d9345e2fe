"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over the whole tables.

Parameters are the fixture values (slide 1 h, receive window 54 min, ...).
Column names equal those of the matching DuckDB statement in ``oracle.py``.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mqtable.operators import admission, counting, delivery, handler, retention, routing
from mqtable.options import QueueOptions, SourceKey
from mqtable.session import scratch_path
from mqtable.sources import messagelog
from mqtable.sources.fixtures import (
    TAG_BUCKET_IDS,
    bindings_table,
    dead_bindings_table,
    hop_bindings_table,
    hop_policies_table,
    message_view,
    policies_table,
    sources_table,
)
from mqtable.streaming import acks, api, capped, consumer, redelivery, state

# --- fixed values: parameters of the registered queries -----------------------
SLIDE_MS = 3_600_000  # batch interval: 1 h
RECEIVE_MS = 3_240_000  # receive window: 54 min
DAY_MS = 86_400_000
ACK_TYPES = ["auto", "basic", "other"]
MAX_ATTEMPTS = 5
TTL_MS = 86_400_000
MAX_LENGTH = 100
MAX_LENGTH_BYTES = 2_000
MAX_PRIORITY = 5
TAKE_N = 25
CAP = 10
STREAM_PARALLELISM = 2
BACKLOG_CAP = 14
QUEUE_CAP = 3
RATE_SLIDE_MS = 1_000
RATE_PARTITIONS = 6
RATE_USER_CAP = 10
REMEMBER_S = 27_000  # 7 h 30 min
UNION_QUEUES = ["click", "error", "view"]
UNMATCHED_QUEUES = ["clicks", "u2"]
READ_QUEUE, READ_FIRST, READ_LAST = "click", 100, 199
PUBLISH_SPLIT = "2024-01-16 00:00:00"
LOG_FILE_RECORDS = messagelog.MAX_RECORDS_PER_FILE
TRIGGER_BYTES = 1 << 30  # of log files per micro-batch
CAPPED_STREAM = {"maxMessagesPerPartition": "4000", "levelParallelism": "2"}
CAPPED_CATCH_UP = 1 << 18  # messages per trigger
CAPPED_SOURCES = [("click", "800"), ("error", None), ("view", "1200"), ("click", None)]
# -------------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _m(spark, sf, tags=True):
    return message_view(spark, sf, with_tag=tags)


def q_decode_body(spark, sf):
    return handler.decoded_text(_m(spark, sf, False))


def q_envelope(spark, sf):
    return handler.envelope(_m(spark, sf))


def q_header_lookup(spark, sf):
    return handler.header_lookup(_m(spark, sf, False), "user", "header_user")


def q_handler_json(spark, sf):
    return handler.handle_json(_m(spark, sf, False)).select("message_id", "k")


def q_handler_udf(spark, sf):
    return handler.handle_udf(_m(spark, sf, False))


def q_handler_split(spark, sf):
    return handler.outcome_counts(_m(spark, sf, False))


def q_multi_queue_union(spark, sf):
    m = _m(spark, sf, False)
    return m.where(F.col("queue").isin(UNION_QUEUES)).select(F.col("queue").alias("source"), "message_id")


def q_topology_bindings(spark, sf):
    b = routing.topology_bindings(sources_table(spark))
    return routing.binding_traffic(_m(spark, sf, False), b)


def _routed(spark, sf, exchange_type=None, queues=None):
    r = routing.route(_m(spark, sf, False), bindings_table(spark, exchange_type, queues))
    return r.select("bound_queue", "message_id")


def q_route_direct(spark, sf):
    return _routed(spark, sf, routing.DIRECT)


def q_route_fanout(spark, sf):
    return _routed(spark, sf, routing.FANOUT)


def q_route_topic(spark, sf):
    return _routed(spark, sf, routing.TOPIC)


def q_route_unmatched(spark, sf):
    b = bindings_table(spark, queues=UNMATCHED_QUEUES)
    return routing.unroutable(_m(spark, sf, False), b).select("message_id")


def q_count_messages(spark, sf):
    return counting.count_by_source(_m(spark, sf, False), sources_table(spark))


def q_is_empty(spark, sf):
    return counting.is_empty_by_source(_m(spark, sf, False), sources_table(spark))


def q_count_approx(spark, sf):
    return counting.count_approx(_m(spark, sf, False), 10, 0.95)


def q_take_messages(spark, sf):
    return counting.take_messages(_m(spark, sf, False), TAKE_N).select("queue", "delivery_tag", "message_id")


def _hourly(m):
    return admission.with_batch(m, SLIDE_MS, RECEIVE_MS)


def q_partition_counts(spark, sf):
    m = _hourly(_m(spark, sf)).withColumn("slot", admission.slot_of(F.col("delivery_tag"), 2))
    return counting.partition_counts(m)


def _batches(spark, sf):
    return admission.per_batch(_hourly(_m(spark, sf, False)))


def q_batch_counts(spark, sf):
    return counting.reported_counts(_batches(spark, sf))


def q_running_total(spark, sf):
    return counting.running_total(_batches(spark, sf))


def q_partition_plan(spark, sf):
    plan = admission.partition_plan(sources_table(spark), STREAM_PARALLELISM)
    return admission.partition_load(plan, _m(spark, sf))


def q_balanced_slots(spark, sf):
    return admission.balanced_slots(_m(spark, sf), 3)


def q_cap_per_partition(spark, sf):
    handled = handler.split_outcomes(handler.handle_json(_m(spark, sf)))
    ok = handled.where(F.col("outcome") == handler.OK)
    capped = admission.cap_per_partition(ok, 2, CAP, DAY_MS)
    return capped.select("batch_id", "queue", "slot", "message_id")


def q_micro_batch_assign(spark, sf):
    return _hourly(_m(spark, sf, False)).select("message_id", "batch_id")


def q_tumbling_counts(spark, sf):
    return admission.tumbling_counts(_m(spark, sf, False), "1 hour")


def q_rate_cap(spark, sf):
    b = _batches(spark, sf)
    with_user = admission.rate_cap(b, RATE_SLIDE_MS, RATE_PARTITIONS, RATE_USER_CAP).select(
        "batch_id", F.col("cap").alias("cap_user")
    )
    default = admission.rate_cap(b, RATE_SLIDE_MS, RATE_PARTITIONS, None).select(
        "batch_id", F.col("cap").alias("cap_default")
    )
    return with_user.join(default, "batch_id")


def q_backlog(spark, sf):
    return admission.backlog(_batches(spark, sf), BACKLOG_CAP)


def q_backlog_messages(spark, sf):
    """W7 per message: when each arrives and in which batch its queue delivers it under a cap."""
    delivered = admission.delivery_batches(_hourly(_m(spark, sf)), QUEUE_CAP)
    return delivered.select("queue", "message_id", F.col("batch_id").alias("arrival_batch"), "delivery_batch")


def q_remember_batches(spark, sf):
    keep = QueueOptions({"rememberDuration": str(REMEMBER_S)}).remember_batches(SLIDE_MS)
    return admission.remember_batches(_batches(spark, sf), keep)


def q_ack_disposition(spark, sf):
    outcomes = handler.split_outcomes(handler.handle_json(_m(spark, sf, False)))
    return delivery.ack_dispositions(outcomes, ACK_TYPES)


def q_redelivery(spark, sf):
    return delivery.redeliveries(_m(spark, sf, False), MAX_ATTEMPTS).select(
        "message_id", "attempt", "redelivered"
    )


def q_dedupe_redelivered(spark, sf):
    return delivery.dedupe_latest(delivery.redeliveries(_m(spark, sf), MAX_ATTEMPTS))


def q_ttl_expire(spark, sf):
    return retention.ttl_live(_m(spark, sf, False), TTL_MS).select("queue", "message_id")


def _dead(spark, sf):
    as_of = retention.latest_publish(_m(spark, sf, False))
    return retention.dead_lettered(_m(spark, sf, False), policies_table(spark), as_of)


def q_max_length(spark, sf):
    return retention.max_length(_m(spark, sf, False), MAX_LENGTH).select("queue", "message_id")


def q_max_length_bytes(spark, sf):
    return retention.max_length_bytes(_m(spark, sf, False), MAX_LENGTH_BYTES).select("queue", "message_id")


def q_dead_letter(spark, sf):
    return _dead(spark, sf).select("message_id", "reason", "exchange")


def q_dead_letter_key(spark, sf):
    return _dead(spark, sf).select("message_id", "routing_key")


def q_dead_letter_routed(spark, sf):
    """Q4: dead letters delivered onward through the dead-letter exchange."""
    routed = routing.route(_dead(spark, sf), dead_bindings_table(spark))
    return routed.select("bound_queue", "message_id", "reason")


def q_dead_letter_hops(spark, sf):
    """Q4/Q5 through queues that dead-letter in turn, with a cycle."""
    m = _m(spark, sf, False)
    as_of = retention.latest_publish(m)
    hops = retention.dead_letter_hops(m, hop_policies_table(spark), hop_bindings_table(spark), as_of)
    return hops.select("message_id", "hop", "queue", "reason", "to_queue", "cycle")


def q_priority_order(spark, sf):
    m = admission.with_batch(_m(spark, sf), DAY_MS)
    return retention.priority_positions(m, MAX_PRIORITY).select("batch_id", "queue", "pos", "message_id")


def q_queue_leases(spark, sf):
    m = retention.with_expiry(_m(spark, sf, False), policies_table(spark))
    return retention.queue_leases(m, F.col("expires_ms"))


def _published_log(spark, sf) -> str:
    """Publish the message view into a fresh log in two batches; returns its path."""
    path = scratch_path(spark, "log")
    m = _m(spark, sf, False)
    split = F.col("published_at") < F.lit(PUBLISH_SPLIT).cast("timestamp_ntz")
    # event ids are dense (0..n-1): fixed-width numbering buckets suffice
    messagelog.publish(spark, m.where(split), path, 0, LOG_FILE_RECORDS, TAG_BUCKET_IDS)
    messagelog.publish(spark, m.where(~split), path, 1, LOG_FILE_RECORDS, TAG_BUCKET_IDS)
    return path


def q_publish_messages(spark, sf):
    path = _published_log(spark, sf)
    return messagelog.read_log(spark, path).select("queue", "delivery_tag", "message_id")


def q_publish_routed(spark, sf):
    """K1 through an exchange: the topic bindings decide the queues, which number their own tags."""
    path = scratch_path(spark, "log")
    m = _m(spark, sf, False)
    messagelog.publish_through(
        spark, m, bindings_table(spark, routing.TOPIC), path, 0, dense_id_bucket=TAG_BUCKET_IDS
    )
    return messagelog.read_log(spark, path).select("queue", "delivery_tag", "message_id")


def q_batch_read_queue(spark, sf):
    path = _published_log(spark, sf)
    return messagelog.read_queue(spark, path, READ_QUEUE, READ_FIRST, READ_LAST).select(
        "delivery_tag", "message_id"
    )


def _stream_totals(spark, sf, queues):
    path = _published_log(spark, sf)
    stream = messagelog.stream_queues(spark, path, queues, max_bytes_per_trigger=TRIGGER_BYTES)
    sink = scratch_path(spark, "sink")
    consumer.run_counts(stream, sink, scratch_path(spark, "ckpt"))
    return consumer.totals(spark, sink)


def q_messagelog_batch_read(spark, sf):
    """S5 through the source API: a slice of one source, its bodies decoded."""
    path = _published_log(spark, sf)
    df = api.read_slice(spark, path, SourceKey(READ_QUEUE), READ_FIRST, READ_LAST)
    return df.select("delivery_tag", "message_id")


def q_messagelog_stream(spark, sf):
    """S3 through the source API: several sources as one stream, per-batch counts summed per queue."""
    path = _published_log(spark, sf)
    stream = api.create_distributed_stream(
        spark, path, [SourceKey(q) for q in UNION_QUEUES], {}, max_bytes_per_trigger=TRIGGER_BYTES
    )
    sink = scratch_path(spark, "sink")
    consumer.run_counts(stream, sink, scratch_path(spark, "ckpt"))
    return consumer.totals(spark, sink)


def _envelope_text(delivery: handler.Delivery) -> str:
    """The fixture's whole-message handler: every field it is given, in one line."""
    user = (delivery.headers or {}).get("user", "-")
    return f"{delivery.exchange}|{delivery.routing_key}|{delivery.delivery_tag}|{user}|{delivery.text}"


def q_stream_handler(spark, sf):
    """S3/P4 by content: a handler over the whole message, on a stream of every queue."""
    path = _published_log(spark, sf)
    stream = messagelog.stream_log(spark, path, max_bytes_per_trigger=TRIGGER_BYTES)
    sink = scratch_path(spark, "handled")
    handled = handler.handled_by(stream, _envelope_text, T.StringType()).select("message_id", "value", "outcome")
    (
        handled.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "ckpt"))
        .trigger(availableNow=True)
        .start(sink)
        .awaitTermination()
    )
    return spark.read.schema(handled.schema).parquet(sink)


def _run(stream, write, checkpoint: str) -> None:
    run = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    run.start().awaitTermination()


def q_stream_leases(spark, sf):
    """Q7 as a stream: the leases of every queue of the published log, kept as runs of activity."""
    path, folder = _published_log(spark, sf), scratch_path(spark, "leases")
    stream = retention.with_expiry(
        messagelog.stream_log(spark, path, max_bytes_per_trigger=TRIGGER_BYTES), policies_table(spark)
    )
    _run(stream, state.lease_writer(folder, F.col("expires_ms")), f"{folder}/checkpoint")
    return state.leases(spark, folder)


def q_stream_distinct(spark, sf):
    """D3 as a stream: the log read by two inputs at different paces, each message kept at its first reading."""
    path, folder = _published_log(spark, sf), scratch_path(spark, "distinct")
    twice = messagelog.stream_log(spark, path, max_bytes_per_trigger=TRIGGER_BYTES)
    twice = twice.unionByName(messagelog.stream_log(spark, path, max_bytes_per_trigger=2 * TRIGGER_BYTES))
    twice = twice.select("queue", "delivery_tag", "message_id")
    _run(twice, state.distinct_writer(folder), f"{folder}/checkpoint")
    return state.distinct_messages(spark, folder, twice.schema)


def q_stream_acks(spark, sf):
    """D1/D2 as a stream: what becomes of every message under each ack type, by a user handler's outcome."""
    path, parts = _published_log(spark, sf), []
    for kind in ACK_TYPES:
        folder = scratch_path(spark, f"acks-{kind}")
        done = acks.deliver(spark, path, folder, {"ackType": kind}, handler.json_k, T.LongType(), MAX_ATTEMPTS)
        parts.append(done.select(F.lit(kind).alias("ack_type"), "queue", "delivery_tag", "attempt", "state"))
    return reduce(DataFrame.unionByName, parts)


def q_stream_redelivery(spark, sf):
    """D2 as a stream: failed deliveries return through a retry log until they
    succeed or reach the attempt limit; one row per message and its last attempt."""
    path = _published_log(spark, sf)
    ok, dead = redelivery.deliver_all(
        spark, path, scratch_path(spark, "redelivery"), redelivery.handler_fails_until(), MAX_ATTEMPTS
    )
    done = ok.select("message_id", "attempt", F.lit("acked").alias("outcome"))
    return done.unionByName(dead.select("message_id", "attempt", F.lit("dead").alias("outcome")))


def q_stream_dedupe(spark, sf):
    """D3 as a stream: every attempt of every message, reduced to the latest per message."""
    path = _published_log(spark, sf)
    stream = messagelog.stream_log(spark, path, max_bytes_per_trigger=TRIGGER_BYTES)
    sink = scratch_path(spark, "latest")
    (
        delivery.redeliveries(stream, MAX_ATTEMPTS)
        .writeStream.foreachBatch(consumer.latest_writer(sink))
        .option("checkpointLocation", scratch_path(spark, "ckpt"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return consumer.latest_deliveries(spark, sink)


def q_stream_capped(spark, sf):
    """Four sources under their own caps; which micro-batch delivers each message to each source."""
    path = _published_log(spark, sf)
    keys = [SourceKey(q, options={"maxMessagesPerPartition": cap} if cap else {}) for q, cap in CAPPED_SOURCES]
    stream = capped.CappedStream(spark, path, scratch_path(spark, "capped"), keys, CAPPED_STREAM, slide_ms=1, catch_up=CAPPED_CATCH_UP)
    sink = scratch_path(spark, "delivered")
    messagelog.ensure_dir(spark, sink)
    columns = ("source_index", "queue", "slot", "message_id", "batch_id")
    stream.drain(capped.trigger_writer(sink, *columns))
    schema = "source_index int, queue string, slot int, message_id long, batch_id long"
    return spark.read.schema(schema).option("basePath", sink).parquet(sink).select(*columns)


def q_stream_single_queue(spark, sf):
    return _stream_totals(spark, sf, [READ_QUEUE])


def q_stream_multi_queue(spark, sf):
    return _stream_totals(spark, sf, UNION_QUEUES)


QUERIES: dict[str, Query] = {
    "decode_body": q_decode_body,
    "envelope": q_envelope,
    "header_lookup": q_header_lookup,
    "handler_json": q_handler_json,
    "handler_udf": q_handler_udf,
    "handler_split": q_handler_split,
    "multi_queue_union": q_multi_queue_union,
    "topology_bindings": q_topology_bindings,
    "route_direct": q_route_direct,
    "route_fanout": q_route_fanout,
    "route_topic": q_route_topic,
    "route_unmatched": q_route_unmatched,
    "count_messages": q_count_messages,
    "is_empty": q_is_empty,
    "count_approx": q_count_approx,
    "take_messages": q_take_messages,
    "partition_counts": q_partition_counts,
    "batch_counts": q_batch_counts,
    "running_total": q_running_total,
    "partition_plan": q_partition_plan,
    "balanced_slots": q_balanced_slots,
    "cap_per_partition": q_cap_per_partition,
    "micro_batch_assign": q_micro_batch_assign,
    "tumbling_counts": q_tumbling_counts,
    "rate_cap": q_rate_cap,
    "backlog": q_backlog,
    "backlog_messages": q_backlog_messages,
    "remember_batches": q_remember_batches,
    "ack_disposition": q_ack_disposition,
    "redelivery": q_redelivery,
    "dedupe_redelivered": q_dedupe_redelivered,
    "ttl_expire": q_ttl_expire,
    "max_length": q_max_length,
    "max_length_bytes": q_max_length_bytes,
    "dead_letter": q_dead_letter,
    "dead_letter_key": q_dead_letter_key,
    "dead_letter_routed": q_dead_letter_routed,
    "dead_letter_hops": q_dead_letter_hops,
    "priority_order": q_priority_order,
    "queue_leases": q_queue_leases,
    "publish_messages": q_publish_messages,
    "publish_routed": q_publish_routed,
    "batch_read_queue": q_batch_read_queue,
    "stream_single_queue": q_stream_single_queue,
    "stream_multi_queue": q_stream_multi_queue,
    "messagelog_batch_read": q_messagelog_batch_read,
    "messagelog_stream": q_messagelog_stream,
    "stream_handler": q_stream_handler,
    "stream_capped": q_stream_capped,
    "stream_leases": q_stream_leases,
    "stream_dedupe": q_stream_dedupe,
    "stream_distinct": q_stream_distinct,
    "stream_acks": q_stream_acks,
    "stream_redelivery": q_stream_redelivery,
}
