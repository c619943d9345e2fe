"""Message log + Structured Streaming: the reference scenario, stream = batch, restart."""

from pyspark.sql import functions as F

from mqtable.session import scratch_path
from mqtable.sources import messagelog
from mqtable.streaming import consumer


def _reference_messages(spark, n=10_000, queue="test-queue"):
    # bodies are the decimal text of 1..n, routing key "", one queue
    return spark.range(1, n + 1).select(
        F.col("id").alias("message_id"),
        F.lit(queue).alias("queue"),
        F.lit("test-exchange").alias("exchange"),
        F.lit("").alias("routing_key"),
        F.col("id").cast("string").alias("body"),
        F.lit(None).cast("map<string,string>").alias("headers"),
        F.lit(None).cast("int").alias("priority"),
        F.lit(0).alias("fail_count"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).cast("timestamp_ntz").alias("published_at"),
    )


def test_reference_scenario_total(spark):
    log = scratch_path(spark, "t-log")
    messagelog.publish(spark, _reference_messages(spark), log, 0, max_records_per_file=1000)
    sink = scratch_path(spark, "t-sink")
    stream = messagelog.stream_queue(spark, log, "test-queue", max_files_per_trigger=2)
    consumer.run_counts(stream, sink, scratch_path(spark, "t-ck"), timeout_s=120)
    per_batch = consumer.sink_batches(spark, sink)
    assert per_batch.select("batch_id").distinct().count() >= 3
    assert per_batch.agg(F.sum("n")).first()[0] == 10_000
    tags = messagelog.read_log(spark, log).agg(F.min("delivery_tag"), F.max("delivery_tag"), F.countDistinct("delivery_tag")).first()
    assert tuple(tags) == (1, 10_000, 10_000)


def test_publish_continues_tags_and_is_idempotent(spark):
    log = scratch_path(spark, "t-log2")
    msgs = _reference_messages(spark, 100, "q")
    messagelog.publish(spark, msgs.where("message_id <= 60"), log, 0)
    messagelog.publish(spark, msgs.where("message_id > 60"), log, 1)
    messagelog.publish(spark, msgs.where("message_id > 60"), log, 1)  # retried batch replaces itself
    df = messagelog.read_log(spark, log)
    assert df.count() == 100
    rows = df.select("message_id", "delivery_tag").collect()
    assert all(r.message_id == r.delivery_tag for r in rows)
    assert messagelog.read_queue(spark, log, "q", 10, 19).count() == 10


def test_stream_equals_batch_and_restart(spark):
    log = scratch_path(spark, "t-log3")
    msgs = _reference_messages(spark, 3000, "a").unionByName(
        _reference_messages(spark, 2000, "b").withColumn("message_id", F.col("message_id") + 10_000)
    )
    messagelog.publish(spark, msgs.where("message_id <= 1500 OR message_id BETWEEN 10001 AND 11000"), log, 0, 400)
    sink, ck = scratch_path(spark, "t-sink3"), scratch_path(spark, "t-ck3")
    stream = lambda: messagelog.stream_queues(spark, log, ["a", "b"], max_files_per_trigger=3)
    consumer.run_counts(stream(), sink, ck, timeout_s=120)
    first = consumer.totals(spark, sink).collect()
    assert sum(r.n for r in first) == 2500
    # more messages arrive; the restarted query resumes from its checkpoint
    messagelog.publish(spark, msgs.where("NOT (message_id <= 1500 OR message_id BETWEEN 10001 AND 11000)"), log, 1, 400)
    consumer.run_counts(stream(), sink, ck, timeout_s=120)
    got = {r.queue: r.n for r in consumer.totals(spark, sink).collect()}
    batch = {r.queue: r["count"] for r in messagelog.read_log(spark, log).groupBy("queue").count().collect()}
    assert got == batch == {"a": 3000, "b": 2000}  # no loss, no repeats


def test_stream_dedupe_within_watermark(spark):
    log = scratch_path(spark, "t-log4")
    msgs = _reference_messages(spark, 50, "q")
    messagelog.publish(spark, msgs, log, 0)
    messagelog.publish(spark, msgs.where("message_id <= 10").withColumn("message_id", F.col("message_id") + 1000), log, 1)
    raw = messagelog.read_log(spark, log)
    # redelivered copies carry the same (queue, delivery_tag)
    copies = raw.where("publish_batch = 1").withColumn("delivery_tag", F.col("message_id") - 1000)
    dup_log = scratch_path(spark, "t-log4b")
    raw.where("publish_batch = 0").unionByName(copies).write.partitionBy("publish_batch", "queue").parquet(dup_log)
    stream = messagelog.stream_queue(spark, dup_log, "q")
    q = (
        consumer.dedupe_stream(stream, "1 hour")
        .writeStream.format("memory")
        .queryName("dedupe_out")
        .option("checkpointLocation", scratch_path(spark, "t-ck4"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    assert spark.sql("SELECT count(*) FROM dedupe_out").first()[0] == 50


def test_progress_counts_and_stream_leases(spark):
    from mqtable.operators import retention

    log = scratch_path(spark, "t-log5")
    msgs = _reference_messages(spark, 3000, "q").withColumn(
        # bursts: 30 messages per minute, then a 2 h pause every 600 messages
        "published_at",
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("message_id") * 2 + (F.col("message_id") / 600).cast("long") * 7200)).cast("timestamp_ntz"),
    )
    messagelog.publish(spark, msgs, log, 0, 500)
    sink, ck = scratch_path(spark, "t-sink5"), scratch_path(spark, "t-ck5")
    q = consumer.run_counts(messagelog.stream_queue(spark, log, "q", max_files_per_trigger=1), sink, ck, timeout_s=120)
    prog = consumer.progress_counts(spark, q).orderBy("batch_id").collect()
    assert sum(r.n for r in prog) == 3000 and prog[0].reported_n is None
    assert all(prog[i].reported_n == prog[i - 1].n for i in range(1, len(prog)))

    leases = (
        consumer.lease_stream(messagelog.stream_queue(spark, log, "q"), "1 hour")
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("lease_out")
        .option("checkpointLocation", scratch_path(spark, "t-ck6"))
        .trigger(availableNow=True)
        .start()
    )
    leases.awaitTermination(120)
    streamed = sorted((r.n,) for r in spark.sql("SELECT n FROM lease_out").collect())
    batch = sorted((r.n,) for r in retention.queue_leases(msgs, 3_600_000).collect())
    assert streamed == batch and len(batch) == 6


def _backward_log(spark, path, files=5):
    """One file a queue and publish batch, each a day before the last."""
    for i in range(files):
        msgs = _reference_messages(spark, 100, f"q{i}").withColumn("message_id", F.col("message_id") + i * 1000)
        messagelog.publish(spark, msgs.withColumn("published_at", F.expr(f"published_at - INTERVAL {i} DAY")), path, i)


def test_stream_leases_of_backward_files(spark):
    from mqtable.operators import retention

    log = scratch_path(spark, "t-log18")
    _backward_log(spark, log)
    q = (
        consumer.lease_stream(messagelog.stream_log(spark, log, max_files_per_trigger=1), "1 hour")
        .writeStream.outputMode("complete").format("memory").queryName("backward_leases")
        .option("checkpointLocation", scratch_path(spark, "t-ck18")).trigger(availableNow=True).start()
    )
    q.awaitTermination(120)
    assert len({p.batchId for p in q.recentProgress if p.numInputRows}) == 5
    streamed = sorted(tuple(r) for r in spark.sql("SELECT queue, lease_start, n FROM backward_leases").collect())
    batch = retention.queue_leases(messagelog.read_log(spark, log), 3_600_000).select("queue", "lease_start", "n")
    assert streamed == sorted(tuple(r) for r in batch.collect()) and len(streamed) == 5


def test_stream_dedupe_of_backward_files(spark):
    log = scratch_path(spark, "t-log19")
    _backward_log(spark, log)
    # every message once more, and the later attempts are read first
    raw = messagelog.read_log(spark, log).select("queue", "delivery_tag", "published_at")
    deliveries, names = scratch_path(spark, "t-deliveries"), [f"q{i}" for i in range(5)]
    for attempt in (2, 1):
        for name in names:
            raw.where(F.col("queue") == name).withColumn("attempt", F.lit(attempt)).coalesce(1).write.mode("append").parquet(deliveries)
    schema = "queue string, delivery_tag long, published_at timestamp_ntz, attempt int"

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(deliveries)

    sink = scratch_path(spark, "t-latest")
    q = stream().writeStream.foreachBatch(consumer.latest_writer(sink)).option(
        "checkpointLocation", scratch_path(spark, "t-ck19")
    ).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert len(q.recentProgress) >= 10
    got = [tuple(r) for r in consumer.latest_deliveries(spark, sink).collect()]
    assert sorted(got) == [(name, tag, 2) for name in names for tag in range(1, 101)]

    (
        consumer.dedupe_stream(stream()).writeStream.format("memory").queryName("backward_first")
        .option("checkpointLocation", scratch_path(spark, "t-ck20")).trigger(availableNow=True).start().awaitTermination(120)
    )
    first = spark.table("backward_first").groupBy("queue").count().collect()
    assert {r.queue: r["count"] for r in first} == dict.fromkeys(names, 100)


def test_stream_factories(spark):
    from pyspark.sql import types as T

    from mqtable.options import OptionError, SourceKey
    from mqtable.streaming import api

    log = scratch_path(spark, "t-log7")
    msgs = _reference_messages(spark, 400, "a").unionByName(
        _reference_messages(spark, 300, "b").withColumn("message_id", F.col("message_id") + 1000)
        .withColumn("body", F.when(F.col("message_id") % 10 == 0, F.lit("x")).otherwise(F.col("body")))
    )
    messagelog.publish(spark, msgs, log, 0, 100)

    def drain(stream, name):
        q = (stream.writeStream.format("memory").queryName(name)
             .option("checkpointLocation", scratch_path(spark, "t-ck-" + name)).trigger(availableNow=True).start())
        q.awaitTermination(120)
        return spark.sql(f"SELECT * FROM {name}")

    single = drain(api.create_stream(spark, log, {"queueName": "a"}, max_files_per_trigger=1), "f_single")
    assert single.count() == 400 and single.where("body = '7'").count() == 1
    keys = [SourceKey("a"), SourceKey("b", options={"levelParallelism": "2"})]
    typed = drain(api.create_distributed_stream(spark, log, keys, {}, lambda d: int(d.text), T.LongType()), "f_multi")
    got = {(r.source_index, r.outcome): r["count"] for r in typed.groupBy("source_index", "outcome").count().collect()}
    assert got == {(0, "ok"): 400, (1, "ok"): 270, (1, "failed"): 30}
    assert api.create_distributed_stream(spark, log, [], {}).count() == 0  # no source: nothing, no error
    import pytest

    with pytest.raises(OptionError):
        api.create_stream(spark, log, {})
    assert api.read_slice(spark, log, SourceKey("b"), 10, 19).count() == 10


def test_stream_redelivery_matches_batch(spark):
    from mqtable.operators import delivery
    from mqtable.streaming import redelivery as rd

    log = scratch_path(spark, "t-log8")
    msgs = _reference_messages(spark, 200, "q").withColumn(
        "fail_count",
        F.when(F.col("message_id") % 17 == 0, F.lit(99)).when(F.col("message_id") % 5 == 0, F.lit(2)).otherwise(F.lit(0)),
    )
    messagelog.publish(spark, msgs, log, 0, 50)
    done, poison = rd.deliver_all(spark, log, scratch_path(spark, "t-redelivery"), rd.handler_fails_until(), max_attempts=5)
    assert done.count() + poison.count() == 200  # every message ends exactly once
    assert poison.count() == msgs.where("fail_count = 99").count() and set(r.attempt for r in poison.collect()) == {5}
    attempts = done.unionByName(poison, allowMissingColumns=True).agg(F.sum("attempt")).first()[0]
    assert attempts == delivery.redeliveries(msgs, 5).count()  # same deliveries as the batch operator


def test_stream_publish_idempotent(spark):
    from mqtable.streaming import redelivery as rd

    src = scratch_path(spark, "t-log9")
    msgs = _reference_messages(spark, 300, "q")
    messagelog.publish(spark, msgs, src, 0, 60)
    out, ck = scratch_path(spark, "t-log9b"), scratch_path(spark, "t-ck9")
    stream = messagelog.stream_queue(spark, src, "q", max_files_per_trigger=2).drop("delivery_tag", "publish_batch")
    stream.writeStream.foreachBatch(rd.publish_writer(out)).option("checkpointLocation", ck).trigger(
        availableNow=True
    ).start().awaitTermination(120)
    got = messagelog.read_log(spark, out)
    assert got.count() == 300 and got.select("delivery_tag").distinct().count() == 300
    assert got.agg(F.max("delivery_tag")).first()[0] == 300


def test_processing_time_trigger(spark):
    log = scratch_path(spark, "t-log10")
    messagelog.publish(spark, _reference_messages(spark, 500, "q"), log, 0, 100)
    sink = scratch_path(spark, "t-sink10")
    q = consumer.run_counts(
        messagelog.stream_log(spark, log, max_files_per_trigger=1), sink, scratch_path(spark, "t-ck10"),
        available_now=False, processing_time="1 second",
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert consumer.totals(spark, sink).first().n == 500


def test_live_total_and_stream_ttl(spark):
    import datetime as dt

    log = scratch_path(spark, "t-log11")
    msgs = _reference_messages(spark, 400, "q")  # published 1,700,000,001 .. 1,700,000,400 s
    messagelog.publish(spark, msgs, log, 0, 100)
    q = (
        consumer.running_total_stream(messagelog.stream_log(spark, log, max_files_per_trigger=1))
        .writeStream.outputMode("complete").format("memory").queryName("live_total")
        .option("checkpointLocation", scratch_path(spark, "t-ck11")).trigger(availableNow=True).start()
    )
    q.awaitTermination(120)
    assert spark.sql("SELECT total FROM live_total").first().total == 400

    sink = scratch_path(spark, "t-ttl")
    as_of = dt.datetime.fromtimestamp(1_700_000_300, dt.timezone.utc).replace(tzinfo=None)  # ttl 100 s: messages after second 200 live
    w = consumer.ttl_writer(sink, 100_000, lambda b: as_of)
    messagelog.stream_log(spark, log).writeStream.foreachBatch(w).option(
        "checkpointLocation", scratch_path(spark, "t-ck12")
    ).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.read.parquet(sink).count() == 200
    assert spark.read.parquet(sink + "_expired").count() == 200
    consumer.retain_batches_conf(spark, 8)
    assert int(spark.conf.get("spark.sql.streaming.minBatchesToRetain")) >= 8


def test_stream_of_empty_queue(spark):
    log = scratch_path(spark, "t-log13")
    messagelog.publish(spark, _reference_messages(spark, 10, "q"), log, 0)
    sink = scratch_path(spark, "t-sink13")
    consumer.run_counts(messagelog.stream_queues(spark, log, ["q", "ghost"]), sink, scratch_path(spark, "t-ck13"), timeout_s=60)
    assert {r.queue: r.n for r in consumer.totals(spark, sink).collect()} == {"q": 10}  # ghost: nothing, no error


def test_queue_names_with_special_characters(spark):
    from mqtable.options import SourceKey
    from mqtable.streaming import api

    log = scratch_path(spark, "t-log14")
    messagelog.publish(spark, _reference_messages(spark, 10, "orders:eu").unionByName(_reference_messages(spark, 5, "a b/c=d")), log, 0)
    sink = scratch_path(spark, "t-sink14")
    stream = api.create_distributed_stream(spark, log, [SourceKey("orders:eu"), SourceKey("a b/c=d")], {})
    consumer.run_counts(stream, sink, scratch_path(spark, "t-ck14"), timeout_s=60)
    assert {r.queue: r.n for r in consumer.totals(spark, sink).collect()} == {"orders:eu": 10, "a b/c=d": 5}
    assert messagelog.read_queue(spark, log, "orders:eu").count() == 10


def test_handler_gets_the_message(spark):
    from pyspark.sql import types as T

    from helpers import messages
    from mqtable.operators import handler

    rows = [
        {"body": "a", "headers": {"h": "1"}, "delivery_tag": 7, "routing_key": "r"},
        {"body": b"\xff", "headers": None},
        {"body": "none"},
        {"body": "raise"},
        {"body": "typed"},
        {"body": None},
    ]

    def fn(d):
        if d.text == "raise":
            raise ValueError
        if d.text in ("none", None):
            return None
        return "seven" if d.text == "typed" else (d.delivery_tag if d.body == b"a" and d.headers == {"h": "1"} else len(d.body))

    got = handler.handled_by(messages(spark, rows), fn, T.LongType()).orderBy("message_id").collect()
    assert [(r.value, r.outcome) for r in got] == [(7, "ok"), (1, "ok"), (None, "ok"), (None, "failed"), (None, "failed"), (None, "ok")]


def test_republished_batch_leaves_nothing_behind(spark):
    log = scratch_path(spark, "t-log15")
    messagelog.publish(spark, _reference_messages(spark, 10, "a").unionByName(_reference_messages(spark, 10, "b")), log, 0)
    messagelog.publish(spark, _reference_messages(spark, 4, "a"), log, 0)
    messagelog.publish(spark, _reference_messages(spark, 3, "a"), log, 1)
    rows = messagelog.read_log(spark, log).select("queue", "delivery_tag").collect()
    assert sorted((r.queue, r.delivery_tag) for r in rows) == [("a", i) for i in range(1, 8)]


def test_redelivery_without_poison(spark):
    from mqtable.streaming import redelivery as rd

    log = scratch_path(spark, "t-log16")
    messagelog.publish(spark, _reference_messages(spark, 20, "q").withColumn("fail_count", F.lit(0)), log, 0)
    ok, dead = rd.deliver_all(spark, log, scratch_path(spark, "t-redelivery2"), rd.handler_fails_until(), 3)
    assert ok.count() == 20 and dead.count() == 0


def test_print_stream(spark, capfd):
    log = scratch_path(spark, "t-log17")
    messagelog.publish(spark, _reference_messages(spark, 3, "q"), log, 0)
    q = consumer.print_stream(messagelog.stream_log(spark, log).select("message_id"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert q.exception() is None
