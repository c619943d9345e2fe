"""Answers outside the fixtures: given tags, repeated publishes, replays, rare queues, time limits, capped streams."""

import time

import pytest
from helpers import messages
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_streaming import _reference_messages

from mqtable.operators import counting, retention
from mqtable.options import OptionError, SourceKey
from mqtable.session import scratch_path
from mqtable.sources import messagelog
from mqtable.streaming import api, capped, consumer, redelivery


def test_take_keeps_given_tags(spark):
    log = scratch_path(spark, "w-log")
    messagelog.publish(spark, _reference_messages(spark, 14, "q").where("message_id > 10"), log, 0)
    messagelog.publish(spark, _reference_messages(spark, 3, "q"), log, 1)  # smaller ids, later tags
    rows = counting.take_messages(messagelog.read_log(spark, log), 6).select("message_id", "delivery_tag").collect()
    assert [tuple(r) for r in rows] == [(11, 1), (12, 2), (13, 3), (14, 4), (1, 5), (2, 6)]


def test_ties_in_time_go_by_tag(spark):
    m = messages(spark, [{"message_id": 9 - i, "delivery_tag": i + 1} for i in range(5)]).withColumn(
        "published_at", F.lit("2024-01-01").cast("timestamp_ntz")
    )
    assert {r.delivery_tag for r in retention.max_length(m, 2).collect()} == {4, 5}


def _streamed(spark, log, sink, ck):
    consumer.run_counts(messagelog.stream_log(spark, log), sink, ck, timeout_s=120)
    return {r.queue: r.n for r in consumer.totals(spark, sink).collect()}


def test_repeated_publish_reaches_a_stream_once(spark):
    log, sink, ck = (scratch_path(spark, x) for x in ("w-log", "w-sink", "w-ck"))
    msgs = _reference_messages(spark, 8, "q").withColumn("headers", F.create_map(F.lit("user"), F.lit("7")))
    messagelog.publish(spark, msgs, log, 0)
    assert _streamed(spark, log, sink, ck) == {"q": 8}
    messagelog.publish(spark, msgs.repartition(3), log, 0)
    assert _streamed(spark, log, sink, ck) == {"q": 8}
    messagelog.publish(spark, msgs.withColumn("message_id", F.col("message_id") + 100), log, 1)
    assert _streamed(spark, log, sink, ck) == {"q": 16}


@pytest.mark.parametrize("crash_after", ["data", "manifest", "move"])
def test_publish_recovers_from_a_crash(spark, monkeypatch, crash_after):
    log = scratch_path(spark, "w-log")
    msgs = _reference_messages(spark, 9, "q")
    messagelog.publish(spark, msgs.where("message_id <= 3"), log, 0)

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as broken:
        if crash_after == "data":
            broken.setattr(messagelog, "_digest", crash)
        elif crash_after == "manifest":
            broken.setattr(messagelog, "_settle", crash)
        else:
            move = messagelog._move
            broken.setattr(messagelog, "_move", lambda s, a, b: move(s, a, b) if a.endswith("data") else crash())
        with pytest.raises(RuntimeError):
            messagelog.publish(spark, msgs.where("message_id BETWEEN 4 AND 6"), log, 1)
    if crash_after == "data":  # nothing was committed: the writer tries again
        assert messagelog.read_log(spark, log).count() == 3
        messagelog.publish(spark, msgs.where("message_id BETWEEN 4 AND 6"), log, 1)
    messagelog.publish(spark, msgs.where("message_id > 6"), log, 2)
    rows = messagelog.read_log(spark, log).select("message_id", "delivery_tag").collect()
    assert sorted(tuple(r) for r in rows) == [(i, i) for i in range(1, 10)]


def test_replay_leaves_no_stale_retry(spark):
    ok, retry, dead = (scratch_path(spark, x) for x in ("w-ok", "w-retry", "w-dead"))
    batch = messages(spark, [{} for _ in range(4)]).withColumn("publish_batch", F.lit(0).cast("long")).withColumn("attempt", F.lit(1))
    for answer in (False, True):
        redelivery.redelivery_writer(ok, retry, dead, lambda df: F.lit(answer))(batch, 0)
    assert redelivery.attempts_in(spark, ok).count() == 4 and redelivery.attempts_in(spark, retry).count() == 0


def test_count_approx_keeps_rare_queues(spark):
    m = messages(spark, [{"message_id": i} for i in (1, 2, 3)])
    assert [tuple(r) for r in counting.count_approx(m).collect()] == [("q", 0, 0, 28, 0.95)]


def test_count_within_time(spark):
    assert counting.count_within(spark.range(1000), 60_000) == (1000.0, 1000.0, 1000.0, 1.0)
    began = time.time()
    napping = spark.range(0, 8, 1, 8).where("id < 5").union(spark.range(0, 3, 1, 3).select(_nap("id").alias("id")))
    mean, low, high, confidence = counting.count_within(napping, 2_000)
    # eight of eleven partitions hold five rows; the others were still asleep
    assert time.time() - began < 15 and confidence == 0.95 and low <= mean <= high


def _nap(column):
    @F.udf("long")
    def nap(x):
        time.sleep(20)
        return x

    return nap(column)


def test_caps_bound_every_batch(spark):
    log, folder, sink = (scratch_path(spark, x) for x in ("w-log", "w-capped", "w-sink"))
    both = _reference_messages(spark, 20, "a").unionByName(_reference_messages(spark, 7, "b").withColumn("message_id", F.col("message_id") + 50))
    messagelog.publish(spark, both, log, 0, 4)
    messagelog.ensure_dir(spark, sink)
    keys = [SourceKey("a", options={"maxMessagesPerPartition": "2"}), SourceKey("b"), SourceKey("ghost"), SourceKey("a")]

    def stream(**params):
        return capped.CappedStream(spark, log, folder, keys, {"maxMessagesPerPartition": "3", **params}, lambda d: int(d.text), T.LongType(), 1)

    def delivered():
        rows = spark.read.schema("source_index int, queue string, slot int, message_id long, value string, batch_id long").option("basePath", sink)
        return rows.parquet(sink).collect()

    write = capped.folder_writer(sink, "source_index", "queue", "slot", "message_id", F.col("value").cast("string").alias("value"))
    crashed = []

    def crash_once(batch, batch_id):
        if batch_id == 2 and not crashed:
            crashed.append(batch_id)
            batch.limit(1).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
            raise RuntimeError("crash in the third batch")
        write(batch, batch_id)

    with pytest.raises(Exception, match="crash"):
        stream(storageLevel="MEMORY_ONLY").drain(crash_once, timeout_s=120)
    # the shares of the batch that crashed are kept, whatever is published meanwhile
    messagelog.publish(spark, _reference_messages(spark, 5, "b").withColumn("message_id", F.col("message_id") + 70), log, 1)
    stream().drain(crash_once, timeout_s=120)
    rows = delivered()
    sizes = {}
    for r in rows:
        sizes[r.source_index, r.batch_id] = sizes.get((r.source_index, r.batch_id), 0) + 1
    assert {i: max(n for (j, _), n in sizes.items() if j == i) for i in (0, 1, 3)} == {0: 2, 1: 3, 3: 3}
    got = sorted((r.source_index, r.message_id) for r in rows)
    a, b = list(range(1, 21)), [*range(51, 58), *range(71, 76)]
    assert got == sorted([(0, i) for i in a] + [(1, i) for i in b] + [(3, i) for i in a])
    assert sorted((r.batch_id, r.message_id) for r in rows if r.source_index == 0) == [(i // 2, i + 1) for i in range(20)]
    assert all(int(r.value) == r.message_id % (50 if r.message_id <= 57 else 70) for r in rows if r.queue == "b")


def test_slots_of_a_capped_stream(spark):
    log, sink = scratch_path(spark, "w-log"), scratch_path(spark, "w-sink")
    messagelog.publish(spark, _reference_messages(spark, 11, "a"), log, 0)
    messagelog.ensure_dir(spark, sink)
    params = {"queueName": "a", "maxMessagesPerPartition": "2", "levelParallelism": "3"}
    capped.CappedStream(spark, log, scratch_path(spark, "w-capped"), None, params, slide_ms=1).drain(capped.folder_writer(sink, "slot", "delivery_tag"), 120)
    rows = spark.read.schema("slot int, delivery_tag long, batch_id long").option("basePath", sink).parquet(sink).collect()
    assert sorted((r.delivery_tag, r.slot, r.batch_id) for r in rows) == [(t, (t - 1) % 3, (t - 1) // 3 // 2) for t in range(1, 12)]


def test_caps_are_never_ignored(spark):
    with pytest.raises(OptionError):
        api.create_distributed_stream(spark, "x", [SourceKey("a", options={"maxMessagesPerPartition": "2"})], {})
    with pytest.raises(ValueError):
        capped.CappedStream(spark, "x", "y", [SourceKey("a")], {"maxMessagesPerPartition": "0"})


def test_every_report_is_kept(spark):
    log, sink, ck, reports = (scratch_path(spark, x) for x in ("w-log", "w-sink", "w-ck", "w-reports"))
    messagelog.publish(spark, _reference_messages(spark, 120, "q"), log, 0, 10)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    listener = consumer.ProgressLog(spark, reports)
    spark.streams.addListener(listener)
    try:
        q = consumer.run_counts(messagelog.stream_log(spark, log, max_files_per_trigger=1), sink, ck, timeout_s=120)
        deadline = time.time() + 20
        while consumer.logged_progress(spark, reports, q.id).where("n > 0").count() < 12 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    rows = consumer.logged_progress(spark, reports, q.id).where("n > 0").orderBy("batch_id").collect()
    assert len(q.recentProgress) <= 3 and [r.batch_id for r in rows] == list(range(12)) and sum(r.n for r in rows) == 120
    assert [r.reported_n for r in rows] == [None, *(r.n for r in rows[:-1])]


@pytest.mark.parametrize("cap", [1, 3, 100])
def test_delivery_batches_against_iteration(spark, monkeypatch, cap):
    import random

    from mqtable.operators import admission

    monkeypatch.setattr(admission, "TAG_BUCKET", 7)
    rnd, rows, want = random.Random(cap), [], {}
    for queue, n in (("hot", 90), ("q", 11), (None, 5)):
        batch, taken, at = 0, {}, 0
        for tag in range(1, n + 1):
            batch += rnd.choice([0, 0, 0, 0, 1, 2, -1 if batch else 0])
            at = max(at, batch)
            while taken.get(at, 0) >= cap:
                at += 1
            taken[at] = taken.get(at, 0) + 1
            rows.append((queue, tag, batch))
            want[queue, tag] = at
    m = spark.createDataFrame(rows, "queue string, delivery_tag long, batch_id long")
    got = admission.delivery_batches(m, cap).collect()
    assert {(r.queue, r.delivery_tag): r.delivery_batch for r in got} == want and len(got) == len(rows)
