"""A capped stream that has fallen behind: several batches per trigger, each under its own caps."""

import pytest
from helpers import messages

from mqtable.options import SourceKey
from mqtable.session import scratch_path
from mqtable.sources import messagelog
from mqtable.streaming import capped

COLUMNS = ("source_index", "queue", "slot", "message_id", "batch_id")


def _publish(spark, log, batch_id, **queues):
    rows = [{"queue": q, "message_id": i} for q, ids in queues.items() for i in ids]
    messagelog.publish(spark, messages(spark, rows), log, batch_id)


def _delivered(spark, sink):
    schema = "source_index int, queue string, slot int, message_id long, batch_id long"
    return spark.read.schema(schema).option("basePath", sink).parquet(sink).select(*COLUMNS).collect()


def test_batches_of_a_trigger_keep_their_caps(spark):
    log, folder, sink = (scratch_path(spark, x) for x in ("c-log", "c-capped", "c-sink"))
    _publish(spark, log, 0, a=range(1, 41), b=range(101, 108))
    messagelog.ensure_dir(spark, sink)
    keys = [SourceKey("a", options={"maxMessagesPerPartition": "1"}), SourceKey("b"), SourceKey("a")]

    def stream():
        return capped.CappedStream(spark, log, folder, keys, {"maxMessagesPerPartition": "3", "levelParallelism": "2"}, slide_ms=1, catch_up=30)

    write, triggers, crashed = capped.trigger_writer(sink, *COLUMNS), [], []

    def crash_once(batch, trigger):
        triggers.append(trigger)
        if trigger == 1 and not crashed:
            crashed.append(trigger)
            batch.limit(1).select(*COLUMNS).write.mode("overwrite").parquet(f"{sink}/trigger={trigger}")
            raise RuntimeError("crash in the second trigger")
        write(batch, trigger)

    with pytest.raises(Exception, match="crash"):
        stream().drain(crash_once, timeout_s=120)
    # what the crashed trigger takes is settled, whatever is published meanwhile
    settled = [tuple(s) for s in stream().shares(1)]
    _publish(spark, log, 1, b=range(108, 113))
    assert [tuple(s) for s in stream().shares(1)] == settled
    stream().drain(crash_once, timeout_s=120)
    rows = _delivered(spark, sink)
    by = lambda i: sorted((r.message_id, r.slot, r.batch_id) for r in rows if r.source_index == i)
    assert by(0) == [(i + 1, i % 2, i // 2) for i in range(40)]
    assert by(2) == [(i + 1, i % 2, i // 2 // 3) for i in range(40)]
    assert [m for m, _, _ in by(1)] == list(range(101, 113))
    assert [b for m, _, b in by(1) if m < 108] == [i // 2 // 3 for i in range(7)]
    # twenty batches in few triggers, none of which takes more messages than it may
    assert max(triggers) < 6 and {r.batch_id for r in rows} == set(range(20))


def test_a_batch_is_planned_without_a_spark_job(spark):
    log, folder = scratch_path(spark, "c-log"), scratch_path(spark, "c-capped")
    _publish(spark, log, 0, a=range(1, 11))
    stream = capped.CappedStream(spark, log, folder, [SourceKey("a")], {"maxMessagesPerPartition": "2"})
    assert [(s.batch_id, s.done, s.n) for s in stream.shares(0)] == [(0, 0, 2)]
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        assert [stream.shares(t)[0][-2:] for t in range(1, 4)] == [(2, 2), (4, 2), (6, 2)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    # a new publish is seen by the next batch
    _publish(spark, log, 1, b=[50])
    _publish(spark, log, 2, a=[11])
    assert [[tuple(s[-2:]) for s in stream.shares(t)] for t in range(4, 7)] == [[(8, 2)], [(10, 1)], []]
    # another start finds the cursor in what is written
    again = capped.CappedStream(spark, log, folder, [SourceKey("a")], {"maxMessagesPerPartition": "2"})
    assert [tuple(s[-2:]) for s in again.shares(5)] == [(10, 1)] and again.shares(6) == []


def test_catch_up_is_positive(spark):
    with pytest.raises(ValueError):
        capped.CappedStream(spark, "x", "y", [SourceKey("a")], {}, catch_up=0)
