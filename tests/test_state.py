"""State that grows with gaps and pauses: distinct messages, leases, the acknowledgement ledger."""

import datetime as dt
import random

import pytest
from helpers import T0, messages
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_streaming import _reference_messages

from mqtable.operators import retention
from mqtable.session import scratch_path
from mqtable.sources import messagelog
from mqtable.streaming import acks, state


def _tagged(spark, rows):
    return spark.createDataFrame(rows, "queue string, delivery_tag long, attempt int")


def test_intervals_merge_and_gaps_stay(spark, monkeypatch):
    monkeypatch.setattr(state, "TAG_BUCKET", 100)
    folder = scratch_path(spark, "s-distinct")
    write = state.distinct_writer(folder)
    rnd = random.Random(5)
    tags = [("a", t) for t in range(1, 400) if t % 97] + [(None, t) for t in range(1, 40)]
    rnd.shuffle(tags)
    batches = [tags[i::5] for i in range(5)]
    for b, some in enumerate(batches):
        repeats = rnd.sample(tags[: 50 * (b + 1)], 30)
        rows = [(q, t, 2) for q, t in repeats] + [(q, t, a) for q, t in some for a in (1, 1, 3)]
        df = _tagged(spark, rows)
        write(df, b)
        if b == 2:
            write(df, b)  # a replayed batch replaces itself
    got = [tuple(r) for r in state.distinct_messages(spark, folder, df.schema).select("queue", "delivery_tag").collect()]
    assert sorted(got, key=str) == sorted(tags, key=str)  # none twice, none lost
    seen = spark.read.schema(state.SEEN_SCHEMA).parquet(f"{folder}/seen/batch_id=4").collect()
    # one interval per (queue, bucket) and one more per gap: not a row a message
    assert len(seen) == 1 + 4 + 4 and sum(r.hi - r.lo + 1 for r in seen) == len(tags)


def test_least_attempt_is_first(spark):
    rows = _tagged(spark, [("a", 1, 3), ("a", 1, 1), ("a", 2, 2), ("a", 5, 1)])
    seen = spark.createDataFrame([("a", 0, 4, 6)], state.SEEN_SCHEMA)
    assert sorted(tuple(r) for r in state.unseen(rows, seen).collect()) == [("a", 1, 1), ("a", 2, 2)]


def test_distinct_stream_over_restarts(spark):
    log, folder = scratch_path(spark, "s-log"), scratch_path(spark, "s-distinct")
    both = _reference_messages(spark, 60, "a").unionByName(_reference_messages(spark, 30, "b").withColumn("message_id", F.col("message_id") + 100))

    def run():
        one = messagelog.stream_log(spark, log, max_files_per_trigger=1)
        other = messagelog.stream_log(spark, log, max_files_per_trigger=3)
        twice = one.unionByName(other).select("queue", "delivery_tag", "message_id")
        q = twice.writeStream.foreachBatch(state.distinct_writer(folder)).option("checkpointLocation", f"{folder}/ck")
        q.trigger(availableNow=True).start().awaitTermination(120)
        return twice.schema

    messagelog.publish(spark, both.where("message_id % 2 = 0"), log, 0, 10)
    run()
    messagelog.publish(spark, both.where("message_id % 2 = 1"), log, 1, 10)
    schema = run()
    rows = [(r.queue, r.message_id) for r in state.distinct_messages(spark, folder, schema).collect()]
    assert sorted(rows) == sorted([("a", i) for i in range(1, 61)] + [("b", i) for i in range(101, 131)])


@pytest.mark.parametrize("gap", [1, 1_000, 7_500, None])
def test_leases_of_any_order(spark, gap):
    rnd = random.Random(gap)
    times = [0]
    for _ in range(300):
        times.append(times[-1] + rnd.choice([0, 1, 200, 999, 1_000, 1_001, 7_499, 7_500, 20_000]))
    rows = [{"message_id": i, "queue": rnd.choice(["hot"] * 8 + ["q", None]), "published_at": T0 + dt.timedelta(milliseconds=t)} for i, t in enumerate(times)]
    rnd.shuffle(rows)
    expires = F.lit(gap).cast("int")
    folder = scratch_path(spark, "s-leases")
    write = state.lease_writer(folder, expires)
    for b in range(4):
        df = messages(spark, rows[b::4])
        write(df, b)
        if b == 1:
            write(df, b)
    got = [tuple(r) for r in state.leases(spark, folder).collect()]
    want = [tuple(r) for r in retention.queue_leases(messages(spark, rows), expires).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = messagelog._fs(spark, f"{folder}/runs")
    assert len(kept[0].listStatus(kept[1])) == 2  # the state and the one before


def test_leases_close(spark):
    folder = scratch_path(spark, "s-leases")
    rows = [{"published_at": T0}, {"published_at": T0 + dt.timedelta(hours=3)}]
    state.lease_writer(folder, F.lit(3_600_000))(messages(spark, rows), 0)
    as_of = F.lit(str(T0 + dt.timedelta(hours=3, minutes=30))).cast("timestamp_ntz")
    assert sorted((r.lease_start, r.closed) for r in state.leases(spark, folder, as_of).collect()) == [
        (T0, True), (T0 + dt.timedelta(hours=3), False)
    ]


def test_lease_messages_are_not_dealt_by_queue_alone(spark):
    plan = state.activity(messages(spark, [{}]), F.lit(1000))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan and "slot" in plan.split("Exchange hashpartitioning(")[1][:60] or "_groupingexpression" in plan


def _poison():
    def handler(delivery):  # workers cannot import this file
        if int(delivery.text) % 10 == 0:
            raise ValueError("poison")
        return int(delivery.text)

    return handler


def test_ledger_of_ack_types(spark):
    log = scratch_path(spark, "s-log")
    messagelog.publish(spark, _reference_messages(spark, 40, "q"), log, 0, 15)
    want = {
        "auto": {(i, 1, "auto") for i in range(1, 41)},
        "basic": {(i, 3, "dead") if i % 10 == 0 else (i, 1, "acked") for i in range(1, 41)},
        "none": {(i, 1, "unacked") for i in range(1, 41)},
    }
    for kind, rows in want.items():
        folder = scratch_path(spark, "s-acks")
        done = acks.deliver(spark, log, folder, {"ackType": kind}, _poison(), T.LongType(), 3)
        assert {(r.delivery_tag, r.attempt, r.state) for r in done.collect()} == rows
        assert acks._changes(spark, folder).count() == 0  # all in the snapshot
    # later messages go on from there
    messagelog.publish(spark, _reference_messages(spark, 5, "q").withColumn("message_id", F.col("message_id") + 90), log, 1)
    done = acks.deliver(spark, log, folder, {"ackType": "none"}, _poison(), T.LongType(), 3)
    assert done.count() == 45


def test_ledger_after_a_crash(spark):
    """The retries were written, the changes were not; the batch runs again after a restart."""
    log, folder = scratch_path(spark, "s-log"), scratch_path(spark, "s-acks")
    messagelog.publish(spark, _reference_messages(spark, 20, "q"), log, 0, 5)
    from mqtable.options import QueueOptions
    from mqtable.streaming import redelivery

    write = acks.ack_writer(folder, QueueOptions({}), _poison(), T.LongType(), 3)
    crashed = []

    def crash_once(batch, batch_id):
        write(batch, batch_id)
        if not crashed:
            crashed.append(batch_id)
            messagelog._remove(spark, f"{folder}/changes/batch_id={batch_id}")
            raise RuntimeError("crash")

    with pytest.raises(Exception, match="crash"):
        redelivery.drain_retries(spark, log, f"{folder}/retry", f"{folder}/checkpoint", crash_once)
    done = acks.deliver(spark, log, folder, {}, _poison(), T.LongType(), 3)
    assert {(r.delivery_tag, r.attempt, r.state) for r in done.collect()} == {
        (i, 3, "dead") if i % 10 == 0 else (i, 1, "acked") for i in range(1, 21)
    }


def test_late_changes_do_not_win(spark):
    folder = scratch_path(spark, "s-acks")
    for b, rows in enumerate([[("q", 1, 2, "acked")], [("q", 1, 1, "requeued"), ("q", 2, 1, "acked")], [("q", 3, 1, "acked")]]):
        spark.createDataFrame(rows, acks.CHANGE_SCHEMA).write.parquet(f"{folder}/changes/batch_id={b}")
    want = [("q", 1, 2, "acked"), ("q", 2, 1, "acked"), ("q", 3, 1, "acked")]
    for upto in (None, 0, 1, 1, 2):
        if upto is not None:
            acks.compact(spark, folder, upto)
        assert sorted(tuple(r) for r in acks.ledger(spark, folder).collect()) == want
