"""Hand-made edge tables (malformed bodies, corner patterns, empty sources, ...)."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import T0, messages
from mqtable.operators import admission, counting, delivery, handler, retention, routing
from mqtable.schema import BINDING_SCHEMA, POLICY_SCHEMA, SOURCE_SCHEMA


def test_decode_malformed_utf8(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),), (bytearray(b""),), (None,)], "body binary")
    from mqtable.functions.text import decode_body

    got = [r[0] for r in df.select(decode_body("body")).collect()]
    assert got == ["a�b", "", None]


def test_json_handler_outcomes(spark):
    m = messages(spark, [{"body": b} for b in ['{"k": 5}', "{bad", "", None, '{"k": "x"}', '{"j": 1}', '{"k": null}']])
    rows = handler.split_outcomes(handler.handle_json(m)).orderBy("message_id").select("k", "outcome").collect()
    assert [(r.k, r.outcome) for r in rows] == [
        (5, "ok"),
        (None, "failed"),
        (None, "failed"),
        (None, "ok"),  # no body: nothing to handle
        (None, "failed"),
        (None, "failed"),
        (None, "ok"),  # a null result is a success
    ]


def test_udf_handler_matches_builtin(spark):
    m = messages(spark, [{"body": b} for b in ['{"k": 5}', "{bad", "", None, '{"k": 7}']])
    a = {r.message_id: r.k for r in handler.handle_udf(m).collect()}
    b = {r.message_id: r.k for r in handler.handle_json(m).collect()}
    assert a == b


def test_header_lookup_null_safe(spark):
    m = messages(spark, [{"headers": {"user": "7"}}, {"headers": None}, {"headers": {"other": "1"}}])
    got = [r[1] for r in handler.header_lookup(m, "user").orderBy("message_id").collect()]
    assert got == ["7", None, None]


def _bind(spark, rows):
    return spark.createDataFrame(rows, BINDING_SCHEMA)


def test_topic_routing_corner_patterns(spark):
    keys = ["", "a", "a.b", "a.x.b", "a.x.y.b"]
    pats = ["#", "*", "a.#.b", "#.b", "a.#", "", "#.#"]
    m = messages(spark, [{"routing_key": k} for k in keys])
    b = _bind(spark, [(f"q{i}", "ex", "topic", p) for i, p in enumerate(pats)])
    got = {(r.bound_queue, r.message_id) for r in routing.route(m, b).collect()}
    from mqtable.functions.topic import word_match

    want = {(f"q{i}", j) for i, p in enumerate(pats) for j, k in enumerate(keys) if word_match(p, k)}
    assert got == want


def test_overlapping_bindings_deliver_once(spark):
    m = messages(spark, [{"routing_key": "a.b"}])
    b = _bind(spark, [("q", "ex", "topic", "a.*"), ("q", "ex", "topic", "#.b")])
    assert routing.route(m, b).count() == 1


def test_direct_and_fanout_and_unroutable(spark):
    m = messages(spark, [{"routing_key": "k1"}, {"routing_key": "k2"}, {"routing_key": None}])
    direct = _bind(spark, [("d", "ex", "direct", "k1")])
    assert [r.message_id for r in routing.route(m, direct).collect()] == [0]
    fan = _bind(spark, [("f", "ex", "fanout", "ignored")])
    assert routing.route(m, fan).count() == 3
    assert sorted(r.message_id for r in routing.unroutable(m, direct).collect()) == [1, 2]
    other_exchange = _bind(spark, [("f", "elsewhere", "fanout", "x")])
    assert routing.route(m, other_exchange).count() == 0


def test_topology_needs_exchange_and_type(spark):
    s = spark.createDataFrame(
        [
            (0, "a", "ex", "topic", "x, y", {}),
            (1, "b", "ex", None, "z", {}),
            (2, "c", None, None, None, {}),
            (3, "d", "ex", "topic", None, {}),
        ],
        SOURCE_SCHEMA,
    )
    rows = routing.topology_bindings(s).collect()
    assert sorted(r.routing_key for r in rows) == [" y", "x"]  # split, not trimmed
    import pytest

    with pytest.raises(routing.TopologyError):
        routing.topology_bindings(s, strict=True)


def test_no_sources_and_empty_source(spark):
    m = messages(spark, [{"queue": "q"}])
    none = spark.createDataFrame([], SOURCE_SCHEMA)
    assert counting.count_by_source(m, none).count() == 0
    s = spark.createDataFrame([(0, "q", None, None, None, {}), (1, "idle", None, None, None, {})], SOURCE_SCHEMA)
    got = {r.queue: r.empty for r in counting.is_empty_by_source(m, s).collect()}
    assert got == {"q": False, "idle": True}
    plan = admission.partition_plan(none)
    assert plan.count() == 0


def test_partition_plan_indexes(spark):
    s = spark.createDataFrame(
        [(0, "a", None, None, None, {}), (1, "b", None, None, None, {"levelParallelism": "3"})], SOURCE_SCHEMA
    )
    rows = admission.partition_plan(s, stream_parallelism=1).orderBy("partition_index").collect()
    assert [(r.partition_index, r.queue, r.slot) for r in rows] == [(0, "a", 0), (1, "b", 0)]  # the stream's parallelism holds
    same = admission.partition_plan(
        spark.createDataFrame([(0, "a", None, None, None, {}), (1, "b", None, None, None, {})], SOURCE_SCHEMA), 2
    )
    assert sorted((r.partition_index, r.queue, r.slot) for r in same.collect()) == [
        (0, "a", 0), (1, "a", 1), (2, "b", 0), (3, "b", 1)
    ]


def test_receive_window_batches(spark):
    ts = [T0 + dt.timedelta(milliseconds=x) for x in (0, 899, 900, 999, 1000, 1899, 1900)]
    m = messages(spark, [{"published_at": t} for t in ts])
    def batches(receive):
        return [r.batch_id - 1704067200 for r in admission.with_batch(m, 1000, receive).orderBy("message_id").collect()]
    assert batches(900) == [0, 0, 1, 1, 1, 1, 2]
    assert batches(1000) == [0, 0, 0, 0, 1, 1, 1]
    assert batches(5000) == batches(1000)  # larger than the slide is clamped
    assert batches(0) == batches(1)  # at least 1 ms


def test_cap_zero_and_slots(spark):
    m = messages(spark, [{} for _ in range(10)])
    assert admission.cap_per_partition(m, 1, 0, 3_600_000).count() == 0
    three = {r.slot: r.n for r in admission.balanced_slots(m, 3).collect()}
    assert three == {0: 4, 1: 3, 2: 3}
    assert admission.cap_per_partition(m, 3, 2, 3_600_000).count() == 6


def test_ttl_zero_expires_everything_but_nothing_newer(spark):
    m = messages(spark, [{} for _ in range(5)])
    assert retention.ttl_live(m, 0).count() == 0
    assert retention.ttl_live(m, 10_000).count() == 5


def test_ack_types(spark):
    m = messages(spark, [{"body": '{"k": 1}'}, {"body": "{bad"}])
    out = handler.split_outcomes(handler.handle_json(m))
    got = {(r.ack_type, r.disposition): r.n for r in delivery.ack_dispositions(out, ["auto", "basic", "other"]).collect()}
    assert got == {("auto", "auto"): 2, ("basic", "acked"): 1, ("basic", "requeued"): 1, ("other", "unacked"): 2}


def test_dedupe_repeated_deliveries(spark):
    m = messages(spark, [{"fail_count": 0}, {"fail_count": 1}, {"fail_count": 2}, {"fail_count": 99}])
    d = delivery.redeliveries(m, 5)
    assert d.count() == 1 + 2 + 3 + 5
    once = delivery.dedupe_latest(d)
    assert once.count() == 4
    assert delivery.dedupe_latest(once.withColumn("x", F.lit(1))).count() == 4  # idempotent


def test_dead_letter_reasons(spark):
    m = messages(spark, [{"queue": "a"} for _ in range(5)] + [{"queue": "b", "body": "x" * 10} for _ in range(3)])
    pol = spark.createDataFrame(
        [("a", 2, None, None, None, "dlx", "dead", None), ("b", None, None, None, 15, None, None, None)], POLICY_SCHEMA
    )
    dead = retention.dead_lettered(m, pol).collect()
    assert sorted(r.message_id for r in dead) == [0, 1, 2]
    assert {r.reason for r in dead} == {"maxlen"} and {r.exchange for r in dead} == {"dlx"}
    assert {r.routing_key for r in dead} == {"dead"}


def test_queue_lease_gap_boundary(spark):
    ts = [T0, T0 + dt.timedelta(minutes=59), T0 + dt.timedelta(minutes=118), T0 + dt.timedelta(minutes=200)]
    m = messages(spark, [{"published_at": t} for t in ts])
    rows = retention.queue_leases(m, 3_600_000, chunk_us=3_600_000_000).orderBy("lease_start").collect()
    assert [r.n for r in rows] == [3, 1]
    exact = messages(spark, [{"published_at": T0}, {"published_at": T0 + dt.timedelta(hours=1)}])
    assert retention.queue_leases(exact, 3_600_000).count() == 2  # a gap of exactly `expires` ends the lease


def test_count_approx_exact_when_counted(spark):
    m = messages(spark, [{"queue": "q"} for _ in range(40)])
    counted = counting.count_by_source(m, spark.createDataFrame([(0, "q", None, None, None, {})], SOURCE_SCHEMA))
    r = counting.count_approx(m, counted=counted).first()
    assert (r.mean, r.low, r.high) == (40, 40, 40)
    est = counting.count_approx(m).first()
    assert est.mean == 40 and est.low < 40 < est.high


def test_persist_batch_levels(spark):
    from mqtable.options import QueueOptions
    from mqtable.streaming.consumer import persist_batch

    df = spark.range(5)
    for level in ["NONE", "MEMORY_ONLY_SER", "MEMORY_AND_DISK_SER_2", "DISK_ONLY"]:
        kept = persist_batch(df, QueueOptions({"storageLevel": level}))
        assert kept.storageLevel.useMemory or kept.storageLevel.useDisk
        kept.unpersist()


def test_observed_count_memo(spark):
    m = messages(spark, [{} for _ in range(7)])
    observed, obs = counting.observe_count(m, "memo")
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["n"] == 7


def test_per_batch_empty_and_gaps(spark):
    empty = messages(spark, [{}]).where("false")
    assert admission.per_batch(admission.with_batch(empty, 1000)).count() == 0
    ts = [T0, T0 + dt.timedelta(seconds=5)]
    m = admission.with_batch(messages(spark, [{"published_at": t} for t in ts]), 1000)
    assert [r.n for r in admission.per_batch(m).orderBy("batch_id").collect()] == [1, 0, 0, 0, 0, 1]


def test_trailing_commas_and_gaps_between_batches(spark):
    s = spark.createDataFrame([(0, "a", "ex", "topic", "x,,y,,", {}), (1, "b", "ex", "topic", "", {}), (2, "c", "ex", "topic", ",", {})], SOURCE_SCHEMA)
    got = sorted((r.queue, r.routing_key) for r in routing.topology_bindings(s).collect())
    assert got == [("a", ""), ("a", "x"), ("a", "y"), ("b", "")]
    far = messages(spark, [{"published_at": T0}, {"published_at": T0 + dt.timedelta(days=11574)}])
    busy = admission.busy_batches(admission.with_batch(far, 1)).orderBy("batch_id").collect()
    assert [(r.n, r.gap) for r in busy] == [(1, 0), (1, 11574 * 86_400_000 - 1)]


def test_patterns_share_few_tokens_and_match_exactly(spark):
    from mqtable.functions.topic import word_match

    patterns = ["", "#", "*", "a.b", "a.#", "#.b", "*.#", "#.*.b.#", "a.*.b", "#.#", "x-y.#.é+", "a..b"]
    keys = ["", "a", "b", "a.b", "a.x.b", "a..b", "x-y.é+", "x-y.q.é+", ".", "a."]
    b = _bind(spark, [(f"q{i}", "ex", "topic", p) for i, p in enumerate(patterns)] + [("null", "ex", "topic", None)])
    m = messages(spark, [{"routing_key": k} for k in keys])
    got = {(r.bound_queue, r.message_id) for r in routing.route(m, b).collect()}
    assert got == {(f"q{i}", j) for i, p in enumerate(patterns) for j, k in enumerate(keys) if word_match(p, k)}
