"""Skew-proof helpers equal their brute-force definitions; conservation laws hold."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import T0, messages
from mqtable.functions.time import floor_div
from mqtable.operators import admission, handler, ordering, retention


def _random_messages(spark, n, seed, queues=("a", "b", "c"), skew=0.6):
    rnd = random.Random(seed)
    rows, tags = [], {}
    t = T0
    for i in range(n):
        q = queues[0] if rnd.random() < skew else rnd.choice(queues)
        tags[q] = tags.get(q, 0) + 1
        t = t + dt.timedelta(minutes=rnd.choice([0, 1, 5, 30, 61, 200]))
        body = rnd.choice(['{"k": 1}', "x" * rnd.randint(0, 40), None, "{bad"])
        rows.append({"message_id": i, "queue": q, "delivery_tag": tags[q], "published_at": t, "body": body,
                     "priority": rnd.choice([None, 0, 3, 7])})
    return messages(spark, rows)


@pytest.fixture(params=["broadcast", "shuffle"])
def side_path(request, spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    if request.param == "shuffle":
        spark.conf.set(key, "-1")
    yield request.param
    spark.conf.set(key, before)


@pytest.mark.parametrize("seed", [1, 2])
def test_ordinal_equals_row_number(spark, seed):
    m = _random_messages(spark, 300, seed).drop("delivery_tag")
    got = ordering.ordinal(m, ["queue"], [F.col("message_id")], [floor_div("message_id", F.lit(7))], "tag")
    pdf = m.toPandas()
    pdf["want"] = pdf.sort_values("message_id").groupby("queue").cumcount() + 1
    merged = got.toPandas().merge(pdf[["message_id", "want"]], on="message_id")
    assert len(merged) == 300 and (merged.tag == merged.want).all()


def test_ordinal_max_rank(spark):
    m = _random_messages(spark, 200, 3).drop("delivery_tag")
    got = ordering.ordinal(m, ["queue"], [F.col("message_id")], [floor_div("message_id", F.lit(5))], "tag", max_rank=4)
    counts = {r.queue: r.n for r in got.groupBy("queue").agg(F.count("*").alias("n")).collect()}
    assert all(v == 4 for v in counts.values())
    assert got.agg(F.max("tag")).first()[0] == 4


@pytest.mark.parametrize("seed", [4, 5])
def test_newest_within_equals_running_sum(spark, seed, side_path):
    m = _random_messages(spark, 250, seed)
    limit = 15
    byte_limit = 120
    kept = retention.max_length(m, limit, bucket_us=3_600_000_000).select("message_id").toPandas()
    kept_b = retention.max_length_bytes(m, byte_limit, bucket_us=3_600_000_000).select("message_id").toPandas()
    pdf = m.toPandas()
    pdf["bytes"] = pdf.body.map(lambda b: 0 if b is None else len(b))
    pdf = pdf.sort_values(["queue", "published_at", "delivery_tag"], ascending=[True, False, False])
    pdf["rn"] = pdf.groupby("queue").cumcount() + 1
    pdf["cb"] = pdf.groupby("queue")["bytes"].cumsum()
    assert set(kept.message_id) == set(pdf[pdf.rn <= limit].message_id)
    assert set(kept_b.message_id) == set(pdf[pdf.cb <= byte_limit].message_id)
    dropped = retention.max_length(m, limit, keep=False, bucket_us=3_600_000_000).count()
    assert dropped + len(kept) == 250  # kept + dead = all


@pytest.fixture(params=[None, 3])
def chunk_target(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(ordering, "CHUNK_TARGET_ROWS", request.param)  # split every busy interval
    return request.param


@pytest.mark.parametrize("seed", [6, 7])
def test_gap_sessions_equal_lag_form(spark, seed, side_path, chunk_target):
    m = _random_messages(spark, 200, seed)
    got = retention.queue_leases(m, 60 * 60_000, chunk_us=4 * 3_600_000_000).toPandas()
    pdf = m.toPandas().sort_values(["queue", "published_at", "message_id"])
    pdf["prev"] = pdf.groupby("queue").published_at.shift()
    pdf["start"] = pdf.prev.isna() | ((pdf.published_at - pdf.prev) >= pd.Timedelta(hours=1))
    pdf["sid"] = pdf.groupby("queue").start.cumsum()
    want = pdf.groupby(["queue", "sid"]).agg(lease_start=("published_at", "min"), n=("message_id", "count")).reset_index()
    a = sorted(zip(got.queue, pd.to_datetime(got.lease_start), got.n))
    b = sorted(zip(want.queue, pd.to_datetime(want.lease_start), want.n))
    assert a == b


def test_time_chunks_bounded_and_monotone(spark):
    m = _random_messages(spark, 400, 10, skew=0.9)
    from mqtable.functions.time import epoch_micros

    c, cols = ordering.time_chunks(
        m, ["queue"], epoch_micros("published_at"), 24 * 3_600_000_000, "ck", target_rows=20, tiebreak=F.col("message_id")
    )
    pdf = c.toPandas().sort_values(["queue", "published_at", "message_id"])
    for q, grp in pdf.groupby("queue"):
        ks = list(zip(*[grp[x] for x in cols]))
        assert ks == sorted(ks)  # grows with time
    sizes = pdf.groupby(["queue", *cols]).size()
    assert len(sizes) > 20 and sizes.max() <= 20  # hot days were split, ties by message id


def test_value_chunks_sparse_ids(spark):
    rnd = random.Random(11)
    ids = rnd.sample(range(0, 2**50), 500) + list(range(10**12, 10**12 + 300))  # sparse + one dense cluster
    df = spark.createDataFrame([(i, "q" if k % 4 else "r") for k, i in enumerate(ids)], "id long, g string")
    chunked, cols = ordering.value_chunks(df, ["g"], F.col("id"), "ck", target_rows=50)
    c = chunked.toPandas().sort_values(["g", "id"])
    for g, grp in c.groupby("g"):
        ks = list(zip(*[grp[x] for x in cols]))
        assert ks == sorted(ks)  # monotone in the value
    sizes = c.groupby(["g", *cols]).size()
    assert sizes.max() <= 100 and len(sizes) <= len(ids) // 3  # bounded rows per chunk, far fewer chunks than rows
    ranked = ordering.ordinal(chunked, ["g"], [F.col("id")], [F.col(x) for x in cols], "pos").toPandas()
    ranked["want"] = ranked.sort_values("id").groupby("g").cumcount() + 1
    assert (ranked.pos == ranked.want).all()


def test_priority_positions_equal_window(spark):
    m = admission.with_batch(_random_messages(spark, 150, 8), 86_400_000)
    got = retention.priority_positions(m, 5).select("message_id", "pos").toPandas()
    pdf = m.toPandas()
    pdf["eff"] = pdf.priority.fillna(0).clip(upper=5)
    pdf = pdf.sort_values(["batch_id", "queue", "eff", "delivery_tag"], ascending=[True, True, False, True])
    pdf["want"] = pdf.groupby(["batch_id", "queue"]).cumcount() + 1
    merged = got.merge(pdf[["message_id", "want"]], on="message_id")
    assert (merged.pos == merged.want).all() and len(merged) == 150


def test_conservation(spark):
    m = _random_messages(spark, 300, 9)
    out = handler.split_outcomes(handler.handle_json(m))
    n_ok = out.where(F.col("outcome") == "ok").count()
    n_failed = out.where(F.col("outcome") == "failed").count()
    assert n_ok + n_failed == 300  # ok + failed = all
    b = admission.per_batch(admission.with_batch(m, 3_600_000))
    cap = 2
    rows = admission.backlog(b, cap).orderBy("batch_id").collect()
    level = 0
    for r in rows:  # iterative definition
        level = max(0, level + r.n - cap)
        assert r.backlog == level
    arrived = sum(r.n for r in rows)
    served = sum(min(cap, (rows[i - 1].backlog if i else 0) + r.n) for i, r in enumerate(rows))
    assert served + rows[-1].backlog == arrived  # admitted + backlog = arrived
    capped = admission.cap_per_partition(m, 2, 3, 3_600_000)
    per = capped.groupBy("batch_id", "queue", "slot").count().agg(F.max("count")).first()[0]
    assert per <= 3  # caps never exceeded


def test_routing_same_on_both_join_paths(spark, side_path):
    from mqtable.operators import routing
    from mqtable.schema import BINDING_SCHEMA

    rnd = random.Random(12)
    keys = ["a.b", "a.x.b", "hot.key", "", "c"] + [f"k{i}.b" for i in range(20)]
    m = messages(spark, [{"routing_key": "hot.key" if rnd.random() < 0.4 else rnd.choice(keys)} for _ in range(300)])
    b = spark.createDataFrame(
        [("q1", "ex", "topic", "#.b"), ("q2", "ex", "topic", "hot.*"), ("q3", "ex", "direct", "c"), ("q1", "ex", "topic", "a.#")],
        BINDING_SCHEMA,
    )
    from mqtable.functions.topic import word_match

    pats = {"q1": ["#.b", "a.#"], "q2": ["hot.*"]}
    want = set()
    for r in m.collect():
        for q, ps in pats.items():
            if any(word_match(p, r.routing_key) for p in ps):
                want.add((q, r.message_id))
        if r.routing_key == "c":
            want.add(("q3", r.message_id))
    got = {(r.bound_queue, r.message_id) for r in routing.route(m, b).collect()}
    assert got == want
    unrouted = {r.message_id for r in routing.unroutable(m, b).collect()}
    assert unrouted == {r.message_id for r in m.collect()} - {mid for _, mid in want}


def test_equal_timestamps_are_split_by_the_tiebreak(spark):
    from mqtable.functions.time import epoch_micros

    m = messages(spark, [{"message_id": i, "published_at": T0} for i in range(1000)])
    c, cols = ordering.time_chunks(m, ["queue"], epoch_micros("published_at"), 3_600_000_000, "ck", 10, F.col("message_id"))
    pdf = c.toPandas().sort_values("message_id")
    assert pdf.groupby(cols).size().max() <= 10
    keys = list(zip(*[pdf[x] for x in cols]))
    assert keys == sorted(keys)
