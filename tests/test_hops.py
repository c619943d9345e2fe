"""Dead letters that pass through several queues: a chain, a cycle, queues that nothing enters."""

import datetime as dt

from helpers import T0, messages
from pyspark.sql import functions as F

from mqtable.operators import retention
from mqtable.schema import BINDING_SCHEMA, POLICY_SCHEMA


def _hops(spark, rows, policies, bindings, as_of=T0 + dt.timedelta(days=1)):
    p = spark.createDataFrame([(q, n, ttl, None, None, dlx, key, None) for q, n, ttl, dlx, key in policies], POLICY_SCHEMA)
    b = spark.createDataFrame([(q, "dlx", "direct", key) for q, key in bindings], BINDING_SCHEMA)
    found = retention.dead_letter_hops(messages(spark, rows), p, b, F.lit(str(as_of)).cast("timestamp_ntz"))
    return sorted(tuple(r) for r in found.collect())


def test_chain_and_cycle(spark):
    policies = [("a", 2, None, "dlx", "b"), ("b", 1, None, "dlx", "c"), ("c", 0, None, "dlx", "a"), ("z", 0, None, None, None)]
    rows = [{"queue": "a"} for _ in range(5)] + [{"queue": "z"}]
    got = _hops(spark, rows, policies, [("b", "b"), ("c", "c"), ("a", "a")])
    # a keeps 3 and 4, b keeps 2, c keeps none, and a has had them before
    want = [(i, 0, "a", "maxlen", "b", False) for i in (0, 1, 2)] + [(5, 0, "z", "maxlen", None, False)]
    want += [(i, 1, "b", "maxlen", "c", False) for i in (0, 1)] + [(i, 2, "c", "maxlen", "a", True) for i in (0, 1)]
    assert got == sorted(want)


def test_entering_messages_push_out_those_there(spark):
    # b holds an old message; a's dead letter is newer and takes its place
    rows = [{"queue": "b", "published_at": T0}, *({"queue": "a", "published_at": T0 + dt.timedelta(hours=h)} for h in (1, 2))]
    got = _hops(spark, rows, [("a", 1, None, "dlx", "b"), ("b", 1, None, "dlx", "none")], [("b", "b")])
    assert got == [(0, 1, "b", "maxlen", None, False), (1, 0, "a", "maxlen", "b", False)]


def test_expired_messages_start_anew(spark):
    # an hour in a, then ten hours in b: expired there too at the end of the day; half a day in c is not over
    hour = 3_600_000
    policies = [("a", None, hour, "dlx", "b"), ("b", None, 10 * hour, "dlx", "c"), ("c", None, 14 * hour, "dlx", "a")]
    got = _hops(spark, [{"queue": "a"}], policies, [("b", "b"), ("c", "c"), ("a", "a")])
    assert got == [(0, 0, "a", "expired", "b", False), (0, 1, "b", "expired", "c", False)]


def test_nothing_moves(spark):
    assert _hops(spark, [{"queue": "a"}, {"queue": None}], [("a", 5, None, "dlx", "b")], [("b", "b")]) == []
