"""The topic index: few candidates beyond the matches, and the same matches as word by word."""

import random

import pytest
from pyspark.sql import functions as F

from mqtable.functions.topic import word_match
from mqtable.operators import routing
from mqtable.schema import BINDING_SCHEMA


def _keys(spark, keys):
    return spark.createDataFrame([("ex", k) for k in keys], "exchange string, routing_key string")


def _bound(spark, patterns):
    return spark.createDataFrame([(f"q{i}", "ex", "topic", p) for i, p in enumerate(patterns)], BINDING_SCHEMA)


@pytest.mark.parametrize("shape", ["*.b{}.*", "#.w{}.#", "a.#.w{}", "w{}.#", "*.*.w{}.#.c"])
def test_candidates_are_few(spark, shape):
    literal = shape.replace("#", "x").replace("*", "y")
    keys = _keys(spark, [literal.format(i) for i in range(200)])
    bound = _bound(spark, [shape.format(i) for i in range(200)])
    assert routing._candidates(keys, bound).count() <= 220
    assert routing.resolve_routes(keys, bound).count() == 200


def test_common_words_are_not_looked_up(spark):
    """A word that every key has is passed over for a rarer one."""
    keys = _keys(spark, [f"events.k{i}.u{i % 4}" for i in range(100)])
    bound = _bound(spark, [f"events.k{i}.*" for i in range(100)] + [f"events.#.k{i}.#" for i in range(100)] + ["events.nothing.#"])
    assert routing._candidates(keys, bound).count() == 200


def test_matches_equal_word_by_word(spark):
    rnd = random.Random(8)
    words = ["a", "b", "", "c d", "1", "a.b"]
    keys = sorted({".".join(rnd.choice(words) for _ in range(rnd.randrange(6))) for _ in range(120)})
    patterns = sorted({".".join(rnd.choice([*words, "*", "#", "#"]) for _ in range(rnd.randrange(6))) for _ in range(160)})
    got = routing.resolve_routes(_keys(spark, [*keys, None]), _bound(spark, patterns)).collect()
    want = {(k, f"q{i}") for k in keys for i, p in enumerate(patterns) if word_match(p, k)}
    assert {(r.routing_key, r.bound_queue) for r in got} == want and len(got) == len(want)


def test_all_types_at_once(spark):
    rows = [("d", "ex", "direct", "a.b"), ("f", "ex", "fanout", None), ("t", "ex", "topic", "a.*"), ("t", "ex", "topic", "#.b"), ("n", "ex", "topic", None), ("d", "ex", "direct", None)]
    found = routing.resolve_routes(_keys(spark, ["a.b", "a", None, ""]), spark.createDataFrame(rows, BINDING_SCHEMA))
    assert {(r.routing_key, r.bound_queue) for r in found.collect()} == {
        ("a.b", "d"), ("a.b", "t"), *((k, "f") for k in ("a.b", "a", None, ""))
    }


def test_unknown_type(spark):
    bad = _bound(spark, ["a"]).withColumn("exchange_type", F.lit("headers"))
    with pytest.raises(routing.TopologyError):
        routing.resolve_routes(_keys(spark, ["a"]), bad)
