"""Length limits that cut through one busy instant: split by quantile bounds, same rows."""

import datetime as dt
import random

import pytest
from helpers import T0, messages
from pyspark.sql import functions as F

from mqtable.operators import ordering, retention

LIMIT, BYTES = 170, 900


def _busy(spark, at, n=400, seed=3):
    rng = random.Random(seed)
    rows = [
        {"message_id": i, "delivery_tag": i + 1, "queue": rng.choice(["hot", "hot", "small"]), "body": "x" * rng.randrange(9),
         "published_at": T0 + dt.timedelta(microseconds=at(rng))}
        for i in range(n)
    ]
    rng.shuffle(rows)
    return messages(spark, rows)


TIMES = {
    "one instant": lambda rng: 0,
    "a hot instant among others": lambda rng: 500 if rng.random() < 0.6 else rng.randrange(1000),
    "spread": lambda rng: rng.randrange(10**6),
    "several seconds": lambda rng: rng.choice([0, 0, 0, 900_000, 1_500_000, 2_000_000]),
}


@pytest.mark.parametrize("at", TIMES.values(), ids=TIMES)
def test_a_hot_second_gives_the_same_rows(spark, at):
    m = _busy(spark, at)
    pdf = m.toPandas().sort_values(["queue", "published_at", "delivery_tag"], ascending=[True, False, False])
    pdf["rn"] = pdf.groupby("queue").cumcount() + 1
    pdf["cb"] = pdf.body.map(len).groupby(pdf.queue).cumsum()
    for keep in (True, False):
        by_count = retention.max_length(m, LIMIT, keep, target_rows=20).select("message_id").toPandas()
        by_bytes = retention.max_length_bytes(m, BYTES, keep, target_rows=20).select("message_id").toPandas()
        assert sorted(by_count.message_id) == sorted(pdf[(pdf.rn <= LIMIT) == keep].message_id)
        assert sorted(by_bytes.message_id) == sorted(pdf[(pdf.cb <= BYTES) == keep].message_id)


def test_two_limits_that_cut_in_different_seconds(spark):
    m = _busy(spark, TIMES["several seconds"])
    policies = spark.createDataFrame(
        [("hot", None, 60, 800, "dlx", None)],
        "queue string, message_ttl_ms long, max_length long, max_length_bytes long, dead_letter_exchange string, dead_letter_routing_key string",
    )
    pdf = m.where("queue = 'hot'").toPandas().sort_values(["published_at", "delivery_tag"], ascending=False)
    gone = pdf[(pdf.assign(n=1).n.cumsum() > 60) | (pdf.body.map(len).cumsum() > 800)]
    for target in (1, 45, 1000):
        dead = retention.dead_lettered(m, policies, target_rows=target).select("message_id").toPandas()
        assert sorted(dead.message_id) == sorted(gone.message_id)


@pytest.mark.parametrize("at", [TIMES["one instant"], TIMES["a hot instant among others"]], ids=["one instant", "mixed"])
def test_no_part_holds_much_of_a_hot_second(spark, at):
    rows = spark.createDataFrame(
        [(0, at(random.Random(i)), i, 1, 0) for i in range(6000)], "__bk long, __t long, __i long, __w0 long, __before0 long"
    )
    parts = ordering._newest_parts(rows, rows, ["__bk"], ["__w0"])
    sizes = [r.n for r in parts.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 6000 * 0.03
