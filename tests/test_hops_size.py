"""What several hops of dead letters write and read, and the rows that budgets drop as a flag."""

import datetime as dt
import pathlib
import random

from helpers import T0, messages
from pyspark.sql import functions as F

from mqtable.functions.time import epoch_micros, floor_div
from mqtable.operators import ordering, retention
from mqtable.schema import BINDING_SCHEMA, POLICY_SCHEMA


def test_hops_keep_what_may_be_looked_at_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(retention, "scratch_path", lambda spark, label: str(tmp_path / label))
    policies = [("a", 2, None, None, None, "dlx", "b", None), ("b", 1, None, None, None, "dlx", "none", None), ("z", 3, None, None, None, None, None, None)]
    rows = [{"queue": q, "body": "x" * 5000} for q in "aaaaazzzzbb"]
    p, b = spark.createDataFrame(policies, POLICY_SCHEMA), spark.createDataFrame([("b", "dlx", "direct", "b")], BINDING_SCHEMA)
    got = retention.dead_letter_hops(messages(spark, rows), p, b, F.lit(str(T0)).cast("timestamp_ntz"))
    want = [(0, 0, "a", "b"), (1, 0, "a", "b"), (2, 0, "a", "b"), (5, 0, "z", None), (9, 0, "b", None), (0, 1, "b", None), (1, 1, "b", None), (2, 1, "b", None)]
    assert sorted((r.message_id, r.hop, r.queue, r.to_queue or "") for r in got.collect()) == sorted((*w[:3], w[3] or "") for w in want)
    written = {f.name: spark.read.parquet(str(f)) for f in pathlib.Path(tmp_path / "dead-letter-hops").iterdir()}
    # no binding names a or z: what stays there is not carried along
    stayed = [df for name, df in written.items() if name.startswith("stayed-")]
    assert stayed and all({r.queue for r in df.select("queue").collect()} <= {"b"} for df in stayed)
    assert not [name for name, df in written.items() if "body" in df.columns]


def test_rows_beyond_budgets(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        at = None if rng.random() < 0.05 else T0 + dt.timedelta(microseconds=rng.choice([0, 7, 400_000, rng.randrange(4_000_000)]))
        rows.append({"message_id": i, "queue": rng.choice(["a", "a", "a", "b", "c", "d", None]), "body": "x" * rng.randrange(4), "published_at": at})
    limits = spark.createDataFrame([("a", 250, 300), ("b", None, 60), ("c", 0, None), ("d", None, None), (None, 40, None)], "queue string, n int, bytes int")
    df = ordering.join_on(messages(spark, rows), limits, ["queue"]).withColumn("size", F.octet_length("body")).cache()
    newest = [F.col("published_at").desc(), F.col("message_id").desc()]
    numbers = [epoch_micros("published_at"), F.col("message_id")]
    budgets = [(F.lit(1), F.col("n")), (F.col("size"), F.col("bytes"))]
    bucket = floor_div(epoch_micros("published_at"), F.lit(1_000_000))
    ids = lambda d: sorted(r.message_id for r in d.select("message_id").collect())
    for some in (budgets, budgets[:1], budgets[1:]):
        want = ids(ordering.newest_within(df, ["queue"], bucket, newest, some, keep=False))
        for target in (None, 10):
            found = ordering.beyond_budgets(df, ["queue"], bucket, newest, some, "over", numbers, lambda d: d.cache(), target)
            assert found.count() == len(rows) and set(found.columns) == {*df.columns, "over"}
            assert ids(found.where("over")) == want, target
    df.unpersist()
