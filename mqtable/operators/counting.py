"""Batch counting."""

from __future__ import annotations

import math
import uuid
from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mqtable.operators.ordering import join_on


def count_by_source(m: DataFrame, sources: DataFrame) -> DataFrame:
    """A1: messages per source queue; a source without messages counts 0."""
    counts = m.groupBy("queue").agg(F.count(F.lit(1)).alias("n"))
    return join_on(sources.select("queue").distinct(), counts, ["queue"], how="left").select(
        "queue", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def observe_count(batch: DataFrame, name: str = "batch"):
    """A1 memo: ``(observed_df, observation)``; after the first action on
    ``observed_df`` (e.g. the sink write), ``observation.get["n"]`` is the batch
    count without a second pass over the data."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return batch.observe(obs, F.count(F.lit(1)).alias("n")), obs


def is_empty_by_source(m: DataFrame, sources: DataFrame) -> DataFrame:
    """A3: whether each source has nothing to deliver; no message is counted."""
    present = m.select("queue").distinct().withColumn("__has", F.lit(True))
    return join_on(sources.select("queue").distinct(), present, ["queue"], how="left").select(
        "queue", F.col("__has").isNull().alias("empty")
    )


def z_score(confidence: float) -> float:
    return NormalDist().inv_cdf((1.0 + confidence) / 2.0)


def count_approx(
    m: DataFrame, sample_mod: int = 10, confidence: float = 0.95, counted: DataFrame | None = None
) -> DataFrame:
    """A2: per-queue count estimated from a deterministic 1/``sample_mod`` sample
    of message ids, with a normal-approximation interval (rounded) and its ``confidence``.
    A queue of which no message is sampled has the estimate 0, and as its upper end the largest count
    that leaves so empty a sample that often.

    When the batch was already counted (``counted``: ``queue, n``), the answer is
    exact: ``mean = low = high = n`` with confidence 1.0, and nothing is scanned."""
    if counted is not None:
        n = F.col("n").cast("long")
        return counted.select("queue", n.alias("mean"), n.alias("low"), n.alias("high"), F.lit(1.0).alias("confidence"))
    p = 1.0 / sample_mod
    z = z_score(confidence)
    sampled = m.groupBy("queue").agg(F.count_if(F.pmod("message_id", F.lit(sample_mod)) == 0).alias("__k"))
    unseen = math.log(1.0 - confidence) / math.log(1.0 - p) if p < 1.0 else 0.0
    mean = F.col("__k") / F.lit(p)
    half = F.lit(z) * F.sqrt(F.col("__k") * F.lit(1.0 - p)) / F.lit(p)
    return sampled.select(
        "queue",
        F.round(mean).cast("long").alias("mean"),
        F.round(mean - half).cast("long").alias("low"),
        F.when(F.col("__k") == 0, F.lit(math.floor(unseen))).otherwise(F.round(mean + half)).cast("long").alias("high"),
        F.lit(float(confidence)).alias("confidence"),
    )


def count_within(m: DataFrame, timeout_ms: int, confidence: float = 0.95) -> tuple[float, float, float, float]:
    """A2 under a time limit: ``(mean, low, high, confidence)`` of the number of messages.

    Partitions that are counted when the time is up give the estimate and its interval; if all are, it is
    exact with confidence 1.0.  What is still running is then cancelled.  Rows are counted in the JVM."""
    sc = m.sparkSession.sparkContext
    tag = f"count-within-{uuid.uuid4().hex}"
    sc.addJobTag(tag)
    try:
        bound = m._jdf.queryExecution().toRdd().countApprox(int(timeout_ms), float(confidence)).initialValue()
        return bound.mean(), max(0.0, bound.low()), bound.high(), bound.confidence()
    finally:
        sc.removeJobTag(tag)
        sc.cancelJobsWithTag(tag)


def take_messages(m: DataFrame, n: int) -> DataFrame:
    """A4: the first ``n`` messages in (queue, ``delivery_tag``) order; a top-k without a global sort.

    Messages that have no tags yet are taken in (queue, message_id) order.  The result then begins each
    queue it reaches at its first message, so the tags of these few rows are their positions."""
    if "delivery_tag" in m.columns:
        return m.orderBy("queue", "delivery_tag").limit(n)
    first = m.orderBy("queue", "message_id").limit(n)
    return first.withColumn("delivery_tag", F.row_number().over(Window.partitionBy("queue").orderBy("message_id")).cast("long"))


def partition_counts(m: DataFrame) -> DataFrame:
    """A5: messages each (batch, partition) received; needs ``batch_id`` and ``slot``."""
    return m.groupBy("batch_id", "queue", "slot").agg(F.count(F.lit(1)).alias("n"))


def reported_counts(batches: DataFrame) -> DataFrame:
    """A batch reports the previous batch's total (first batch: NULL)."""
    return batches.withColumn("reported_n", F.lag("n").over(Window.orderBy("batch_id")))


def running_total(batches: DataFrame) -> DataFrame:
    """Cumulative messages over batches."""
    upto = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return batches.withColumn("total", F.sum("n").over(upto).cast("long"))
