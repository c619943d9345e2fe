"""Admission: partitions, slots, caps and micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mqtable.functions.time import batch_index, floor_div
from mqtable.operators.ordering import group_key, join_on, ordinal
from mqtable.options import DEFAULT_LEVEL_PARALLELISM

TAG_BUCKET = 1 << 20  # delivery tags per numbering bucket (bounds one task's rows)


def slot_of(tag: Column, parallelism) -> Column:
    """Consumer slot of a message: dense tags dealt round-robin (tag 1 -> slot 0)."""
    p = parallelism if isinstance(parallelism, Column) else F.lit(parallelism)
    return F.pmod(tag - F.lit(1), p).cast("int")


def with_batch(m: DataFrame, slide_ms: int, receive_ms: int | None = None, name: str = "batch_id") -> DataFrame:
    """Micro-batch index of every message (receive window <= slide)."""
    return m.withColumn(name, batch_index("published_at", slide_ms, receive_ms))


def partition_plan(sources: DataFrame, stream_parallelism: int = DEFAULT_LEVEL_PARALLELISM) -> DataFrame:
    """One input partition per (source, slot), ``parallelism * key_index + slot``.

    The stream's ``levelParallelism`` holds for every source; a source's own option does not change it."""
    return sources.select(
        "key_index",
        "queue",
        F.lit(stream_parallelism).alias("parallelism"),
        F.explode(F.sequence(F.lit(0), F.lit(stream_parallelism - 1))).alias("slot"),
    ).select(
        (F.col("key_index") * F.col("parallelism") + F.col("slot")).cast("int").alias("partition_index"),
        "key_index",
        "queue",
        "slot",
        "parallelism",
    )


def partition_load(plan: DataFrame, m: DataFrame) -> DataFrame:
    """Messages each planned partition receives (0 for an idle partition)."""
    per_queue_p = plan.select("queue", "parallelism").distinct()
    slotted = join_on(m.select("queue", "delivery_tag"), per_queue_p, ["queue"]).select(
        "queue", slot_of(F.col("delivery_tag"), F.col("parallelism")).alias("slot")
    )
    counts = slotted.groupBy("queue", "slot").agg(F.count(F.lit(1)).alias("n"))
    out = join_on(plan, counts, ["queue", "slot"], how="left")
    return out.select("partition_index", "queue", "slot", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def balanced_slots(m: DataFrame, parallelism: int) -> DataFrame:
    """Competing consumers share a queue round-robin; per-slot counts differ by <= 1."""
    return m.groupBy("queue", slot_of(F.col("delivery_tag"), parallelism).alias("slot")).agg(
        F.count(F.lit(1)).alias("n")
    )


def cap_per_partition(m: DataFrame, parallelism: int, cap: int, slide_ms: int, receive_ms: int | None = None):
    """The first ``cap`` messages of each (batch, queue, slot) in tag order."""
    b = with_batch(m, slide_ms, receive_ms).withColumn("slot", slot_of(F.col("delivery_tag"), parallelism))
    ranked = ordinal(
        b,
        partition_by=["batch_id", "queue", "slot"],
        order_by=[F.col("delivery_tag")],
        buckets=[floor_div("delivery_tag", F.lit(TAG_BUCKET))],
        name="__pos",
        max_rank=cap,
    )
    return ranked.drop("__pos")


def per_batch(m: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Messages per batch on a dense batch axis (a batch with no messages counts 0).

    Idle batches come from the gap before each busy one, spread over tasks by Spark; use
    ``busy_batches`` where run lengths will do.
    """
    busy = busy_batches(m, batch_col)
    idle = F.when(F.col("gap") > 0, F.sequence(F.col(batch_col) - F.col("gap"), F.col(batch_col) - 1)).otherwise(F.array().cast("array<bigint>"))
    empty = busy.where("gap > 0").select(F.explode(idle).alias(batch_col), F.lit(0).cast("long").alias("n"))
    return busy.select(batch_col, "n").unionByName(empty)


def busy_batches(m: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """``batch_id, n, gap``: batches with messages, and how many idle ones lie before each."""
    counts = m.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n"))
    before = F.lag(batch_col).over(Window.orderBy(batch_col))
    return counts.withColumn("gap", F.coalesce(F.col(batch_col) - before - 1, F.lit(0)))


def rate_cap(
    batches: DataFrame,
    slide_ms: int,
    partitions: int,
    user_cap: int | None,
    legacy: bool = False,
) -> DataFrame:
    """Per-partition cap from the previous batch's rate (messages/s).

    ``r = floor(slide_s * rate)``; with a user cap it is ``min(r, cap)``; without
    one the rate is split over the partitions (``ceil(r / partitions)``; the
    original multiplication is kept behind ``legacy=True``).  A rate of 0
    leaves only the user's cap (NULL = no cap).
    """
    w = Window.orderBy("batch_id")
    prev_b, prev_n = F.lag("batch_id").over(w), F.lag("n").over(w)
    rate = F.when(prev_b == F.col("batch_id") - 1, prev_n).otherwise(F.lit(0))
    r = F.floor(F.col("__rate") * F.lit(slide_ms) / F.lit(1000)).cast("long")
    user = F.lit(user_cap).cast("long")
    split = r * F.lit(partitions) if legacy else F.ceil(r / F.lit(partitions)).cast("long")
    return (
        batches.withColumn("__rate", rate)
        .withColumn("cap", F.when(F.col("__rate") > 0, F.least(r, user) if user_cap is not None else split).otherwise(user))
        .drop("__rate")
    )


def backlog(batches: DataFrame, cap: int) -> DataFrame:
    """Messages left in the queue after each capped batch,
    ``L_b = max(0, L_{b-1} + n_b - cap)`` in closed form (no iteration)."""
    upto = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    s = F.sum(F.col("n") - F.lit(cap)).over(upto)
    b = batches.withColumn("__s", s)
    return b.withColumn(
        "backlog", (F.col("__s") - F.least(F.lit(0), F.min("__s").over(upto))).cast("long")
    ).drop("__s")


def delivery_batches(m: DataFrame, cap: int | Column, batch_col: str = "batch_id") -> DataFrame:
    """W7 per message: ``delivery_batch``, in which a queue that delivers at most ``cap`` messages a batch, in tag
    order, delivers each one; ``m`` has its arrival batch and dense tags.

    Number the places of all batches, ``cap`` a batch: a message takes its own batch's first place or the
    one after its predecessor's, whichever is later.  So its place is its position plus the running maximum of
    (first place - position), which needs no iteration.  The maxima are taken per (queue, ``TAG_BUCKET`` tags);
    those of earlier buckets come from a row a bucket.
    """
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    position = F.col("delivery_tag") - 1
    d = m.withColumn("__cap", cap.cast("long")).withColumn("__bucket", floor_div("delivery_tag", F.lit(TAG_BUCKET)))
    d = d.withColumn("__lead", F.col(batch_col) * F.col("__cap") - position).withColumn("__key", group_key("queue", "__bucket"))
    earlier = Window.partitionBy("queue").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = d.groupBy("__key", "queue", "__bucket").agg(F.max("__lead").alias("__most"))
    buckets = buckets.select(F.col("__key").alias("__okey"), F.max("__most").over(earlier).alias("__before"))
    d = d.join(buckets, d["__key"] == buckets["__okey"], "left")
    upto = Window.partitionBy("__key").orderBy("delivery_tag").rowsBetween(Window.unboundedPreceding, 0)
    place = F.greatest("__before", F.max("__lead").over(upto)) + position
    out = d.withColumn("delivery_batch", floor_div(place, F.col("__cap")))
    return out.drop("__cap", "__bucket", "__lead", "__key", "__okey", "__before")


def remember_batches(batches: DataFrame, keep: int) -> DataFrame:
    """The last ``keep`` batches (those a stream still remembers)."""
    last = batches.select(F.max("batch_id")).scalar()
    return batches.where(F.col("batch_id") > last - F.lit(keep))


def tumbling_counts(m: DataFrame, width: str) -> DataFrame:
    """Messages per (fixed window, queue)."""
    return m.groupBy(F.window("published_at", width).start.alias("window_start"), "queue").agg(
        F.count(F.lit(1)).alias("n")
    )
