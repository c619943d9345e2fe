"""Delivery semantics: acknowledgement, bounded redelivery, de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mqtable.options import AUTO_ACK, BASIC_ACK

DEFAULT_MAX_ATTEMPTS = 5


def disposition(ack_type, ok) -> F.Column:
    """What happens to a delivery: auto-acked by the broker, acked, requeued
    (nack with requeue) or left unacknowledged (any other ack type)."""
    return (
        F.when(ack_type == F.lit(AUTO_ACK), F.lit("auto"))
        .when((ack_type == F.lit(BASIC_ACK)) & ok, F.lit("acked"))
        .when(ack_type == F.lit(BASIC_ACK), F.lit("requeued"))
        .otherwise(F.lit("unacked"))
    )


def ack_dispositions(outcomes: DataFrame, ack_types: list[str]) -> DataFrame:
    """``ack_type, disposition, n`` for each ack type; ``outcomes`` has an ``outcome``
    column.  Outcomes are counted first, so only the tiny count table is
    replicated once per ack type (no join)."""
    counts = outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("__n"))
    crossed = counts.withColumn("ack_type", F.explode(F.array(*[F.lit(t) for t in ack_types])))
    return crossed.groupBy(
        "ack_type", disposition(F.col("ack_type"), F.col("outcome") == "ok").alias("disposition")
    ).agg(F.sum("__n").cast("long").alias("n"))


def redeliveries(m: DataFrame, max_attempts: int = DEFAULT_MAX_ATTEMPTS) -> DataFrame:
    """One row per delivery attempt.  A message whose handler fails ``f`` times
    is delivered ``f + 1`` times, at most ``max_attempts`` (poison messages stop)."""
    attempts = F.least(F.coalesce("fail_count", F.lit(0)) + 1, F.lit(max_attempts))
    return m.withColumn("attempt", F.explode(F.sequence(F.lit(1), attempts))).withColumn(
        "redelivered", F.col("attempt") > 1
    )


def dedupe_latest(deliveries: DataFrame, keys=("queue", "delivery_tag")) -> DataFrame:
    """D3 (batch): one row per message, its latest attempt (a partial aggregation,
    not a window: repeats are combined map-side)."""
    return deliveries.groupBy(*keys).agg(F.max("attempt").alias("attempt"))
