"""Redelivery and publishing as streams.

D2: every micro-batch runs the handler; deliveries that fail go to a retry
log with ``attempt + 1`` (a second stream input, ``unionByName``), poison
messages stop at ``max_attempts`` and land in a dead sink.  K1: a stream of
messages is published into a message log, one publish batch per micro-batch.
All writes replace their own ``batch_id`` folder, so a replayed
micro-batch leaves nothing of its first try.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mqtable.operators.delivery import DEFAULT_MAX_ATTEMPTS
from mqtable.sources import messagelog
from mqtable.streaming.consumer import persist_batch

TRIGGER_BYTES = 1 << 30  # of files per micro-batch and input

RETRY_SCHEMA = T.StructType(
    [f for f in messagelog.LOG_SCHEMA.fields] + [T.StructField("attempt", T.IntegerType())]
)
# the retry log on disk: one folder per writing micro-batch
RETRY_LOG_SCHEMA = T.StructType(RETRY_SCHEMA.fields + [T.StructField("batch_id", T.LongType())])


def _overwrite(df: DataFrame, path: str, batch_id: int) -> None:
    """The batch's folder is replaced whole, so a replay that writes no rows leaves none of the first try."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def delivery_stream(
    spark: SparkSession, log: str, retry: str, queues: list[str] | None = None, max_bytes_per_trigger: int = TRIGGER_BYTES
) -> DataFrame:
    """Fresh deliveries (attempt 1) of all queues, or of ``queues``, plus their pending retries, bounded by bytes a batch."""
    messagelog.ensure_dir(spark, retry)
    limit = {"max_bytes_per_trigger": max_bytes_per_trigger}
    source = messagelog.stream_queues(spark, log, queues, **limit) if queues else messagelog.stream_log(spark, log, **limit)
    pending = spark.readStream.schema(RETRY_LOG_SCHEMA).option("basePath", retry).option("maxBytesPerTrigger", max_bytes_per_trigger)
    retried = pending.parquet(retry)
    return source.withColumn("attempt", F.lit(1)).unionByName(retried, allowMissingColumns=True)


def attempts_in(spark: SparkSession, sink: str) -> DataFrame:
    """Deliveries a sink or retry log holds; none when nothing was written."""
    messagelog.ensure_dir(spark, sink)
    return spark.read.schema(RETRY_LOG_SCHEMA).option("basePath", sink).parquet(sink)


def drain_retries(
    spark: SparkSession, log: str, retry: str, checkpoint: str, write: Callable[[DataFrame, int], None]
) -> int | None:
    """Run the stream over what is there until no retry is pending; returns the last batch's id, if there was one.

    A run consumes the retries that the ones before wrote.
    """
    pending, last = True, None
    while pending:
        ran: list[int] = []

        def writer(batch: DataFrame, batch_id: int) -> None:
            write(batch, batch_id)
            ran.append(batch_id)

        stream = delivery_stream(spark, log, retry)
        run = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        run.start().awaitTermination()
        # what these batches requeued is still to be read
        pending = bool(ran) and not attempts_in(spark, retry).where(F.col("batch_id") >= min(ran)).isEmpty()
        last = max(ran, default=last)
    return last


def deliver_all(
    spark: SparkSession, log: str, folder: str, succeeds: Callable[[DataFrame], Column], max_attempts: int = DEFAULT_MAX_ATTEMPTS
) -> tuple[DataFrame, DataFrame]:
    """Deliver all that is there until no retry is pending; returns the acked and the dead."""
    ok, dead, retry, ckpt = (f"{folder}/{x}" for x in ("ok", "dead", "retry", "checkpoint"))
    drain_retries(spark, log, retry, ckpt, redelivery_writer(ok, retry, dead, succeeds, max_attempts))
    return attempts_in(spark, ok), attempts_in(spark, dead)


def handler_fails_until(fail_count: str = "fail_count") -> Callable[[DataFrame], Column]:
    """The fixture handler: it fails while ``attempt <= fail_count``."""
    return lambda df: F.col("attempt") > F.coalesce(F.col(fail_count), F.lit(0))


def redelivery_writer(
    ok_sink: str,
    retry: str,
    dead_sink: str,
    succeeds: Callable[[DataFrame], Column],
    max_attempts: int = DEFAULT_MAX_ATTEMPTS,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: ack the successes, requeue failures, stop poison."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # judged once: the handler may be costly, and three writes follow
        judged = persist_batch(batch.withColumn("__ok", succeeds(batch)))
        _overwrite(judged.where("__ok").drop("__ok"), ok_sink, batch_id)
        failed = judged.where(~F.col("__ok")).drop("__ok")
        again = failed.where(F.col("attempt") < max_attempts).withColumn("attempt", F.col("attempt") + 1)
        _overwrite(again.select(*RETRY_SCHEMA.fieldNames()), retry, batch_id)
        _overwrite(failed.where(F.col("attempt") >= max_attempts), dead_sink, batch_id)
        judged.unpersist()

    return write


def publish_writer(log: str, batch_offset: int = 0) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for K1: micro-batch ``b`` becomes publish batch
    ``batch_offset + b``; a replay re-publishes the same tags in place."""

    def write(batch: DataFrame, batch_id: int) -> None:
        messagelog.publish(batch.sparkSession, batch, log, batch_offset + batch_id)

    return write
