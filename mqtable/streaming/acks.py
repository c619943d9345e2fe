"""An acknowledgement ledger fed by handler outcomes.

Every micro-batch runs the handler and writes what became of each delivery, one change per (queue, tag,
attempt): ``auto`` (settled when sent, whatever the handler does), ``acked``, ``requeued`` (delivered again by
the retry log), ``dead`` (the last attempt failed too) or ``unacked`` (an ack type that never answers).
The ledger is the latest change per message, whatever order they were written in.  Its older batches are
compacted into a snapshot, so it holds a row a message and not one an attempt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mqtable.operators.delivery import DEFAULT_MAX_ATTEMPTS, disposition
from mqtable.operators.handler import OK, Delivery, handled_by
from mqtable.options import QueueOptions
from mqtable.sources import messagelog
from mqtable.streaming.consumer import persist_batch
from mqtable.streaming.redelivery import RETRY_SCHEMA, _overwrite, drain_retries

CHANGE_SCHEMA = "queue string, delivery_tag long, attempt int, state string"
DEAD = "dead"


def _snapshots(spark: SparkSession, folder: str) -> list[int]:
    fs, path = messagelog._fs(spark, f"{folder}/snapshot")
    ids = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(i for i in ids if messagelog._exists(spark, f"{folder}/snapshot/upto={i}/_SUCCESS"))


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{folder}/changes"
    messagelog.ensure_dir(spark, path)
    return spark.read.schema(f"{CHANGE_SCHEMA}, batch_id long").option("basePath", path).parquet(path)


def _latest(changes: DataFrame) -> DataFrame:
    last = F.max(F.struct("attempt", "state")).alias("last")
    return changes.groupBy("queue", "delivery_tag").agg(last).select("queue", "delivery_tag", "last.attempt", "last.state")


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """``queue, delivery_tag, attempt, state``: the latest state of every message delivered so far."""
    kept = _snapshots(spark, folder)
    changes = _changes(spark, folder)
    if kept:
        snapshot = spark.read.schema(CHANGE_SCHEMA).parquet(f"{folder}/snapshot/upto={kept[-1]}")
        changes = changes.where(F.col("batch_id") > kept[-1]).drop("batch_id").unionByName(snapshot)
    return _latest(changes.select("queue", "delivery_tag", "attempt", "state"))


def compact(spark: SparkSession, folder: str, upto: int) -> None:
    """Replace the changes of the batches up to ``upto`` (all finished) by a snapshot.

    The snapshot counts from the moment it is complete; what it replaces is removed afterwards, so a compaction
    that is cut off leaves a ledger that reads the same."""
    kept = _snapshots(spark, folder)
    if kept and kept[-1] >= upto:
        return
    changes = _changes(spark, folder).where((F.col("batch_id") <= upto) & (F.col("batch_id") > (kept[-1] if kept else -1)))
    changes = changes.drop("batch_id")
    if kept:
        changes = changes.unionByName(spark.read.schema(CHANGE_SCHEMA).parquet(f"{folder}/snapshot/upto={kept[-1]}"))
    _latest(changes).select("queue", "delivery_tag", "attempt", "state").write.mode("overwrite").parquet(f"{folder}/snapshot/upto={upto}")
    fs, path = messagelog._fs(spark, f"{folder}/changes")
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and int(name.split("=")[1]) <= upto:
            fs.delete(status.getPath(), True)
    for old in kept:
        messagelog._remove(spark, f"{folder}/snapshot/upto={old}")


def ack_writer(
    folder: str,
    options: QueueOptions,
    handler: Callable[[Delivery], object],
    return_type: T.DataType,
    max_attempts: int = DEFAULT_MAX_ATTEMPTS,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over deliveries with ``attempt``: runs the handler, writes the changes and the retries."""

    def write(batch: DataFrame, batch_id: int) -> None:
        state = disposition(F.lit(options.ack_type), F.col("outcome") == OK)
        state = F.when((state == "requeued") & (F.col("attempt") >= max_attempts), F.lit(DEAD)).otherwise(state)
        # judged once: the handler may be costly, and two writes follow
        judged = persist_batch(handled_by(batch, handler, return_type).withColumn("state", state), options)
        again = judged.where(F.col("state") == "requeued").withColumn("attempt", F.col("attempt") + 1)
        _overwrite(again.select(*RETRY_SCHEMA.fieldNames()), f"{folder}/retry", batch_id)
        _overwrite(judged.select("queue", "delivery_tag", "attempt", "state"), f"{folder}/changes", batch_id)
        judged.unpersist()

    return write


def deliver(
    spark: SparkSession,
    log: str,
    folder: str,
    params: dict[str, str],
    handler: Callable[[Delivery], object],
    return_type: T.DataType,
    max_attempts: int = DEFAULT_MAX_ATTEMPTS,
) -> DataFrame:
    """Deliver all that the log holds under ``ackType`` until no retry is pending, and return the ledger."""
    write = ack_writer(folder, QueueOptions(params), handler, return_type, max_attempts)
    last = drain_retries(spark, log, f"{folder}/retry", f"{folder}/checkpoint", write)
    if last is not None:
        compact(spark, folder, last)
    return ledger(spark, folder)
