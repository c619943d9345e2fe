"""Structured Streaming consumers: per-batch counts with an idempotent sink.

The reference scenario is "consume everything in 1 s batches and check that
the per-batch counts add up to the number published".  Here a stream over the
message log writes ``(batch_id, queue, n)`` per micro-batch into the batch's
own folder (a replayed batch replaces it whole), and the checkpoint makes a restart continue without loss or repeats.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from mqtable.options import QueueOptions


def batch_count_writer(sink: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: count the batch per queue and store it under ``sink``
    (one action per batch, so the batch needs no persisting)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # the batch's folder is replaced whole, so a replay without rows leaves nothing stale
        counts = batch.groupBy("queue").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return write


def persist_batch(batch: DataFrame, options: QueueOptions | None = None) -> DataFrame:
    """K5: keep a micro-batch for several actions at the configured storage level."""
    from pyspark import StorageLevel

    level = (options or QueueOptions({})).batch_storage_level()
    # Python-side data is always serialized, so the *_SER names map to their plain twins
    return batch.persist(getattr(StorageLevel, level.replace("_SER", "")))


def run_counts(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    timeout_s: float | None = None,
) -> StreamingQuery:
    """Start (and for ``available_now`` wait for) the per-batch counting query."""
    writer = stream.writeStream.foreachBatch(batch_count_writer(sink)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 second")
    q = writer.start()
    if available_now:
        q.awaitTermination(timeout_s)
    return q


def sink_batches(spark: SparkSession, sink: str) -> DataFrame:
    """``batch_id, queue, n`` rows written by the counting query; none before its first batch."""
    from mqtable.sources.messagelog import ensure_dir

    ensure_dir(spark, sink)
    return spark.read.schema("queue string, n long, batch_id long").option("basePath", sink).parquet(sink)


def totals(spark: SparkSession, sink: str) -> DataFrame:
    """Sum of the per-batch counts per queue (the reference test's check)."""
    return sink_batches(spark, sink).groupBy("queue").agg(F.sum("n").cast("long").alias("n"))


def event_time(col: str = "published_at"):
    """TIMESTAMP for watermarks from a TIMESTAMP_NTZ wall clock, read as UTC so the
    session time zone (and its DST gaps) cannot move it."""
    from mqtable.functions.time import epoch_micros

    return F.timestamp_micros(epoch_micros(col))


def wall_clock(ts):
    """Back from ``event_time`` to the TIMESTAMP_NTZ wall clock."""
    from mqtable.functions.time import EPOCH_TEXT

    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit(EPOCH_TEXT).cast("timestamp_ntz"))


def dedupe_stream(stream: DataFrame, delay: str | None = None) -> DataFrame:
    """D3 (stream): the first copy read of each (queue, delivery_tag); state is one key per message.

    ``delay`` is not used: a watermark would also drop first deliveries that are read late.  For the
    latest attempt, as in batch, see ``latest_writer``."""
    return stream.dropDuplicates(["queue", "delivery_tag"])


def latest_writer(sink: str) -> Callable[[DataFrame, int], None]:
    """D3 (stream): ``foreachBatch`` function that writes the latest attempt per message of each
    micro-batch into the batch's own folder (a replayed batch replaces it); see ``latest_deliveries``."""
    from mqtable.operators.delivery import dedupe_latest

    def write(batch: DataFrame, batch_id: int) -> None:
        dedupe_latest(batch).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return write


def latest_deliveries(spark: SparkSession, sink: str) -> DataFrame:
    """``queue, delivery_tag, attempt``: the latest attempt over all batches of ``latest_writer``, in any order of arrival."""
    from mqtable.operators.delivery import dedupe_latest
    from mqtable.sources.messagelog import ensure_dir

    ensure_dir(spark, sink)
    rows = spark.read.schema("queue string, delivery_tag long, attempt int, batch_id long").option("basePath", sink)
    return dedupe_latest(rows.parquet(sink))


#: Stands for "never" in a session gap.
NEVER = "36500 days"


def expiry_gap(expires_ms: Column) -> Column:
    """Session gap of a per-queue expiry in milliseconds; NULL never expires."""
    seconds = F.concat((expires_ms / 1000).cast("decimal(20,3)").cast("string"), F.lit(" seconds"))
    return F.coalesce(seconds, F.lit(NEVER))


def lease_stream(stream: DataFrame, expires: str | Column) -> DataFrame:
    """Q7 (stream): queue leases as session windows over the activity stream:
    ``queue, lease (window), lease_start (wall clock), n``; the gap may differ per queue.

    Run it in complete mode, which keeps all state.  There is no watermark: the log is ordered
    per queue, not by time, and a watermark would drop what is read late."""
    return (
        stream.withColumn("__event_time", event_time())
        .groupBy("queue", F.session_window("__event_time", expires).alias("lease"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("lease_start", wall_clock(F.col("lease.start")))
    )


def complete_table_writer(sink: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` for complete-mode aggregates: each batch carries the whole
    result table, which replaces the sink (a replayed batch writes the same)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    return write


def progress_counts(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """A6 (live): rows each micro-batch consumed, from the query's progress
    reports, and the count a batch reports (the previous batch's).

    ``recentProgress`` keeps the last ``spark.sql.streaming.numRecentProgressUpdates``
    reports (metadata only, one small row per batch)."""
    from pyspark.sql import Window

    rows = [(int(p.batchId), int(p.numInputRows)) for p in query.recentProgress]
    df = spark.createDataFrame(rows, "batch_id long, n long")
    return df.withColumn("reported_n", F.lag("n").over(Window.orderBy("batch_id")))


PROGRESS_SCHEMA = "query_id string, batch_id long, n long, batch_ms long, at string"


class ProgressLog(StreamingQueryListener):
    """A6 (live): keeps every progress report of the session's streams as a small file below ``folder``.

    ``spark.streams.addListener(ProgressLog(spark, folder))`` before the streams start.  A file is named by
    query and batch, so a batch that is reported again after a restart replaces its report.  Only reports are
    written, no job is run."""

    def __init__(self, spark: SparkSession, folder: str):
        from mqtable.sources.messagelog import ensure_dir

        self.spark, self.folder = spark, folder.rstrip("/")
        ensure_dir(spark, self.folder)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        import json

        from mqtable.sources.messagelog import _fs

        p = event.progress
        row = {"query_id": str(p.id), "batch_id": p.batchId, "n": p.numInputRows, "batch_ms": p.batchDuration, "at": p.timestamp}
        fs, path = _fs(self.spark, f"{self.folder}/{p.id}-{p.batchId}.json")
        out = fs.create(path, True)
        try:
            out.write(bytearray(json.dumps(row).encode()))
        finally:
            out.close()


def logged_progress(spark: SparkSession, folder: str, query_id: str | None = None) -> DataFrame:
    """``query_id, batch_id, n, batch_ms, at`` of all reports kept, with the count a batch reports (the previous one's)."""
    from pyspark.sql import Window

    rows = spark.read.schema(PROGRESS_SCHEMA).json(folder)
    if query_id is not None:
        rows = rows.where(F.col("query_id") == str(query_id))
    return rows.withColumn("reported_n", F.lag("n").over(Window.partitionBy("query_id").orderBy("batch_id")))


def print_stream(stream: DataFrame, rows: int = 20, processing_time: str = "1 second") -> StreamingQuery:
    """K3: print every micro-batch to the console."""
    return (
        stream.writeStream.format("console")
        .option("numRows", rows)
        .option("truncate", "false")
        .trigger(processingTime=processing_time)
        .start()
    )


def running_total_stream(stream: DataFrame) -> DataFrame:
    """A7 (live): messages consumed so far per queue; run in complete output mode."""
    return stream.groupBy("queue").agg(F.count(F.lit(1)).alias("total"))


def ttl_writer(sink: str, ttl_ms: int, as_of_fn=None) -> Callable[[DataFrame, int], None]:
    """Q1 (stream): inside ``foreachBatch`` keep the messages alive at the batch time
    (``as_of_fn(batch_id)`` -> datetime, default now) and write them; expired
    ones are kept for dead-lettering under ``<sink>_expired``.  A watermark
    would drop expired rows silently, which dead-lettering cannot allow."""
    import datetime as dt

    from mqtable.operators.retention import is_expired

    def write(batch: DataFrame, batch_id: int) -> None:
        when = as_of_fn(batch_id) if as_of_fn else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        as_of = F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")  # exact wall clock, no zone
        dead = F.coalesce(is_expired(F.lit(ttl_ms), as_of), F.lit(False))
        flagged = persist_batch(batch.withColumn("__dead", dead))
        for path, cond in ((sink, ~F.col("__dead")), (f"{sink}_expired", F.col("__dead"))):
            (
                flagged.where(cond).drop("__dead")
                .write.mode("overwrite")
                # the batch's folder is replaced whole, so a replay leaves nothing stale
                .parquet(f"{path}/batch_id={batch_id}")
            )
        flagged.unpersist()

    return write


def retain_batches_conf(spark: SparkSession, keep: int) -> None:
    """Keep at least ``keep`` batches of checkpoint metadata (the remember window)."""
    current = int(spark.conf.get("spark.sql.streaming.minBatchesToRetain", "100"))
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", str(max(current, keep)))
