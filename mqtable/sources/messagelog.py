"""A replayable message log: Parquet partitioned by ``publish_batch`` then ``queue``.

Publishing appends one batch: messages get the next dense per-queue ``delivery_tag`` (current end
of the queue + position in ``message_id`` order).  A batch is written beside the log together with its
manifest (per queue the tags, the number of messages and a digest of the whole batch) and then moved into
place: readers see it once and whole.  Publishing a batch again with the same messages does nothing, so no
stream reads it twice; with other messages it replaces the batch's folder.  A publish that was cut off is
either finished or forgotten by the next one.  The manifests also hold the queues' ends, so publishing
never rescans earlier batches.  Reads are partition-pruned on ``queue`` and filter-pushed on ``delivery_tag``.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mqtable.functions.time import floor_div
from mqtable.operators.ordering import join_on, ordinal, value_chunks
from mqtable.schema import MESSAGE_SCHEMA

BATCH_COL = "publish_batch"
MAX_RECORDS_PER_FILE = 1_000_000

LOG_SCHEMA = T.StructType(
    [f for f in MESSAGE_SCHEMA.fields if f.name != "queue"]
    + [T.StructField(BATCH_COL, T.LongType()), T.StructField("queue", T.StringType())]
)


def _fs(spark: SparkSession, path: str):
    """The file system of ``path`` (local, HDFS, object store) and the path on it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create ``path`` on its file system if missing."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there whole or not at all."""
    fs, p = _fs(spark, path)
    part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, p):
        raise OSError(f"cannot write {path}")


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``, whole."""
    fs, to = _fs(spark, target)
    fs.mkdirs(to.getParent())
    fs.delete(to, True)
    if not fs.rename(_fs(spark, source)[1], to):
        raise OSError(f"cannot move {source} to {target}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log as a batch DataFrame (empty when nothing was published)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("basePath", path).parquet(path)


ENDS_SCHEMA = "queue string, first long, end long, n long, digest string, publish_batch long"


def _ends_path(path: str) -> str:
    return path.rstrip("/") + "-ends"


def _staging_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}-staging/{BATCH_COL}={int(batch_id)}"


def _settle(spark: SparkSession, path: str, batch_id: int) -> None:
    """Move a staged batch into place if its manifest was written; every step may be repeated."""
    staging, name = _staging_path(path, batch_id), f"{BATCH_COL}={int(batch_id)}"
    if _exists(spark, f"{staging}/ends/_SUCCESS"):
        if _exists(spark, f"{staging}/data"):
            _move(spark, f"{staging}/data", f"{path.rstrip('/')}/{name}")
        _move(spark, f"{staging}/ends", f"{_ends_path(path)}/{name}")
    _remove(spark, staging)


def settle_all(spark: SparkSession, path: str) -> None:
    """Finish the publishes that were cut off after their manifest, and forget those before it."""
    fs, folder = _fs(spark, path.rstrip("/") + "-staging")
    if fs.exists(folder):
        for status in fs.listStatus(folder):
            _settle(spark, path, int(status.getPath().getName().split("=")[1]))


def _row_hash() -> F.Column:
    """A hash of everything a publisher gives of a message."""
    given = [f.name for f in MESSAGE_SCHEMA.fields if f.name not in ("delivery_tag", "headers")]
    return F.xxhash64(*given, F.map_entries("headers")).cast("decimal(38,0)")


def _digest(rows: int | None, total) -> str:
    return f"{rows or 0}:{total or 0}"


def published(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """The batches of the log with the times they were moved into place: another list if anything was published."""
    fs, folder = _fs(spark, _ends_path(path))
    if not fs.exists(folder):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(folder))


def queue_ends(spark: SparkSession, path: str, before_batch: int | None = None) -> DataFrame:
    """Last delivery tag per queue over the batches before ``before_batch``."""
    if not _exists(spark, _ends_path(path)):
        return spark.createDataFrame([], "queue string, __end long")
    ends = spark.read.schema(ENDS_SCHEMA).parquet(_ends_path(path))
    if before_batch is not None:
        ends = ends.where(F.col(BATCH_COL) < before_batch)
    return ends.groupBy("queue").agg(F.max("end").alias("__end"))


def publish(
    spark: SparkSession,
    messages: DataFrame,
    path: str,
    batch_id: int,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    dense_id_bucket: int | None = None,
) -> None:
    """K1: append ``messages`` (already routed to a ``queue``) as batch ``batch_id``.

    Files hold at most ``max_records_per_file`` messages, in tag order, so a
    stream can admit a queue in bounded steps (``maxFilesPerTrigger``) and tag
    ranges prune row groups.  One writer per log is assumed.

    Numbering buckets come from ``value_chunks`` (any id distribution); a
    caller whose ids are known to be dense may pass ``dense_id_bucket`` (ids
    per bucket) instead and save those passes.
    """
    from pyspark.sql import Observation

    settle_all(spark, path)
    cols = [f.name for f in MESSAGE_SCHEMA.fields if f.name != "delivery_tag"]
    fresh = messages.select(*cols)
    sums = (F.count(F.lit(1)).alias("n"), F.sum(_row_hash()).alias("total"))
    if _exists(spark, f"{_ends_path(path)}/{BATCH_COL}={int(batch_id)}"):
        committed = spark.read.schema(ENDS_SCHEMA).parquet(_ends_path(path)).where(F.col(BATCH_COL) == batch_id).first()
        if committed and committed.digest == _digest(*fresh.agg(*sums).first()):
            return
    # numbering continues after the earlier batches only, so a retry of this
    # batch gets the same tags and replaces its own partitions
    ends = queue_ends(spark, path, before_batch=batch_id)
    if dense_id_bucket:
        chunks, buckets = [], [floor_div("message_id", F.lit(dense_id_bucket))]
    else:
        fresh, chunks = value_chunks(fresh, ["queue"], F.col("message_id"), "__id_chunk")
        buckets = [F.col(c) for c in chunks]
    numbered = ordinal(
        fresh,
        partition_by=["queue"],
        order_by=[F.col("message_id")],
        buckets=buckets,
        name="__pos",
    ).drop(*chunks)
    numbered = join_on(numbered, ends, ["queue"], how="left")
    out = numbered.withColumn("delivery_tag", (F.coalesce("__end", F.lit(0)) + F.col("__pos")).cast("long"))
    staging = _staging_path(path, batch_id)
    seen = Observation()
    out = out.select(*[f.name for f in LOG_SCHEMA.fields if f.name != BATCH_COL]).observe(seen, *sums)
    data = f"{staging}/data"
    out.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).partitionBy("queue").parquet(data)
    # from the written tags: one narrow column of this batch alone
    written = spark.read.schema(LOG_SCHEMA).parquet(data)
    ends = written.groupBy("queue").agg(
        F.min("delivery_tag").alias("first"), F.max("delivery_tag").alias("end"), F.count(F.lit(1)).alias("n")
    )
    digest = _digest(seen.get["n"], seen.get["total"])
    ends.withColumn("digest", F.lit(digest)).write.mode("overwrite").parquet(f"{staging}/ends")
    _settle(spark, path, batch_id)


def publish_through(
    spark: SparkSession, messages: DataFrame, bindings: DataFrame, path: str, batch_id: int, **limits
) -> None:
    """K1 through an exchange: route ``messages`` by ``bindings`` and append them to the bound queues.

    Messages no binding matches are dropped, as a broker drops them.
    """
    from mqtable.operators.routing import route

    routed = route(messages.drop("queue"), bindings).withColumnRenamed("bound_queue", "queue")
    publish(spark, routed, path, batch_id, **limits)


def read_queue(spark: SparkSession, path: str, queue: str, first_tag: int | None = None, last_tag: int | None = None):
    """A bounded slice of one queue by delivery tag (pruned + pushed down)."""
    df = read_log(spark, path).where(F.col("queue") == queue)
    if first_tag is not None:
        df = df.where(F.col("delivery_tag") >= first_tag)
    if last_tag is not None:
        df = df.where(F.col("delivery_tag") <= last_tag)
    return df


def _reader(spark: SparkSession, path: str, max_files_per_trigger: int | None, max_bytes_per_trigger: int | None):
    """A log that nothing was published to yet gives empty batches instead of an error."""
    ensure_dir(spark, path)
    reader = spark.readStream.schema(LOG_SCHEMA).option("basePath", path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)


def stream_log(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """Every queue of the log as one stream (``queue`` comes from the folder names)."""
    return _reader(spark, path, max_files_per_trigger, max_bytes_per_trigger)


def stream_queues(spark: SparkSession, path: str, queues: Iterable[str], **limits) -> DataFrame:
    """Several queues as one stream: one file source, whose batches read only their folders."""
    queues = list(queues)
    if not queues:
        raise ValueError("no source queues: nothing to consume")
    return stream_log(spark, path, **limits).where(F.col("queue").isin(queues))


def stream_queue(spark: SparkSession, path: str, queue: str, **limits) -> DataFrame:
    """An unbounded stream of one queue."""
    return stream_queues(spark, path, [queue], **limits)
