"""Stateful consumers whose state grows with gaps and pauses, not with messages (D3, Q7).

Both run in ``foreachBatch`` over any order of messages.  The state after a batch is a table in a folder of
its own, made from the state before and the batch; a replayed batch starts from the same state and replaces
what it wrote.  The last two states are kept.

* ``distinct_writer``: tags are dense per queue, so what was seen is a set of tag intervals.  They are kept
  per (queue, range of ``TAG_BUCKET`` tags): without gaps one row each.  Messages are dealt by that pair.
* ``lease_writer``: messages closer than the gap are one lease, and so are all messages of a time slot as wide as
  the gap.  A batch is first summed per (queue, slot), with map-side partial sums; only these sums and
  the runs so far meet per queue.  A late message joins or connects runs wherever it falls.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mqtable.functions.time import EPOCH_TEXT, MS, epoch_micros, floor_div
from mqtable.operators.ordering import group_key
from mqtable.sources import messagelog

TAG_BUCKET = 1 << 20
DAY_US = 86_400_000 * MS
SEEN_SCHEMA = "queue string, bucket long, lo long, hi long"
RUNS_SCHEMA = "queue string, gap_us long, start_us long, end_us long, n long"


def _state_before(spark: SparkSession, folder: str, batch_id: int, schema: str) -> DataFrame:
    """The state that the last batch before ``batch_id`` left, or none."""
    fs, path = messagelog._fs(spark, folder)
    ids = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path)] if fs.exists(path) else []
    done = [i for i in ids if i < batch_id and messagelog._exists(spark, f"{folder}/batch_id={i}/_SUCCESS")]
    return spark.read.schema(schema).parquet(f"{folder}/batch_id={max(done)}") if done else spark.createDataFrame([], schema)


def _keep_state(state: DataFrame, folder: str, batch_id: int) -> None:
    state.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
    messagelog._remove(state.sparkSession, f"{folder}/batch_id={batch_id - 2}")


def _islands(tags: DataFrame) -> DataFrame:
    """``queue, bucket, lo, hi`` of the maximal intervals that some intervals cover together."""
    per = Window.partitionBy(group_key("queue", "bucket")).orderBy("lo", "hi")
    before = F.max("hi").over(per.rowsBetween(Window.unboundedPreceding, -1))
    marked = tags.withColumn("new", (before.isNull() | (F.col("lo") > before + 1)).cast("int"))
    numbered = marked.withColumn("island", F.sum("new").over(per.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("queue", "bucket", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")


def unseen(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """One row per message of ``batch`` (least attempt, if there is one) whose tag no interval of ``seen`` holds."""
    d = batch.withColumn("bucket", floor_div("delivery_tag", F.lit(TAG_BUCKET)))
    marks = seen.select("queue", "bucket", F.col("lo").alias("delivery_tag"), F.col("hi").alias("__hi"))
    both = d.withColumn("__hi", F.lit(None).cast("long")).unionByName(marks, allowMissingColumns=True)
    # an interval's own row comes before the messages at its start
    order = [F.col("delivery_tag"), F.col("__hi").desc_nulls_last(), *([F.col("attempt")] if "attempt" in batch.columns else [])]
    per = Window.partitionBy(group_key("queue", "bucket")).orderBy(*order)
    past = per.rowsBetween(Window.unboundedPreceding, -1)
    fresh = both.withColumn("__past", F.max("__hi").over(past)).withColumn("__same", F.lag("delivery_tag").over(per))
    fresh = fresh.where(F.col("__hi").isNull() & (F.col("__past").isNull() | (F.col("__past") < F.col("delivery_tag"))))
    return fresh.where(F.col("__same").isNull() | (F.col("__same") != F.col("delivery_tag"))).select(*batch.columns)


def distinct_writer(folder: str) -> Callable[[DataFrame, int], None]:
    """D3: ``foreachBatch`` function that writes each message once, at its first reading, below ``<folder>/out``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _state_before(spark, f"{folder}/seen", batch_id, SEEN_SCHEMA)
        out = f"{folder}/out/batch_id={batch_id}"
        unseen(batch, seen).write.mode("overwrite").parquet(out)
        fresh = spark.read.schema(batch.schema).parquet(out).select("queue", F.col("delivery_tag").alias("lo"))
        fresh = fresh.select("queue", floor_div("lo", F.lit(TAG_BUCKET)).alias("bucket"), "lo", F.col("lo").alias("hi"))
        _keep_state(_islands(fresh.unionByName(seen)), f"{folder}/seen", batch_id)

    return write


def distinct_messages(spark: SparkSession, folder: str, schema) -> DataFrame:
    """What ``distinct_writer`` has written so far; ``schema`` is the stream's."""
    messagelog.ensure_dir(spark, f"{folder}/out")
    return spark.read.schema(schema).option("basePath", f"{folder}/out").option("recursiveFileLookup", "true").parquet(f"{folder}/out")


def activity(batch: DataFrame, expires_ms: Column) -> DataFrame:
    """Per queue and time slot the first and last time and the number of messages, as rows of ``RUNS_SCHEMA``.

    A slot is as wide as the queue's gap, so its messages are closer than the gap; without a gap, or with one
    of zero, a slot is a day or an instant."""
    gap = (expires_ms.cast("long") * F.lit(MS)).alias("gap_us")
    d = batch.select("queue", gap, epoch_micros("published_at").alias("us"))
    width = F.greatest(F.coalesce("gap_us", F.lit(DAY_US)), F.lit(1))
    return (
        d.groupBy("queue", "gap_us", floor_div("us", width).alias("slot"))
        .agg(F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.count(F.lit(1)).alias("n"))
        .drop("slot")
    )


def merge_runs(runs: DataFrame) -> DataFrame:
    """Runs of ``RUNS_SCHEMA`` joined wherever the pause between them is shorter than the gap (none: always)."""
    per = Window.partitionBy(group_key("queue")).orderBy("start_us", "end_us")
    before = F.max("end_us").over(per.rowsBetween(Window.unboundedPreceding, -1))
    new = before.isNull() | F.coalesce(F.col("start_us") - before >= F.col("gap_us"), F.lit(False))
    marked = runs.withColumn("new", new.cast("int"))
    numbered = marked.withColumn("run", F.sum("new").over(per.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("queue", "gap_us", "run").agg(
        F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("n").alias("n")
    ).drop("run")


def lease_writer(folder: str, expires_ms: Column) -> Callable[[DataFrame, int], None]:
    """Q7: ``foreachBatch`` function that keeps the leases of everything read so far below ``<folder>/runs``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        runs = _state_before(batch.sparkSession, f"{folder}/runs", batch_id, RUNS_SCHEMA)
        _keep_state(merge_runs(activity(batch, expires_ms).unionByName(runs)), f"{folder}/runs", batch_id)

    return write


def leases(spark: SparkSession, folder: str, as_of: Column | None = None) -> DataFrame:
    """``queue, lease_start, n`` of the leases so far, and with ``as_of`` whether each is ``closed`` by then."""
    runs = _state_before(spark, f"{folder}/runs", 1 << 62, RUNS_SCHEMA)
    start = F.timestamp_add("MICROSECOND", F.col("start_us"), F.lit(EPOCH_TEXT).cast("timestamp_ntz"))
    out = runs.withColumn("lease_start", start)
    if as_of is not None:
        out = out.withColumn("closed", F.coalesce(epoch_micros(as_of) - F.col("end_us") >= F.col("gap_us"), F.lit(False)))
    return out.select("queue", "lease_start", "n", *(["closed"] if as_of is not None else []))
