"""Streams that obey ``maxMessagesPerPartition``.

Every micro-batch takes at most the cap from each (source, slot) and leaves the rest for later batches.
Tags are dense per queue, so a slot is an arithmetic progression of tags and its cursor is one number: a
batch's share is a range of tags, read from the log by a pushed-down filter, and no message is numbered.

The shares of a trigger are written to ``<folder>/shares/trigger-<id>.json`` before it reads; the cursor is the
sum of all earlier shares.  A trigger that is replayed after a crash finds its shares and delivers the same
messages again, whatever has been published meanwhile, so with a sink that replaces what a trigger wrote,
nothing is lost or delivered twice.  The shares grow with sources and batches, not with messages, and are read
back once per start.  Structured Streaming runs the triggers and keeps their ids in its checkpoint.

A trigger delivers one batch.  With a small cap and a long log that is many triggers, each of which costs some
tenths of a second, so a stream that has fallen behind may catch up: a trigger then delivers several batches in a
row, each with its own shares and id, as a scheduler that is late finds several slides due.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mqtable.operators.admission import slot_of
from mqtable.operators.handler import Delivery
from mqtable.options import QueueOptions, SourceKey, source_keys
from mqtable.sources import messagelog

#: What one batch takes: the ``n`` messages of a slot that follow the first ``done`` of it.
SHARE_SCHEMA = "batch_id long, source_index int, queue string, slot int, slots int, done long, n long"
#: Batches that one trigger delivers at most when it catches up.
CATCH_UP_BATCHES = 256
#: Queues whose tag ranges are pushed down one by one; with more, one range is.
RANGES = 64


class Share(NamedTuple):
    """A row of ``SHARE_SCHEMA``."""

    batch_id: int
    source_index: int
    queue: str
    slot: int
    slots: int
    done: int
    n: int


class CappedStream:
    """The messages of several sources in micro-batches under each source's own cap.

    ``levelParallelism`` of the stream is the number of slots of a queue; ``maxMessagesPerPartition`` of a source
    wins over the stream's; without one, a batch takes all there is.  ``storageLevel`` keeps a batch while
    ``write`` uses it, ``rememberDuration`` keeps checkpoints.  A queue that several sources name is delivered to
    each of them at its own pace.

    With ``catch_up`` a trigger delivers as many whole batches as hold that many messages together, at least one;
    ``write`` then gets them with a column ``batch_id``, and the trigger's id.
    """

    def __init__(
        self,
        spark: SparkSession,
        log: str,
        folder: str,
        keys: Sequence[SourceKey] | None,
        params: Mapping[str, str],
        handler: Callable[[Delivery], object] | None = None,
        return_type: T.DataType = T.StringType(),
        slide_ms: int = 1_000,
        catch_up: int | None = None,
    ):
        self.spark, self.log, self.folder = spark, log, folder.rstrip("/")
        self.options = QueueOptions(dict(params))
        self.handler, self.return_type, self.slide_ms = handler, return_type, slide_ms
        self.catch_up = catch_up
        self.sources = source_keys(self.options, list(keys or []))
        merged = [self.options.merged(k.options) for k in self.sources]
        for o in merged:
            o.policy_arguments()  # bad values raise
        self.caps = [o.max_messages_per_partition for o in merged]
        if catch_up is not None and catch_up < 1:
            raise ValueError("catch_up must be positive: give None for one batch per trigger")
        if any(c is not None and c < 1 for c in self.caps):
            raise ValueError("maxMessagesPerPartition must be positive: no batch would take anything")
        self.slots = max(1, self.options.parallelism)

        self._after: int | None = None  # the trigger that the cursor stands after
        self._cursor: dict[tuple[int, int], int] = {}
        self._last = -1
        self._ends: tuple[list, dict[str, int]] | None = None

    def _rewind(self, trigger: int) -> None:
        """The cursor as it was before ``trigger``, from what is written: once per start."""
        folder = f"{self.folder}/shares"
        messagelog.ensure_dir(self.spark, folder)
        earlier = self.spark.read.schema(f"{SHARE_SCHEMA}, trigger long").json(folder).where(F.col("trigger") < trigger)
        rows = earlier.groupBy("source_index", "slot").agg(F.sum("n").alias("done"), F.max("batch_id").alias("last")).collect()
        self._cursor = {(r.source_index, r.slot): r.done for r in rows}
        self._last = max((r.last for r in rows), default=-1)

    def _queue_ends(self) -> dict[str, int]:
        """Last tag of the sources' queues; read again only when the log's list of publishes has changed."""
        listed = messagelog.published(self.spark, self.log)
        if self._ends is None or self._ends[0] != listed:
            ends = messagelog.queue_ends(self.spark, self.log).where(F.col("queue").isin(list({k.queue for k in self.sources})))
            self._ends = listed, {r.queue: r["__end"] for r in ends.collect()}
        return self._ends[1]

    def _decide(self, trigger: int) -> list[Share]:
        ends, done, found, total = self._queue_ends(), dict(self._cursor), [], 0
        first = max(trigger, self._last + 1)
        for batch_id in range(first, first + (1 if self.catch_up is None else CATCH_UP_BATCHES)):
            taken = []
            for i, source in enumerate(self.sources):
                for slot in range(self.slots):
                    # tags slot + 1, slot + 1 + slots, ... up to the queue's end
                    there = max(0, (ends.get(source.queue, 0) - slot - 1 + self.slots) // self.slots)
                    before = done.get((i, slot), 0)
                    left = there - before
                    n = left if self.caps[i] is None else min(left, self.caps[i])
                    if n > 0:
                        taken.append(Share(batch_id, i, source.queue, slot, self.slots, before, n))
            size = sum(s.n for s in taken)
            if not taken or (found and total + size > self.catch_up):
                break
            done.update({(s.source_index, s.slot): s.done + s.n for s in taken})
            found.extend(taken)
            total += size
        return found

    def shares(self, trigger: int) -> list[Share]:
        """What ``trigger`` takes, decided once and written."""
        path = f"{self.folder}/shares/trigger-{trigger}.json"
        if self._after != trigger - 1:
            self._rewind(trigger)
        if messagelog._exists(self.spark, path):
            found = [Share(*r) for r in self.spark.read.schema(SHARE_SCHEMA).json(path).collect()]
        else:
            found = self._decide(trigger)
            if found:
                messagelog.write_small(self.spark, path, "\n".join(json.dumps({**s._asdict(), "trigger": trigger}) for s in found))
        for s in found:
            self._cursor[s.source_index, s.slot] = s.done + s.n
            self._last = max(self._last, s.batch_id)
        self._after = trigger
        return found

    def messages(self, shares: list[Share]) -> DataFrame:
        """The messages of some shares with ``source_index`` and ``slot``, and ``batch_id`` if they may be of several batches."""
        spans: dict[str, tuple[int, int]] = {}
        for s in shares:
            first, last = (s.done * s.slots + s.slot + 1, (s.done + s.n - 1) * s.slots + s.slot + 1)
            lo, hi = spans.get(s.queue, (first, last))
            spans[s.queue] = (min(lo, first), max(hi, last))
        tag, rows = F.col("delivery_tag"), messagelog.read_log(self.spark, self.log)
        if len(spans) <= RANGES:
            rows = rows.where(reduce(lambda a, b: a | b, [(F.col("queue") == q) & tag.between(*span) for q, span in spans.items()]))
        else:
            rows = rows.where(F.col("queue").isin(list(spans)) & tag.between(min(a for a, _ in spans.values()), max(b for _, b in spans.values())))
        rows = rows.withColumn("slot", slot_of(tag, self.slots))
        taken = self.spark.createDataFrame([tuple(s) for s in shares], SHARE_SCHEMA)
        nth = F.floor((tag - 1) / F.col("slots"))
        # one row per batch, source and slot
        joined = rows.join(F.broadcast(taken), ["queue", "slot"]).where((nth >= F.col("done")) & (nth < F.col("done") + F.col("n")))
        return joined.drop("slots", "done", "n", *([] if self.catch_up else ["batch_id"]))

    def _writer(self, write: Callable[[DataFrame, int], None], drained: threading.Event) -> Callable[[DataFrame, int], None]:
        from mqtable.streaming.api import with_handler
        from mqtable.streaming.consumer import persist_batch

        def run(tick: DataFrame, trigger: int) -> None:
            shares = self.shares(trigger)
            if not shares:
                drained.set()
                return
            batch = with_handler(self.messages(shares), self.handler, self.return_type)
            keep = "storageLevel" in self.options.raw
            if keep:
                batch = persist_batch(batch, self.options)
            write(batch, trigger if self.catch_up else shares[0].batch_id)
            if keep:
                batch.unpersist()

        return run

    def start(self, write: Callable[[DataFrame, int], None], drained: threading.Event | None = None) -> StreamingQuery:
        """Run a trigger every slide.  ``write`` gets each batch and its id (see ``catch_up``), and must replace what that id wrote before."""
        from mqtable.streaming.consumer import retain_batches_conf

        if "rememberDuration" in self.options.raw:
            retain_batches_conf(self.spark, self.options.remember_batches(self.slide_ms))
        clock = self.spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
        return (
            clock.writeStream.foreachBatch(self._writer(write, drained or threading.Event()))
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(processingTime=f"{self.slide_ms} milliseconds")
            .start()
        )

    def drain(self, write: Callable[[DataFrame, int], None], timeout_s: float = 3600) -> None:
        """Run batches until one finds nothing to take."""
        drained = threading.Event()
        query = self.start(write, drained)
        try:
            while not drained.is_set():
                if query.awaitTermination(0.1):
                    raise query.exception() or RuntimeError("the stream stopped by itself")
                timeout_s -= 0.1
                if timeout_s < 0:
                    raise TimeoutError("messages are left")
        finally:
            query.stop()


def folder_writer(sink: str, *columns: str) -> Callable[[DataFrame, int], None]:
    """A ``write`` that stores a batch's columns in the batch's own folder, replaced whole on a replay."""
    return _folder_writer(sink, "batch_id", columns)


def trigger_writer(sink: str, *columns: str) -> Callable[[DataFrame, int], None]:
    """The same for a stream that catches up: a folder per trigger, ``batch_id`` is a column."""
    return _folder_writer(sink, "trigger", columns)


def _folder_writer(sink: str, name: str, columns: tuple[str, ...]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, number: int) -> None:
        (batch.select(*columns) if columns else batch).write.mode("overwrite").parquet(f"{sink}/{name}={number}")

    return write
