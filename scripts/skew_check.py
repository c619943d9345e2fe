"""Skew experiment: skew-proof operators vs naive PARTITION BY queue windows.

Derives a 10M-message ``events`` table from sf0.1 (x100, one queue with ~60%
of the rows) under the shared scratch folder, runs each operator into the
noop sink with Spark's event log on, and prints wall time plus the slowest
task and the most shuffle records one task read.

    python scripts/skew_check.py [source_sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    from pyspark.sql import SparkSession, Window as W
    from pyspark.sql import functions as F

    src = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    probe = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    from mqtable.session import scratch_path

    run = scratch_path(probe, "skew").replace("file:", "")
    probe.stop()
    evdir = f"{run}/eventlog"
    os.makedirs(evdir, exist_ok=True)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", evdir)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from mqtable.operators import retention
    from mqtable.sources.fixtures import message_view

    ev = spark.read.parquet(f"{src}/events.parquet")
    k = spark.range(0, 100).withColumnRenamed("id", "k")
    hot = F.pmod(F.xxhash64("event_id", "k"), F.lit(10)) < 6
    big = ev.crossJoin(F.broadcast(k)).select(
        (F.col("event_id") * 100 + F.col("k")).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("k").cast("decimal(8,6)") / 10)).alias("ts"),
        (F.col("user_id") + F.col("k")).alias("user_id"),
        F.when(hot, F.lit("hot")).otherwise(F.col("event_type")).alias("event_type"),
        "value",
        "props",
    )
    big.repartition(16).write.parquet(f"{run}/events.parquet")

    windows = {}

    def timed(name, df):
        t = time.time()
        df.write.format("noop").mode("overwrite").save()
        windows[name] = (t, time.time())

    m, m0 = message_view(spark, run), message_view(spark, run, with_tag=False)
    timed("warm", m0.select("message_id"))
    timed("tags_ours", m.select("queue", "delivery_tag", "message_id"))
    naive = m0.withColumn("delivery_tag", F.row_number().over(W.partitionBy("queue").orderBy("message_id")).cast("long"))
    timed("tags_naive", naive.select("queue", "delivery_tag", "message_id"))
    m.write.parquet(f"{run}/tagged.parquet")
    tagged = spark.read.parquet(f"{run}/tagged.parquet")
    newest = W.partitionBy("queue").orderBy(F.col("published_at").desc(), F.col("delivery_tag").desc())
    timed("maxbytes_ours", retention.max_length_bytes(tagged, 2000).select("queue", "message_id"))
    run_bytes = F.sum(F.octet_length("body")).over(newest.rowsBetween(W.unboundedPreceding, 0))
    timed("maxbytes_naive", tagged.withColumn("cb", run_bytes).where("cb <= 2000").select("queue", "message_id"))
    timed("leases_ours", retention.queue_leases(m0, 60_000))
    w = W.partitionBy("queue").orderBy("published_at", "message_id")
    prev = F.lag("published_at").over(w)
    s = m0.withColumn("start", (prev.isNull() | (F.col("published_at") - prev >= F.expr("INTERVAL 1 MINUTE"))).cast("int"))
    s = s.withColumn("sid", F.sum("start").over(w.rowsBetween(W.unboundedPreceding, 0)))
    timed("leases_naive", s.groupBy("queue", "sid").agg(F.count("*").alias("n")))
    spark.stop()

    import zstandard

    tasks = []
    for f in glob.glob(f"{evdir}/*/events_*"):
        raw = open(f, "rb").read()
        text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode() if f.endswith(".zstd") else raw.decode()
        for line in text.splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in e:
                tm = e["Task Metrics"]
                rec = tm.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                tasks.append((e["Task Info"]["Launch Time"] / 1000, tm["Executor Run Time"] / 1000, rec))
    out = {}
    for name, (a, b) in windows.items():
        mine = [t for t in tasks if a <= t[0] <= b]
        out[name] = {
            "wall_s": round(b - a, 1),
            "max_task_s": round(max((t[1] for t in mine), default=0), 2),
            "max_task_shuffle_records": max((t[2] for t in mine), default=0),
        }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
