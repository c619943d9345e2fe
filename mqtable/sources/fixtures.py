"""The canonical message view over the driver's ``events`` table, and side tables.

Every queue operator reads messages in ``MESSAGE_SCHEMA`` shape; this module
derives them from ``events`` (so the work grows with the data) and defines
the small binding / source / policy tables used by the registered queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mqtable.functions.text import headers_map
from mqtable.functions.time import floor_div
from mqtable.operators.ordering import ordinal
from mqtable.schema import BINDING_SCHEMA, POLICY_SCHEMA, SOURCE_SCHEMA



# Width (in event ids) of the buckets the per-queue tag numbering is split into;
# bounds the rows one numbering task sees, whatever the queue skew.
TAG_BUCKET_IDS = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def message_view(spark: SparkSession, sf_dir: str, with_tag: bool = True) -> DataFrame:
    """``events`` as messages: one queue per event type, exchange ``events``,
    routing key ``events.<type>.u<user mod 4>``, every 17th body truncated
    (malformed JSON), optional ``user`` header, nullable priority, and the
    handler failure count used by redelivery.  ``delivery_tag`` is the dense
    per-queue position in ``event_id`` order (only computed when asked for).
    """
    ev = read_table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    m = ev.select(
        eid.alias("message_id"),
        F.col("event_type").alias("queue"),
        F.lit("events").alias("exchange"),
        F.concat(
            F.lit("events."), F.col("event_type"), F.lit(".u"), (uid % 4).cast("string")
        ).alias("routing_key"),
        F.when(
            eid % 17 == 0, F.expr("substring(props, 1, length(props) - 1)")
        ).otherwise(F.col("props")).cast("binary").alias("body"),
        F.when(uid % 2 == 0, uid.cast("string")).alias("header_user"),
        F.when(uid % 5 != 0, uid % 7).cast("int").alias("priority"),
        F.when(eid % 34 == 0, F.lit(99))
        .when(eid % 17 == 0, 1 + eid % 3)
        .otherwise(F.lit(0))
        .cast("int")
        .alias("fail_count"),
        F.col("ts").alias("published_at"),
    )
    m = m.withColumn("headers", headers_map(user=F.col("header_user"))).drop("header_user")
    if with_tag:
        # event ids are dense (0..n-1), so fixed-width id buckets hold at most
        # TAG_BUCKET_IDS rows each and need no extra pass; for ids of unknown
        # density use ``value_chunks`` (as publishing does)
        m = ordinal(
            m,
            partition_by=["queue"],
            order_by=[F.col("message_id")],
            buckets=[floor_div("message_id", F.lit(TAG_BUCKET_IDS))],
            name="delivery_tag",
        )
    return m


# --- fixed values: side tables of the registered queries ----------------------
BINDINGS = [
    ("all", "events", "topic", "#"),
    ("clicks", "events", "topic", "events.click.*"),
    ("clicks", "events", "topic", "#.u1"),
    ("u2", "events", "topic", "#.u2"),
    ("mid", "events", "topic", "*.error.#"),
    ("none", "events", "topic", "events.*"),
    ("exact", "events", "direct", "events.view.u0"),
    ("exact", "events", "direct", "events.view.u1"),
    ("fan_a", "events", "fanout", "x"),
    ("fan_b", "events", "fanout", "y"),
]

DEAD_BINDINGS = [
    ("dead_all", "dlx", "topic", "#"),
    ("dead_clicks", "dlx", "direct", "dead.click"),
]

# queues that pass dead letters on: first -> second -> third -> first
HOP_POLICIES = [
    ("click", 100, None, None, None, "dlx", "hop.one", None),
    ("error", None, 86400000, None, None, "dlx", None, None),
    ("first", 400, None, None, None, "dlx", "hop.two", None),
    ("second", None, 604800000, None, None, "dlx", "hop.three", None),
    ("third", 50, None, None, None, "dlx", "hop.one", None),
    ("view", 1000, None, None, None, "dlx", "nowhere", None),
    ("signup", None, None, None, None, None, None, None),
    ("purchase", 500, None, None, None, None, None, None),
]
HOP_BINDINGS = [
    ("first", "dlx", "direct", "hop.one"),
    ("first", "dlx", "topic", "events.error.#"),
    ("second", "dlx", "direct", "hop.two"),
    ("third", "dlx", "direct", "hop.three"),
]

SOURCES = [
    (0, "click", "events", "topic", "events.click.*,#.u1", {"levelParallelism": "2"}),
    (1, "error", "events", None, "events.error.#", {}),
    (2, "view", None, None, None, {"maxMessagesPerPartition": "10"}),
    (3, "ghost", "events", "topic", None, {"levelParallelism": "junk"}),
]

POLICIES = [
    ("click", 100, None, 3600000, None, "dlx", "dead.click", 5),
    ("error", None, 86400000, 3600000, None, "dlx", None, 5),
    ("view", None, None, 3600000, 2000, None, None, 3),
    ("signup", None, None, None, None, None, None, None),
    ("purchase", None, None, None, None, None, None, None),
]
# -------------------------------------------------------------------------------


def bindings_table(spark: SparkSession, exchange_type: str | None = None, queues=None) -> DataFrame:
    rows = [b for b in BINDINGS if exchange_type is None or b[2] == exchange_type]
    if queues is not None:
        rows = [b for b in rows if b[0] in queues]
    return spark.createDataFrame(rows, BINDING_SCHEMA)


def dead_bindings_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEAD_BINDINGS, BINDING_SCHEMA)


def hop_policies_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HOP_POLICIES, POLICY_SCHEMA)


def hop_bindings_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HOP_BINDINGS, BINDING_SCHEMA)


def sources_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCES, SOURCE_SCHEMA)


def policies_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POLICIES, POLICY_SCHEMA)
