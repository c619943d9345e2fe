"""Queue policies as table operators (Q1-Q7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mqtable.functions.time import MS, epoch_micros, floor_div
from mqtable.operators.ordering import beyond_budgets, gap_sessions, join_on, newest_within, ordinal
from mqtable.operators.routing import resolve_routes
from mqtable.session import scratch_path

SECOND_US, HOUR_US = 1_000 * MS, 3_600_000 * MS
TAG_BUCKET = 1 << 20
EXPIRED, MAXLEN = "expired", "maxlen"


def _lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def latest_publish(m: DataFrame) -> Column:
    """Scalar subquery: the newest publish time of the log (default 'now')."""
    return m.select(F.max("published_at")).scalar()


def is_expired(ttl_ms, as_of: Column) -> Column:
    """A message is dead once ``published_at + ttl <= as_of`` (NULL ttl: never)."""
    return _expired_by(ttl_ms, epoch_micros(as_of))


def _expired_by(ttl_ms, as_of_us: Column) -> Column:
    ttl = _lit_or_col(ttl_ms).cast("long")
    return (epoch_micros("published_at") + ttl * F.lit(MS)) <= as_of_us


def ttl_live(m: DataFrame, ttl_ms, as_of: Column | None = None) -> DataFrame:
    """Q1: messages still alive at ``as_of``."""
    as_of = latest_publish(m) if as_of is None else as_of
    return m.where(~F.coalesce(is_expired(ttl_ms, as_of), F.lit(False)))


def _body_bytes() -> Column:
    return F.octet_length(F.col("body").cast("binary"))


def _recency_bucket(bucket_us: int) -> Column:
    return floor_div(epoch_micros("published_at"), F.lit(bucket_us))


def _newest(m: DataFrame) -> list[Column]:
    """Newest first, ties by the tag; messages without tags are not numbered for it: their tags would rise with the id."""
    return [F.col("published_at").desc(), F.col("delivery_tag" if "delivery_tag" in m.columns else "message_id").desc()]


def _newest_numbers(m: DataFrame) -> list[Column]:
    """What ``_newest`` sorts by, as numbers."""
    return [epoch_micros("published_at"), F.col("delivery_tag" if "delivery_tag" in m.columns else "message_id")]


def max_length(m: DataFrame, limit, keep: bool = True, bucket_us: int = SECOND_US, target_rows: int | None = None) -> DataFrame:
    """Q2: newest ``limit`` messages per queue (drop-head overflow), for any limit.

    Whole seconds inside or outside the limit are decided on their counts; a window sees only the
    one second per queue that straddles it, in parts if that has over ``target_rows`` rows, even if
    all of them share an instant.
    """
    budget = [(F.lit(1), _lit_or_col(limit))]
    return newest_within(m, ["queue"], _recency_bucket(bucket_us), _newest(m), budget, keep, _newest_numbers(m), target_rows)


def max_length_bytes(
    m: DataFrame, limit, keep: bool = True, bucket_us: int = SECOND_US, target_rows: int | None = None
) -> DataFrame:
    """Q3: longest newest suffix per queue whose body bytes total <= ``limit``."""
    budget = [(_body_bytes(), _lit_or_col(limit))]
    return newest_within(m, ["queue"], _recency_bucket(bucket_us), _newest(m), budget, keep, _newest_numbers(m), target_rows)


def dead_lettered(
    m: DataFrame, policies: DataFrame, as_of: Column | None = None, target_rows: int | None = None
) -> DataFrame:
    """Q4/Q5: messages a queue's policies remove, re-addressed to the dead-letter
    exchange (``reason`` expired / maxlen); without one they are gone.
    Expiry is applied first, then the length and byte limits to what is left.

    With ``target_rows`` a straddling second of more rows is split, as in ``max_length``.  That reads the
    messages a few times more, so without it such a second of a queue is one task."""
    as_of = latest_publish(m) if as_of is None else as_of
    mp = join_on(m, policies, ["queue"])  # one row per queue
    dead_exp = F.coalesce(is_expired(F.col("message_ttl_ms"), as_of), F.lit(False))
    expired = mp.where(dead_exp).withColumn("reason", F.lit(EXPIRED))
    live = mp.where(~dead_exp)
    budgets = [(F.lit(1), F.col("max_length")), (_body_bytes(), F.col("max_length_bytes"))]
    over = newest_within(live, ["queue"], _recency_bucket(SECOND_US), _newest(m), budgets, False, _newest_numbers(m) if target_rows else (), target_rows)
    over = over.withColumn("reason", F.lit(MAXLEN))
    dead = expired.unionByName(over).where(F.col("dead_letter_exchange").isNotNull())
    return dead.withColumn("exchange", F.col("dead_letter_exchange")).withColumn(
        "routing_key", F.coalesce("dead_letter_routing_key", "routing_key")
    )


def dead_letter_hops(m: DataFrame, policies: DataFrame, bindings: DataFrame, as_of: Column) -> DataFrame:
    """Q4/Q5 over several hops: ``message_id, hop, queue, reason, to_queue, cycle``, a row per dead letter and queue it is
    routed to (NULL: none).

    A dead letter enters the queues that its dead-letter exchange binds, where it meets the messages there and
    the queue's own policies, until none moves.  It is dropped, with ``cycle``, from a queue it has been in
    before, so a message makes at most as many hops as there are queues.  An expired message enters at the time
    it expired, one over a limit keeps its time.

    Each hop looks only at the queues that something entered, and keeps what stays only in queues that a binding
    names, as no other is looked at again.  It writes to the shared folder: what is there, without the bodies, then
    the letters and what stays; and the small tables (policies, a row per queue of where its limit cuts,
    routes of distinct keys), so that Spark knows their sizes and no join with them moves the messages.
    ``as_of`` is one instant.
    """
    spark = m.sparkSession
    folder = scratch_path(spark, "dead-letter-hops")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    columns = ["message_id", "queue", "routing_key", "size", "published_at", "path"]
    now = F.lit(spark.range(1).select(epoch_micros(as_of)).first()[0]).cast("long")
    policies, bindings = kept(policies, "policies"), kept(bindings, "bindings")
    bound = kept(bindings.select("queue").distinct().withColumn("enterable", F.lit(True)), "bound")
    entered = m.withColumn("path", F.array("queue")).withColumn("size", _body_bytes()).select(*columns)
    stayed, letters, hop = None, [], 0
    expiry = F.timestamp_add("MILLISECOND", F.col("message_ttl_ms").cast("long"), F.col("published_at"))
    newest = [F.col("published_at").desc(), F.col("message_id").desc(), F.array_join("path", "/").desc()]
    numbers = [epoch_micros("published_at"), F.col("message_id")]
    budgets = [(F.lit(1), F.col("max_length")), (F.col("size"), F.col("max_length_bytes"))]
    while True:
        there = entered
        if stayed is not None:
            again = kept(entered.select("queue").distinct(), f"entered-{hop}")
            there = there.unionByName(join_on(stayed, again, ["queue"], how="left_semi"))
            quiet = join_on(stayed, again, ["queue"], how="left_anti")
        there = join_on(kept(there, f"there-{hop}"), policies, ["queue"])
        dead = F.coalesce(_expired_by(F.col("message_ttl_ms"), now), F.lit(False))
        live = beyond_budgets(there.where(~dead), ["queue"], _recency_bucket(SECOND_US), newest, budgets, "over", numbers, lambda df: kept(df, f"cuts-{hop}"))
        expired = there.where(dead).withColumn("reason", F.lit(EXPIRED)).withColumn("published_at", expiry)
        fates = expired.unionByName(live.withColumn("reason", F.when(F.col("over"), F.lit(MAXLEN))).drop("over"))
        fates = join_on(fates, bound, ["queue"], how="left").where("reason IS NOT NULL OR enterable")
        fates = fates.select(*columns, "reason", F.col("dead_letter_exchange").alias("exchange"), F.coalesce("dead_letter_routing_key", "routing_key").alias("dead_key"))
        fates = kept(fates, f"fates-{hop}")
        moved = fates.where("reason IS NOT NULL").withColumn("routing_key", F.col("dead_key"))
        asked = kept(moved.where("exchange IS NOT NULL").select("exchange", "routing_key").distinct(), f"keys-{hop}")
        routes = kept(resolve_routes(asked, bindings), f"routes-{hop}")
        routed = join_on(moved, routes, ["exchange", "routing_key"], how="left").withColumn("hop", F.lit(hop))
        cycle = F.coalesce(F.array_contains("path", F.col("bound_queue")), F.lit(False))
        routed = routed.withColumn("cycle", cycle).select(*columns, "hop", "reason", "bound_queue", "cycle")
        letters.append(routed)
        left = fates.where("reason IS NULL").select(*columns)
        # what was not looked at this time stays too
        left = left if stayed is None else left.unionByName(quiet)
        entered = routed.where("bound_queue IS NOT NULL AND NOT cycle").withColumn("path", F.concat("path", F.array("bound_queue")))
        entered = entered.withColumn("queue", F.col("bound_queue")).select(*columns)
        if entered.isEmpty():
            break
        stayed = kept(left, f"stayed-{hop}")
        hop += 1
    events = reduce(DataFrame.unionByName, letters)
    return events.select("message_id", "hop", "queue", "reason", F.col("bound_queue").alias("to_queue"), "cycle")


def priority_positions(m: DataFrame, max_priority, batch_col: str = "batch_id") -> DataFrame:
    """Q6: delivery position inside each (batch, queue): higher effective priority
    first (``least(coalesce(priority, 0), max)``), then arrival order."""
    eff = F.least(F.coalesce("priority", F.lit(0)), _lit_or_col(max_priority))
    d = m.withColumn("__prio", F.coalesce(eff, F.lit(0)))
    return ordinal(
        d,
        partition_by=[batch_col, "queue"],
        order_by=[F.col("__prio").desc(), F.col("delivery_tag")],
        buckets=[-F.col("__prio"), floor_div("delivery_tag", F.lit(TAG_BUCKET))],
        name="pos",
    ).drop("__prio")


def with_expiry(m: DataFrame, policies: DataFrame) -> DataFrame:
    """``m`` with its queue's ``expires_ms`` (NULL: the queue never expires)."""
    return join_on(m, policies.select("queue", "expires_ms"), ["queue"], how="left")


def queue_leases(m: DataFrame, expires_ms: int | Column, chunk_us: int = 24 * HOUR_US) -> DataFrame:
    """Q7: a queue unused for ``expires`` is deleted; each run of activity with gaps
    shorter than that is one lease: ``queue, lease_start, n``.  The time may differ per queue
    (``with_expiry``); where it is NULL the queue has one lease."""
    gap = _lit_or_col(expires_ms).cast("long") * MS
    s = gap_sessions(m, ["queue"], "published_at", gap, chunk_us, tiebreak=["message_id"])
    return s.withColumnRenamed("session_start", "lease_start")
