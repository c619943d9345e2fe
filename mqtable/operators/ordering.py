"""Order-dependent building blocks that stay balanced when one group is huge.

A queue is a low-cardinality key: a window ``PARTITION BY queue`` would put a
whole queue (possibly a third of the log) into one task.  The helpers below
split every group by a coarse, order-preserving *bucket*, solve the small
per-bucket problem on an aggregate table, and run exact windows only inside
``(group, bucket)`` partitions whose size the bucket width bounds.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mqtable.functions.time import epoch_micros, floor_div

def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def group_key(*cols) -> Column:
    """One non-null key for columns that may be null: equal nulls give equal keys.

    Joins and windows on it use plain equality on one expression, so they share one exchange.
    """
    return F.struct(*[_c(c) for c in cols])


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on same-named keys; the right side's keys are dropped.

    Spark chooses between broadcast and shuffle by the size it knows, and AQE splits hot keys.
    """
    key = group_key(*keys)
    renamed = right.withColumn("__r_key", key).drop(*keys)
    out = left.withColumn("__l_key", key)
    return out.join(renamed, out["__l_key"] == renamed["__r_key"], how).drop("__l_key", "__r_key")


# Rows one window task should see at most (about); hot time intervals are split to it.
CHUNK_TARGET_ROWS = 1 << 20
_MAX_SPLIT = 1 << 20  # sub-ranges per chunk (keeps the chunk key a long)


def _split_hot(
    d: DataFrame, partition_by: Sequence[str], target: int, base: str, values: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Split hot chunks into contiguous sub-ranges until none holds more than ``target`` rows.

    A (group, chunk) with more rows is re-based to the range its rows occupy and cut into
    ``4 * ceil(rows / target)`` (at least 64) equal parts: by the first value whose range is not a
    point, so rows that tie on one value are split by the next.  Rows that tie on all values have
    no order to keep and are dealt by hash.  Only hot chunks enter a level's side table, and the
    chunk order is the lexicographic order of the returned columns.
    """
    names = [base]
    while True:
        keys = [*partition_by, *names]
        ranges = [f(v).alias(f"__{n}{i}") for i, v in enumerate(values) for n, f in (("lo", F.min), ("hi", F.max))]
        hot = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt"), *ranges).where(F.col("__cnt") > target)
        if hot.isEmpty():
            return d, names
        name = f"{base}_{len(names)}"
        parts = F.least(F.lit(_MAX_SPLIT), F.greatest(F.lit(64), 4 * F.ceil(F.col("__cnt") / F.lit(target)))).cast("double")
        d = join_on(d, hot.withColumn("__parts", parts), keys, how="left")
        sub = F.pmod(F.xxhash64(*values), F.col("__parts").cast("long"))
        for i, v in reversed(list(enumerate(values))):
            lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
            step = (hi - lo + F.lit(1.0)) / F.col("__parts")
            cut = F.least(F.floor((F.col(v) - lo) / step), F.col("__parts") - 1).cast("long")
            sub = F.when(hi > lo, F.greatest(cut, F.lit(0))).otherwise(sub)
        ties = [F.col(f"__lo{i}") == F.col(f"__hi{i}") for i in range(len(values))]
        # a chunk of nothing but full ties is as fine as an order can make it
        d = d.withColumn(name, F.coalesce(sub, F.lit(0)).cast("long")).drop("__cnt", "__parts", *[f"__{n}{i}" for i in range(len(values)) for n in ("lo", "hi")])
        names.append(name)
        if hot.where(~reduce(lambda a, b: a & b, ties)).isEmpty():
            return d, names


def time_chunks(
    df: DataFrame,
    partition_by: Sequence[str],
    ts_us: Column,
    base_us: int,
    name: str,
    target_rows: int | None = None,
    tiebreak: Column | None = None,
) -> tuple[DataFrame, list[str]]:
    """Add chunk columns that order rows by time (then ``tiebreak``) inside each group
    (lexicographically) and hold about ``target_rows`` rows or fewer per chunk.

    Time is cut into ``base_us`` intervals; an interval with more than ``target_rows`` rows of one
    group is split into contiguous sub-intervals of the span its rows occupy, as often as needed.
    """
    d = df.withColumn("__x", ts_us.cast("double")).withColumn("__y", (tiebreak if tiebreak is not None else ts_us).cast("double"))
    d = d.withColumn(name, floor_div(ts_us, F.lit(base_us)))
    d, names = _split_hot(d, partition_by, target_rows or CHUNK_TARGET_ROWS, name, ["__x", "__y"])
    return d.drop("__x", "__y"), names


def value_chunks(
    df: DataFrame,
    partition_by: Sequence[str],
    value: Column,
    name: str,
    target_rows: int | None = None,
) -> tuple[DataFrame, list[str]]:
    """Add chunk columns that order rows by an integer ``value`` inside each group and hold about
    ``target_rows`` rows or fewer, for dense, sparse and clustered values alike.

    Each group's range ``[min, max]`` is cut into ``ceil(count / target)`` equal base ranges (a
    per-group table), then hot ranges are split further as in ``time_chunks``.
    """
    target = target_rows or CHUNK_TARGET_ROWS
    d = df.withColumn("__x", value.cast("double"))
    stats = d.groupBy(*partition_by).agg(
        F.min("__x").alias("__gmin"),
        F.max("__x").alias("__gmax"),
        F.count(F.lit(1)).alias("__n"),
    )
    pieces = F.greatest(F.lit(1.0), F.ceil(F.col("__n") / F.lit(target)).cast("double"))
    stats = stats.select(
        *partition_by, "__gmin", ((F.col("__gmax") - F.col("__gmin") + F.lit(1.0)) / pieces).alias("__bw")
    )
    d = join_on(d, stats, list(partition_by), how="left")
    base = F.floor((F.col("__x") - F.col("__gmin")) / F.col("__bw")).cast("long")
    d, names = _split_hot(d.withColumn(name, base).drop("__gmin", "__bw"), partition_by, target, name, ["__x"])
    return d.drop("__x"), names


def ordinal(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column],
    buckets: Sequence[Column],
    name: str,
    max_rank: int | None = None,
) -> DataFrame:
    """``row_number() OVER (PARTITION BY partition_by ORDER BY order_by)`` computed
    without a per-group single task.

    ``buckets`` are coarse sort keys (ascending) that agree with ``order_by``
    (e.g. ``id div 2^20``).  Rows are counted per (group, bucket), bucket
    offsets come from a running sum over that small table, and the exact
    ``row_number`` runs per (group, bucket) only.  The offset join and the
    window share one shuffle on (group, bucket).  With ``max_rank`` only rows
    ranked ``<= max_rank`` are returned and buckets wholly past it are dropped
    before the shuffle.
    """
    bnames = [f"__b{i}" for i in range(len(buckets))]
    d = df
    for n, c in zip(bnames, buckets):
        d = d.withColumn(n, c)
    keys = list(partition_by) + bnames
    counts = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*partition_by).orderBy(*bnames).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group_key(*keys).alias("__okey"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    d = d.withColumn("__key", group_key(*keys)).drop(*bnames)
    # every (group, bucket) has an offset row, so LEFT equals INNER; LEFT lets Catalyst
    # drop the whole numbering when the ordinal is not used
    how = "left"
    if max_rank is not None:
        offsets, how = offsets.where(F.col("__off") < F.lit(max_rank)), "inner"
    joined = d.join(offsets, d["__key"] == offsets["__okey"], how).drop("__okey")
    inner = Window.partitionBy("__key").orderBy(*order_by)
    out = joined.withColumn(name, (F.col("__off") + F.row_number().over(inner)).cast("long"))
    if max_rank is not None:
        out = out.where(F.col(name) <= F.lit(max_rank))
    return out.drop("__off", "__key")


def _weighed(df: DataFrame, bucket: Column, budgets: Sequence[tuple[Column, Column]], splits: Sequence[Column]) -> tuple[DataFrame, list[str], list[str]]:
    """``df`` with ``__bk``, the splits' numbers, and the budgets' weights and limits, whose names it returns."""
    d = df.withColumn("__bk", bucket)
    for name, value in zip(("__t", "__i"), splits):
        d = d.withColumn(name, value.cast("long"))
    ws, ls = [], []
    for i, (weight, limit) in enumerate(budgets):
        d = d.withColumn(f"__w{i}", F.coalesce(weight, F.lit(0)).cast("long"))
        d = d.withColumn(f"__l{i}", limit.cast("long"))
        ws.append(f"__w{i}")
        ls.append(f"__l{i}")
    return d, ws, ls


def _bucket_classes(d: DataFrame, partition_by: Sequence[str], ws: Sequence[str], ls: Sequence[str]) -> DataFrame:
    """Per (group, bucket): the newer buckets' sums, the rows, and whether it lies ``in`` or ``out`` of the budgets or is ``cut``."""
    keys = list(partition_by) + ["__bk"]
    per = d.groupBy(*keys).agg(
        *[F.sum(w).alias(f"__bw{i}") for i, w in enumerate(ws)],
        *[F.max(lim).alias(f"__L{i}") for i, lim in enumerate(ls)],
        F.count(F.lit(1)).alias("__cnt"),
    )
    newer = Window.partitionBy(*partition_by).orderBy(F.col("__bk").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    inside, outside = [], []
    for i in range(len(ws)):
        before = F.coalesce(F.sum(f"__bw{i}").over(newer), F.lit(0))
        per = per.withColumn(f"__before{i}", before)
        lim = F.col(f"__L{i}")
        inside.append(lim.isNull() | (F.col(f"__before{i}") + F.col(f"__bw{i}") <= lim))
        outside.append(lim.isNotNull() & (F.col(f"__before{i}") > lim))
    all_in = reduce(lambda a, b: a & b, inside)
    any_out = reduce(lambda a, b: a | b, outside)
    return per.select(
        *keys,
        *[f"__before{i}" for i in range(len(ws))],
        F.when(all_in, F.lit("in")).when(any_out, F.lit("out")).otherwise(F.lit("cut")).alias("__cls"),
        "__cnt",
    )


def newest_within(
    df: DataFrame,
    partition_by: Sequence[str],
    bucket: Column,
    newest_first: Sequence[Column],
    budgets: Sequence[tuple[Column, Column]],
    keep: bool = True,
    splits: Sequence[Column] = (),
    target_rows: int | None = None,
) -> DataFrame:
    """Rows of the longest newest suffix per group that fits every budget.

    Each budget ``(weight, limit)`` means ``sum(weight) OVER (PARTITION BY g ORDER
    BY newest_first ROWS UNBOUNDED PRECEDING) <= limit`` (weight 1 gives
    ``row_number() <= limit``; NULL limit = unlimited).  Each condition keeps a
    prefix in newest-first order, so their conjunction is one too, and limits
    applied one after the other give the same rows.  ``bucket`` must grow with
    recency (e.g. an hour index) and limits must be constant per group.
    Buckets wholly inside or outside all budgets are decided on the small
    per-bucket table; the exact running sums run only in the one bucket per
    group that straddles the cut.  ``keep=False`` returns the dropped rows.

    ``splits`` are the two numbers that ``newest_first`` sorts by first, both descending.  A straddling
    bucket of over ``target_rows`` rows is then cut into parts by ``_newest_parts``, and the running sums
    start from the sums of the newer parts, so no task sees the whole bucket.
    """
    d, ws, ls = _weighed(df, bucket, budgets, splits)
    keys = list(partition_by) + ["__bk"]
    per = _bucket_classes(d, partition_by, ws, ls)
    parts = ["__part"] if splits else []
    in_run = Window.partitionBy(*keys, *parts).orderBy(*newest_first).rowsBetween(Window.unboundedPreceding, 0)
    fits = reduce(
        lambda a, b: a & b,
        [
            F.col(f"__l{i}").isNull() | (F.col(f"__before{i}") + F.sum(f"__w{i}").over(in_run) <= F.col(f"__l{i}"))
            for i in range(len(budgets))
        ],
    )
    drop_cols = ["__bk", "__cls", "__cnt", "__fits", "__t", "__i", *parts, *ws, *ls, *[f"__before{i}" for i in range(len(budgets))]]

    # only the straddling rows reach a window; Spark computes ``per`` once for both branches
    joined = join_on(d, per, keys)
    whole = joined.where(F.col("__cls") == ("in" if keep else "out"))
    cut = joined.where(F.col("__cls") == "cut")
    if splits:
        hot = join_on(d, per.where((F.col("__cls") == "cut") & (F.col("__cnt") > (target_rows or CHUNK_TARGET_ROWS))), keys)
        cut = _newest_parts(cut, hot, keys, ws)
    cut = cut.withColumn("__fits", fits)
    cut = cut.where(F.col("__fits") if keep else ~F.col("__fits"))
    return whole.drop(*drop_cols).unionByName(cut.drop(*drop_cols))


def beyond_budgets(
    df: DataFrame,
    partition_by: Sequence[str],
    bucket: Column,
    newest_first: Sequence[Column],
    budgets: Sequence[tuple[Column, Column]],
    name: str,
    splits: Sequence[Column],
    write: Callable[[DataFrame], DataFrame],
    target_rows: int | None = None,
) -> DataFrame:
    """``df`` with ``name``: whether ``newest_within`` drops the row, for a ``df`` that is cheap to read again.

    Newest first, a group's buckets are inside the budgets, then one may straddle the cut, and the rest are
    outside.  So a row per group says it all; ``write`` stores these rows, and as Spark knows their size, it
    joins few of them without moving any message.  Only straddling buckets are shuffled, in parts where hot.
    """
    d, ws, ls = _weighed(df, bucket, budgets, splits)
    befores = [f"__before{i}" for i in range(len(ws))]
    at, out = F.col("__cls") == "cut", F.col("__cls") == "out"
    bounds = _bucket_classes(d, partition_by, ws, ls).groupBy(*partition_by).agg(
        F.max(at).alias("__has_cut"), F.max(F.when(at, F.col("__bk"))).alias("__cut"), F.max(F.when(at, F.col("__cnt"))).alias("__cnt"),
        F.max(out).alias("__has_out"), F.max(F.when(out, F.col("__bk"))).alias("__out"), *[F.max(F.when(at, F.col(x))).alias(x) for x in befores],
    )
    bounds = write(bounds)
    d = join_on(d, bounds, partition_by)
    straddles = F.col("__has_cut") & F.col("__bk").eqNullSafe(F.col("__cut"))
    # rows without a bucket are the oldest
    past = F.col("__has_out") & (F.col("__bk").isNull() | F.coalesce(F.col("__bk") <= F.col("__out"), F.lit(False)))
    cut, keys = d.where(straddles), [*partition_by, "__bk"]
    hot = F.col("__cnt") > (target_rows or CHUNK_TARGET_ROWS)
    if bounds.where(hot).isEmpty():
        cut = cut.withColumn("__part", F.lit(0))
    else:
        cut = _newest_parts(cut, cut.where(hot), keys, ws)
    run = Window.partitionBy(*keys, "__part").orderBy(*newest_first).rowsBetween(Window.unboundedPreceding, 0)
    over = [F.coalesce(F.col(b) + F.sum(w).over(run) > F.col(x), F.lit(False)) for b, w, x in zip(befores, ws, ls)]
    cut = cut.withColumn(name, reduce(lambda a, b: a | b, over))
    rows = [*df.columns, name]
    return d.where(~straddles).withColumn(name, past).select(*rows).unionByName(cut.select(*rows))


_PARTS = 64  # parts of a hot straddling bucket; each holds about this share of its rows at most


def _newest_parts(cut: DataFrame, hot: DataFrame, keys: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """``cut`` with ``__part``, ordered like (``__t``, ``__i``), and ``__before*`` raised by the newer parts' sums.

    Quantile sketches of both numbers over a bucket's ``hot`` rows give the bounds.  A time between two
    bounds belongs to the part between them, which has few rows.  A time that is a bound itself may have any
    number of rows: it is a part of its own, cut again by the bounds of ``__i``, which is its order.  Buckets
    without hot rows are one part.
    """
    shares = F.array(*[F.lit(i / _PARTS) for i in range(1, _PARTS)])
    bounds = hot.groupBy(*keys).agg(
        F.percentile_approx("__t", shares, 10 * _PARTS).alias("__tb"), F.percentile_approx("__i", shares, 10 * _PARTS).alias("__ib")
    )

    def placed(df: DataFrame, how: str) -> DataFrame:
        df = join_on(df, bounds, keys, how=how)
        below = F.size(F.filter("__tb", lambda b: b < F.col("__t")))
        inner = F.when(F.array_contains("__tb", F.col("__t")), 1 + F.coalesce(F.size(F.filter("__ib", lambda b: b < F.col("__i"))), F.lit(0))).otherwise(0)
        # a bound's own rows are newer than those below it, older than those above
        own = F.when(inner > 0, below * 2 + 1).otherwise(below * 2)
        known = F.col("__tb").isNotNull() & F.col("__t").isNotNull()  # no time sorts last
        return df.withColumn("__part", F.when(known, own * (_PARTS + 1) + inner).otherwise(-1)).drop("__tb", "__ib")

    sums = placed(hot, "inner").groupBy(*keys, "__part").agg(*[F.sum(w).alias(f"__s{w}") for w in weights])
    newer = Window.partitionBy(*keys).orderBy(F.col("__part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "__part", *[F.coalesce(F.sum(f"__s{w}").over(newer), F.lit(0)).alias(f"__n{w}") for w in weights])
    cut = join_on(placed(cut, "left"), sums, [*keys, "__part"], how="left")
    for i, w in enumerate(weights):
        cut = cut.withColumn(f"__before{i}", F.col(f"__before{i}") + F.coalesce(F.col(f"__n{w}"), F.lit(0)))
    return cut.drop(*[f"__n{w}" for w in weights])


def gap_sessions(
    df: DataFrame,
    partition_by: Sequence[str],
    ts: str,
    gap_us: int | Column,
    chunk_us: int,
    tiebreak: Iterable[str] = (),
) -> DataFrame:
    """Gap sessions per group: a new session starts when the previous event of the
    group is ``>= gap`` earlier (or there is none; a NULL gap never ends one).  Returns
    ``partition_by..., session_start (ts type), n``.

    Time is cut into chunks of ``chunk_us`` (hot chunks split further by
    ``time_chunks``); the previous event of a chunk's
    first row comes from the small per-chunk table, so every window runs per
    (group, chunk).  Rows before the first start in a chunk belong to the last
    session of an earlier chunk, resolved on the per-(chunk, session) table.
    """
    tiebreak = list(tiebreak)
    gap = gap_us if isinstance(gap_us, Column) else F.lit(gap_us)
    d = df.select(*partition_by, *tiebreak, F.col(ts).alias("__ts"), gap.alias("__gap")).withColumn(
        "__us", epoch_micros("__ts")
    )
    d, cks = time_chunks(
        d, partition_by, F.col("__us"), chunk_us, "__ck", tiebreak=F.xxhash64(*tiebreak) if tiebreak else None
    )
    keys = list(partition_by) + cks
    chunks = d.groupBy(*keys).agg(F.max("__us").alias("__cmax"))
    chunks = chunks.select(
        *keys, F.lag("__cmax").over(Window.partitionBy(*partition_by).orderBy(*cks)).alias("__pmax")
    )
    d = join_on(d, chunks, keys)
    local = Window.partitionBy(*keys).orderBy("__us", *tiebreak)
    prev = F.coalesce(F.lag("__us").over(local), F.col("__pmax"))
    d = d.withColumn("__start", prev.isNull() | F.coalesce(F.col("__us") - prev >= F.col("__gap"), F.lit(False)))
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn(
        "__sess",
        F.max(F.when(F.col("__start"), F.struct("__us", "__ts"))).over(upto),
    )
    pieces = d.groupBy(*keys, "__sess").agg(F.count(F.lit(1)).alias("__n"))
    owner_w = (
        Window.partitionBy(*partition_by)
        .orderBy(*cks, F.col("__sess").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    pieces = pieces.withColumn("__owner", F.last("__sess", ignorenulls=True).over(owner_w))
    out = pieces.groupBy(*partition_by, "__owner").agg(F.sum("__n").cast("long").alias("n"))
    return out.select(*partition_by, F.col("__owner.__ts").alias("session_start"), "n")
