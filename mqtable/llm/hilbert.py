"""Approximate nearest neighbours over shifted space-filling curves.

Each curve projects the vectors onto a few random orthogonal directions, squashes and shifts the
coordinates, and orders the vectors by Hilbert key.  Spark range-partitions every ordering; a row's
position is the count of the partitions before it plus its place in its own.  A query is compared
with the rows in a window of positions around its own place on every curve; the windows' best are
merged and ranked by exact distance.

* Equal vectors are one class with its smallest ids, so a vector that a third of the rows share costs
  one place on a curve, and ties go to the smallest ids exactly.
* The window is a share of the ordering: in data without structure the neighbours of a point are
  spread over a fixed share of any curve, so a fixed width would lose recall as the data grow.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mqtable.llm.common import map_arrow, materialize

CURVES, DIMS, BITS = 16, 4, 12
#: Share of an ordering that a query's window covers, and rows on either side at least.
SHARE, LEAST_SIDE = 0.1, 256
#: Positions and queries that one task compares.
BUCKET, QUERIES_AT_ONCE = 4096, 4096
SEED = 20240


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid ``cells`` (``bits`` per axis), by Gray-code unfolding."""
    x = cells.T.astype(np.int64)
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> level) & 1
    return key


def _directions(dim: int, curves: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Projection of all curves side by side, and their shifts."""
    rng = np.random.default_rng(SEED)
    turns = [np.linalg.qr(rng.normal(size=(dim, min(dim, dims))))[0] for _ in range(curves)]
    return np.hstack(turns), rng.random(curves * min(dim, dims)) / 2


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda c: c != 0), F.lit(False))


def _ordered(classes: DataFrame, dim: int, curves: int, dims: int) -> DataFrame:
    """``curve, pos, rep, vec, asks`` with positions from 0 along each curve."""
    spread, shift = _directions(dim, curves, dims)
    width = spread.shape[1] // curves

    def sums(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count, first, second = 0, np.zeros(spread.shape[1]), np.zeros(spread.shape[1])
        for batch in batches:
            y = _matrix(batch.column(0), dim) @ spread
            count, first, second = count + len(y), first + y.sum(0), second + (y**2).sum(0)
        yield pa.RecordBatch.from_pydict({"axis": np.arange(len(first)), "n": np.full(len(first), count), "a": first, "b": second})

    # one row per axis, however many rows there are
    stats = map_arrow(classes.select("vec"), sums, "axis long, n long, a double, b double").groupBy("axis").agg(
        F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")
    ).orderBy("axis").toPandas()
    mean = (stats.a / stats.n).to_numpy()
    scale = np.sqrt(np.maximum(stats.b / stats.n - mean**2, 0).to_numpy())
    scale[scale == 0] = 1

    def keyed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                z = np.clip((_matrix(part.column(1), dim) @ spread - mean) / scale, -20, 20)
                place = 0.5 / (1 + np.exp(-1.7 * z)) + shift
                cells = np.minimum((place * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
                for curve in range(curves):
                    key = hilbert_keys(cells[:, curve * width : (curve + 1) * width], BITS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(part.num_rows, curve, np.int32)), pa.array(key), *part.columns],
                        names=["curve", "key", "rep", "vec", "asks"],
                    )

    vec = classes.schema["vec"].dataType.simpleString()
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        map_arrow(classes.select("rep", "vec", "asks"), keyed, f"curve int, key long, rep long, vec {vec}, asks boolean")
        .repartitionByRange(parts, "curve", "key", "rep")
        .sortWithinPartitions("curve", "key", "rep")
    )
    placed = materialize(
        placed.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "curves"
    )
    # a partition holds one stretch of each of its curves; the table of stretches has one row for each
    stretches = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first_row"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stretches.select(
        "curve", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_row")).alias("offset")
    )
    return placed.join(offsets, ["curve", "part"]).select(
        "curve", (F.col("row") + F.col("offset")).alias("pos"), "rep", "vec", "asks"
    )


def _best(k: int, dim: int):
    """Per query of a group its ``k`` nearest rows by exact distance, ties to the smaller ``rep``."""

    def search(table):
        import pyarrow as pa

        asks = table.column("asks").to_numpy()
        reps = table.column("rep").to_numpy()
        x = _matrix(table.column("vec").combine_chunks(), dim).astype(np.float64)
        rows, asked = np.flatnonzero(~asks), np.flatnonzero(asks)
        out: tuple[list, list, list] = [], [], []
        if len(rows):
            data, ids = x[rows], reps[rows]
            norms = (data**2).sum(1)
            for lo in range(0, len(asked), 256):
                some = asked[lo : lo + 256]
                rough = norms - 2 * x[some] @ data.T
                cut = np.partition(rough, min(k, len(rows)) - 1, axis=1)[:, min(k, len(rows)) - 1]
                slack = 1e-9 * (np.abs(cut) + norms.max() + (x[some] ** 2).sum(1))
                for q, near in zip(some, rough <= (cut + slack)[:, None]):
                    at = np.flatnonzero(near)
                    d = np.sqrt(((data[at] - x[q]) ** 2).sum(1))
                    best = np.lexsort((ids[at], d))[:k]
                    out[0].append(np.full(len(best), reps[q]))
                    out[1].append(ids[at][best])
                    out[2].append(d[best])
        flat = [np.concatenate(o) if o else np.empty(0) for o in out]
        return pa.table({"query": flat[0].astype(np.int64), "rep": flat[1].astype(np.int64), "score": flat[2].astype(float)})

    return search


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    curves: int = CURVES,
    dims: int = DIMS,
    share: float = SHARE,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query row's ``k`` nearest other rows that were found.

    Nearness is Euclidean distance in double precision, ties to the smaller id.  Rows without an id,
    vectors that are null, zero or not finite, and vectors whose length differs from that of the
    smallest id take no part, neither as queries nor as candidates.  Rows that repeat an id are
    candidates once per distinct vector and never for that id.  With fewer than ``k`` candidates all
    are returned; an empty table gives no rows.  Other columns are not read.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks")
    ).where(F.col("id").isNotNull() & usable(F.col("vec")))
    dim = rows.agg(F.min_by(F.size("vec"), "id")).first()[0]
    if dim is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vec") == dim)
    classes = materialize(rows.groupBy("vec").agg(F.min("id").alias("rep"), F.bool_or("asks").alias("asks")), "ann-classes")
    # of a class the k + 1 smallest ids are enough: one may be the query itself.  Spark limits the
    # ranked rows before the shuffle.
    smallest = Window.partitionBy("vec").orderBy("id")
    members = materialize(
        rows.select("vec", "id").distinct().withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= k + 1)
        .join(classes.select("vec", "rep"), "vec").select("rep", "id"),
        "ann-members",
    )
    queries = materialize(
        rows.where("asks").join(classes.select("vec", "rep"), "vec").select(F.col("id").alias("query_id"), F.col("rep").alias("query")).distinct(),
        "ann-queries",
    )
    n, asked = classes.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))).first()
    side = max(LEAST_SIDE, math.ceil(n * share / 2))
    salts = max(1, math.ceil(asked * min(1.0, (2 * side + BUCKET) / n) / QUERIES_AT_ONCE))
    placed = _ordered(classes, dim, curves, dims)
    data = placed.select(
        "curve", F.floor(F.col("pos") / BUCKET).alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        "rep", "vec", F.lit(False).alias("asks"),
    )
    reach = F.sequence(
        F.floor(F.greatest(F.lit(0), F.col("pos") - side) / BUCKET), F.floor(F.least(F.lit(n - 1), F.col("pos") + side) / BUCKET)
    )
    asking = placed.where("asks").select(
        "curve", F.explode(reach).alias("bucket"), F.pmod(F.xxhash64("rep"), F.lit(salts)).cast("int").alias("salt"), "rep", "vec", "asks"
    )
    found = data.unionByName(asking).groupBy("curve", "bucket", "salt").applyInArrow(_best(k + 1, dim), "query long, rep long, score double")
    best = Window.partitionBy("query").orderBy("score", "rep")
    merged = found.distinct().withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth")
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        queries.join(materialize(merged, "ann-found"), "query")
        .join(members.withColumnRenamed("id", "vec_id"), "rep")
        .where(F.col("vec_id") != F.col("query_id"))
        .select("query_id", F.row_number().over(ranked).cast("int").alias("rank"), "vec_id", "score")
        .where(F.col("rank") <= k)
    )
