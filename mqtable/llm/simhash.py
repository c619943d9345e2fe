"""SimHash near-dedup with vantage-point trees.

Fingerprints of 64 bits link when at most ``max_bits`` bits differ; components of links are groups.

* Rows with equal fingerprints are one class; only classes are searched.
* Random fingerprints lie close to half their bits apart, so over all 64 bits triangle bounds of a
  radius of 4 prune little.  The bits are therefore cut into three blocks: links differ by at most
  ``max_bits // 3`` in one of them, so one tree per block with that smaller radius meets them all.
* The upper levels of a tree are vantage points taken from the data.  A class lives in the shard
  named by its distances to them and also queries the shards that its radius overlaps; other
  branches are pruned by ``|d(q, v) - d(p, v)| <= d(q, p)``.  Of two shards only the lesser queries.
* The number of levels follows from the number of classes.  A shard over ``CHUNK`` rows is cut into
  chunks that meet pairwise in separate tasks, so that no group is unbounded.
* In a task the tree goes on with vantage points of its own, compares leaves in whole 64 bits, and
  links that join nothing new are not emitted; a chunk returns a spanning forest of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mqtable.llm.common import hash128, known_id, map_arrow, materialize
from mqtable.llm.components import connected_components

#: Classes a shard should have about, and at most for one task's side.
SHARD, CHUNK = 1 << 16, 1 << 16
BLOCKS = 3
#: Compared at once: this many pairs.
PAIRS = 1 << 22
SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the XXH64 of word shingles; 0 without words."""
    import xxhash

    words = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    joined = b" ".join(words)
    stops = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in stops)]
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        last = stops[lo + shingle - 1 : hi + shingle - 1] or [stops[-1]]
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo:hi], last, strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", hashes: bool = False
) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) per row of ``docs``; with ``hashes`` also ``h1, h2`` of the text."""

    def hashed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                fps = np.array([fingerprint(t.as_py(), shingle) for t in part.column(1)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps), *part.columns[2:]], names=["doc_id", "fp", *part.schema.names[2:]])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *(hash128(text) if hashes else []))
    return map_arrow(rows, hashed, "doc_id long, fp long" + ", h1 long, h2 long" * hashes)


def _masks() -> list[int]:
    cuts = [round(64 * b / BLOCKS) for b in range(BLOCKS + 1)]
    return [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _homes_and_visits(classes: DataFrame, points: list[int], levels: int, radius: int) -> DataFrame:
    """``fp, tree, path, visitor``: the home shard of each class, and the later shards its radius overlaps."""

    def distance(tree: int, level: int) -> Column:
        point = points[(tree * levels + level) % len(points)]
        return F.bit_count(F.col("fp").bitwiseXOR(F.lit(point)).bitwiseAND(F.lit(_signed(_masks()[tree]))))

    reached = None
    for tree in range(BLOCKS):
        # a path has 6 bits per level; ``ahead`` tells that an earlier level has left the home path upwards
        rows = classes.select("fp", F.lit(tree).alias("tree"), F.lit(0).cast("long").alias("path"), F.lit(False).alias("ahead"))
        for level in range(levels):
            d = distance(tree, level)
            low = F.when(F.col("ahead"), d - radius).otherwise(d)
            rows = (
                rows.withColumn("d", d)
                .withColumn("to", F.explode(F.sequence(F.greatest(F.lit(0), low), d + radius)))
                .select("fp", "tree", (F.col("path") * 64 + F.col("to")).alias("path"), (F.col("ahead") | (F.col("to") > F.col("d"))).alias("ahead"))
            )
        reached = rows if reached is None else reached.unionByName(rows)
    return reached.withColumnRenamed("ahead", "visitor")


def _chunked(rows: DataFrame, chunk: int) -> DataFrame:
    """Adds ``i, j`` (which chunks meet) and ``side``: 0 member, 1 other, 2 both.

    The members of chunk ``i`` meet the members of chunks from ``i`` on and all visitors.
    """
    sizes = rows.groupBy("tree", "path").agg(
        F.ceil(F.count(F.when(~F.col("visitor"), 1)) / chunk).cast("int").alias("m"),
        F.ceil(F.count(F.when(F.col("visitor"), 1)) / chunk).cast("int").alias("v"),
    )
    rows = rows.join(sizes.where("m > 0"), ["tree", "path"])
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("visitor"), F.col("v")).otherwise(F.col("m"))).cast("int")
    rows = rows.withColumn("own", own)

    def meet(i: Column, j: Column, side: int) -> Column:
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))

    own, m, v = F.col("own"), F.col("m"), F.col("v")
    meetings = F.when(F.col("visitor"), F.transform(F.sequence(F.lit(0), m - 1), lambda i: meet(i, m + own, 1))).otherwise(
        F.concat(
            F.array(meet(own, own, 2)),
            F.transform(F.filter(F.sequence(F.lit(0), m + v), lambda j: (j > own) & (j < m + v)), lambda j: meet(own, j, 0)),
            F.transform(F.filter(F.sequence(F.lit(0), m), lambda i: i < own), lambda i: meet(i, own, 1)),
        )
    )
    return rows.select("fp", "tree", "path", F.inline_outer(meetings))


class _Forest:
    """Links found so far among ``fps``, as the least index of each component."""

    def __init__(self, fps: np.ndarray):
        self.fps, self.label = fps, np.arange(len(fps))

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            new = x != y
            if not new.any():
                return
            a, b, x, y = a[new], b[new], x[new], y[new]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (deeper := self.label[self.label]).tobytes() != self.label.tobytes():
                self.label = deeper

    def joined(self, a: np.ndarray, b: np.ndarray) -> bool:
        return bool((self.label[a] == self.label[a[0]]).all() and (self.label[b] == self.label[a[0]]).all())

    def search(self, a: np.ndarray, b: np.ndarray, mask: np.uint64, radius: int, max_bits: int, depth: int = 0) -> None:
        """Link all pairs of ``a`` x ``b`` within ``max_bits`` that lie within ``radius`` under ``mask``."""
        if not len(a) or not len(b) or self.joined(a, b):
            return
        if len(a) * len(b) > PAIRS // 16 and depth < 8:
            point = self.fps[a[(depth * 7919) % len(a)]]
            to_a = np.bitwise_count((self.fps[a] ^ point) & mask).astype(np.int8)
            to_b = np.bitwise_count((self.fps[b] ^ point) & mask).astype(np.int8)
            shells = np.unique(to_a)
            if len(shells) > 1:
                for d in shells:
                    self.search(a[to_a == d], b[np.abs(to_b - d) <= radius], mask, radius, max_bits, depth + 1)
                return
        step = max(1, PAIRS // len(b))
        for lo in range(0, len(a), step):
            some = a[lo : lo + step]
            if self.joined(some, b):
                continue
            near = np.bitwise_count(self.fps[some][:, None] ^ self.fps[b][None, :]) <= max_bits
            x, y = np.nonzero(near)
            self.link(some[x], b[y])


def _links(max_bits: int):
    masks, radius = _masks(), max_bits // BLOCKS

    def search(table):
        import pyarrow as pa

        fps = table.column("fp").to_numpy().view(np.uint64)
        side = table.column("side").to_numpy()
        mask = np.uint64(masks[table.column("tree")[0].as_py()])
        forest = _Forest(fps)
        forest.search(np.flatnonzero(side != 1), np.flatnonzero(side != 0), mask, radius, max_bits)
        moved = np.flatnonzero(forest.label != np.arange(len(fps)))
        signed = fps.view(np.int64)
        return pa.table({"u": signed[moved], "v": signed[forest.label[moved]]})

    return search


def near_links(classes: DataFrame, max_bits: int = 4, shard: int = SHARD, chunk: int = CHUNK) -> DataFrame:
    """Edges ``u, v`` that connect exactly the fingerprints of ``classes(fp)`` (distinct) within ``max_bits``."""
    n = classes.count()
    levels = max(1, math.ceil(math.log(max(1, n / shard)) / math.log(8)))
    # vantage points: a few members, the first by hash
    points = [r[0] for r in classes.orderBy(F.xxhash64("fp")).limit(levels * BLOCKS).collect()] or [0]
    rows = materialize(_homes_and_visits(classes.select("fp"), points, levels, max_bits // BLOCKS), "simhash-shards")
    return _chunked(rows, chunk).groupBy("tree", "path", "i", "j").applyInArrow(_links(max_bits), "u long, v long")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text", hashes: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links; null ids are not counted, so it is
    null where no member has an id.  Null, empty or wordless text has fingerprint zero and links
    like any other; repeated rows link to each other; an empty table gives no rows.  Other columns
    are not read.

    With ``hashes`` also ``h1, h2`` of the text, and ``chosen``: whether the row is its group's least by
    (id, ``h1, h2``), ids before null.
    """
    rows = materialize(fingerprints(docs, shingle, id_col, text_col, hashes), "simhash-rows")

    def least_key(key: Column | str) -> list[Column]:
        return [F.min(key).alias("least_key")] if hashes else []

    key = F.struct(F.col("doc_id").isNull().alias("no_id"), known_id(F.col("doc_id")).alias("id"), "h1", "h2") if hashes else None
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), *least_key(key)), "simhash-classes")
    nodes = connected_components(near_links(classes, max_bits))
    linked = materialize(
        nodes.select(F.col("node").alias("fp"), "component").join(classes, "fp"), "simhash-linked"
    )
    least = linked.groupBy("component").agg(F.min("first_id").alias("component_id"), *least_key("least_key"))
    by_class = linked.drop("least_key").join(least, "component").select(
        "fp", "component_id", F.lit(True).alias("has"), *([F.col("least_key").alias("group_key")] if hashes else [])
    )
    groups = classes.join(by_class, "fp", "left").select(
        "fp", F.when(F.col("has"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"),
        *([F.coalesce("group_key", "least_key").alias("least_key")] if hashes else []),
    )
    return rows.join(groups, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        *(["h1", "h2", (key == F.col("least_key")).alias("chosen")] if hashes else []),
    )
