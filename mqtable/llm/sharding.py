"""Sharding by extendible hashing.

Rows are keyed by 60 bits of a hash.  A bucket is a hash prefix; a directory indexed by prefix
bits names the bucket of every row, and only a bucket over the byte limit splits on its next
bit, so shards differ in depth.

* Sizes are summed per prefix of a base depth chosen from the total (about eight prefixes to a
  shard), with map-side partial sums; all shallower sizes roll up from that small table.
* Prefixes that are still too large at the base depth go on, alone, with more bits: a directory
  of directories.  Each round reads only the rows of such prefixes.
* A bucket whose rows all have one hash cannot split.  If it is over the limit, its rows go to
  pages of bounded size within the bucket, numbered per input partition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mqtable.llm.common import materialize

HASH_BITS = 60
#: Extra bits of a round over what evenly spread rows need.
SPARE_BITS = 3


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key's text, as a long; a null key hashes as ``''``."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: int) -> Column:
    return F.shiftright(h, HASH_BITS - depth)


def _round_directory(rows: DataFrame, shallow: int, deep: int, limit: int) -> DataFrame:
    """Directory at ``deep`` bits: ``base, depth`` of the bucket (null: over the limit at ``deep`` bits too)."""
    base = materialize(
        rows.groupBy(_prefix(F.col("h"), deep).alias("base")).agg(
            F.sum("n_bytes").alias("n_bytes"), F.min("h").alias("low"), F.max("h").alias("high")
        ),
        "shard-sizes",
    )
    paths = base.withColumn("depth", F.explode(F.sequence(F.lit(shallow), F.lit(deep)))).withColumn(
        "prefix", F.expr(f"shiftright(base, {deep} - depth)")
    )
    fitting = (
        paths.groupBy("depth", "prefix")
        .agg(F.sum("n_bytes").alias("n_bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
        .where((F.col("n_bytes") <= limit) | (F.col("low") == F.col("high")))
        .select("depth", "prefix")
    )
    best = paths.join(fitting, ["depth", "prefix"]).groupBy("base").agg(F.min("depth").alias("depth"))
    return base.select("base").join(best, "base", "left")


def shard(
    docs: DataFrame, limit_bytes: int, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, depth, shard`` (bucket bits, ``/page`` in a paged bucket).

    ``n_bytes`` is the UTF-8 length of the text, 0 for null.  A null key hashes like the empty
    string; repeated rows share a bucket and fill pages of at most ``limit_bytes`` when it is
    too large; a single row over the limit is a shard by itself.  An empty table gives no rows;
    a table that fits is one shard of depth 0 (name ``-``).  Other columns are not read.
    """
    rows = materialize(
        docs.select(
            F.col(key_col).alias("doc_id"),
            hash_bits(F.col(key_col)).alias("h"),
            F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
            F.spark_partition_id().alias("part"),
        ),
        "shard-keys",
    )
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    shallow, placed = 0, []
    deep = min(HASH_BITS, math.ceil(math.log2(max(1, total / limit_bytes))) + SPARE_BITS)
    while True:
        directory = materialize(_round_directory(rows, shallow, deep, limit_bytes), "shard-directory")
        found = rows.withColumn("base", _prefix(F.col("h"), deep)).join(directory, "base")
        placed.append(found.where(F.col("depth").isNotNull()))
        if directory.where("depth is null").isEmpty():
            break
        rows = materialize(found.where(F.col("depth").isNull()).drop("base", "depth"), "shard-rest")
        shallow, deep = deep + 1, min(HASH_BITS, deep + 2 * SPARE_BITS + 2)
    every = placed[0]
    for more in placed[1:]:
        every = every.unionByName(more)
    every = every.withColumn(
        "bucket",
        F.when(F.col("depth") == 0, F.lit("-")).otherwise(
            F.substring(F.lpad(F.conv(F.col("h").cast("string"), 10, 2), HASH_BITS, "0"), F.lit(1), F.col("depth"))
        ),
    )
    sizes = every.groupBy("bucket").agg(
        F.sum("n_bytes").alias("bucket_bytes"), F.count(F.lit(1)).alias("n_rows"), F.max("n_bytes").alias("largest")
    )
    paged = materialize(
        sizes.where((F.col("bucket_bytes") > limit_bytes) & (F.col("n_rows") > 1)).select(
            "bucket", F.greatest(F.lit(1), F.floor(F.lit(limit_bytes) / F.col("largest"))).alias("per_page")
        ),
        "shard-pages",
    )
    plain = ["doc_id", "n_bytes", "depth", "bucket"]
    whole = every.join(paged, "bucket", "left_anti").select(*plain, F.col("bucket").alias("shard"))
    if paged.isEmpty():
        return whole.drop("bucket")
    w = Window.partitionBy("bucket", "part").orderBy("n_bytes")
    pages = (
        every.join(paged, "bucket")
        .withColumn("page", F.floor((F.row_number().over(w) - 1) / F.col("per_page")))
        .select(*plain, F.concat_ws("/", "bucket", F.concat_ws(".", "part", "page")).alias("shard"))
    )
    return whole.unionByName(pages).drop("bucket")


def shard_sizes(placed: DataFrame) -> DataFrame:
    """``shard, depth, n_docs, n_bytes`` of what ``shard`` returned."""
    return placed.groupBy("shard", "depth").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_bytes").alias("n_bytes")
    )
