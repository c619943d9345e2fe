"""Benchmark decontamination by winnowing.

Every window of ``n`` words has ``n - k + 1`` hashed k-grams; the window's fingerprint is the
smallest of them, the leftmost on ties.  Equal windows therefore have equal fingerprints at equal
offsets, which guarantees that every shared span of at least ``n`` words is met.

* Benchmark windows are written once as ``(fingerprint, offset, words)`` with their items.
* Pass 1 marks the documents that share any fingerprint; the fingerprints are exploded straight
  into the join, without the text.
* Pass 2 reads only marked texts, joins their fingerprints with the windows, extends each hit to
  the whole window by comparing words, and unites the spans per document.

Documents are keyed by id and text, so copies of a row are judged once.  Generators are the outer
ones: the others get a filter that evaluates the generated array a second time, inside lambdas even
once per element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mqtable.llm.common import hash128, known_id, lower_ascii, materialize, shown_id

#: What separates words, after A-Z is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of a-z, 0-9 and non-ASCII characters, A-Z lower-cased first; null has none."""
    return F.filter(
        F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS, -1), lambda w: w != ""
    )


def _grams(n_words: Column, size: int) -> Column:
    """Word offsets (from 0) of all grams of ``size`` words; empty when there are none."""
    return F.when(n_words >= size, F.sequence(F.lit(0), n_words - size)).otherwise(F.array().cast("array<int>"))


def _hashes(words_: str, size: int) -> Column:
    return F.transform(
        _grams(F.size(words_), size), lambda i: F.xxhash64(F.lit(size), F.slice(F.col(words_), i + 1, size))
    )


def _selected(hashes: str, per_window: int) -> Column:
    """Per window the position of its smallest hash, leftmost on ties."""
    def pick(i: Column) -> Column:
        own = F.slice(F.col(hashes), i + 1, per_window)
        return (i + F.array_position(own, F.array_min(own)) - 1).cast("int")

    return F.transform(_grams(F.size(hashes), per_window), pick)


def _benchmark_windows(items: DataFrame, n: int, k: int, item_col: str, text_col: str) -> DataFrame:
    """``window, n_words, fp, offset`` and the list of ``items`` for each distinct window.

    An item of fewer than ``n`` words is one window, whose fingerprint is the hash of the whole.
    """
    w = items.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    long_ = w.where(F.size("w") >= n).select(
        "item_id", F.explode_outer(F.transform(_grams(F.size("w"), n), lambda i: F.slice(F.col("w"), i + 1, n))).alias("window")
    )
    short = w.where(F.size("w") < n).select("item_id", F.col("w").alias("window"))
    both = long_.unionByName(short).distinct()
    both = both.withColumn("h", F.when(F.size("window") >= n, _hashes("window", k)))
    return both.select(
        "item_id",
        "window",
        F.size("window").alias("n_words"),
        F.coalesce(F.array_min("h"), F.xxhash64(F.size("window"), F.col("window"))).alias("fp"),
        F.coalesce(F.array_position("h", F.array_min("h")) - 1, F.lit(0)).cast("int").alias("offset"),
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    n: int = 10,
    k: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    hashes: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, spans, items``;
    with ``hashes`` also ``h1, h2`` of the text.

    ``spans`` are the disjoint hit intervals ``(start, end)`` in words, end exclusive; ``items`` the
    ids, as strings, of the items with an occurring window, sorted.  Null or wordless text has no
    words and no hits; items without words match nothing; a null item id is left out of ``items``
    but its windows hit; repeated items count once; repeated rows of ``docs`` each get their row.
    Empty tables give no rows, or rows without hits.  Other columns are not read.
    """
    if not 0 < k <= n:
        raise ValueError("k must be from 1 to n")
    windows = materialize(_benchmark_windows(items, n, k, item_col, item_text_col), "bench-windows")
    prints = materialize(windows.select("fp").distinct(), "bench-prints")
    # the lengths of short items: at most n - 1 numbers
    short = sorted(r[0] for r in windows.where(F.col("n_words") < n).select("n_words").distinct().collect())

    d = docs.select(known_id(F.col(id_col)).alias("id"), F.col(text_col).cast("string").alias("text")).select(
        "id", *hash128(F.col("text")), "text"
    )
    key = ["id", "h1", "h2"]

    def fingerprints(rows: DataFrame) -> DataFrame:
        """Adds ``w`` (words), ``h`` (k-gram hashes), and ``at`` (selected positions) to ``id, h1, h2, text``."""
        rows = rows.select(*key, words(F.col("text")).alias("w"))
        rows = rows.select(*key, "w", _hashes("w", k).alias("h"))
        return rows.select(*key, "w", "h", F.array_distinct(_selected("h", n - k + 1)).alias("at"))

    whole_grams = F.concat(F.array().cast("array<bigint>"), *[_hashes("w", size) for size in short])
    picked = F.concat(F.transform("at", lambda i: F.get("h", i)), whole_grams)
    # the null entry carries the document itself; words stay behind the generator
    marks = (
        fingerprints(d)
        .select(
            *key,
            F.size("w").cast("long").alias("n_words"),
            F.concat(F.array(F.lit(None).cast("bigint")), F.array_distinct(picked)).alias("fps"),
        )
        .select(*key, "n_words", F.explode_outer("fps").alias("fp"))
    )
    marked = materialize(
        marks.join(prints.withColumn("met", F.lit(1)), "fp", "left")
        .where(F.col("fp").isNull() | F.col("met").isNotNull())
        .groupBy(*key)
        .agg(
            F.max("n_words").alias("n_words"),
            F.count(F.when(F.col("fp").isNull(), 1)).alias("copies"),
            F.count("met").alias("met"),
        ),
        "bench-marked",
    )

    def around(start: Column, before: int, width: int) -> Column:
        """Words from ``before`` words ahead of ``start``; ``lead`` says how many those really are."""
        lead = F.least(start, F.lit(before))
        return F.struct(start.alias("start"), lead.alias("lead"), F.slice(F.col("w"), start - lead + 1, lead + width).alias("near"))

    suspects = d.join(marked.where("met > 0").select(*key), key, "left_semi").dropDuplicates(key)
    met = fingerprints(suspects)
    grams = [F.transform("at", lambda i: F.struct(F.get("h", i).alias("fp"), around(i, n - k, n).alias("c")))]

    def whole(size: int) -> Column:
        zipped = F.arrays_zip(_hashes("w", size).alias("fp"), _grams(F.size("w"), size).alias("i"))
        return F.transform(zipped, lambda x: F.struct(x["fp"].alias("fp"), around(x["i"], 0, size).alias("c")))

    grams += [whole(size) for size in short]
    sites = met.select(*key, F.concat(*grams).alias("gs")).select(*key, F.inline_outer("gs"))
    own = F.slice(F.col("c.near"), F.col("c.lead") - F.col("offset") + 1, F.col("n_words"))
    hits = materialize(
        sites.join(windows, "fp")
        .where((F.col("offset") <= F.col("c.lead")) & F.when(F.col("offset") <= F.col("c.lead"), own == F.col("window")))
        .select(*key, (F.col("c.start") - F.col("offset")).alias("start"), "n_words", "item_id"),
        "bench-hits",
    )
    before = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    running = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    spans = (
        hits.groupBy(*key, "start")
        .agg(F.max(F.col("start") + F.col("n_words")).alias("end"))
        .withColumn("fresh", F.when(F.col("start") <= F.max("end").over(before), 0).otherwise(1))
        .withColumn("span", F.sum("fresh").over(running))
        .groupBy(*key, "span")
        .agg(F.struct(F.min("start").alias("start"), F.max("end").alias("end")).alias("s"))
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list("s")).alias("spans"))
    )
    found = hits.groupBy(*key).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return (
        marked.join(materialize(spans.join(found, key), "bench-found"), key, "left")
        .withColumn("copy", F.explode(F.expr("sequence(1, int(copies))")))
        .select(
            shown_id(F.col("id")).alias("doc_id"),
            "n_words",
            F.coalesce(F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"]), F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("spans", empty).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            *(["h1", "h2"] if hashes else []),
        )
    )
