"""Line dedup: drop lines that too many documents share.

Lines are exploded per document as 128-bit hashes of their normalised text, distinct
documents are counted per hash, and lines over the threshold go from every document but the
one with the largest id.  Everything is a DataFrame expression.

* The (hash, document) pairs are written once; counts and the drop lists both read them.
* Counting is ``distinct`` on (hash, document) followed by a count with map-side partial
  sums, so a line that a third of all documents hold is spread over all tasks.
* Drop lists are grouped per document and text, so a list is never longer than its text, whatever ids
  rows share; the text itself moves once, for the final join, which is a merge join at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mqtable.llm.common import WHITE, hash128, known_id, lower_ascii, materialize, shown_id


def _line_hashes(text: Column, min_chars: int) -> Column:
    """Per line ``(h1, h2)`` of the key, null where the key is shorter than ``min_chars``."""
    keys = F.transform(F.split(lower_ascii(text), "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)))
    return F.transform(keys, lambda key: F.when(F.char_length(key) >= min_chars, F.struct(*hash128(key))))


def _drop_lists(d: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``id, t1, t2, drops``: the hashes of the lines that each text of an id (``t1, t2``: its hash) loses."""
    held = materialize(
        d.select(
            "id",
            "t1",
            "t2",
            # outer: an inner generator gets a filter that evaluates the array a second time
            F.explode_outer(
                F.array_distinct(F.filter(_line_hashes(F.col("text"), min_chars), lambda h: h.isNotNull()))
            ).alias("h"),
        )
        .where(F.col("h").isNotNull())
        .select("id", "t1", "t2", "h.h1", "h.h2"),
        "lines",
    )
    # written, so that the join below reads two plain shuffles and AQE can split a hot line
    common = materialize(
        held.select("id", "h1", "h2")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .drop("n_docs"),
        "lines-common",
    )
    return materialize(
        held.join(common, ["h1", "h2"])
        .where(F.col("id") < F.col("keeper"))
        .groupBy("id", "t1", "t2")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("drops")),
        "line-drops",
    )


def drop_common_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_lines, n_dropped, kept`` (the remaining text).

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased.  Keys of
    at least ``min_chars`` code points that at least ``min_docs`` distinct ids hold are dropped
    from every id but the largest.  Null or empty text is one empty line; a null id counts as
    one document, the smallest; rows that share an id are judged as one document and each keep their
    own row; other columns are not read, so their names cannot clash; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    t1, t2 = hash128(text)
    d = docs.select(known_id(F.col(id_col)).alias("id"), t1.alias("t1"), t2.alias("t2"), text.alias("text"))
    drops = _drop_lists(d, min_chars, min_docs)
    # CASE evaluates one branch: documents without drops are not hashed again
    marked = F.arrays_zip(
        F.split("text", "\n", -1).alias("line"), _line_hashes(F.col("text"), min_chars).alias("hash")
    )
    left = F.transform(
        F.filter(marked, lambda x: x["hash"].isNull() | ~F.array_contains(F.col("drops"), x["hash"])),
        lambda x: x["line"],
    )
    touched = F.col("drops").isNotNull()
    return (
        d.join(drops.hint("merge"), ["id", "t1", "t2"], "left")
        .select(
            shown_id(F.col("id")).alias("doc_id"),
            F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
            "text",
            F.when(touched, left).alias("left"),
        )
        .select(
            "doc_id",
            "n_lines",
            F.when(F.col("left").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("left")).cast("long").alias("n_dropped"),
            F.coalesce(F.array_join("left", "\n"), F.col("text")).alias("kept"),
        )
    )
