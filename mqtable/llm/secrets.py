"""Secret scans with multipart credential linking.

Strong patterns report every match.  Weak parts (login names, token-like strings, endpoints) say
little alone; they are reported only when the parts that complete a credential co-occur within a
distance in the same document:

* a weak secret needs an identifier near it,
* an identifier needs a secret near it,
* an endpoint needs both near it.

``split`` and ``regexp_extract_all`` walk the same matches, so the lengths of the pieces between
them give the positions by a running sum.  Only these lengths leave the document's row.  Linking is
an interval join of the parts, written as range-frame windows over start positions: the sorted
intervals meet within the frame and no pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Kinds in report order, pattern, group whose length counts, least length.
# Where a match is a whole run of one class, the least length stands in the pattern: shorter runs
# cannot begin or shift a longer one, and every word has some.
STRONG = [
    (
        "assign",
        "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
        "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
]
WEAK = [
    ("login", "([uU][sS][eE][rR]|[lL][oO][gG][iI][nN]|[cC][lL][iI][eE][nN][tT]_?[iI][dD])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9_.@-]+)", 2, 2),
    ("opaque", "[A-Za-z0-9+/_-]{16,}", 0, 16),
    ("endpoint", "[hH][tT][tT][pP][sS]?://[A-Za-z0-9.-]+", 0, 12),
]
IDENTIFIERS, SECRETS = ("access", "login"), ("assign", "hex", "opaque")
#: Greatest distance, in code points between starts, at which parts complete each other.
REACH = 200


def _parts(text: Column, order: int, pattern: str, group: int, least: int, mixed: bool) -> Column:
    """Per match: kind, number, length of the text before it since the last match, own length, and whether it counts."""
    zipped = [
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
    ]
    if group:
        zipped.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def part(x: Column, i: Column) -> Column:
        counts = F.char_length(x["value" if group else "hit"]) >= least
        if mixed:  # letters of either case alone are words
            counts &= x["hit"].rlike("[0-9]") & x["hit"].rlike("[A-Za-z]")
        return F.struct(
            F.lit(order).alias("kind"),
            i.alias("i"),
            F.char_length(x["gap"]).alias("gap"),
            F.char_length(x["hit"]).alias("size"),
            counts.alias("counts"),
        )

    return F.filter(F.transform(F.arrays_zip(*zipped), part), lambda p: p["size"].isNotNull())


def scan(docs: DataFrame, reach: int = REACH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, found``, the spans ``(start, kind, end)`` sorted by start, then kind.

    Positions count code points, the end is exclusive, ``kind`` is an index into ``STRONG + WEAK``.
    Matches are leftmost and do not overlap within a kind; those that fail a length test are
    dropped afterwards.  A weak part that overlaps a strong span is no part.  Null or empty text
    has no spans; a null id stays null; each repeated row is judged by itself; an empty table gives
    no rows.  Other columns are not read.
    """
    kinds = STRONG + WEAK
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    opaque = [k[0] for k in kinds].index("opaque")
    # kind -1 stands for the document, so that one without parts stays
    none = F.array(F.struct(F.lit(-1), F.lit(0), F.lit(0), F.lit(0), F.lit(True)))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.concat(
            none.cast("array<struct<kind:int,i:int,gap:int,size:int,counts:boolean>>"),
            *[_parts(text, j, p, g, least, j == opaque) for j, (_, p, g, least) in enumerate(kinds)],
        ).alias("parts"),
    ).select("row", "doc_id", F.inline_outer("parts"))

    within = Window.partitionBy("row", "kind").orderBy("i")
    placed = rows.select(
        "row", "doc_id", "kind", "counts", "size",
        (F.sum(F.col("gap") + F.col("size")).over(within) - F.col("size")).alias("start"),
    ).withColumn("end", F.col("start") + F.col("size")).where("counts")

    strong = F.col("kind").between(0, len(STRONG) - 1)
    doc = Window.partitionBy("row").orderBy("start")
    real = placed.withColumn(
        "inside",
        (F.col("kind") >= len(STRONG))
        & (
            (F.coalesce(F.max(F.when(strong, F.col("end"))).over(doc.rangeBetween(Window.unboundedPreceding, 0)), F.lit(-1)) > F.col("start"))
            | (F.coalesce(F.min(F.when(strong, F.col("start"))).over(doc.rangeBetween(0, Window.unboundedFollowing)), F.col("end")) < F.col("end"))
        ),
    ).where(~F.col("inside"))

    names = [k[0] for k in kinds]
    near = doc.rangeBetween(-reach, reach)

    def count(which: tuple[str, ...]) -> Column:
        return F.count(F.when(F.col("kind").isin([names.index(n) for n in which]), 1)).over(near)

    linked = real.withColumn("ids", count(IDENTIFIERS)).withColumn("keys", count(SECRETS))
    needs = (
        F.when(strong, True)
        .when(F.col("kind") == names.index("login"), F.col("keys") > 0)
        .when(F.col("kind") == names.index("opaque"), F.col("ids") > 0)
        .otherwise((F.col("ids") > 0) & (F.col("keys") > 0))
    )
    span = F.struct(F.col("start").cast("long").alias("start"), "kind", F.col("end").cast("long").alias("end"))
    return linked.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.array_sort(F.collect_list(F.when((F.col("kind") >= 0) & needs, span))).alias("found"),
    ).drop("row")


def span_text(found: Column, kinds: list[tuple]) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k[0]) for k in kinds])
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def digests(found: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of what ``scan`` returned."""
    base = F.filter("found", lambda s: s["kind"] < len(STRONG))

    def n_of(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    counts = [n_of(j).alias(f"n_{k[0]}") for j, k in enumerate(STRONG)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(span_text(base, STRONG).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("found"), STRONG + WEAK).alias("spans"),
    )
