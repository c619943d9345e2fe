"""Quality classifier: a generalised additive model with pairwise interactions.

Text statistics of whole documents are computed once per document.  On a bounded sample of labelled
rows, cyclic boosting visits one feature after the other and fits a shallow tree over its bins to the
residual; the trees add up to one lookup table per feature.  The pairs of features whose residual
gain is largest are boosted in the same way into two-dimensional tables.  A score is the sigmoid of
the added table entries of a document's bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, islice
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mqtable.llm.common import hash128, map_arrow, materialize

#: Labelled rows that a model is fitted on at most, the first by the hash of their id.
SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 150, 80, 0.08
#: Bytes and words of the blocks over which a text's worst part is sought.
BLOCK_BYTES, BLOCK_WORDS = 512, 64

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "distinct", "least_distinct", "repeats", "most_repeats",
    "long_words", "upper", "most_upper", "digits", "most_digits", "marks", "most_marks", "symbols", "most_symbols",
    "bars", "most_bars", "bangs", "most_bangs", "stops", "least_stops", "lines", "line_repeats", "non_ascii",
]

# Classes of bytes: 1 upper case, 2 digit, 3 full stop or comma, 4 other marks, 5 symbols, 6 bar, 7 exclamation.
# In UTF-8, 0x80-0x9E after 0xC3 are the capitals of Latin-1; elsewhere such bytes are continuations.
_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[0x80:0x9F] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
for _group, _chars in ((3, b".,"), (4, b"\"'()-/:;?[]{}"), (5, b"#$%&*+<=>@\\^_`~"), (6, b"|"), (7, b"!")):
    _CLASS[list(_chars)] = _group


def features(text: str | None) -> list[float]:
    """The statistics of ``FEATURES`` of a whole text; zeros for null or empty text."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(FEATURES)
    size = len(data)
    kinds = _CLASS[np.frombuffer(data, np.uint8)]
    blocks = max(1, size // BLOCK_BYTES)  # the last block takes the rest
    cut = blocks * BLOCK_BYTES if size >= BLOCK_BYTES else size
    width = cut // blocks
    cells = np.bincount(
        (np.repeat(np.arange(blocks, dtype=np.int32) * 8, width) + kinds[:cut]), minlength=blocks * 8
    ).reshape(blocks, 8)
    tail = kinds[cut:]
    total = (cells.sum(axis=0) + np.bincount(tail, minlength=8)) / size
    if len(tail):
        cells = np.vstack([cells, np.bincount(kinds[-width:], minlength=8)])
    share = cells / width
    worst, least = share.max(axis=0), share.min(axis=0)

    words = data.split()
    n = len(words)
    same = sum(map(eq, words, islice(words, 1, None)))
    least_distinct, most_same = 1.0, 0.0
    # the last block overlaps the one before, so every word is in a block of the full width
    for lo in sorted({*range(0, n - BLOCK_WORDS, BLOCK_WORDS), max(0, n - BLOCK_WORDS)}):
        some = words[lo : lo + BLOCK_WORDS]
        if some:
            least_distinct = min(least_distinct, len(set(some)) / max(1, len(some)))
            most_same = max(most_same, sum(map(eq, some, islice(some, 1, None))) / max(1, len(some)))
    letters = sum(map(len, words))
    lines = data.split(b"\n")
    return [
        np.log1p(size), np.log1p(n), letters / max(1, n), len(set(words)) / max(1, n), least_distinct, same / max(1, n), most_same,
        max(map(len, words), default=0), total[1], worst[1], total[2], worst[2], total[4], worst[4], total[5], worst[5],
        total[6], worst[6], total[7], worst[7], total[3], least[3], len(lines) / max(1, n), 1 - len(set(lines)) / len(lines),
        data.count(b"\xc3") / size,
    ]


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashes: bool = False) -> DataFrame:
    """``doc_id, x`` (the features as floats) per row of ``docs``; with ``hashes`` also ``h1, h2`` of the text."""

    def computed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                x = np.array([features(t.as_py()) for t in part.column(1)], np.float32)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column(0), flat, *part.columns[2:]], names=["doc_id", "x", *part.schema.names[2:]])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *(hash128(text) if hashes else []))
    return map_arrow(rows, computed, "doc_id long, x array<float>" + ", h1 long, h2 long" * hashes)


def _split(g: np.ndarray, h: np.ndarray, leaves: int = 3, least: float = 2.0) -> np.ndarray:
    """Values per bin of a shallow tree that cuts the ordered bins where the gain is largest."""

    def value(lo: int, hi: int) -> float:
        return gs[hi] - gs[lo], hs[hi] - hs[lo]

    gs, hs = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    parts = [(0, len(g))]
    for _ in range(leaves - 1):
        best = (1e-6, None, None)
        for lo, hi in parts:
            cuts = np.arange(lo + 1, hi)
            if not len(cuts):
                continue
            gl, hl = gs[cuts] - gs[lo], hs[cuts] - hs[lo]
            (ga, ha) = value(lo, hi)
            gain = gl**2 / (hl + 1) + (ga - gl) ** 2 / (ha - hl + 1) - ga**2 / (ha + 1)
            gain[(hl < least) | (ha - hl < least)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (lo, hi), int(cuts[k]))
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for lo, hi in parts:
        ga, ha = value(lo, hi)
        out[lo:hi] = ga / (ha + 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with one cut on either axis of a grid."""
    n = len(g)
    gs, hs = (np.pad(a, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for a in (g, h))
    best, value = 0.0, np.zeros_like(g)
    i, j = np.meshgrid(np.arange(1, n), np.arange(1, n), indexing="ij")

    def corners(s: np.ndarray) -> list[np.ndarray]:
        a, top, left, every = s[i, j], s[i, n], s[n, j], s[n, n]
        return [a, top - a, left - a, every - top - left + a]

    quads = list(zip(corners(gs), corners(hs)))
    gain = sum(a**2 / (b + 1) for a, b in quads)
    k = np.unravel_index(int(np.argmax(gain)), gain.shape)
    best = float(gain[k])
    ci, cj = int(i[k]), int(j[k])
    for (a, b), rows, cols in zip(
        quads, (slice(0, ci), slice(0, ci), slice(ci, n), slice(ci, n)), (slice(0, cj), slice(cj, n)) * 2
    ):
        value[rows, cols] = a[k] / (b[k] + 1)
    return best, value


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row: table entries of the bins, added, through a sigmoid."""
        z = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            z += table[np.searchsorted(edges, x[:, f], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            z += table[
                np.searchsorted(self.pair_edges[a], x[:, a], "right"), np.searchsorted(self.pair_edges[b], x[:, b], "right")
            ]
        return 1 / (1 + np.exp(-z))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins)) if len(column) else np.empty(0)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit to features ``x`` and labels ``y`` (0 or 1).

    Without both labels the score is the smoothed rate of label 1 for every text: 0.5 without rows.
    """
    x, y = np.asarray(x, np.float32).reshape(len(y), len(FEATURES)), np.asarray(y, float)
    rate = (y.sum() + 1) / (len(y) + 2)
    edges, coarse = ([_edges(x[:, f], bins) for f in range(len(FEATURES))] for bins in (BINS, PAIR_BINS))
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Model(float(np.log(rate / (1 - rate))), edges, tables, [], coarse, [])
    if not 0 < y.sum() < len(y):
        return model
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    z = np.full(len(y), model.intercept)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, table in enumerate(tables):
            g, h = residual()
            step = RATE * _split(np.bincount(bins[f], g, len(table)), np.bincount(bins[f], h, len(table)))
            table += step
            z += step[bins[f]]
    small = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        cell = small[a] * PAIR_BINS + small[b]
        return tuple(np.bincount(cell, v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for v in residual())

    able = [f for f, e in enumerate(coarse) if len(e)]
    model.pairs = sorted(combinations(able, 2), key=lambda p: -_quadrants(*grid(*p))[0])[:PAIRS]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            step = RATE * _quadrants(*grid(a, b))[1]
            table += step
            z += step[small[a], small[b]]
    return model


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(table: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit to at most ``sample_rows`` labelled rows that are not held out.

    Null labels are left out, and so are ids with both labels.  The rows come by a hash of their id, those that
    share an id by their features, so a repeated run learns from the same rows.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    known = known.where(~held_out(F.col("doc_id")) & F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other"))
    known = known.where("y = other").drop("other")
    rows = table.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample_rows).select("x", "y")
    held = rows.toArrow()
    return fit(np.array(held.column("x").to_pylist(), np.float32), held.column("y").to_numpy())


def classify(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, label_col: str = "quality",
    id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, hashes: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``; with ``hashes`` also ``h1, h2`` of the text.

    Only the text decides the score, so repeated rows score alike; null text scores like empty
    text, whose statistics are zero; null ids are scored but never learnt from.  An empty table
    gives no rows; labels of unknown documents are ignored.  Other columns are not read.
    """
    table = materialize(feature_table(docs, id_col, text_col, hashes), "quality-features")
    model = train(table, labels, label_col, sample_rows)

    def scored(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(x)), *batch.columns[2:]], names=["doc_id", "score", *batch.schema.names[2:]]
            )

    return map_arrow(table, scored, "doc_id long, score double" + ", h1 long, h2 long" * hashes).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *(["h1", "h2"] if hashes else []),
    )
