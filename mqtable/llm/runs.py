"""Periodic run detection by internal pattern matching.

A run is a stretch of words with smallest period q and length of at least ``max(12, 2q)`` that neither
neighbouring word extends.  Documents are searched in batches within a task, without a shuffle:

* Words are numbered per document, so no match crosses documents.  Prefix doubling names the words'
  blocks of length 1, 2, 4 ... and ends in the suffix array; a name is the first suffix-array index of
  its block's occurrences, so it is the left end of their range.
* For block length m, the periods q that it is responsible for are those with ``2m <= max(12, 2q) - q + 1``
  and no longer block: every run of period q then contains an aligned block and its copy q words later.
* An aligned block asks a wavelet tree over the suffix array for its occurrences in windows of m starts:
  range counts, then the first, second and last by range successor.  They form a progression.  One or
  two occurrences are candidate periods themselves.  Three or more differ by the block's own period d;
  of them only d, or those that map an end of the block's d-periodic stretch to the copy's, can be the
  smallest period of a run, or all where the two stretches touch, and then each is a run.
* Candidates are extended both ways over the block names, which confirms them and gives the run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mqtable.llm.common import map_arrow

MIN_LENGTH = 12
#: Words searched at once; a longer document is searched alone.
BATCH_WORDS = 1 << 17


class BlockNames:
    """Names of the blocks of length 1, 2, 4 ... at every position, and the suffix array."""

    def __init__(self, symbols: np.ndarray):
        n = self.n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        name = self._named(order, symbols[order], np.arange(n))
        self.levels = [name]
        while True:
            size = np.bincount(name, minlength=n)
            open_ = np.flatnonzero(size[name] > 1)  # only blocks with another occurrence are sorted on
            if not len(open_):
                break
            step = 1 << (len(self.levels) - 1)
            after = open_ + step
            tail = np.where(after < n, name[np.minimum(after, n - 1)] + 1, 0)
            key = name[open_].astype(np.int64) * (n + 1) + tail
            by = np.argsort(key, kind="stable")
            at, key = open_[by], key[by]
            # the k-th open element of a name lies k places after the first of that name
            first = np.flatnonzero(np.r_[True, name[at][1:] != name[at][:-1]])
            run = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(at)]))
            place = name[at] + (np.arange(len(at)) - first[run])
            name = name.copy()
            name[at] = self._starts(key, place)
            self.levels.append(name)
        self.order = np.empty(n, np.int64)
        self.order[name] = np.arange(n)

    @staticmethod
    def _starts(key: np.ndarray, place: np.ndarray) -> np.ndarray:
        new = np.r_[True, key[1:] != key[:-1]]
        return place[np.flatnonzero(new)[np.cumsum(new) - 1]]

    def _named(self, order: np.ndarray, key: np.ndarray, place: np.ndarray) -> np.ndarray:
        name = np.empty(self.n, np.int64)
        name[order] = self._starts(key, place)
        return name

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal symbols from ``a`` and ``b`` on (``a < b``)."""
        got = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            name = self.levels[k]
            fits = np.flatnonzero(b + got + (1 << k) <= self.n)
            same = fits[name[a[fits] + got[fits]] == name[b[fits] + got[fits]]]
            got[same] += 1 << k
        return got

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal symbols before ``a`` and ``b`` (``a < b``), their own left out."""
        got = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            name = self.levels[k]
            fits = np.flatnonzero(a - got - (1 << k) >= 0)
            to = got[fits] + (1 << k)
            got[fits[name[a[fits] - to] == name[b[fits] - to]]] += 1 << k
        return got

    def stretch(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The maximal stretch ``[start, end)`` around ``at`` in which words ``period`` apart are equal."""
        return at - self.behind(at, at + period), at + period + self.ahead(at, at + period)


class WaveletTree:
    """Counts and order statistics of the values of an array's ranges, a bit per level."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1
            self.zeros.append(np.r_[0, np.cumsum(1 - one)])
            values = np.r_[values[one == 0], values[one == 1]]

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of ``[lo, hi)`` are less than ``x``."""
        found = np.zeros(len(lo), np.int64)
        past = x >= 1 << self.bits
        for b, zeros in zip(range(self.bits - 1, -1, -1), self.zeros):
            z_lo, z_hi, all_zeros = zeros[lo], zeros[hi], zeros[-1]
            one = ((x >> b) & 1) == 1
            found += np.where(one, z_hi - z_lo, 0)
            lo = np.where(one, all_zeros + lo - z_lo, z_lo)
            hi = np.where(one, all_zeros + hi - z_hi, z_hi)
        return np.where(past, -1, found)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th smallest value (from 0) of ``[lo, hi)``."""
        value = np.zeros(len(lo), np.int64)
        for b, zeros in zip(range(self.bits - 1, -1, -1), self.zeros):
            z_lo, z_hi, all_zeros = zeros[lo], zeros[hi], zeros[-1]
            one = k >= z_hi - z_lo
            k = np.where(one, k - (z_hi - z_lo), k)
            value |= one.astype(np.int64) << b
            lo = np.where(one, all_zeros + lo - z_lo, z_lo)
            hi = np.where(one, all_zeros + hi - z_hi, z_hi)
        return value


def _periods_of(m: int) -> list[tuple[int, int]]:
    """The ranges of periods whose longest certain block has length ``m``."""

    def block(q: int) -> int:
        return 1 << (((max(MIN_LENGTH, 2 * q) - q + 1) // 2).bit_length() - 1)

    small = [q for q in range(1, MIN_LENGTH // 2 + 1) if block(q) == m]
    large = (max(2 * m - 1, MIN_LENGTH // 2 + 1), 4 * m - 2)
    ranges = [(q, q) for q in small]
    merged: list[tuple[int, int]] = []
    for lo, hi in [*ranges, *([large] if large[0] <= large[1] else [])]:
        if merged and merged[-1][1] + 1 == lo and hi - merged[-1][0] < m:
            merged[-1] = (merged[-1][0], hi)
        else:
            merged.append((lo, hi))
    # windows of at most m starts, in which occurrences form one progression
    return [(x, min(x + m - 1, hi)) for lo, hi in merged for x in range(lo, hi + 1, m)]


def _candidates(names: BlockNames, tree: WaveletTree, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (position, period) to confirm, from the blocks of length ``2**k``."""
    m = 1 << k
    name = names.levels[min(k, len(names.levels) - 1)]
    size = np.bincount(name, minlength=names.n)
    at = np.arange(0, names.n - m + 1, m)
    at = at[size[name[at]] > 1]
    if k >= len(names.levels) or not len(at):
        return
    for low, high in _periods_of(m):
        lo, hi = name[at], name[at] + size[name[at]]
        before = tree.below(lo, hi, np.minimum(at + low, names.n - 1))
        upto = np.where(at + high + 1 >= names.n, hi - lo, tree.below(lo, hi, np.minimum(at + high + 1, names.n - 1)))
        n_found = np.where(at + low >= names.n, 0, upto - before)
        some = n_found > 0
        p, lo, hi, before, n_found = at[some], lo[some], hi[some], before[some], n_found[some]
        if not len(p):
            continue
        first, last = tree.smallest(lo, hi, before), tree.smallest(lo, hi, before + n_found - 1)
        few = n_found <= 2
        yield p[few], first[few] - p[few]
        yield p[few], last[few] - p[few]
        p, lo, hi, before, n_found, first, last = (x[~few] for x in (p, lo, hi, before, n_found, first, last))
        if not len(p):
            continue
        d = tree.smallest(lo, hi, before + 1) - first
        x1, y1 = names.stretch(p, d)
        x2, y2 = names.stretch(first, d)
        apart = x1 != x2
        # within one stretch only its period itself can be the smallest
        for q, ok in ((d, ~apart), (y2 - y1, apart), (x2 - x1, apart)):
            ok = ok & (q >= low) & (q <= high)
            yield p[ok], q[ok]
        touch = np.flatnonzero(apart & (y1 >= x2))
        if len(touch):
            each = np.repeat(touch, n_found[touch])
            nth = np.arange(len(each)) - np.repeat(np.cumsum(n_found[touch]) - n_found[touch], n_found[touch])
            q = first[each] + nth * d[each] - p[each]
            # each of these repeats q words at least
            real = np.minimum(y1[each], y2[each] - q) - np.maximum(x1[each], x2[each] - q) >= q
            yield p[each][real], q[real]


def find_runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of a sequence of integers as arrays ``start, end, period``, by start, then period."""
    none = np.empty(0, np.int64)
    if len(symbols) < MIN_LENGTH:
        return none, none, none
    names = BlockNames(symbols)
    if len(names.levels) < 2:
        return none, none, none
    tree = WaveletTree(names.order)
    found = [np.empty((0, 3), np.int64)]
    for k in range(1, len(names.levels)):
        for at, q in _candidates(names, tree, k):
            start, end = names.stretch(at, q)
            long = end - start >= np.maximum(MIN_LENGTH, 2 * q)
            found.append(np.unique(np.stack([start[long], end[long], q[long]], 1), axis=0))
    runs = np.unique(np.concatenate(found), axis=0)
    if not len(runs):
        return none, none, none
    # a stretch found with several periods has the least of them, which divides the others
    least = np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]
    start, end, q = runs[least].T
    by = np.lexsort((q, start))
    return start[by], end[by], q[by]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Every tenth document (by hash of its id) repeats part of its words from a point on; a null id never."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * ((n - a) // p + 1))[: n - a]


def _suspects(flat: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Whether a document repeats any four words in a row, as every run does (equal hashes suffice here)."""
    h = doc[: max(0, len(flat) - 3)].astype(np.uint64)
    for i in range(4):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + flat[i : len(h) + i].astype(np.uint64)
    by = np.argsort(h)
    again = by[1:][h[by[1:]] == h[by[:-1]]]
    out = np.zeros(n_docs, bool)
    out[doc[again]] = True
    return out


def _searched(docs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of every document, found in one sequence of words numbered per document."""
    number = defaultdict(count().__next__).__getitem__
    flat = np.array(list(map(number, chain.from_iterable(docs))), np.int64)
    sizes = np.array([len(words) for words in docs], np.int64)
    doc = np.repeat(np.arange(len(docs)), sizes)
    suspect = _suspects(flat, doc, len(docs))
    some = suspect[doc]
    doc, flat = doc[some], flat[some]
    ends = np.cumsum(np.where(suspect, sizes, 0))
    start, end, q = find_runs(doc * (int(flat.max(initial=0)) + 1) + flat)
    owner = np.searchsorted(ends, start, "right")
    for i in range(len(docs)):
        lo, hi = np.searchsorted(owner, (i, i + 1)) if suspect[i] else (0, 0)
        base = ends[i] - sizes[i]
        yield start[lo:hi] - base, end[lo:hi] - base, q[lo:hi]


def _row(words: list[bytes], runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple:
    start, end, q = runs
    listed = "".join(f"{s},{e - s},{p}\n" for s, e, p in zip(start.tolist(), end.tolist(), q.tolist()))
    best = [None] * 4
    kept = words
    if len(start):
        size = end - start
        i = np.lexsort((q, start, -size))[0]
        best = [int(start[i]), int(size[i]), int(q[i]), int(1000 * size[i] // q[i])]
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, start + q, 1)
        np.add.at(cover, end, -1)
        kept = [w for w, c in zip(words, np.cumsum(cover).tolist()) if c == 0]
    collapsed = b" ".join(kept)
    return len(start), *best, hashlib.sha256(listed.encode()).hexdigest(), listed, collapsed


def _chunks(batch, plant: bool) -> Iterator[tuple[list, list[list[bytes]]]]:
    ids, docs, size = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1)):
        doc_id = doc_id.as_py()
        words = (text.as_py() or "").encode().split()  # of bytes: ASCII white space alone
        ids.append(doc_id)
        docs.append(planted(words, doc_id) if plant else words)
        size += len(words)
        if size >= BATCH_WORDS:
            yield ids, docs
            ids, docs, size = [], [], 0
    if ids:
        yield ids, docs


def _detector(plant: bool, texts: bool):
    def detect(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        names += ["runs", "collapsed"] * texts
        for batch in batches:
            for ids, docs in _chunks(batch, plant):
                rows = []
                for doc_id, words, runs in zip(ids, docs, _searched(docs)):
                    *head, listed, collapsed = _row(words, runs)
                    own = (listed, collapsed.decode()) if texts else ()
                    rows.append((doc_id, *head, hashlib.sha256(collapsed).hexdigest(), *own))
                kinds = [pa.int64()] * 6 + [pa.string()] * (len(names) - 6)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return detect


def detect_runs(
    docs: DataFrame, plant: bool = False, texts: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_runs``, the longest run's ``start, length, period,
    exponent_milli`` (ties: smallest start, then period; nulls without a run), ``runs_sha256`` of every
    run's ``start,length,period`` line, and ``collapsed_sha256`` of the words that no run repeats.

    With ``texts`` also ``runs`` and ``collapsed`` themselves.  With ``plant`` every tenth document is
    first made periodic from a point on (``planted``).  Null, empty or wordless text has no words and no
    runs; repeated rows give repeated results; an empty table gives no rows.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = (
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string" + ", runs string, collapsed string" * texts
    )
    return map_arrow(rows, _detector(plant, texts), schema)
