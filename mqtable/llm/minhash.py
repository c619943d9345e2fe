"""MinHash near-dedup by a multi-index Hamming join.

Documents link when the Jaccard similarity of their sets of word shingles reaches a threshold; components
of links are groups.

* Rows with equal sets are one class; only classes are searched.  A class has a signature of ``SYMBOLS``
  b-bit minima.  Similar sets differ in few symbols: ``max_errors`` is the distance that a pair at the
  threshold exceeds with a probability of ``MISS`` at most (a binomial tail).
* Multi-index: the signature is split into chunks.  By pigeonhole a pair within the distance has a chunk with
  at most ``CHUNK_ERRORS`` errors, so every chunk is hashed once per way to leave out that many symbols.
  Classes with an equal key meet; no pair within the distance is lost.
* A key's classes gather under its least class, the leader.  Members under many keys of a leader are
  listed once, so a group of copies makes few rows, and no pairs are listed.
* Groups come together with the full sets.  In a task, sets meet by counting marked shingles; classes
  that are joined already are not compared again, and only links that join something are emitted.
* A group over ``GROUP_ROWS`` classes or ``GROUP_BYTES`` of sets is cut into chunks, each with the leader.
  Then only classes outside the group's main component meet the other chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mqtable.llm.common import hash128, map_arrow, materialize
from mqtable.llm.components import connected_components

#: Symbols of a signature and their bits.
SYMBOLS, BITS = 64, 16
#: Errors enumerated in a chunk, and the probability that a pair at the threshold is over the distance.
CHUNK_ERRORS, MISS = 1, 1e-6
#: Classes and bytes of sets that one task takes of a group.
GROUP_ROWS, GROUP_BYTES = 512, 16 << 20
#: Parts that a group's rows are dealt to where they meet its facts.
SALTS = 64
#: Distinct words whose hashes a worker keeps.
CACHE_WORDS = 1 << 18
SEED = 42

_MIX = np.uint64(0x9E3779B97F4A7C15)


def max_errors(percent: int) -> int:
    """Differing symbols that a pair of ``percent`` per cent similarity exceeds with a probability of ``MISS`` at most."""
    p = 1 - percent / 100
    tail, r = 1.0, -1
    while tail > MISS:
        r += 1
        tail -= comb(SYMBOLS, r) * p**r * (1 - p) ** (SYMBOLS - r)
    return r


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        h = xxhash.xxh64_intdigest(word, SEED)
        if len(word) <= 64:
            self[word] = h
        return h


_WORDS = _WordHashes()


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of all words if fewer; empty without words."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space alone
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(_WORDS.__getitem__, words)), np.uint64)
    width = min(shingle, len(h))
    n = len(h) - width + 1
    out = np.full(n, np.uint64(width))
    for i in range(width):
        out = out * _MIX + h[i : i + n]
    # multiply and fold, so that all bits depend on all words
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(out ^ (out >> np.uint64(29)))


@cache
def _functions() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED)
    return draw.integers(0, 1 << 63, (2, SYMBOLS), np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> bytes:
    """The ``SYMBOLS`` minima of ``BITS`` bits each, big-endian; empty for an empty set."""
    if not len(shingles):
        return b""
    a, b = _functions()
    least = np.full(SYMBOLS, ~np.uint64(0))
    for lo in range(0, len(shingles), 1024):
        np.minimum(least, (((shingles[lo : lo + 1024, None] ^ b) * a)).min(axis=0), out=least)
    # the low bits of a minimum's top half are as good as uniform, its high bits are not
    return ((least >> np.uint64(24)) & np.uint64((1 << BITS) - 1)).astype(">u2").tobytes()


def _class_rows(shingle: int):
    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            out = []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), shingle)
                digest = xxhash.xxh128_digest(s.tobytes())
                out.append((*np.frombuffer(digest, "<i8").tolist(), len(s), signature(s)))
            s1, s2, n, sig = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h1"), batch.column("h2"), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.binary())],
                names=["doc_id", "h1", "h2", "s1", "s2", "n", "sig"],
            )

    return rows


def _set_rows(shingle: int):
    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                sets = [shingle_set(t.as_py(), shingle).tobytes() for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("c"), pa.array(sets, pa.binary())], names=["c", "shingles"])

    return rows


def chunk_cuts(errors: int) -> list[int]:
    """Ends of the chunks: so many that ``errors`` leave one of them with ``CHUNK_ERRORS`` at most."""
    m = errors // (CHUNK_ERRORS + 1) + 1
    if SYMBOLS // m <= CHUNK_ERRORS:
        raise ValueError("the similarity is too low for this signature")
    return [round(SYMBOLS * i / m) for i in range(m + 1)]


def _keys(sig: Column, errors: int) -> Column:
    """The hashes of all chunks, each without ``CHUNK_ERRORS`` of its symbols."""
    cuts, width = chunk_cuts(errors), BITS // 8
    keys = []
    for lo, hi in zip(cuts, cuts[1:]):
        for left_out in combinations(range(lo, hi), CHUNK_ERRORS):
            kept = [F.substring(sig, x * width + 1, width) for x in range(lo, hi) if x not in left_out]
            keys.append(F.xxhash64(F.lit(len(keys)), *kept))
    return F.array(*keys)


def members(classes: DataFrame, errors: int) -> DataFrame:
    """``leader, c``: every class of ``classes(c, sig)`` under the least class of each of its keys that others share."""
    keys = classes.select("c", F.explode(_keys(F.col("sig"), errors)).alias("key"))
    shared = keys.groupBy("key").agg(F.min("c").alias("leader"), F.count(F.lit(1)).alias("size")).where("size > 1")
    return keys.join(shared.drop("size"), "key").select("leader", "c").distinct()


class _Group:
    """Sets by rising size with their components, as the least index of each."""

    def __init__(self, rows: list[tuple], percent: int):
        # rows: class, its component so far, role, set
        self.rows = sorted(rows, key=lambda r: len(r[3]))
        sets = [np.frombuffer(r[3], np.uint64) for r in self.rows]
        self.sizes = np.array([len(s) for s in sets])
        self.ends = np.r_[0, np.cumsum(self.sizes)]
        distinct, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(distinct), np.int32)
        self.percent = percent
        _, self.label = np.unique([r[1] for r in self.rows], return_inverse=True)
        self.links: list[tuple[int, int]] = []

    def ask(self, i: int) -> None:
        """Link row ``i`` to all rows that it is similar to."""
        size, percent = int(self.sizes[i]), self.percent
        lo = int(np.searchsorted(self.sizes * 100, percent * size, "left"))
        hi = int(np.searchsorted(self.sizes * percent, 100 * size, "right"))
        other = self.label[lo:hi] != self.label[i]
        if not other.any():
            return
        own = self.flat[self.ends[i] : self.ends[i + 1]]
        self.mark[own] = 1
        shared = np.add.reduceat(self.mark[self.flat[self.ends[lo] : self.ends[hi]]], self.ends[lo:hi] - self.ends[lo])
        self.mark[own] = 0
        near = other & (100 * shared >= percent * (size + self.sizes[lo:hi] - shared))
        for label in np.unique(self.label[lo:hi][near]).tolist():
            j = lo + int(np.flatnonzero(near & (self.label[lo:hi] == label))[0])
            self.links.append((self.rows[i][0], self.rows[j][0]))
            self.label[self.label == label] = self.label[i]

    def search(self, first: list[int], rest: bool) -> list[tuple[int, int]]:
        """All links that join something, from ``first`` and, if ``rest``, from every row outside the main component."""
        for i in first:
            self.ask(i)
        if not rest:
            return self.links
        main = np.bincount(self.label).argmax()
        for i in np.flatnonzero(self.label != main).tolist():
            self.ask(i)
        return self.links


def _linked(percent: int):
    """Rows sorted by group and chunk pair: their links.  ``role`` 1 marks the rows asked first.

    Without a second chunk (``j`` is -1) these are the leader, and all rows are compared.
    """

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, rows, links = None, [], []

        def out():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["u", "v"]
            )
            links.clear()
            return batch

        def done():
            if len(rows) > 1:
                group = _Group(rows, percent)
                links.extend(group.search([i for i, r in enumerate(group.rows) if r[2] == 1], key[2] < 0))

        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("leader", "i", "j", "c", "component", "role")]
            for leader, i, j, c, component, role, shingles in zip(*columns, batch.column("shingles")):
                if (leader, i, j) != key:
                    done()
                    key, rows = (leader, i, j), []
                    if len(links) >= 1 << 14:
                        yield out()
                rows.append((c, component, role, shingles.as_buffer()))
        done()
        yield out()

    return search


def _search(grouped: DataFrame, percent: int) -> DataFrame:
    keys = ["leader", "i", "j"]
    n = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = grouped.select(*keys, "c", "component", "role", "shingles")
    return map_arrow(rows.repartition(n, *keys).sortWithinPartitions(*keys, "c"), _linked(percent), "u long, v long")


def _by_leader(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Left join with one row per large group; a group's rows are dealt to many tasks."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), "c"), F.lit(SALTS)).cast("int"))
    return salted.join(facts.select("*", salts), ["leader", "salt"], "left").drop("salt")


def near_links(found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``u, v`` that connect exactly the similar classes within the groups of ``found(leader, c)``."""
    sizes = found.join(sets.select("c", F.octet_length("shingles").alias("bytes")), "c").groupBy("leader").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_ROWS), F.ceil(F.sum("bytes") / GROUP_BYTES)).cast("int").alias("m")
    )
    own = F.pmod(F.xxhash64("c"), F.col("m")).cast("int")
    placed = _by_leader(found, sizes.where("m > 1")).withColumn("m", F.coalesce("m", F.lit(1))).withColumn("own", own)
    leads = F.col("c") == F.col("leader")
    # the leader goes to every chunk of its group
    chunks = F.explode(F.when(leads, F.sequence(F.lit(0), F.col("m") - 1)).otherwise(F.array("own")))
    first = placed.select("leader", "c", chunks.alias("i"), F.lit(-1).alias("j"), leads.cast("int").alias("role"), F.col("c").alias("component"))
    links = materialize(_search(first.join(sets, "c"), percent), "minhash-links")

    cut = materialize(placed.where("m > 1"), "minhash-cut")
    if cut.isEmpty():
        return links
    nodes = connected_components(links.where("u <> v"))
    within = cut.join(nodes.withColumnRenamed("node", "c"), "c", "left").withColumn("component", F.coalesce("component", "c"))
    counts = within.groupBy("leader", "component").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("leader").agg(F.max(F.struct("n", "component"))["component"].alias("main"))
    within = materialize(_by_leader(within, main).withColumn("apart", F.col("component") != F.col("main")), "minhash-within")
    open_ = within.groupBy("leader", F.col("own").alias("i")).agg(F.max("apart").alias("any")).where("any").drop("any")

    # classes apart of chunk i ask all of chunk j; those apart of j ask i in the pair the other way round
    def meet(i: Column, j: Column) -> Column:
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))

    all_chunks = F.sequence(F.lit(0), F.col("m") - 1)
    asks = within.where("apart").select("leader", "c", "component", F.inline(F.transform(F.filter(all_chunks, lambda j: j != F.col("own")), lambda j: meet(F.col("own"), j))))
    others = F.filter(all_chunks, lambda i: i != F.col("own"))
    answers = within.select("leader", "c", "component", "own", F.explode(others).alias("i")).join(open_, ["leader", "i"]).select(
        "leader", "c", "component", "i", F.col("own").alias("j")
    )
    pairs = asks.withColumn("role", F.lit(1)).unionByName(answers.withColumn("role", F.lit(0)))
    return links.unionByName(_search(pairs.join(sets, "c"), percent))


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Rows link when the sets of their distinct ``shingle``-word shingles have ``100 * intersection >= percent *
    union``; a text of fewer words is one shingle.  ``component_id`` is the smallest id reachable, ``kept``
    tells whether it is the row's own.  Null ids do not count as smallest: a component of them alone has a null
    id, and its rows are kept.  Null, empty or wordless texts have no shingles and link with nothing;
    repeated rows link to each other; an empty table gives no rows.  Other columns are not read.
    """
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *hash128(text))
    rows = materialize(
        map_arrow(source, _class_rows(shingle), "doc_id long, h1 long, h2 long, s1 long, s2 long, n long, sig binary"), "minhash-rows"
    )
    # ids of the written classes: the table is read as it was written, whatever a retry does
    carrier = F.min(F.struct("h1", "h2"))
    classes = materialize(
        rows.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("first_id"), F.first("sig").alias("sig"), carrier.alias("of"))
        .withColumn("c", F.monotonically_increasing_id()),
        "minhash-classes",
    )
    found = materialize(members(classes, max_errors(percent)), "minhash-members")

    # the texts of the classes that meet others: copies are merged before the shuffle
    needed = classes.join(found.select("c").distinct(), "c", "left_semi").select("c", F.col("of.h1").alias("h1"), F.col("of.h2").alias("h2"))
    texts = source.groupBy("h1", "h2").agg(F.first("text").alias("text")).join(needed, ["h1", "h2"])
    sets = materialize(map_arrow(texts.select("c", "text"), _set_rows(shingle), "c long, shingles binary"), "minhash-sets")

    nodes = connected_components(near_links(found, sets, percent).where("u <> v"))
    grouped = classes.select("c", "s1", "s2", "first_id").join(nodes.withColumnRenamed("node", "c"), "c", "left")
    grouped = materialize(grouped.withColumn("component", F.coalesce("component", "c")), "minhash-components")
    least = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = grouped.join(least, "component").select("s1", "s2", "component_id", F.lit(True).alias("has"))
    component = F.when(F.col("has"), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(ids, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.equal_null("doc_id", component).alias("kept")
    )
