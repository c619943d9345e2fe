"""Spelling variant grouping over a bit-sliced position index.

The words of the corpus are counted; two words are near if they differ by one inserted, deleted or
replaced code point, and the form of a word is its most frequent near word, if frequent enough.

* Near words whose shorter length is l agree in their first or their last ``h = min(l // 2, 3)`` code
  points, so the vocabulary is dealt to shards by (l, side, those code points).  A word is in four shards.
  A shard over its chunk size is cut into chunks that meet pairwise in tasks of their own.
* In a shard, for every (position, letter) a bitset over the shard's words tells which of them have
  that letter there.  A query word walks its letters and keeps four bitsets: words equal so far, and
  words with one replaced letter, one letter more (positions shifted by one) or one letter less so
  far.  Each step is a few word-parallel ANDs and ORs, for a block of queries at once.
* Words are numbered by falling count, then code points, so the first bit set is the form, and the
  bits set are the near words: pairs are never listed.  A pair that agrees on both sides counts in the
  shard of its first letters only: there the words equal after ``h`` letters are taken out.
* Chains of forms are followed by pointer doubling, a join a round.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mqtable.llm.common import map_arrow, materialize

MIN_LETTERS = 5
#: Distinct words that a task counts before it passes them on.
COUNTED = 1 << 18
#: Words of a shard's chunk at most; for long words fewer, so that its index stays under INDEX_BYTES.
CHUNK, INDEX_BYTES = 1 << 12, 8 << 20
#: Bytes of one bitset of a block of queries.
BLOCK_BYTES = 4 << 20

# Runs of [A-Za-z\\u00C0-\\u00FF] in UTF-8; shorter runs can give no word.
_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf]){%d,}" % MIN_LETTERS)


def words_of(doc_id: int | None, text: bytes) -> Iterator[bytes]:
    """The words of a text in UTF-8, every 97th (by hash of id and word) without one code point; a null id is empty."""
    own = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    crc = zlib.crc32
    for run in _RUN.findall(text):
        run = run.lower()  # of bytes: A-Z alone
        h = crc(run, own)
        if h % 97 == 0:
            letters = run.decode()
            at = h % len(letters)
            run = (letters[:at] + letters[at + 1 :]).encode()
        yield run


def _counter(batches: Iterator) -> Iterator:
    import pyarrow as pa

    counts: Counter[bytes] = Counter()

    def passed_on():
        # bytes are UTF-8; fewer than MIN_LETTERS bytes are fewer code points too
        kept = [(w, n) for w, n in counts.items() if len(w) >= MIN_LETTERS]
        counts.clear()
        words = pa.array([w for w, _ in kept], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            counts.update(words_of(doc_id.as_py(), text.as_buffer().to_pybytes() if text.is_valid else b""))
            if len(counts) >= COUNTED:
                yield passed_on()
    yield passed_on()


def vocabulary(docs: DataFrame, min_count: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of the words of all texts with at least ``MIN_LETTERS`` code points and ``min_count`` occurrences."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = map_arrow(rows, _counter, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= min_count) & (F.char_length("word") >= MIN_LETTERS))


class PositionIndex:
    """Per (position, letter) the bitset of the words that have it there, packed in 64-bit words."""

    def __init__(self, letters: np.ndarray, sizes: np.ndarray):
        self.count, self.width = letters.shape
        self.parts = -(-self.count // 64)
        self.alphabet = np.unique(letters[letters > 0])
        # a last row of zeros for letters and positions that no word has
        table = np.zeros((self.width + 2, len(self.alphabet) + 1, self.parts * 64), bool)
        for j in range(self.width):
            here = np.flatnonzero(sizes > j)
            table[j, np.searchsorted(self.alphabet, letters[here, j]), here] = True
        self.table = self.packed(table)
        self.sizes = sizes

    @staticmethod
    def packed(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=-1, bitorder="little").view("<u8")

    def of_size(self, size: int) -> np.ndarray:
        bits = np.zeros(self.parts * 64, bool)
        bits[: self.count] = self.sizes == size
        return self.packed(bits)

    def codes(self, letters: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.alphabet, letters)
        known = at < len(self.alphabet)
        known[known] = self.alphabet[at[known]] == letters[known]
        return np.where(known, at, len(self.alphabet))

    def near(self, letters: np.ndarray, h: int, longer: bool) -> tuple[np.ndarray, np.ndarray]:
        """Per query (rows of equally long words): the bitset of near words, and that of words with its first ``h`` letters.

        With ``longer`` the queries have one letter more than the shard's length, and only shorter words
        count; else words of the same length and those with one letter more do.
        """
        n, size = letters.shape
        codes = self.codes(letters)
        same = np.full((n, self.parts), ~np.uint64(0))  # equal so far
        replaced = np.zeros_like(same)
        more = np.zeros_like(same)  # the word has had one letter that the query lacks
        less = np.zeros_like(same)  # the query has had one letter that the word lacks
        first = same
        for i in range(size):
            here, ahead = self.table[i, codes[:, i]], self.table[i + 1, codes[:, i]]
            if longer:
                less = (less & self.table[i - 1, codes[:, i]] if i else less) | same
            else:
                replaced = (replaced & here) | (same & ~here)
                # a letter more before this one, now or earlier
                more = (more | same) & ahead
            same = same & here
            if i + 1 == h:
                first = same
        if longer:
            return less & self.of_size(size - 1), first
        return (replaced & self.of_size(size)) | ((more | same) & self.of_size(size + 1)), first


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded with 0, and their lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.array(words).astype(f"<U{int(sizes.max())}").view("<u4").reshape(len(words), -1)
    return flat, sizes


def _shard_forms(shortest: int, suffix: bool, query: list[tuple[str, int]], index: list[tuple[str, int]]) -> Iterator[tuple]:
    """``word, n_near, form, form_n`` of the queries that have near words in the index."""
    index = sorted(index, key=lambda x: (-x[1], x[0]))
    table = PositionIndex(*_letters([w for w, _ in index]))
    h = _overlap(shortest)
    for size in (shortest, shortest + 1):
        words = [w for w, _ in query if len(w) == size]
        step = max(1, BLOCK_BYTES // (8 * table.parts))
        for lo in range(0, len(words), step):
            part = words[lo : lo + step]
            near, first = table.near(_letters(part)[0], h, size > shortest)
            if suffix:
                near &= ~first
            n_near = np.bitwise_count(near).sum(axis=1, dtype=np.int64)
            some = np.flatnonzero(n_near)
            cell = (near[some] != 0).argmax(axis=1)
            bits = near[some, cell]
            best = cell * 64 + np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1))
            for i, b in zip(some.tolist(), best.tolist()):
                yield (part[i], int(n_near[i]), *index[b])


def _overlap(shortest: int) -> int:
    return min(shortest // 2, 3)


def _in_shards(batches: Iterator) -> Iterator:
    """Rows sorted by shard and chunk pair: each group's words in, its forms out."""
    import pyarrow as pa

    out: list[tuple] = []
    key, query, index = None, [], []

    def rows():
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.string(), pa.int64()))],
            names=["word", "n_near", "form", "form_n"],
        )
        out.clear()
        return batch

    for batch in batches:
        for row in batch.to_pylist():
            own = (row["shortest"], row["suffix"], row["part"], row["i"], row["j"])
            if own != key:
                if query and index:
                    out.extend(_shard_forms(key[0], key[1], query, index))
                key, query, index = own, [], []
                if len(out) >= 1 << 14:
                    yield rows()
            if row["side"] != 1:
                query.append((row["word"], row["n"]))
            if row["side"] != 0:
                index.append((row["word"], row["n"]))
    if query and index:
        out.extend(_shard_forms(key[0], key[1], query, index))
    if out:
        yield rows()


def _shards(words: DataFrame) -> DataFrame:
    """``shortest, suffix, part, word, n``: the four shards of each word, without shards of a single word."""
    w, size = F.col("word"), F.char_length("word")

    def shard(shortest: Column, suffix: bool) -> Column:
        h = F.least(F.floor(shortest / 2), F.lit(3)).cast("int")
        part = F.right(w, h) if suffix else F.left(w, h)
        return F.struct(shortest.alias("shortest"), F.lit(suffix).alias("suffix"), part.alias("part"))

    places = F.array(*[shard(s, suffix) for s in (size, size - 1) for suffix in (False, True)])
    return words.select("word", "n", F.explode(places).alias("at")).select("at.*", "word", "n").where(f"shortest >= {MIN_LETTERS}")


def _meetings(dealt: DataFrame) -> DataFrame:
    """Adds ``i, j`` (the chunks of queries and of index that meet) and ``side``: 0 query, 1 index, 2 both."""
    keys = ["shortest", "suffix", "part"]
    # about 100 letters a position: the chunk's index stays within its bytes
    most = F.greatest(F.lit(64), F.least(F.lit(CHUNK), (F.lit(INDEX_BYTES * 8 // 100) / (F.col("shortest") + 3)).cast("int")))
    sizes = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = sizes.select(*keys, F.ceil(F.col("size") / most).cast("int").alias("m"))
    rows = dealt.join(sizes, keys).withColumn("own", F.pmod(F.xxhash64("word"), F.col("m")).cast("int"))
    own = F.col("own")

    def meet(i: Column, j: Column, side: Column) -> Column:
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.alias("side"))

    others = F.filter(F.sequence(F.lit(0), F.col("m") - 1), lambda x: x != own)
    met = F.concat(
        F.array(meet(own, own, F.lit(2))),
        F.transform(others, lambda x: meet(own, x, F.lit(0))),
        F.transform(others, lambda x: meet(x, own, F.lit(1))),
    )
    return rows.select(*keys, "word", "n", F.inline(met))


def near_forms(words: DataFrame, n_tasks: int | None = None) -> DataFrame:
    """``word, n_near, form, form_n`` per word of ``words(word, n)`` with near words; the form is the most frequent
    of them (ties: smallest in code-point order), whatever its count."""
    keys = ["shortest", "suffix", "part", "i", "j"]
    n_tasks = n_tasks or int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = _meetings(_shards(words)).repartition(n_tasks, *keys).sortWithinPartitions(*keys)
    found = map_arrow(grouped, _in_shards, "word string, n_near long, form string, form_n long")
    # counts ascending, so that the greatest has the most frequent; of ties the least word wins
    best = F.min(F.struct((-F.col("form_n")).alias("rank"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.rank")).alias("form_n")
    )


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` for every row of ``links(word, form)`` that has a form: the last of its chain, by pointer doubling.

    The count doubles at every step of a chain, so there are no cycles and few rounds.
    """
    now = materialize(links.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(onward, "root", "left")
        if moved.where("next IS NOT NULL").isEmpty():
            return now
        now = materialize(moved.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def spelling_variants(docs: DataFrame, min_count: int = 3, factor: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` per word of the vocabulary of ``docs``.

    The form is null unless its count is at least ``factor`` times the word's; the root of a word
    without a form is the word itself.  Null, empty or wordless texts give no words, a null id counts as
    an empty one, repeated rows count again, and an empty table gives no rows.  Other columns are not read.
    """
    words = materialize(vocabulary(docs, min_count, id_col, text_col), "spelling-words")
    found = words.join(near_forms(words), "word", "left")
    fits = F.col("form_n") >= factor * F.col("n")
    formed = materialize(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(fits, F.col("form")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    return formed.join(roots(formed), "word", "left").withColumn("root", F.coalesce("root", "word"))
