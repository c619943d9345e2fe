"""Token-ID / binary output: flat unsigned integer files with 64-bit document offsets.

Documents are range-partitioned and sorted by id.  Each partition is written by one task as
``<name>.bin`` (ids back to back, little-endian, 16 bits while the vocabulary allows) and
``<name>.idx`` (magic, number of documents, 64-bit offsets into the ids, 64-bit document ids).  The
global offset of a file is the prefix sum of the ids in the files before it.

A task names its files by a fresh UUID and reports them in its output row; only files in the written
manifest count, so retried and speculative attempts leave nothing that a reader would see.
"""

from __future__ import annotations

import array
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mqtable.llm.common import known_id, map_arrow, materialize, open_fs, shown_id
from mqtable.session import scratch_path

MAGIC = b"TOKENIDX"
#: Parts that a worker's cache holds about, in two generations: some 100 MB.
CACHE_ENTRIES = 1 << 20
#: Bytes of ids that are returned at a time, about.
CHUNK_BYTES = 4 << 20

#: Characters of text whose parts are looked up at once, and the longest part that stays in the cache.
CHUNK_CHARS, CACHED_CHARS = 1 << 21, 64

# Texts of these characters alone take the cached path; any other goes to the tokenizer whole.
_UNUSUAL = re.compile("[^\t\n\x20-\x7e\xa1-ɏ]")
# What a byte is to the cuts: the space, other white space, ASCII letters and digits, ASCII marks.  The
# apostrophe is none of them, as it may begin a word's piece.
_SPACE, _BREAK, _WORD, _MARK = 1, 2, 4, 8
_KIND = np.zeros(256, np.uint8)
_KIND[[c for c in range(33, 127) if c != ord("'")]] = _MARK
_KIND[[c for c in range(127) if chr(c).isalnum()]] = _WORD
_KIND[ord(" ")] = _SPACE
_KIND[[9, 10]] = _BREAK


def _cuts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the UTF-8 bytes of usual texts, which begin at ``starts``, fall into parts; first 0, last the size.

    A byte-level pre-tokenizer cuts at all these places, whatever is around them: before a run of white space
    and before its last character if a word follows (a last space belongs to that word, any other character
    stands alone), and between letters or digits and marks.
    """
    n = len(raw)
    kind = _KIND[raw]
    if n and raw.max() >= 0x80:
        # the last byte of a letter from \u00c0 on, but for the signs of multiplication and division
        lead, low = raw[:-1], raw[1:]
        latin = (lead >= 0xC3) & (low < 0xC0) & (low >= 0x80) & ((lead != 0xC3) | ((low != 0x97) & (low != 0xB7)))
        kind[1:][latin] = _WORD
    white = (kind & (_SPACE | _BREAK)) != 0
    followed = np.zeros(n, bool)
    followed[:-1] = ~white[1:]
    followed[starts[starts > 0] - 1] = False
    before, after = kind[:-1], kind[1:]
    cut = np.zeros(n + 1, bool)
    cut[1:-1] = white[1:] & (followed[1:] | ~white[:-1])
    cut[1:-1] |= ~white[1:] & ((before & _BREAK) != 0)
    cut[1:-1] |= (before | after) & (_WORD | _MARK) == (_WORD | _MARK)
    cut[starts] = True
    cut[[0, n]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of texts as packed integers, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    For a byte-level BPE without a normalizer, the parts that ``_cuts`` gives are encoded independently.  The
    distinct parts of a chunk of texts are looked up in a cache of those that came up lately; new ones are
    joined to two texts, with and without a space before each, that one call of the library each encodes.  Only
    the first token of a word begins with its space, which cuts the result apart again, as line feeds do.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        # the library's own cache of words costs more than it saves: it is asked for new words only
        self.tokenizer.model._resize_cache(0)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.code = "H" if len(vocabulary) <= 1 << 16 else "I"
        self.special = [str(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        kind = str(self.tokenizer.pre_tokenizer.__getstate__())
        self.plain = self.tokenizer.normalizer is None and all(
            s in kind for s in ('"ByteLevel"', '"use_regex":true', '"add_prefix_space":false')
        )
        # new words are joined by white space, across which no special token may come about
        self.plain = self.plain and not any(c.isspace() for s in self.special for c in s)
        # byte-level vocabularies write a space and a line feed as these letters
        self.spaced, self.feed = np.zeros(max(vocabulary.values()) + 1, bool), vocabulary.get("\u010a")
        self.spaced[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return array.array(self.code, ids).tobytes()

    def _ids(self, text: str) -> list[int]:
        # the call that keeps no offsets
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def whole(self, text: str) -> bytes:
        return self.pack(self._ids(text))

    def _usual(self, text: str) -> bool:
        return self.plain and not _UNUSUAL.search(text) and not any(s in text for s in self.special)

    def _joined(self, text: str, sep: str) -> Iterator[bytes]:
        """The ids of every part of ``text``: they begin with a space or, for ``sep`` a line feed, come after one."""
        ids = np.array(self._ids(text), "<u2" if self.code == "H" else "<u4")
        flat, step = ids.tobytes(), ids.itemsize
        at = (np.flatnonzero(self.spaced[ids] if sep == " " else ids == self.feed) * step).tolist()
        skip = 0 if sep == " " else step
        return (flat[lo + skip : hi] for lo, hi in zip(at, [*at[1:], len(flat)], strict=True))

    def _learn(self, parts: list[str]) -> list[str]:
        """Put the ids of ``parts``, which lack there, into the cache; returns those that should not stay."""
        now, old = self.now, self.old
        spaced, bare = [], []
        for p in parts:
            if p in old:
                now[p] = old[p]
            elif p.isspace():
                now[p] = self.whole(p)
            else:
                (spaced if p[0] == " " else bare).append(p)
        if spaced:
            now.update(zip(spaced, self._joined("".join(spaced), " "), strict=True))
        if bare:
            now.update(zip(bare, self._joined("\n" + "\n".join(bare), "\n"), strict=True))
        return [p for p in parts if len(p) > CACHED_CHARS]

    def _cached(self, texts: list[str]) -> Iterator[bytes]:
        """The packed ids of usual texts."""
        import pyarrow as pa

        column = pa.array(texts, pa.large_string())
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
        cuts = _cuts(np.frombuffer(data or b"", np.uint8)[: bounds[-1]], bounds[:-1])
        parts = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts), data or pa.py_buffer(b"")])
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.now.get, distinct))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        brief = self._learn([distinct[i] for i in gaps])
        for i in gaps:
            found[i] = self.now[distinct[i]]
        for p in brief:
            del self.now[p]
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, np.int64)[np.searchsorted(cuts, bounds)].tolist()
        flat = memoryview(data or b"")
        return (bytes(flat[lo:hi]) for lo, hi in zip(ends, ends[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of every text."""
        usual = [self._usual(text) for text in texts]
        cached = self._cached([text for text, u in zip(texts, usual) if u])
        out = [next(cached) if u else self.whole(text) for text, u in zip(texts, usual)]
        if len(self.now) >= CACHE_ENTRIES // 2:
            # what the old generation holds is taken over when it is asked for, else it goes
            self.old, self.now = self.now, {}
        return out

    def __call__(self, text: str) -> bytes:
        return self.encode([text])[0]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file, so that tasks share its caches."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _chunks(column) -> Iterator[list[str]]:
    """Texts of a column, as many at a time as have ``CHUNK_CHARS``, at least one."""
    held, size = [], 0
    for text in column:
        held.append(text.as_py())
        size += len(held[-1])
        if size >= CHUNK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _writer(folder: str, tokenizer_path: str, end_id: int):
    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        end = encoder(tokenizer_path).pack([end_id])
        width = len(end)
        store, root = open_fs(folder)
        store.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        ids, ends, total = array.array("q"), array.array("q", [0]), 0
        with store.open_output_stream(f"{root}/{name}.bin", compression=None) as out:
            for batch in batches:
                ids.extend(batch.column("id").to_pylist())
                for texts in _chunks(batch.column("text")):
                    for packed in encoder(tokenizer_path).encode(texts):
                        out.write(packed)
                        out.write(end)
                        total += len(packed) // width + 1
                        ends.append(total)
        with store.open_output_stream(f"{root}/{name}.idx", compression=None) as out:
            out.write(MAGIC + array.array("q", [len(ids)]).tobytes())
            out.write(ends.tobytes())
            out.write(ids.tobytes())
        yield pa.RecordBatch.from_pylist(
            [{"part": TaskContext.get().partitionId(), "name": name, "width": width, "n_docs": len(ids), "n_tokens": total}]
        )

    return write


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    end_id: int = 0,
    n_files: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the files and return their manifest ``folder, part, name, width, n_docs, n_tokens, base``.

    Every document is the ids of its whole text and ``end_id``; null text is empty.  Order is by id,
    then text: null ids come first, repeated rows follow each other.  An empty table gives files
    without documents.  Other columns are not read.  ``n_files`` defaults to the session's number
    of shuffle partitions.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    n = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(known_id(F.col(id_col)).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # the hash deals rows that share an id over several files
    ordered = rows.repartitionByRange(n, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")
    manifest = materialize(
        map_arrow(
            ordered, _writer(folder, tokenizer_path, end_id), "part long, name string, width long, n_docs long, n_tokens long"
        ),
        "token-manifest",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.select(
        F.lit(folder).alias("folder"), "*", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base")
    )


def _mapped(store, path: str, dtype: str):
    """The file as an array: memory-mapped where the store is a local mount, else read by ranges."""
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if store.get_file_info(path).size else np.empty(0, dtype)
    source = store.open_input_file(path)
    size = np.dtype(dtype).itemsize

    class Ranges:
        def __getitem__(self, part: slice):
            return np.frombuffer(source.read_at((part.stop - part.start) * size, part.start * size), dtype)

    return Ranges()


def _reader(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for file in batch.to_pylist():
            store, root = open_fs(file["folder"])
            index = _mapped(store, f"{root}/{file['name']}.idx", "<i8")
            count = int(index[1:2][0])
            if bytes(np.asarray(index[0:1]).tobytes()) != MAGIC or count != file["n_docs"]:
                raise ValueError(f"not an index of {file['n_docs']} documents: {file['name']}")
            ids = _mapped(store, f"{root}/{file['name']}.bin", f"<u{file['width']}")
            at = 0
            while at < count:
                # as many documents as fill a chunk, at least one
                upto = min(count, at + 4096)
                ends = np.asarray(index[2 + at : 3 + upto])
                fit = int(np.searchsorted(ends, ends[0] + CHUNK_BYTES // 4, "right")) - 1
                fit = max(1, min(fit, upto - at))
                starts = ends[: fit + 1]
                flat = np.asarray(ids[int(starts[0]) : int(starts[-1])]).astype("<u4")
                offsets = ((starts - starts[0]) * 4).astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.asarray(index[3 + count + at : 3 + count + at + fit])),
                        pa.array(starts[:-1] + file["base"]),
                        pa.array(np.diff(starts)),
                        pa.Array.from_buffers(pa.binary(), fit, [None, pa.py_buffer(offsets), pa.py_buffer(flat)]),
                    ],
                    names=["id", "start", "n_tokens", "ids"],
                )
                at += fit


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: ``doc_id, start`` (ids before it), ``n_tokens, ids``.

    ``ids`` holds the document's ids as little-endian unsigned 32-bit integers.
    """
    spread = manifest.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part")
    rows = map_arrow(spread, _reader, "id long, start long, n_tokens long, ids binary")
    return rows.select(shown_id(F.col("id")).alias("doc_id"), "start", "n_tokens", "ids")
