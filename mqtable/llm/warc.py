"""WARC archives with a two-level capture index.

Archives are written where the rows are: each task appends gzipped records to files of its own and
reports where every record lies.  The reported captures are range-partitioned by reversed-host URL
key; each partition becomes one index file of compressed blocks followed by a sparse directory, the
first key and the place of each block.  A lookup finds the index file by its first key, the block by
binary search in the directory, reads that block's range, and then the record's range in the archive.

Payloads are moved only to learn whether they repeat; equal payloads are archived once, and later
captures are revisit records.  Only files named in a written manifest are read, so failed and
repeated task attempts leave nothing behind that counts.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mqtable.llm.common import known_id, map_arrow, materialize, open_fs, shown_id
from mqtable.session import scratch_path

#: Payloads below this many bytes are always archived whole.
REVISIT_BYTES = 100
#: Bytes after which a task begins a new archive file; captures in an index block.
ARCHIVE_BYTES, BLOCK_CAPTURES = 1 << 30, 1024
# Fixed values of the format.
VERSION, DATE = b"WARC/1.1", b"1970-01-01T00:00:00Z"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TAIL = "<qq8s"
MAGIC = b"CDXBLOCK"


def url_key(url: Column) -> Column:
    """Host labels reversed and joined by commas, ``)``, then path and query; null is the empty URL."""
    plain = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), "#.*$", "")
    pattern = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?@]*@)?([^/?:]*)(?::[0-9]*)?(.*)$"
    host = F.lower(F.regexp_extract(plain, pattern, 1))
    rest = F.regexp_extract(plain, pattern, 2)
    return F.when(host == "", plain).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


def _clean(value: str) -> bytes:
    """A header value on one line."""
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in value).encode()


def _record_id(page_id: int) -> bytes:
    return b"<urn:page:%d>" % page_id


def record(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP headers alone, whose length is that of the full payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        VERSION,
        b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: " + _record_id(page_id),
        b"WARC-Date: " + DATE,
        b"WARC-Target-URI: " + (_clean(url) if url else _record_id(page_id)[1:-1]),
        b"WARC-Payload-Digest: sha256:" + digest.encode(),
        b"Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: " + _record_id(refers_to)]
    body = http + (payload if refers_to is None else b"")
    return b"\r\n".join([*head, b"Content-Length: %d" % len(body)]) + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers (lower-case names), HTTP headers and payload of a record."""

    def headers(part: bytes) -> dict[str, str]:
        pairs = (line.split(b":", 1) for line in part.split(b"\r\n")[1:])
        return {k.decode().lower(): v.strip().decode() for k, v in pairs}

    head, rest = data.split(b"\r\n\r\n", 1)
    own = headers(head)
    body = rest[: int(own["content-length"])]
    if not data.startswith(VERSION) or rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    http, payload = body.split(b"\r\n\r\n", 1)
    return {"warc": own, "http": headers(http), "payload": payload}


def _page(record_id: str) -> int:
    return int(record_id.removeprefix("<urn:page:").removesuffix(">"))


def _archive_writer(folder: str):
    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        store, root = open_fs(folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            places: dict[str, list] = {"key": [], "id": [], "file": [], "offset": [], "length": []}
            columns = (batch.column(c) for c in ("key", "id", "url", "payload", "digest", "refers_to"))
            for key, page, url, payload, digest, refers in zip(*columns):
                if out is None or at >= ARCHIVE_BYTES:
                    if out:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                data = gzip.compress(record(page.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers.as_py()), 4, mtime=0)
                out.write(data)
                for c, v in zip(places, (key.as_py(), page.as_py(), name, at, len(data))):
                    places[c].append(v)
                at += len(data)
            yield pa.RecordBatch.from_pydict(places)
        if out:
            out.close()

    return write


def write_archive(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> tuple[str, DataFrame]:
    """Write one record per row of ``pages``; returns the folder and ``key, id, file, offset, length``.

    Null payloads are empty.  Of records whose equal payloads have at least ``REVISIT_BYTES`` bytes,
    those of the smallest id are responses and the others revisit it; a null id sorts before all.
    Repeated rows are records of their own.  Other columns are not read.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = pages.select(
        known_id(F.col(id_col)).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    repeated = materialize(
        rows.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n"),
        "warc-repeated",
    )
    records = rows.join(repeated, "digest", "left").select(
        url_key(F.col("url")).alias("key"), "id", "url", "payload", "digest",
        F.when(F.col("first") != F.col("id"), F.col("first")).alias("refers_to"),
    )
    captures = map_arrow(records, _archive_writer(folder), "key string, id long, file string, offset long, length long")
    return folder, materialize(captures, "warc-captures")


def _index_writer(folder: str):
    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        store, root = open_fs(folder)
        store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.cdx"
        directory: list[list] = []
        block: list[list] = []
        at = 0
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:

            def flush() -> int:
                data = zlib.compress("\n".join(json.dumps(c, ensure_ascii=False) for c in block).encode())
                out.write(data)
                directory.append([block[0][0], block[0][1], at, len(data)])
                block.clear()
                return len(data)

            for batch in batches:
                for capture in zip(*(c.to_pylist() for c in batch.columns)):
                    block.append(list(capture))
                    if len(block) == BLOCK_CAPTURES:
                        at += flush()
            if block:
                at += flush()
            packed = zlib.compress(json.dumps(directory, ensure_ascii=False).encode())
            out.write(packed + struct.pack(TAIL, at, len(packed), MAGIC))
        if directory:
            yield pa.RecordBatch.from_pylist(
                [{"part": TaskContext.get().partitionId(), "index": name, "first_key": directory[0][0], "first_id": directory[0][1]}]
            )

    return write


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the index files of ``captures`` into ``folder``; returns their manifest, one row per file."""
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "id", "file", "offset"]  # file and offset deal a capture that repeats over several files
    rows = captures.select(*order, "length").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return materialize(map_arrow(rows, _index_writer(folder), "part long, index string, first_key string, first_id long"), "warc-index")


class Index:
    """The capture index as a task sees it: one open file, its directory, and one block at a time."""

    def __init__(self, folder: str, files: list[tuple[tuple[str, int], str]]):
        self.store, self.root = open_fs(folder)
        self.firsts = [first for first, _ in files]
        self.names = [name for _, name in files]
        self.file = self.block = (None,)

    def _open(self, number: int) -> None:
        if self.file[0] == number:
            return
        path = f"{self.root}/{self.names[number]}"
        source = self.store.open_input_file(path)
        width = struct.calcsize(TAIL)
        at, size, magic = struct.unpack(TAIL, source.read_at(width, source.size() - width))
        if magic != MAGIC:
            raise ValueError(f"not an index: {path}")
        directory = json.loads(zlib.decompress(source.read_at(size, at)))
        self.file = (number, source, [(key, page) for key, page, *_ in directory], directory)

    def _captures(self, number: int, block: int) -> dict[tuple[str, int], list]:
        if self.block[0] != (number, block):
            _, source, _, directory = self.file
            _, _, at, size = directory[block]
            held: dict[tuple[str, int], list] = {}
            for line in zlib.decompress(source.read_at(size, at)).decode().split("\n"):
                key, page, *place = json.loads(line)
                held.setdefault((key, page), []).append(place)
            self.block = ((number, block), held)
        return self.block[1]

    def find(self, key: str, page: int) -> Iterator[list]:
        """``file, offset, length`` of every capture of the page under the key."""
        wanted = (key, page)
        number = max(0, bisect_left(self.firsts, wanted) - 1)
        while number < len(self.names) and self.firsts[number] <= wanted:
            self._open(number)
            firsts = self.file[2]
            block = max(0, bisect_left(firsts, wanted) - 1)
            while block < len(firsts) and firsts[block] <= wanted:
                yield from self._captures(number, block).get(wanted, ())
                block += 1
            number += 1


def lookup(requests: DataFrame, folder: str, index: DataFrame) -> DataFrame:
    """``file, offset, length`` of all captures of the distinct requests ``key, id``.

    The manifest of index files, a row for each partition they were written from, goes to every
    task; keys are read from the files.  Requests are sorted, so a task opens each block once.
    """
    files = [((r["first_key"], r["first_id"]), r["index"]) for r in index.orderBy("part").collect()]

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found = Index(folder, files)
        for batch in batches:
            places = [p for key, page in zip(*(c.to_pylist() for c in batch.columns)) for p in found.find(key, page)]
            file, offset, length = zip(*places) if places else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(file, pa.string()), pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
                names=["file", "offset", "length"],
            )

    parts = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = requests.select("key", "id").distinct().repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id")
    return map_arrow(ordered, search, "file string, offset long, length long")


def _record_reader(folder: str):
    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        store, root = open_fs(folder)
        name, source = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                out = []
                for file, offset, length in zip(*(c.to_pylist() for c in batch.slice(lo, 128).columns)):
                    if file != name:
                        name, source = file, store.open_input_file(f"{root}/{file}")
                    found = parse(gzip.decompress(source.read_at(length, offset)))
                    own, kind = found["warc"], found["warc"]["warc-type"]
                    digest = own["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response" and digest != hashlib.sha256(found["payload"]).hexdigest():
                        raise ValueError(f"damaged record in {file} at {offset}")
                    out.append({
                        "id": _page(own["warc-record-id"]),
                        "payload_bytes": int(found["http"]["content-length"]),
                        "payload_digest": digest,
                        "record_type": kind,
                        "refers_to": _page(own["warc-refers-to"]) if kind == "revisit" else None,
                        "payload": found["payload"] if kind == "response" else None,
                    })
                yield pa.RecordBatch.from_pylist(out, schema=schema())

    def schema():
        import pyarrow as pa

        return pa.schema([("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                          ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    return read


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, payload`` of the records at ``places``.

    Length and digest are those of the full payload; a revisit has no ``payload`` of its own.  A
    response whose payload does not match its digest raises.
    """
    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = places.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    rows = map_arrow(
        ordered,
        _record_reader(folder),
        "id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )
    return rows.select(
        shown_id(F.col("id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        shown_id(F.col("refers_to")).alias("refers_to"), "payload",
    )


def requests_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    return pages.select(url_key(F.col(url_col)).alias("key"), known_id(F.col(id_col)).alias("id"))
