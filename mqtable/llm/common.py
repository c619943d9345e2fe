"""Shared helpers: column expressions, tables written to the shared folder, file access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mqtable.session import scratch_path, workers_import_package

#: The ASCII white space \x20 \x09-\x0D, as a set for ``btrim``.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Stands for a null id where rows are grouped or joined by it; smaller than any other id.
NULL_ID = -(2**63)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, lower-cased.  Pure ASCII takes the fast path."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def known_id(column: Column) -> Column:
    """A long id in which null is a value of its own that sorts first."""
    return F.coalesce(column.cast("long"), F.lit(NULL_ID))


def shown_id(column: Column) -> Column:
    return F.when(column != NULL_ID, column)


def hash128(column: Column) -> list[Column]:
    """Two differently seeded 64-bit hashes: 128 bits that stand for the value."""
    return [F.xxhash64(column).alias("h1"), F.xxhash64(F.lit("second"), column).alias("h2")]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and tells Catalyst the true size,
    so that joins with the table are broadcast only when it is known to be small.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers can import this package, however the driver found it."""
    workers_import_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def open_fs(uri: str):
    """pyarrow file system and path of a folder in the shared store (``file:``, ``hdfs:``, ``s3:`` ...)."""
    from pyarrow import fs

    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)
