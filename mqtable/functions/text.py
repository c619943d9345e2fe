"""Body and header functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_body(body) -> Column:
    """Bytes (or text) -> UTF-8 text; malformed sequences become U+FFFD.

    ``decode(body, 'UTF-8')`` raises on malformed input under ANSI mode, so the
    bytes are reinterpreted and repaired with ``make_valid_utf8`` instead.
    """
    return F.make_valid_utf8(_col(body).cast("string"))


def headers_map(**entries) -> Column:
    """``MAP<STRING,STRING>`` of the non-null entries, NULL when all are absent."""
    pairs = [(k, _col(v).cast("string")) for k, v in entries.items()]
    if len(pairs) == 1:  # common case without a higher-order function (stays in codegen)
        (k, v), = pairs
        return F.when(v.isNotNull(), F.create_map(F.lit(k), v))
    kv = F.map_from_entries(
        F.filter(
            F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs]),
            lambda e: e["value"].isNotNull(),
        )
    )
    return F.when(F.size(kv) > 0, kv)


def header_value(headers, key: str) -> Column:
    """NULL-safe header lookup (NULL map or missing key -> NULL)."""
    return F.try_element_at(_col(headers), F.lit(key))
