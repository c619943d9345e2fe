"""Time arithmetic on message timestamps without time-zone dependence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS = 1_000  # microseconds per millisecond
EPOCH_TEXT = "1970-01-01 00:00:00"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ column (wall clock, no zone)."""
    return F.timestamp_diff(
        "MICROSECOND", F.lit(EPOCH_TEXT).cast("timestamp_ntz"), _col(ts).cast("timestamp_ntz")
    )


def floor_div(a, b) -> Column:
    """Floor division of integers that is also right for negative numerators."""
    a, b = _col(a), _col(b)
    return F.call_function("div", a - F.pmod(a, b), b)


def batch_index(ts, slide_ms: int, receive_ms: int | None = None) -> Column:
    """Micro-batch a message lands in when each batch receives for ``receive_ms``.

    A batch ``b`` covers processing time ``[b*slide - (slide - receive), b*slide + receive)``
    shifted so that arrivals after the receive window wait for the next batch:
    ``batch = floor((t + slide - receive) / slide)`` with ``0 < receive <= slide``.
    """
    receive = slide_ms if receive_ms is None else max(1, min(receive_ms, slide_ms))
    shifted = epoch_micros(ts) + F.lit((slide_ms - receive) * MS)
    return floor_div(shifted, F.lit(slide_ms * MS))
