"""Body decoding, envelope projection and message handlers."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mqtable.functions.text import decode_body, header_value

OK, FAILED = "ok", "failed"


def decoded_text(m: DataFrame) -> DataFrame:
    """Body bytes -> text (malformed UTF-8 -> U+FFFD)."""
    return m.select("message_id", decode_body("body").alias("text"))


def envelope(m: DataFrame) -> DataFrame:
    """The delivery envelope next to the decoded body."""
    return m.select(
        "message_id",
        decode_body("body").alias("body"),
        "exchange",
        "routing_key",
        "delivery_tag",
    )


def header_lookup(m: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """Optional header; absent map or key gives NULL."""
    return m.select("message_id", header_value("headers", key).alias(alias or f"header_{key}"))


def _parsed(body: Column, field: str, data_type: str) -> Column:
    return F.from_json(
        body,
        f"`{field}` {data_type}, `_corrupt` string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )


def handle_json(m: DataFrame, field: str = "k", data_type: str = "bigint") -> DataFrame:
    """P4 (built-in): decode + JSON field, added as ``<field>`` and ``ok``.

    The handler fails on a present body that is no JSON object with a fitting field; a field that
    holds null is a success whose value is NULL.
    """
    body = decode_body("body")
    parsed = _parsed(body, field, data_type)
    has_field = F.array_contains(F.json_object_keys(body), field)
    ok = body.isNull() | F.coalesce(parsed["_corrupt"].isNull() & has_field, F.lit(False))
    return m.withColumn(field, F.when(ok, parsed[field])).withColumn("ok", ok)


@dataclass(frozen=True)
class Delivery:
    """A message as a user handler sees it."""

    body: bytes | None
    queue: str | None = None
    exchange: str | None = None
    routing_key: str | None = None
    delivery_tag: int | None = None
    headers: dict[str, str] | None = None

    @property
    def text(self) -> str | None:
        """The body as UTF-8 text, malformed sequences replaced."""
        return None if self.body is None else self.body.decode("utf-8", "replace")


def _column_or_null(m: DataFrame, name: str, data_type: str) -> Column:
    return (F.col(name) if name in m.columns else F.lit(None)).cast(data_type)


def message_handler(m: DataFrame, fn: Callable[[Delivery], object], return_type: T.DataType) -> Column:
    """P4 (user code): ``struct(value, ok)`` of ``fn`` over the whole message, in Arrow batches.

    ``ok`` is false for that row alone when the call raises or its value does not fit
    ``return_type``; a handler that returns None succeeds with the value NULL.
    """
    from mqtable.session import workers_import_package

    workers_import_package(m.sparkSession)

    def call(*fields):
        *plain, tag, headers = fields
        delivery = Delivery(*plain, None if pd.isna(tag) else int(tag), None if headers is None else json.loads(headers))
        try:
            return fn(delivery), True
        except Exception:  # noqa: BLE001 - a handler failure is data, not a crash
            return None, False

    @F.pandas_udf(T.StructType([T.StructField("value", return_type), T.StructField("ok", T.BooleanType())]))
    def apply(
        body: pd.Series, queue: pd.Series, exchange: pd.Series, routing_key: pd.Series, tag: pd.Series, headers: pd.Series
    ) -> pd.DataFrame:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(return_type)
        done = [call(*row) for row in zip(body, queue, exchange, routing_key, tag, headers)]
        values = [v for v, _ in done]
        try:
            pa.array(values, kind)
        except (pa.ArrowInvalid, pa.ArrowTypeError, TypeError, ValueError, OverflowError):
            for i, v in enumerate(values):
                try:
                    pa.array([v], kind)
                except (pa.ArrowInvalid, pa.ArrowTypeError, TypeError, ValueError, OverflowError):
                    done[i] = (None, False)
        return pd.DataFrame({"value": pd.Series([v for v, _ in done], dtype=object), "ok": [ok for _, ok in done]})

    return apply(
        F.col("body").cast("binary"),
        *[_column_or_null(m, c, "string") for c in ("queue", "exchange", "routing_key")],
        _column_or_null(m, "delivery_tag", "long"),
        F.to_json("headers") if "headers" in m.columns else F.lit(None).cast("string"),
    )


def handled_by(m: DataFrame, fn: Callable[[Delivery], object], return_type: T.DataType) -> DataFrame:
    """``m`` with ``value`` and ``outcome`` of a user handler."""
    out = m.withColumn("__handled", message_handler(m, fn, return_type))
    out = out.withColumn("value", F.col("__handled.value")).withColumn("ok", F.col("__handled.ok"))
    return split_outcomes(out.drop("__handled")).drop("ok")


def json_k(delivery: Delivery):
    """Example user handler: the integer field ``k`` of a JSON body."""
    value = json.loads(delivery.text)["k"]
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError("k is not an integer")
    return value


def handle_udf(m: DataFrame, fn: Callable[[Delivery], object] = json_k, return_type=T.LongType(), out: str = "k"):
    """P4 via a user function; columns ``message_id, <out>``."""
    return handled_by(m, fn, return_type).select("message_id", F.col("value").alias(out))


def split_outcomes(handled: DataFrame) -> DataFrame:
    """``outcome`` of rows with the handler's ``ok``."""
    return handled.withColumn("outcome", F.when(F.col("ok"), F.lit(OK)).otherwise(F.lit(FAILED)))


def outcome_counts(m: DataFrame) -> DataFrame:
    """``queue, outcome, n`` with the built-in JSON handler."""
    handled = split_outcomes(handle_json(m))
    return handled.groupBy("queue", "outcome").agg(F.count(F.lit(1)).alias("n"))
