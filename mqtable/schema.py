"""Schemas of the message log and its side tables."""

from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("message_id", T.LongType()),
        T.StructField("queue", T.StringType()),
        T.StructField("delivery_tag", T.LongType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("routing_key", T.StringType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("priority", T.IntegerType()),
        T.StructField("fail_count", T.IntegerType()),
        T.StructField("published_at", T.TimestampNTZType()),
    ]
)

BINDING_SCHEMA = T.StructType(
    [
        T.StructField("queue", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("exchange_type", T.StringType()),
        T.StructField("routing_key", T.StringType()),
    ]
)

POLICY_SCHEMA = T.StructType(
    [
        T.StructField("queue", T.StringType()),
        T.StructField("max_length", T.IntegerType()),
        T.StructField("message_ttl_ms", T.IntegerType()),
        T.StructField("expires_ms", T.IntegerType()),
        T.StructField("max_length_bytes", T.IntegerType()),
        T.StructField("dead_letter_exchange", T.StringType()),
        T.StructField("dead_letter_routing_key", T.StringType()),
        T.StructField("max_priority", T.IntegerType()),
    ]
)

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("key_index", T.IntegerType()),
        T.StructField("queue", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("exchange_type", T.StringType()),
        T.StructField("routing_keys", T.StringType()),
        T.StructField("options", T.MapType(T.StringType(), T.StringType())),
    ]
)
