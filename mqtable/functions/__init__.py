"""Column-level functions (all JVM-side built-ins, no Python UDFs)."""

from mqtable.functions.text import decode_body, header_value, headers_map
from mqtable.functions.time import batch_index, epoch_micros, floor_div
from mqtable.functions.topic import topic_key_words, topic_matches, topic_regex

__all__ = [
    "batch_index",
    "decode_body",
    "epoch_micros",
    "floor_div",
    "header_value",
    "headers_map",
    "topic_key_words",
    "topic_matches",
    "topic_regex",
]
