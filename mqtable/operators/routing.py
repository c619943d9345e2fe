"""Exchange routing (J1-J4) and topology declaration.

Routes are resolved once per *distinct* (exchange, routing key), never per message, by an equi-join
on (exchange, token).  A direct binding's token is its key, a fanout binding's a constant.  A topic
pattern could be looked up by any of its literal words at its place: counted from the front before the
first ``#``, from the back after the last, with the key's length where there is none, and anywhere between
two.  Its token is that of these signatures which the fewest keys have, so a key meets hardly more
patterns than it matches; the pattern itself, compiled to a regular expression as a column, decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mqtable.functions.topic import key_word_list, topic_key_words, topic_regex_column
from mqtable.operators.ordering import join_on
from mqtable.session import scratch_path

DIRECT, FANOUT, TOPIC = "direct", "fanout", "topic"
EXCHANGE_TYPES = (DIRECT, FANOUT, TOPIC)


class TopologyError(ValueError):
    pass


def topology_bindings(sources: DataFrame, strict: bool = False) -> DataFrame:
    """One binding per comma-separated routing key (not trimmed) of each source
    that names both an exchange and its type; otherwise nothing is bound.
    ``strict=True`` raises for a source with an exchange but no type."""
    if strict:
        bad = sources.where(F.col("exchange").isNotNull() & F.col("exchange_type").isNull()).limit(1)
        if bad.count():
            raise TopologyError("a source names an exchange without an exchange type")
    declared = sources.where(
        F.col("exchange").isNotNull() & F.col("exchange_type").isNotNull() & F.col("routing_keys").isNotNull()
    )
    return declared.select(
        "queue",
        "exchange",
        "exchange_type",
        F.explode(_comma_list(F.col("routing_keys"))).alias("routing_key"),
    )


def _comma_list(text: Column) -> Column:
    """Parts between commas, without empty ones at the end; the empty text is one empty part."""
    kept = F.regexp_replace(text, ",+$", "")
    return F.when((kept == "") & (text != ""), F.array().cast("array<string>")).otherwise(F.split(kept, ",", -1))


def _types(bindings: DataFrame) -> set[str]:
    """The exchange types that occur: three at most, else an error."""
    found = {r[0] for r in bindings.select("exchange_type").distinct().limit(len(EXCHANGE_TYPES) + 1).collect()}
    if not found <= set(EXCHANGE_TYPES):
        raise TopologyError(f"an exchange type is none of {', '.join(EXCHANGE_TYPES)}")
    return found


def _at(kind: str, place: Column, word: Column) -> Column:
    """The token of a word at its place."""
    return F.concat(F.lit(kind), place.cast("string"), F.lit(":"), word)


def _signatures(pattern: Column) -> Column:
    """Tokens of a topic pattern: every key that matches has all of them."""
    words = key_word_list(pattern)
    size, first = F.size(words), F.array_position(words, "#") - 1
    last = F.size(words) - F.array_position(F.reverse(words), "#")
    sized = F.concat(F.lit("n"), size.cast("string"), F.lit("@"))

    def token(word: Column, i: Column) -> Column:
        place = (
            F.when(first < 0, F.concat(sized, i.cast("string"), F.lit(":"), word))
            .when(i < first, _at("p", i, word))
            .when(i > last, _at("s", size - i, word))
            .otherwise(F.concat(F.lit("w:"), word))
        )
        return F.when(~word.isin("*", "#"), place)

    literal = F.filter(F.transform(words, token), lambda t: t.isNotNull())
    return F.when(F.size(literal) > 0, literal).otherwise(F.array(F.when(first < 0, sized).otherwise(F.lit("any"))))


def _key_tokens(keys: DataFrame, types: set[str]) -> DataFrame:
    """``k_exchange, k_key, k_token`` and the other columns of ``keys``: once per token that a binding may have."""
    words = key_word_list(F.col("routing_key"))
    size = F.size(words)
    sized = F.concat(F.lit("n"), size.cast("string"), F.lit("@"))
    parts = [F.array().cast("array<string>")]
    if FANOUT in types:
        parts.append(F.array(F.lit("x:")))
    if DIRECT in types:
        parts.append(F.array(F.concat(F.lit("d:"), "routing_key")))
    if TOPIC in types:
        placed = [
            F.transform(words, lambda w, i: F.concat(sized, i.cast("string"), F.lit(":"), w)),
            F.transform(words, lambda w, i: _at("p", i, w)),
            F.transform(words, lambda w, i: _at("s", size - i, w)),
            F.array_distinct(F.transform(words, lambda w: F.concat(F.lit("w:"), w))),
        ]
        topic = F.concat(F.array(F.lit("any"), sized), *placed)
        parts.append(F.coalesce(topic, F.array().cast("array<string>")))
    rest = [c for c in keys.columns if c not in ("exchange", "routing_key")]
    tokens = F.filter(F.concat(*parts), lambda t: t.isNotNull())
    return keys.select(F.col("exchange").alias("k_exchange"), F.col("routing_key").alias("k_key"), *rest, F.explode(tokens).alias("k_token"))


def _topic_tokens(bindings: DataFrame, k: DataFrame) -> DataFrame:
    """Topic bindings with ``token``: of their signatures that which the fewest keys have; those no key has are left out.

    The choice is written to the shared folder, so that Spark knows its size when it joins it with the keys."""
    names = bindings.columns
    each = bindings.distinct().withColumn("token", F.explode(_signatures(F.col("routing_key"))))
    asked = each.select(F.col("exchange").alias("k_exchange"), F.col("token").alias("k_token")).distinct()
    counts = k.join(asked, ["k_exchange", "k_token"], "left_semi").groupBy("k_exchange", "k_token").agg(F.count(F.lit(1)).alias("__keys"))
    known = each.join(counts, (F.col("exchange") == F.col("k_exchange")) & (F.col("token") == F.col("k_token")), "left")
    rarest = F.min(F.struct(F.coalesce("__keys", F.lit(0)).alias("keys"), F.col("token").alias("token"))).alias("rarest")
    # bindings of whatever columns, some of them null
    chosen = known.groupBy(*names).agg(rarest).where(F.col("rarest.keys") > 0)
    chosen = chosen.select(*names, F.col("rarest.token").alias("token"))
    path = scratch_path(chosen.sparkSession, "topic-tokens")
    chosen.write.parquet(path)
    return chosen.sparkSession.read.schema(chosen.schema).parquet(path)


def _candidates(keys: DataFrame, bindings: DataFrame) -> DataFrame:
    """Pairs of keys and bindings with a common token, with the binding's ``regex`` if it is a pattern."""
    types = _types(bindings)
    k = _key_tokens(keys, types)
    is_topic = F.col("exchange_type") == TOPIC
    named = (F.col("exchange_type") == FANOUT) | F.col("routing_key").isNotNull()
    plain = F.when(F.col("exchange_type") == DIRECT, F.concat(F.lit("d:"), "routing_key")).otherwise(F.lit("x:"))
    b = bindings.where(named & ~is_topic).withColumn("token", plain).withColumn("regex", F.lit(None).cast("string"))
    if TOPIC in types:
        topic = _topic_tokens(bindings.where(named & is_topic), k)
        b = b.unionByName(topic.withColumn("regex", topic_regex_column(F.col("routing_key"))))
    return k.join(b, (F.col("k_exchange") == F.col("exchange")) & (F.col("k_token") == F.col("token")))


def _matched(keys: DataFrame, bindings: DataFrame) -> DataFrame:
    """Every (key, binding) pair that matches; a null routing key matches fanout bindings only."""
    fits = F.col("regex").isNull() | F.coalesce(F.rlike(topic_key_words(F.col("k_key")), F.col("regex")), F.lit(False))
    return _candidates(keys, bindings).where(fits)


def resolve_routes(keys: DataFrame, bindings: DataFrame) -> DataFrame:
    """(exchange, routing_key) of ``keys`` -> bound queue, one row per distinct match.

    direct: same key; fanout: any key; topic: pattern match.  Two bindings of
    one queue that both match give one route (the queue gets the message once).
    """
    found = _matched(keys.select("exchange", "routing_key").distinct(), bindings)
    return found.select(F.col("k_exchange").alias("exchange"), F.col("k_key").alias("routing_key"), F.col("queue").alias("bound_queue")).distinct()


def route(messages: DataFrame, bindings: DataFrame) -> DataFrame:
    """Every (bound queue, message) pair the exchange delivers."""
    routes = resolve_routes(messages, bindings)
    return join_on(messages, routes, ["exchange", "routing_key"])


def unroutable(messages: DataFrame, bindings: DataFrame) -> DataFrame:
    """Messages no binding matches (a broker drops them)."""
    routable = resolve_routes(messages, bindings).select("exchange", "routing_key").distinct()
    return join_on(messages, routable, ["exchange", "routing_key"], how="left_anti")


def binding_traffic(messages: DataFrame, bindings: DataFrame) -> DataFrame:
    """Declared bindings with the number of messages each one matches.

    Messages are first counted per distinct (exchange, routing key); only that
    table meets the bindings, and each binding is matched on its own, so
    overlapping bindings of one queue are all reported.
    """
    key_counts = messages.groupBy("exchange", "routing_key").agg(F.count(F.lit(1)).alias("__n"))
    names = ["queue", "exchange", "exchange_type", "routing_key"]
    matched = _matched(key_counts, bindings).groupBy(*names).agg(F.sum("__n").alias("__m"))
    out = join_on(bindings.select(*names), matched, names, how="left")
    return out.select(*names, F.coalesce("__m", F.lit(0)).cast("long").alias("n_matched"))


__all__ = [
    "binding_traffic",
    "resolve_routes",
    "route",
    "topology_bindings",
    "unroutable",
]
