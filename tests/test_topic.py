import itertools
import re

from mqtable.functions.topic import topic_regex, word_match

PATTERNS = ["#", "*", "a.#.b", "#.b", "a.#", "", "#.#", "a.*", "*.b.#", "a..b", "#.*", "*.#.*", "a.b", "#.#.a",
            "*.*", "a.#.#.b", "events.click.*", "#.u1", "*.error.#"]
KEYS = ["", "a", "a.b", "a.x.b", "a.x.y.b", "b", "x.b", "a..b", ".", "a.b.c", "x.y", "c",
        "events.click.u1", "events.error.u0", "error", "x.error"]


def _py_match(pattern, key):
    norm = "" if key == "" else "." + key
    return re.search(topic_regex(pattern), norm) is not None


def test_regex_equals_word_semantics():
    for p, k in itertools.product(PATTERNS, KEYS):
        assert _py_match(p, k) == word_match(p, k), (p, k)


def test_corner_cases():
    assert word_match("#", "") and not word_match("*", "")
    assert word_match("", "") and not word_match("", "a")
    assert word_match("a.#.b", "a.b") and word_match("a.#.b", "a.x.y.b")
    assert word_match("a.*", "a.") and not word_match("a.*", "a")


def test_spark_rlike_agrees(spark):
    from pyspark.sql import functions as F

    from mqtable.functions.topic import topic_matches

    df = spark.createDataFrame([(k,) for k in KEYS], "k string")
    cols = [topic_matches(F.col("k"), p).alias(f"p{i}") for i, p in enumerate(PATTERNS)]
    rows = df.select("k", *cols).collect()
    for r in rows:
        for i, p in enumerate(PATTERNS):
            assert r[f"p{i}"] == word_match(p, r["k"]), (p, r["k"])


from hypothesis import given, settings
from hypothesis import strategies as st

WORDS = st.sampled_from(["a", "b", "c", "", "x.y"])
PATTERN_WORDS = st.sampled_from(["a", "b", "*", "#", ""])


@settings(max_examples=400, deadline=None)
@given(st.lists(PATTERN_WORDS, max_size=5), st.lists(WORDS, max_size=5))
def test_regex_equals_word_semantics_random(pattern_words, key_words):
    pattern = ".".join(pattern_words)
    key = ".".join(key_words)
    assert _py_match(pattern, key) == word_match(pattern, key), (pattern, key)
