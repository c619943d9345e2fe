"""Topic-exchange binding patterns compiled to anchored regular expressions.

A routing key is a list of ``.``-separated words (the empty key has no
words).  In a binding pattern ``*`` stands for exactly one word and ``#``
for zero or more words.  The key is matched in a normalised form that puts
a ``.`` before every word (``""`` -> ``""``, ``"a.b"`` -> ``".a.b"``), so each
pattern word compiles to one independent piece:

    literal w -> \\.w      * -> \\.[^.]*      # -> (?:\\.[^.]*)*
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = r"\.[^.]*"


def _escape(word: str) -> str:
    # backslash before every non-word character is a literal in Java regex and RE2
    return "".join(ch if (ch.isalnum() or ch == "_") else "\\" + ch for ch in word)


def pattern_words(pattern: str) -> list[str]:
    words = pattern.split(".") if pattern != "" else []
    out: list[str] = []
    for w in words:
        if w == "#" and out and out[-1] == "#":
            continue  # "#.#" matches exactly what "#" matches
        out.append(w)
    return out


def topic_regex(pattern: str) -> str:
    """Anchored regex for ``pattern`` over the normalised key (see module doc)."""
    pieces = []
    for w in pattern_words(pattern):
        if w == "#":
            pieces.append(f"(?:{_WORD})*")
        elif w == "*":
            pieces.append(_WORD)
        else:
            pieces.append(r"\." + _escape(w))
    return "^" + "".join(pieces) + "$"


def key_word_list(key: Column) -> Column:
    """Words of a routing key or pattern; the empty key has none, null stays null."""
    return F.when(key == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(key, r"\.", -1))


def topic_regex_column(pattern: Column) -> Column:
    """``topic_regex`` of a column of patterns."""

    def piece(word: Column) -> Column:
        literal = F.concat(F.lit(r"\."), F.regexp_replace(word, r"([^\p{L}\p{N}_])", r"\\$1"))
        return F.when(word == "#", F.lit(f"(?:{_WORD})*")).when(word == "*", F.lit(_WORD)).otherwise(literal)

    # "#.#" matches exactly what "#" matches, and nested repeats would backtrack
    plain = F.regexp_replace(pattern, r"(^|\.)#(\.#)+(?=\.|$)", r"$1#")
    return F.concat(F.lit("^"), F.array_join(F.transform(key_word_list(plain), piece), ""), F.lit("$"))


def topic_key_words(key) -> Column:
    """Normalised routing key: a dot before each word; the empty key stays empty."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(key == F.lit(""), F.lit("")).otherwise(F.concat(F.lit("."), key))


def topic_matches(key, pattern: str) -> Column:
    return topic_key_words(key).rlike(topic_regex(pattern))


def word_match(pattern: str, key: str) -> bool:
    """Direct word-by-word definition (used by tests as the reference semantics)."""
    p = pattern_words(pattern)
    k = key.split(".") if key != "" else []

    def go(i: int, j: int) -> bool:
        if i == len(p):
            return j == len(k)
        if p[i] == "#":
            return any(go(i + 1, jj) for jj in range(j, len(k) + 1))
        if j == len(k):
            return False
        return (p[i] == "*" or p[i] == k[j]) and go(i + 1, j + 1)

    return go(0, 0)
