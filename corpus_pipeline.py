"""A training-corpus pipeline over ``documents``: five stages, each written and read again.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the columns of ``docs``.
Rows are matched to a stage's decisions by id and text (a 128-bit hash of it), with a null id as a value
of its own, so every text is judged apart whatever id it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mqtable.llm import decontam, gam, mixing, simhash, tokenbin
from mqtable.llm.common import hash128, known_id, materialize
from mqtable.llm.queries import MIX_KEEP, MIX_POWER, table, token_rows


def _rows_of(docs: DataFrame, decided: DataFrame, keep: Column, labels: tuple = (), once: bool = False) -> DataFrame:
    """Rows of ``docs`` with a kept row of their id, text and ``labels`` in ``decided``; with ``once`` one row of each."""
    h1, h2 = hash128(F.col("text").cast("string"))
    own = {"__id": known_id(F.col("doc_id")), "__h1": h1, "__h2": h2}
    own |= {f"__{c}": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in labels}
    kept = decided.where(keep).select(
        known_id(F.col("doc_id")).alias("__id"), *[F.col(c).alias(f"__{c}") for c in ("h1", "h2", *labels)]
    )
    rows = docs.withColumns(own).join(kept.distinct().hint("merge"), list(own), "left_semi")
    # grouped by the key of the join, so the texts are not shuffled again
    return (rows.dropDuplicates(list(own)) if once else rows).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.7)."""
    judged = gam.classify(docs, table(spark, sf_dir, "labels"), threshold=0.7, hashes=True)
    return _rows_of(docs, judged, F.col("predicted") == 1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that with the smallest id, ids before null, then by its text's hash."""
    groups = simhash.near_duplicates(docs, shingle=4, max_bits=4, hashes=True)
    return _rows_of(docs, groups, F.col("chosen"), once=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), n=10, hashes=True)
    return _rows_of(docs, found, F.col("n_hit") == 0)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample raked to flattened source, language and topic shares."""
    mixed = mixing.mix(docs, keep=MIX_KEEP, power=MIX_POWER, hashes=True)
    return _rows_of(docs, mixed, F.col("selected"), labels=("source", "lang"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids as read back from the token files."""
    import public_tokenizers

    return token_rows(tokenbin.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mixture),
    ("token files", tokens),
]
#: No SQL can train the classifier or run the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
