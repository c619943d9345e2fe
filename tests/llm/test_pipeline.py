"""The corpus pipeline: each stage takes effect on all that its predecessor kept."""

import zlib

import numpy as np
from conftest import SF001
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from mqtable.llm import gam
from mqtable.llm.common import materialize
from test_native import contamination
from test_python import brute_fingerprint, brute_links, groups, token_rows


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, kept = docs.columns, {"": {r.doc_id: r.text for r in docs.collect()}}
    at = docs
    for name, stage in pipeline.STAGES[:-1]:
        at = materialize(stage(spark, at, SF001), "stage")
        assert at.columns == columns
        kept[name] = {r.doc_id: r.text for r in at.collect()}
        assert at.count() == len(kept[name])
    every, good, unique, clean, mixed = kept.values()

    judged = {r.doc_id: r.predicted for r in gam.classify(docs, spark.read.parquet(f"{SF001}/labels.parquet")).collect()}
    assert set(good) == {i for i, p in judged.items() if p}

    ids = sorted(good)
    of = groups(brute_links([brute_fingerprint(good[i]) for i in ids], 4), range(len(ids)))
    assert set(unique) == {ids[root] for root in of.values()}

    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(clean) == {i for i, _, hit, _ in contamination(sorted(unique.items()), items, 10) if not hit}

    assert set(mixed) < set(clean)
    taken = sum(len(t.split()) for t in mixed.values()) / sum(len(t.split()) for t in clean.values())
    assert abs(taken - 0.8) < 0.1

    got = sorted(tuple(r) for r in pipeline.run(spark, SF001).collect())
    assert got == token_rows(sorted(mixed.items()))


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF001).columns == docs.columns
            assert stage(spark, docs, SF001).count() <= docs.count()
    tokens = pipeline.tokens(spark, odd_docs, SF001)
    assert tokens.count() == odd_docs.count()
    first = pipeline.near_duplicates(spark, odd_docs, SF001)
    assert first.where("doc_id = 1").count() == 1


def test_texts_that_share_an_id_are_judged_apart(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    schema = "doc_id long, text string, lang string, source string"

    def kept(stage, rows, onto=None):
        made = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], schema)
        got = stage(spark, made if onto is None else onto.select(*made.columns).unionByName(made), SF001)
        return sorted(((r.doc_id, r.text) for r in got.collect() if onto is None or r.doc_id in (None, -7)), key=repr)

    a, b, c, d = (" ".join(f"{w}{i * i % 97}" for i in range(60)) for w in ("ant", "bee", "cat", "dog"))
    rows = [(1, a), (2, a), (2, b), (None, a), (None, c), (None, c), (None, d)]
    assert kept(pipeline.near_duplicates, rows) == sorted([(1, a), (2, b), (None, c), (None, d)], key=repr)

    item = max((r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()), key=len)
    rows = [(i, t) for i in (None, 7) for t in (a, f"{b} {item}")]
    assert kept(pipeline.decontamination, rows) == [(7, a), (None, a)]

    judged = {r.doc_id: r.predicted for r in gam.classify(docs, spark.read.parquet(f"{SF001}/labels.parquet")).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    good, bad = (texts[next(i for i in sorted(judged) if judged[i] == p)] for p in (1, 0))
    rows = [(i, t) for i in (None, -7) for t in (good, bad)]
    assert kept(pipeline.quality, rows, docs) == sorted([(-7, good), (None, good)], key=repr)

    rows = [(None, f"{a} {i}") for i in range(200)]
    assert 120 < len(kept(pipeline.mixture, rows)) < 200
