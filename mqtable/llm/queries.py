"""The registered queries of the subpackage, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mqtable.llm import decontam, gam, hilbert, linededup, minhash, mixing, runs, secrets, sharding, simhash, spelling, tokenbin, warc
from mqtable.llm.oracle import oracle
from mqtable.session import workers_import_package

#: Byte limit of a shard.
SHARD_BYTES = 4 << 20
#: Share of all tokens that a mixture takes, and the power that flattens its marginals.
MIX_KEEP, MIX_POWER = 0.8, 0.8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder, captures = warc.write_archive(pages)
    index = warc.build_index(captures, folder)
    places = warc.lookup(warc.requests_of(pages), folder, index)
    return warc.read_records(places, folder).drop("payload")


def op2_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.drop_common_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), keep=MIX_KEEP, power=MIX_POWER)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = tokenbin.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_rows(manifest)


def token_rows(manifest: DataFrame) -> DataFrame:
    return tokenbin.read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARD_BYTES)
    return placed.select("doc_id", "n_bytes", "depth", "shard")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=85)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.detect_runs(table(spark, sf_dir, "documents"), plant=True)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_hilbert_neighbours": op2_hilbert_neighbours,
    "op3_simhash": op3_simhash,
    "op4_secrets": op4_secrets,
    "op5_line_dedup": op5_line_dedup,
    "op6_mixing": op6_mixing,
    "op7_token_files": op7_token_files,
    "op8_decontamination": op8_decontamination,
    "op9_quality": op9_quality,
    "op10_sharding": op10_sharding,
    "op11_minhash": op11_minhash,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE = oracle(SHARD_BYTES)
