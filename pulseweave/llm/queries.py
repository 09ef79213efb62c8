"""The registered queries of this subpackage: operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.llm import (conversations, decontamination, kd_shards, line_dedup, lm_scoring,
                            merkle, pseudonyms, quality, secrets, sentencepiece_backend, simhash,
                            substring_dedup, suffix_dedup)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SHARDS = 24
PSEUDONYM_KEY = "pulseweave-check"
#: The default model file; ``op10`` and the pipeline's last stage read it on the driver.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/benchmark.parquet")


@query
def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in every document."""
    return secrets.scan_secrets(spark, documents(spark, folder))


@query
def op2_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in one of 24 shards of near-equal bytes."""
    return kd_shards.shard(spark, documents(spark, folder), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with pseudonyms in place of validated numbers and dates."""
    docs = documents(spark, folder)
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY).select(
        "doc_id", "text", F.size("pii_kinds").cast("long").alias("n_values"), "pii_kinds")


@query
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words removed from every document, and a digest of the rest."""
    return substring_dedup.dedup_substrings(spark, documents(spark, folder)).drop("kept")


@query
def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Base and model score of every document."""
    return lm_scoring.score(documents(spark, folder))


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines removed from every document, and a digest of the rest."""
    return line_dedup.dedup_report(spark, documents(spark, folder))


@query
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in every document, and whether it is contaminated."""
    return decontamination.contamination(spark, documents(spark, folder),
                                         benchmark(spark, folder))


@query
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(spark, documents(spark, folder))


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.judge(documents(spark, folder)).drop("lost_chars")


def model_bytes(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@query
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, parity with sentencepiece, and the round trip."""
    return sentencepiece_backend.encode(documents(spark, folder), model_bytes())


@query
def op11_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes removed from every document, and a digest of the rest."""
    return suffix_dedup.dedup_bytes(spark, documents(spark, folder)).drop("kept")


@query
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots, siblings' digest and verification of every document."""
    return merkle.manifest(spark, documents(spark, folder))


@query
def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of every (damaged) conversation."""
    return conversations.repair(spark, spark.read.parquet(f"{folder}/conversations.parquet"))
