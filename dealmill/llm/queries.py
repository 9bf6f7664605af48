"""Registered queries of the training-data operators; ``SQL`` holds the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealmill.llm import (
    bpe, collocations, fingerprints, mixing, near_dup, pieces, quality_model, quality_rules, ranked_search, repeats, secrets, toxicity, url_filter,
)
from dealmill.llm.common import table
from dealmill.llm.oracle import SQL

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"))


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    scored = toxicity.score(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(pieces.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES)))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_source_mix": op2_source_mix,
    "op3_fingerprints": op3_fingerprints,
    "op4_quality_rules": op4_quality_rules,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_quality_model": op6_quality_model,
    "op7_repeated_strings": op7_repeated_strings,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
    "op11_ranked_search": op11_ranked_search,
    "op12_collocations": op12_collocations,
    "op13_sentencepiece": op13_sentencepiece,
}
