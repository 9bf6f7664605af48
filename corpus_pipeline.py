"""Training-data pipeline over ``documents``: quality, near-duplicates, secrets, mix and tokens."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealmill.llm import mixing, near_dup, quality_model, secrets
from dealmill.llm.bpe import Tokenizer
from dealmill.llm.common import table, whole_text
from dealmill.llm.queries import TOKENIZER
from dealmill.session import checkpoint_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the stage's own input, accepts."""
    return quality_model.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the smallest id."""
    return near_dup.one_per_group(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials replaced by the name of their kind."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, as often as it does, in training order."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, n_tokens, ids): ids are little-endian unsigned 32-bit integers."""
    tokenizer = Tokenizer(spark, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)
    ids = docs.select("doc_id", "source", "lang", tokenizer.encode(whole_text()).alias("ids"))
    return ids.select("doc_id", "source", "lang", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", keep_good),
    ("near duplicates", deduplicate),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
    ("tokens", tokenize),
]

# Fingerprints, rank files and the trained classifier are not SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
