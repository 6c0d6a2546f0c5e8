"""From documents to token ids: good documents, one of each group of near copies, no benchmark items, no personal data."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.bpe import bpe_encode, load_ranks
from marquee.llm.common import importable, scratch, table
from marquee.llm.decontaminate import without_leaks
from marquee.llm.jaccard import first_of_each_class
from marquee.llm.pii import redact
from marquee.llm.quality import keep_good

RANKS = "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own rules and their source's verdict keep."""
    importable(spark)
    return keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the least id, of each class linked by five-word shingles at 0.8 or more."""
    importable(spark)
    return first_of_each_class(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, also with other names, numbers or units."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by its kind; ``n_chars`` follows the text."""
    importable(spark)
    masked = redact(docs)
    chars = F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", chars).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the hash of the bytes that they decode to."""
    importable(spark)
    ranks, pattern = load_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN
    both = bpe_encode(docs.select("doc_id", "lang", "source", "text"), ranks, pattern, bytes_col="bytes")
    return both.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# SQL can't say the byte-pair merges or the bootstrap; tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
