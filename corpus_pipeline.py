"""The corpus pipeline: documents in, SentencePiece ids of the clean ones out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arcloom.llm import decontaminate, exact_dedup, jaccard_join, language_id, sentencepiece_codec
from arcloom.storage import run_dir


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language, mixed ones too; the model learns from the rows that name theirs."""
    return language_id.keep_identified(docs, language_id.train(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more over five-word shingles."""
    return jaccard_join.keep_one(docs, k=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark windows cut out; documents that consist mostly of them go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.clean_documents(docs, items)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every remaining text."""
    return sentencepiece_codec.tokenize_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("sentencepiece", tokenize),
]

#: Language identification is learned, so no SQL gives these rows; from what it keeps on, tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read back for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = run_dir(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
