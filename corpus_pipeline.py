"""From raw documents to token ids: five stages, each a whole-table Spark job."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketspark.llm import bpe, decontaminate, pii, simhash, toxicity
from marketspark.llm.common import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is predicted toxic go. The field learns from the labels of the documents at hand."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.without_toxic(docs, labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the row with the least doc_id stays."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds ten consecutive words of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; personal data in its text is replaced by the kind, and n_chars is counted anew."""
    return pii.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every row; the ids are decoded and compared with the text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.tokenize(docs, path, public_tokenizers.PATTERN, "doc_id", "lang", "source")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("byte-level BPE", encode),
]

ORACLE_SQL: str | None = None  # fields, fingerprints and merges have no SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
