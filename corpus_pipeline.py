"""Documents to tokens: five stages, each one operator of ``seatwise.llm``.

Each stage works on the rows its predecessor wrote. What a stage decides is
done: rows it rejects are gone, what it rewrites is rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seatwise.llm import bpe, decontaminate, language, secrets, simhash
from seatwise.llm.common import stored, table
from seatwise.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised."""
    return language.keep_identified(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets replaced in their texts."""
    return secrets.redact(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.encode_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("bpe_encoding", bpe_encoding),
]

#: No stage can be told in SQL: four run trained models or a tokenizer, one XXH64.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
