"""The dealt operators as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seatwise.llm import (
    bpe,
    conversations,
    decontaminate,
    embeddings,
    html_text,
    impacts,
    language,
    licenses,
    secrets,
    simhash,
    substrings,
    toxicity,
    whitening,
)
from seatwise.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(table(spark, sf_dir, "conversations"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impacts.top_matches(table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_licenses": op2_licenses,
    "op3_secrets": op3_secrets,
    "op4_substrings": op4_substrings,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_language": op7_language,
    "op8_embeddings": op8_embeddings,
    "op9_bpe": op9_bpe,
    "op10_decontaminate": op10_decontaminate,
    "op11_conversations": op11_conversations,
    "op12_topk": op12_topk,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op2_licenses": licenses.oracle_sql(),
    "op4_substrings": substrings.oracle_sql(),
    "op8_embeddings": embeddings.oracle_sql(),
    "op11_conversations": conversations.oracle_sql(),
    "op12_topk": impacts.oracle_sql(),
}
