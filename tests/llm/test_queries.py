"""Registered queries: their SQL, their columns, and the pipeline end to end."""

import re

import compare
import corpus_pipeline
import edges
import pytest

import __spark_entry__ as contract
from seatwise.llm import bpe, queries, simhash

COLUMNS = {
    "op1_html": ["page_id", "url", "text", "n_chars"],
    "op2_licenses": "doc_id n_words n_base first_word last_word base_labels labels score".split(),
    "op4_substrings": "doc_id n_words n_removed kept_sha256".split(),
    "op5_toxicity": "doc_id held_out score predicted passages".split(),
    "op6_simhash": "doc_id fingerprint component_id".split(),
    "op7_language": "doc_id held_out lang_pred score".split(),
    "op8_embeddings": "vec_id n_links component_id kept".split(),
    "op11_conversations": (
        "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256"
    ).split(),
    "op12_topk": "query_id rank vec_id score".split(),
    "op13_whitening": (
        "vec_id component n deviation whitened explained identity_error"
    ).split(),
    "op9_bpe": "doc_id n_tokens ids_sha256 decoded_sha256".split(),
}


def test_all_are_registered():
    names = set(contract.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {re.match(r"op\d+_", n)[0] for n in queries.QUERIES} == {f"op{n}_" for n in range(1, 14)}
    assert set(queries.ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, sf_dir, name):
    duck = compare.connect(sf_dir)
    got = compare.spark_rows(queries.QUERIES[name](spark, sf_dir))
    assert got and got == compare.sql_rows(duck, queries.ORACLE[name])


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").columns == COLUMNS[name]


def test_pipeline_against_its_stages_in_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    groups = {
        r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()
    }
    from test_decontaminate import leaks

    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    first = {i: t for i, t in texts.items() if groups[i] == i}
    leaked = {
        d for d, _ in leaks(first.items(), [(r["item_id"], r["text"]) for r in items.collect()])
    }
    encoder = bpe.Encoder(queries.tokenizer_path())
    expected = {}
    for i, text in first.items():
        if i not in leaked:
            clean = re.sub(r"\b[0-9a-fA-F]{40}\b", "[redacted]", text)
            ids, decoded = encoder.text(clean)
            expected[i] = (ids.count(" ") + 1, bpe.digest(ids), bpe.digest(decoded))
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == expected
    assert len(rows) == len(expected)


def test_stages_take_awkward_and_empty_tables(spark, sf_dir):
    for start in (edges.documents(spark), edges.empty(spark)):
        docs = start.selectExpr("* except (lang)", "if(doc_id % 2 = 0, 'en', 'de') AS lang")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, sf_dir)
            assert sorted(after.columns) == sorted(docs.columns)
            docs = after
        result = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert result.columns == COLUMNS["op9_bpe"]
        assert result.count() == docs.count()
