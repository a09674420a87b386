"""Operators without a SQL form against plain versions and the libraries they must equal."""

import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from creditloom.llm import mixing, tokens
from creditloom.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.llm import reference
from tests.parity import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_registered():
    assert set(LLM_QUERIES) <= set(queries()) and set(LLM_ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_oracle(spark, name):
    assert differences(LLM_QUERIES[name](spark, SF_DIR), connect(SF_DIR), LLM_ORACLES[name]) == []


def test_simhash(spark, documents):
    rows = LLM_QUERIES["op2_simhash"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == reference.simhash_components(documents)


def test_token_counts(spark, documents, tokenizer):
    rows = LLM_QUERIES["op3_token_counts"](spark, SF_DIR).collect()
    expected = {}
    for i, text in documents.items():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected[i] = (len((text or "").encode()), n, n > 2048)
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == expected


def test_bpe(spark, documents, tokenizer):
    rows = LLM_QUERIES["op8_bpe"](spark, SF_DIR).collect()
    expected = {}
    for i, text in documents.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        expected[i] = (len(ids), reference.sha(" ".join(map(str, ids))), reference.sha(decoded))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == expected


def test_frequent_long_pretokens_are_joined_not_broadcast(spark, tokenizer):
    long = "verylongword" * 40
    rows = [(i, f"{long} and {'some words ' * (i % 7)} {long}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    head = tokens.head_words(docs, path, tokens.SAMPLE_DOCS, tokens.HEAD_WORDS)
    assert head and all(len(word.encode()) <= tokens.HEAD_BYTES for word in head)
    expected = {i: len(tokenizer.encode(text, add_special_tokens=False).ids) for i, text in rows}
    assert {r.doc_id: r.n_tokens for r in tokens.token_counts(docs, path).collect()} == expected


def test_language(spark):
    """The query and the pipeline's stage; the table is small enough for the model to keep every piece."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    held_out = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows}
    learned = [(r.text, r.lang) for r in rows if not held_out[r.doc_id] and r.text is not None and r.lang is not None]
    model = reference.Languages(learned)
    expected = {r.doc_id: model.judge(r.text) for r in rows}
    found = {r.doc_id: r for r in LLM_QUERIES["op9_language"](spark, SF_DIR).collect()}
    assert len(found) == len(rows)
    for i, (lang, score) in expected.items():
        assert (found[i].held_out, found[i].lang_pred) == (held_out[i], lang)
        assert found[i].score == pytest.approx(score, abs=1e-9)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, SF_DIR).collect()}
    assert kept == {i for i, (lang, score) in expected.items() if lang != "und" and score > 1 / len(model.names) + 1e-9}


def test_pipeline_mix_equals_sql(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    taken = connect(SF_DIR).execute(f"SELECT doc_id, copies FROM ({mixing.sql(corpus_pipeline.MIX)})").fetchall()
    expected = sorted(i for i, copies in taken for _ in range(copies))
    assert sorted(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, SF_DIR).collect()) == expected
