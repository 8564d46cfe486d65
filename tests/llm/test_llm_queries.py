"""The registered queries against DuckDB, and the pipeline against plain Python."""

import re

import pytest
import public_tokenizers
import sentencepiece
from llm_cases import empty_docs, hard_docs
from oracle_compare import compare, duck
from test_llm_operators import brute_overlaps, pairs, plain_components, plain_fingerprint, plain_quality, words_of

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from conftest import SF_SMALL
from gridwave.llm import pii
from gridwave.llm.oracle import SQL
from gridwave.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    assert compare(spark, name, SF_SMALL, duck(SF_SMALL), verbose=False)


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_pipeline_equals_plain_python(spark):
    """Every stage's decision, made again without Spark."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = pairs(spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    rows = {i: t for i, t in pairs(docs) if plain_quality(t)[-1]}
    ids = sorted(rows)
    roots = plain_components([plain_fingerprint(rows[i]) for i in ids])
    rows = {i: rows[i] for k, i in enumerate(ids) if roots[k] == k}
    # Only items that share a run of three words with a text can overlap with it.
    runs = {tuple(w[k:k + 3]) for _, t in items for w in [words_of(t)] for k in range(len(w) - 2)}
    suspects = [(i, t) for i, t in rows.items() for w in [words_of(t)]
                if sum(tuple(w[k:k + 3]) in runs for k in range(len(w) - 2)) >= 3]
    hit = {i for i, _ in brute_overlaps(suspects, items)} if len(suspects) <= 20 else None
    kept = corpus_pipeline.run(spark, SF_SMALL)
    got = {r.doc_id: r for r in kept.collect()}
    if hit is not None:
        assert set(got) == set(rows) - hit
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, r in got.items():
        assert r.round_trip and r.n_ids == len(r.ids)
        text = library.decode(list(r.ids))
        base = pii.base_spans(rows[i])
        if not base and text == rows[i]:
            continue
        assert "[" in text and not pii.base_spans(text)
        assert r.n_chars == len(text)


@pytest.mark.parametrize("make", [hard_docs, empty_docs])
def test_stages_on_hard_rows(spark, make):
    docs = make(spark)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert tuple(out.columns) == corpus_pipeline.COLUMNS, name
        out.collect()
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == (1 if make is hard_docs else 0) or make is hard_docs
