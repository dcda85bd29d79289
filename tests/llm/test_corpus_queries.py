"""The registered corpus queries: those with SQL against it, the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter

import oracle
import pytest
import sentencepiece

import __spark_entry__ as entry_points
import corpus_pipeline
from moodtide.llm import mixing, pieces, pii, rules, simhash
from moodtide.llm.common import table
from moodtide.llm.queries import QUERIES, SQL, piece_model


def test_every_corpus_query_is_registered():
    named = entry_points.queries()
    assert all(name in named for name in QUERIES) and named["pipeline"] is corpus_pipeline.run
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    rows = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    assert rows and rows == oracle.duckdb_rows(oracle.connect(sf_dir), SQL[name])


def test_pipeline_stage_by_stage(spark, documents, sf_dir):
    docs = documents
    kept = {row.doc_id for row in rules.quality_verdicts(docs).filter("kept").collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_dedup", "personal_data", "source_mix", "sentencepiece"]
    stage = dict(corpus_pipeline.STAGES)

    docs = stage["quality_rules"](spark, docs, sf_dir).cache()
    assert {row.doc_id for row in docs.collect()} == kept and docs.columns == documents.columns
    named = {row.component_id for row in simhash.near_duplicates(docs).collect()}
    docs = stage["simhash_dedup"](spark, docs, sf_dir).cache()
    assert {row.doc_id for row in docs.collect()} == named and docs.columns == documents.columns
    before, found = docs, {row.doc_id: row for row in pii.personal_data(docs).collect()}
    docs = stage["personal_data"](spark, docs, sf_dir).cache()
    assert docs.columns == documents.columns and docs.count() == before.count()
    texts = {row.doc_id: row.text for row in before.collect()}
    for row in docs.collect():
        assert (row.text == texts[row.doc_id]) == (found[row.doc_id].spans == "") and row.n_chars == len(row.text)
    mix = mixing.mixed(docs)
    docs = stage["source_mix"](spark, docs, sf_dir).cache()
    assert docs.columns == documents.columns and Counter(map(tuple, docs.collect())) == Counter(map(tuple, mix.collect()))
    result = stage["sentencepiece"](spark, docs, sf_dir).collect()
    assert all(row.round_trip for row in result) and len(result) == docs.count()
    vocabulary = pieces.Encoder(pieces.Vocabulary.load(piece_model()))
    sizes = {row.doc_id: len(vocabulary.encode([row.text])[0]) for row in docs.collect()}
    assert all(row.n_pieces == sizes[row.doc_id] for row in result)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert Counter(map(str, whole.collect())) == Counter(map(str, result))


def test_ids_of_all_documents_equal_the_library(spark):
    sf_dir = "/root/testdata/sf0.01"
    model = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    texts = {row.doc_id: row.text or "" for row in table(spark, sf_dir, "documents").collect()}
    got = QUERIES["op8_sentencepiece"](spark, sf_dir).collect()
    assert len(got) == len(texts) and all(row.ids == model.encode(texts[row.doc_id]) for row in got)
    assert all(row.n_pieces == len(row.ids) and row.round_trip for row in got)


def test_pipeline_of_nothing(spark, none, sf_dir):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []
