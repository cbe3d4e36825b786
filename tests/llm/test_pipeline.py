"""The whole pipeline against its parts on small tables, and what it keeps."""

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from lendsight.llm import bpe, jaccard_join, quality


@pytest.fixture(scope="module")
def stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(corpus_pipeline.materialise(stage(spark, tables[-1], data), name))
    return tables


def test_stages_return_documents(stages):
    columns = stages[0].columns
    assert [t.columns for t in stages[:-1]] == [columns] * 5
    sizes = [t.count() for t in stages]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] > 0.4 * sizes[0]
    whole = {r.doc_id: r for r in stages[0].collect()}
    assert all(whole[r.doc_id] == r for t in stages[1:-1] for r in t.collect())


def test_rules_take_what_fails(stages):
    kept = {r.doc_id for r in stages[1].collect()}
    for r in stages[0].collect():
        n, _, _, _, repeated = quality.text_measures(r.text)
        assert (r.doc_id in kept) == (n >= 20 and 100 * repeated <= 30 * n)


def test_one_of_each_group_stays(stages):
    groups = {r.doc_id: r.class_id for r in jaccard_join.similar_documents(stages[2]).collect()}
    assert {r.doc_id for r in stages[3].collect()} == set(groups.values())


def test_ids_are_those_of_the_library(stages):
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    for r in stages[5].collect():
        ids = np.array(own.encode_ordinary(texts[r.doc_id]), dtype="<u4")
        assert bytes(r.ids) == ids.tobytes() and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_registered_whole(spark, data, stages):
    rows = __spark_entry__.queries()["pipeline"](spark, data)
    assert {r.doc_id for r in rows.collect()} == {r.doc_id for r in stages[-1].collect()}


def test_odd_documents_do_not_stop_a_stage(spark, documents, data):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, data), name)
    assert 0 < docs.count() < documents.count()
