"""Shards and token files against plain Python."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendsight.llm import catalog, sharding, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _items(docs):
    return docs.select("doc_id", "shard", sharding.byte_size(F.col("text")).alias("size"))


def test_shards_are_contiguous_balanced_and_gapless(documents):
    rows = sharding.balanced_shards(_items(documents), ["doc_id"], "size", 4).collect()
    assert len(rows) == documents.count()
    rows.sort(key=lambda r: r.start)
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)
    before = 0
    for r in rows:
        assert r.start == before
        before += r.size
    assert [r.doc_id for r in rows if r.doc_id is not None] == sorted(r.doc_id for r in rows if r.doc_id is not None)
    largest = max(r.size for r in rows)
    for shard in range(4):
        own = [r for r in rows if r.shard == shard]
        assert [r.slot for r in own] == list(range(len(own)))
        assert sum(r.size for r in own) <= before / 4 + largest
        assert all(int(4 * (r.start + r.size / 2) / before) == shard for r in own)


def test_no_items_no_shards(nothing):
    assert sharding.balanced_shards(_items(nothing), ["doc_id"], "size", 8).count() == 0


def test_equal_keys_are_dealt_over_shards(spark):
    same = spark.range(1000).select(F.lit(7).alias("doc_id"), F.lit(10).cast("long").alias("size"))
    counts = sharding.balanced_shards(same, ["doc_id"], "size", 8).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in counts) == [125] * 8


def test_query_covers_documents(spark, data):
    rows = catalog.QUERIES["op6_balanced_shards"](spark, data).collect()
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(given)
    assert all(r.size == len(given[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(given[r.doc_id].encode()) for r in rows)
    by = np.bincount([r.shard for r in rows], [r.size for r in rows])
    assert len(by) == 8 and by.max() - by.min() <= 2 * max(r.size for r in rows)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_added_tokens_in_a_text_like_the_plain_call(spark, tokenizer):
    texts = ["end<|endoftext|> next", "<|endoftext|>", "a <|endoftext|>b c", "plain <|endoftext words", "two  spaces <|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = token_files.read_token_files(token_files.write_token_files(docs, "doc_id", "text", PATH, 2)).collect()
    expected = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    assert 50256 in expected[0]
    assert {r.key: (r.n_tokens, r.ids_crc32) for r in rows} == {
        i: (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for i, ids in expected.items()
    }


def test_files_hold_the_ids_in_order(documents, tokenizer):
    files = token_files.write_token_files(documents, "doc_id", "text", PATH, 2, length=64)
    found = []
    for row in sorted(files.collect(), key=lambda r: r.slice):
        found += [(k, ids.tolist()) for k, _, ids in token_files.document_ids(row.file)]
    expected = [(r.doc_id, [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in documents.collect()]
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert [k is not None for k, _ in found] == sorted(k is not None for k, _ in found)
    read = {(r.key, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(files).collect()}
    assert read == {(k, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for k, ids in expected}


def test_starts_add_up(documents):
    rows = token_files.read_token_files(token_files.write_token_files(documents, "doc_id", "text", PATH, 2)).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]


def test_batches_are_mapped_sequences(documents):
    file = token_files.write_token_files(documents, "doc_id", "text", PATH, 2, length=32).first().file
    reader = token_files.open_file(f"{file}.arrow")
    assert reader.schema.field("tokens").type == pa.list_(pa.uint16(), 32)
    batch = reader.get_batch(0)
    assert batch.column("tokens")[0].as_py() == batch.column("tokens").flatten().to_pylist()[:32]
    last = reader.get_batch(reader.num_record_batches - 1).column("mask").flatten().to_pylist()
    assert last == sorted(last, reverse=True)


def test_no_documents_no_files(nothing):
    files = token_files.write_token_files(nothing, "doc_id", "text", PATH, 2)
    assert files.count() == 0 and token_files.read_token_files(files).count() == 0
