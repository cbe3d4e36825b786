"""The transducer against the library, the decoder against bytes cut anywhere."""

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lendsight.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


ENCODER = bpe.TextEncoder(bpe.read_ranks(PATH), P.PATTERN)
DECODER = bpe.TextDecoder(bpe.read_ranks(PATH))


def _ids(text):
    return np.frombuffer(ENCODER.encode(text), dtype="<u4").tolist()


def test_texts_like_the_library(texts, library):
    for text in texts:
        assert _ids(text or "") == library.encode_ordinary(text or "")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t é日😀'sS!#0. \x1c -", max_size=40) | st.text(max_size=30))
def test_any_text_like_the_library(text):
    ranks = bpe.read_ranks(PATH)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}) if not CACHE else CACHE[0]
    CACHE[:] = [own]
    assert _ids(text) == own.encode_ordinary(text)
    assert DECODER.decode(ENCODER.encode(text)) == text


CACHE: list = []


def test_a_small_cache_gives_the_same(texts, library):
    small = bpe.Transducer(bpe.read_ranks(PATH), max_steps=50)
    for piece in (texts[0] or "").split():
        assert small.encode(piece.encode()) == library.encode_ordinary(piece)


def test_tokens_that_merging_never_makes():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300}
    made = bpe.Transducer(ranks)
    assert made.encode(b"abc") == [300] and made.encode(b"abcd") == [97, 98, 99, 100] and made.encode(b"") == []


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=30), st.lists(st.integers(0, 30), max_size=4))
def test_utf8_stream_is_the_same_however_cut(data, cuts):
    stream, out, at = bpe.Utf8Stream(), "", 0
    for cut in sorted(c for c in cuts if c <= len(data)):
        out += stream.feed(data[at:cut])
        at = cut
    assert out + stream.feed(data[at:]) + stream.finish() == data.decode("utf-8", "replace")


def test_columns(documents, library):
    made = documents.withColumn("ids", bpe.encode_text(F.col("text"), PATH, P.PATTERN))
    rows = made.withColumn("back", bpe.decode_ids(F.col("ids"), PATH)).collect()
    both = documents.select("text", bpe.round_trip(F.col("text"), PATH, P.PATTERN).alias("m")).collect()
    assert len(rows) == documents.count() and all(r.back == (r.text or "") for r in rows)
    for r in both:
        ids = library.encode_ordinary(r.text or "")
        assert hashlib.sha256(bytes(r.m.ids)).hexdigest() == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.m.text == (r.text or "")


def test_no_rows(nothing):
    assert nothing.select(bpe.round_trip(F.col("text"), PATH, P.PATTERN)).count() == 0
