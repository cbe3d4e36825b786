"""Product codes against an exhaustive search in plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from lendsight.llm import catalog, vector_codes


def _plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error) of every kept row and the final entries, every part against every entry."""
    kept = [(k, v) for k, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v in kept), default=0) // parts) * parts
    kept = [(k, [math.floor(256 * x) for x in v] + [0] * (width - len(v)), v) for k, v in kept]
    step = width // parts
    cut = lambda v: [tuple(v[i * step:(i + 1) * step]) for i in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((gap(x, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for _, v, _ in kept:
                x = cut(v)[p]
                mine.setdefault(near(x, books[p])[1], []).append(x)
            for i, xs in mine.items():
                books[p][i] = tuple(sum(c) // len(xs) for c in zip(*xs))
    coded = []
    for k, v, _ in kept:
        found = [near(x, books[p]) for p, x in enumerate(cut(v))]
        coded.append((k, "".join(f"{i:02x}" for _, i in found), sum(g for g, _ in found)))
    return coded, books


def _table(spark, rows):
    return spark.createDataFrame(
        [(k, v, lab, "x", 1) for k, v, lab in rows], "vec_id long, embedding array<float>, label int, code string, slot int"
    ).repartition(3)


def _found(df):
    books = vector_codes.train(df, "vec_id", "embedding")
    coded = vector_codes.with_label_error(vector_codes.encode(df, "embedding", books), "label")
    return coded, books


def test_codes_like_an_exhaustive_search(spark):
    random.seed(3)
    # Few different values: ties and equal entries everywhere.
    rows = [(i, [random.choice([0.0, 0.25, -0.25, 0.5, 1 / 3]) for _ in range(32)], random.choice([1, 2, None])) for i in range(300)]
    rows += [rows[7], rows[7], (None, [0.1] * 32, 5), (400, None, 1), (401, [None] + [0.0] * 31, 1), (402, [math.nan] * 32, 1)]
    rows += [(403, [math.inf] + [0.0] * 31, None), (404, [0.5] * 20, 2), (405, [], 2)]
    rows = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for k, v, lab in rows]
    coded, books = _found(_table(spark, rows))
    expected, plain = _plain([(k, v) for k, v, _ in rows])
    assert books.tolist() == [[list(e) for e in book] for book in plain]
    got = coded.collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r.vec_id, r.code, r.error) for r in got), key=key) == sorted(expected, key=key)
    sums = {}
    for r in got:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == sums[r.label] for r in got) and None in sums
    assert coded.columns == ["vec_id", "label", "slot", "code", "error", "label_error"]


def test_search_reads_less_than_the_book():
    random.seed(4)
    books = np.array([[[random.randint(-500, 500), random.randint(-500, 500)] for _ in range(64)]])
    points = np.array([[random.choice(books[0].tolist())] for _ in range(500)]) + 1
    search = vector_codes.Orchard(books)
    entry, gap = search.search(points)
    every = ((points[:, 0, None, :] - books[0][None]) ** 2).sum(axis=2)
    assert (entry[:, 0] == every.argmin(axis=1)).all() and (gap[:, 0] == every.min(axis=1)).all()


def test_nothing_and_one(spark):
    empty = _table(spark, [(1, None, 1)])
    coded, books = _found(empty)
    assert coded.count() == 0 and vector_codes.books_digest(books) == hashlib.sha256(b"").hexdigest()
    coded, _ = _found(_table(spark, [(1, [], 1), (2, [], 1)]))
    assert {(r.code, r.error, r.label_error) for r in coded.collect()} == {("00" * 16, 0, 0)}
    coded, _ = _found(_table(spark, [(1, [0.5] * 16, None)]))
    assert [(r.code, r.error, r.label_error) for r in coded.collect()] == [("00" * 16, 0, 0)]


def test_very_large_components_saturate(spark):
    coded, _ = _found(_table(spark, [(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1), (3, [0.0] * 16, 1)]))
    assert {r.error for r in coded.collect()} == {0}


def test_codes_are_decoded(spark):
    df = _table(spark, [(i, [i / 8, 0.0] * 16, 0) for i in range(5)])
    books = vector_codes.train(df, "vec_id", "embedding")
    coded = vector_codes.encode(df, "embedding", books)
    rows = coded.select("vec_id", vector_codes.decode(coded["code"], books).alias("v")).collect()
    assert {r.vec_id: r.v for r in rows} == {i: [32 * i, 0] * 16 for i in range(5)}


def test_query_like_an_exhaustive_search(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    expected, books = _plain([(r.vec_id, r.embedding) for r in table])
    rows = catalog.QUERIES["op12_vector_codes"](spark, data).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in rows) == sorted(expected)
    text = ",".join(str(c) for book in books for e in book for c in e)
    assert {r.codebooks_sha256 for r in rows} == {hashlib.sha256(text.encode()).hexdigest()}


@pytest.mark.parametrize("parts,length", [(4, 1), (2, 3)])
def test_ties_go_to_the_lower_index(parts, length):
    rng = np.random.default_rng(5)
    books, points = rng.integers(-3, 4, (parts, 40, length)), rng.integers(-4, 5, (200, parts, length))
    entry, gap = vector_codes.Orchard(books).search(points)
    every = ((points[:, :, None, :] - books[None]) ** 2).sum(axis=3)
    assert (entry == every.argmin(axis=2)).all() and (gap == every.min(axis=2)).all()
