"""Groups, links and classes against all pairs compared plainly."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendsight.llm import catalog, embedding_dedup, graph, jaccard_join


def _classes(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        one, two = sorted((find(a), find(b)))
        root[two] = one
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 1), (1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)]])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.id: r.component for r in graph.connected_components(frame).collect()}
    ids = {i for a, b in edges for i in (a, b) if a != b}
    assert found == {i: c for i, c in _classes(ids | {i for e in edges for i in e}, edges).items() if i in ids}


def test_random_components(spark):
    random.seed(2)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)]
    found = {r.id: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = _classes(range(300), edges)
    assert all(expected[i] == c for i, c in found.items())


def _sets(text):
    words = (text or "").lower().encode().split()
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _plain_join(rows):
    sets = [(k, _sets(t)) for k, t in rows]
    links = [
        (i, j) for i in range(len(sets)) for j in range(i) if sets[i][1] and sets[j][1] and sets[i][0] is not None
        and sets[j][0] is not None and len(sets[i][1] & sets[j][1]) / len(sets[i][1] | sets[j][1]) >= 0.8
    ]
    return sets, links


def _expected(rows):
    sets, links = _plain_join(rows)
    classes = _classes(range(len(rows)), links)
    least = {}
    for i, c in classes.items():
        if sets[i][0] is not None:
            least[c] = min(least.get(c, sets[i][0]), sets[i][0])
    degree = np.bincount([i for link in links for i in link], minlength=len(rows))
    return sorted((str(sets[i][0]), str(least.get(classes[i]) if sets[i][0] is not None else None), int(degree[i])) for i in range(len(rows)))


def _found(frame):
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in frame.collect())


def test_join_like_all_pairs(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert _found(jaccard_join.similar_documents(documents)) == _expected(rows)


def test_join_of_a_large_group_in_chunks(spark, monkeypatch):
    random.seed(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(random.randrange(3)):
            own[random.randrange(60)] = f"x{random.randrange(5)}"
        rows.append((i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = _expected(rows)
    assert _found(jaccard_join.similar_documents(frame)) == expected
    monkeypatch.setattr(graph, "CHUNK_ROWS", 16)
    monkeypatch.setattr(graph.linked_members, "__defaults__", (16, 1 << 20))
    assert _found(jaccard_join.similar_documents(frame)) == expected


def test_rows_of_one_key_and_empty_tables(spark, nothing):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "quite other words stand in here"), (2, "A b c  d e f"), (3, None)]
    found = {(r.doc_id, r.class_id, r.n_links) for r in jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(1, 1, 2), (1, 1, 0), (2, 1, 2), (3, 3, 0)}
    assert jaccard_join.similar_documents(nothing).count() == 0


def test_one_of_each(documents):
    kept = jaccard_join.one_of_each(documents)
    assert kept.columns == documents.columns
    found = jaccard_join.similar_documents(documents).collect()
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if r.doc_id == r.class_id} | {None}


def test_rows_and_not_keys_are_dropped(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(1, one, "x"), (5, one, "x"), (5, two, "x"), (7, three, "x"), (7, three, "x"), (7, three, "y"), (None, one, "x"), (9, "", "x"), (9, "", "x")]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "doc_id long, text string, lang string, _repeated int, _digest int, _key int, key int")
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(1, one), (5, two), (7, three), (None, one), (9, ""), (9, "")], key=str)
    assert {(r._repeated, r._digest, r._key, r.key) for r in kept.collect()} == {(1, 2, 3, 4)}


def test_depth_shortens_until_the_recall_is_met():
    assert jaccard_join.depth_for(0.998, 0.8) == 5 and jaccard_join.depth_for(0.99, 0.8) == 6
    assert jaccard_join.depth_for(0.999999, 0.5) == 1 or 1 - 0.5**20 >= 0.999999


def test_join_query_like_all_pairs(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    by_shingle = {}
    sets = {r.doc_id: _sets(r.text) for r in docs}
    for k, own in sets.items():
        for s in own:
            by_shingle.setdefault(s, []).append(k)
    pairs = {(a, b) for ks in by_shingle.values() for a in ks for b in ks if a < b}
    links = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    classes = _classes(sets, links)
    degree = dict.fromkeys(sets, 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    found = {r.doc_id: (r.class_id, r.n_links) for r in catalog.QUERIES["op10_jaccard_join"](spark, data).collect()}
    assert found == {k: (classes[k], degree[k]) for k in sets}


def _vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, kept string")


def _cosine_links(rows):
    known = [
        (k, np.array(v, dtype=np.float64)) for k, v in rows
        if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    return known, [
        (i, j) for i in range(len(known)) for j in range(i) if len(known[i][1]) == len(known[j][1])
        and known[i][1] @ known[j][1] / (np.linalg.norm(known[i][1]) * np.linalg.norm(known[j][1])) >= 0.9
    ]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_like_all_pairs(spark, kind):
    rng = np.random.default_rng(4)
    rows = []
    for group in range(12):
        centre = rng.standard_normal(24)
        for _ in range([1, 2, 3, 40][group % 4]):
            rows.append((centre + 0.15 * rng.standard_normal(24)).astype(np.float32).tolist())
    rows += [rows[0], rows[0], [2 * x for x in rows[0]], None, [], [0.0] * 24, [None] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0, 2.0], [1.0, 2.0]]
    rows = list(enumerate(rows)) + [(None, rows[0])]
    frame = _vectors(spark, [(k, v, 1, "x") for k, v in rows], kind)
    known, links = _cosine_links(rows)
    classes = _classes(range(len(known)), links)
    degree = np.bincount([i for link in links for i in link], minlength=len(known))
    expected = {known[i][0]: (int(degree[i]), min(known[j][0] for j in classes if classes[j] == classes[i])) for i in classes}
    found = embedding_dedup.near_duplicate_vectors(frame).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id) == expected.get(r.vec_id, (0, r.vec_id)) and r.kept == (r.vec_id == r.component_id)


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicate_vectors(_vectors(spark, [])).count() == 0


def test_vector_query_over_the_table(spark, data):
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()}
    known, links = _cosine_links(list(given.items()))
    degree = dict.fromkeys(given, 0)
    for i, j in links:
        degree[known[i][0]] += 1
        degree[known[j][0]] += 1
    rows = catalog.QUERIES["op1_near_duplicate_vectors"](spark, data).collect()
    assert {r.vec_id: r.n_links for r in rows} == degree


def test_recall_of_the_passes_at_the_threshold():
    rng = np.random.default_rng(9)
    n, dim = 3000, 64
    one = rng.standard_normal((n, dim))
    one /= np.linalg.norm(one, axis=1)[:, None]
    off = rng.standard_normal((n, dim))
    off -= (off * one).sum(axis=1)[:, None] * one
    off /= np.linalg.norm(off, axis=1)[:, None]
    two = 0.9 * one + (1 - 0.81) ** 0.5 * off
    keys = embedding_dedup.projection_keys(np.concatenate([one, two]), embedding_dedup.PASSES, embedding_dedup.BITS)
    met = np.zeros(n, dtype=bool)
    for p in range(embedding_dedup.PASSES):
        place = np.empty(2 * n, dtype=int)
        place[np.argsort(keys[:, p], kind="stable")] = np.arange(2 * n)
        met |= np.abs(place[:n] - place[n:]) <= embedding_dedup.WINDOW
    assert met.mean() >= 0.99


def test_pairs_in_a_dense_cone_are_found(spark):
    rng = np.random.default_rng(8)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    centre, own = unit(rng.standard_normal((1, 128))), rng.standard_normal((2000, 128))
    own = unit(own - (own @ centre.T) * centre)
    cone = 0.8**0.5 * centre + 0.2**0.5 * own
    other = rng.standard_normal((400, 128))
    other -= (other @ centre.T) * centre + (other * own[:400]).sum(axis=1, keepdims=True) * own[:400]
    pairs = 0.8**0.5 * centre + 0.2**0.5 * (0.525 * own[:400] + (1 - 0.525**2) ** 0.5 * unit(other))
    rows = [*cone, *pairs, *unit(rng.standard_normal((4000, 128)))]
    frame = _vectors(spark, [(i, [float(x) for x in v], 0, "") for i, v in enumerate(rows)])
    found = {r.vec_id: r.component_id for r in embedding_dedup.near_duplicate_vectors(frame).select("vec_id", "component_id").collect()}
    assert np.mean([found[i] == found[2000 + i] for i in range(400)]) >= 0.99


def test_more_rows_to_a_window_ask_for_more_passes():
    misses = [np.exp(embedding_dedup.log_misses([(p, shared, 100) for p in range(32)], 0.9))[:10].mean() for shared in (10, 14, 18)]
    assert misses == sorted(misses) and misses[0] < 0.01 < misses[1]
