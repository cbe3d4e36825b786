"""Manifest and proofs against trees built in plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendsight.llm import catalog, merkle


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(values):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _climb(nodes):
    """Root, and for each node its steps: (nodes before, nodes after) in its run, level by level."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a // 16 * 16: a // 16 * 16 + 16]
            steps[i].append((run[: a % 16], run[a % 16 + 1:]))
        nodes = [_h("".join(nodes[i: i + 16])) for i in range(0, len(nodes), 16)]
        at = [a // 16 for a in at]
    return nodes[0], steps


def _plain(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        text = r[4]
        changed = text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        groups.setdefault(r[1], []).append((r[0], _leaf(r), _leaf((*r[:4], changed)) if tampered else _leaf(r)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for s in order}
    made = {s: _climb([x[1] for x in trees[s]]) for s in order}
    root, tops = _climb([made[s][0] for s in order])
    result = []
    for s, top in zip(order, tops):
        for (doc, leaf, claimed), steps in zip(trees[s], made[s][1]):
            folded, proof = claimed, []
            for before, after in [*steps, *top]:
                proof += [*before, *after]
                folded = _h("".join([*before, folded, *after]))
            result.append((doc, leaf, made[s][0], root, _h("".join(proof)), folded, folded == root))
    return result


def _found(docs):
    rows = merkle.documents_manifest(docs).collect()
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in rows]


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]))


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def test_odd_documents(documents):
    given = [tuple(r[c] for c in COLUMNS) for r in documents.collect()]
    assert _sorted(_found(documents)) == _sorted(_plain(given))


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 1, 1], [257, 1, 3], [300] + [1] * 40])
def test_trees_of_any_size(spark, sizes):
    rows = [(100 * i + n * 7, f"s{i:02d}" if i else None, "en", n, f"Text {n}") for i, size in enumerate(sizes) for n in range(size)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert _sorted(_found(docs)) == _sorted(_plain(rows))


def test_nothing(nothing):
    assert merkle.documents_manifest(nothing).count() == 0


def test_leaf_partitions_share_a_hot_tree(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEAVES", 37)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "en", i, f"T{i}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert _sorted(_found(docs)) == _sorted(_plain(rows))


def test_a_partition_fetches_no_node_it_can_derive():
    spots = {0: (1000, np.arange(100, 300)), 2: (5, np.array([3]))}
    own = {(t, s) for t, (_, held) in spots.items() for s in held.tolist()}
    for tree, level, known, members, runs in merkle._climb(spots, 40):
        below = {s for s in range(1000) if tree != merkle.TOP and (tree, s) in own} if tree >= 0 else {0, 2}
        assert set(known.tolist()) == {s // 16**level for s in below}
        assert {m // 16 for m in members.tolist()} == set(runs.tolist()) == {s // 16 ** (level + 1) for s in below}


def test_siblings_are_the_proof(spark):
    rows = [(i, "a" if i < 40 else "b", f"l{i}") for i in range(60)]
    leaves = spark.createDataFrame(rows, "id long, grp string, word string").select(
        "id", "grp", merkle.leaf_digest(F.col("word")).alias("leaf"), F.lit(None).cast("string").alias("claimed")
    )
    got = merkle.proofs(merkle.manifest(leaves, "grp", "id", "leaf"), "id", "leaf", "claimed", siblings=True).collect()
    assert all(r.verified and _h(r.siblings) == r.proof_sha256 for r in got)
    assert {len(r.siblings) // 64 for r in got if r.id < 32} == {15 + 2 + 1}


def test_query_like_plain_trees(spark, data):
    table = [tuple(r[c] for c in COLUMNS) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    rows = catalog.QUERIES["op13_merkle_manifest"](spark, data).collect()
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in rows]
    assert _sorted(got) == _sorted(_plain(table))
