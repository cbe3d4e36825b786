"""Similarity join of texts on word shingles: MinHash LSH forest, then exact Jaccard."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lendsight.llm.graph import connected_components, linked_members
from lendsight.llm.words import Memo, free_name, words_of
from lendsight.session import materialise

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
#: MinHash values of a tree, the longest prefix.
DEPTH = 6
#: Least probability that a pair at the threshold shares a prefix in some tree.
RECALL = 0.998
MAX_WORDS = 300_000

_random = np.random.default_rng(7)
FACTORS = _random.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)
PLACES = _random.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_words = Memo(xxhash.xxh64_intdigest, MAX_WORDS)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word runs of a lower-cased text.

    A text of one to four words is one shingle, one without words has none.
    """
    words = words_of((text or "").lower().encode())
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter((_words[w] for w in words), dtype=np.uint64, count=len(words))
    span = min(SHINGLE, len(words))
    count = len(words) - span + 1
    mixed = np.full(count, span, dtype=np.uint64)
    for i in range(span):
        turned = (hashes[i: i + count] + PLACES[i]) * PLACES[i]
        mixed = (mixed ^ (turned >> np.uint64(29))) * PLACES[0] + turned
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed * PLACES[1])


def signature(hashes: np.ndarray) -> np.ndarray:
    """Least value of the shingles under each of the forest's hash functions."""
    least = np.full(len(FACTORS), (1 << 64) - 1, dtype=np.uint64)
    for at in range(0, len(hashes), 1024):
        part = hashes[at: at + 1024, None] * FACTORS + OFFSETS
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def depth_for(recall: float, threshold: float, trees: int = TREES, deepest: int = DEPTH) -> int:
    """Shortens the prefix from the deepest until a pair at the threshold is met with probability ``recall``."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def text_digest(text: Column) -> Column:
    return F.coalesce(F.md5(text.cast("binary")), F.lit(""))


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, digest of its shingles, n_shingles, the signature and text_md5; rows without shingles have a NULL digest."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingles(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signature(s) if len(s) else None for s in sets], pa.list_(pa.int32())),
                    part.column(2),
                ], ["key", "digest", "n_shingles", "signature", "text_md5"])

    kind = docs.schema[key].dataType.simpleString()
    read = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), text_digest(F.col(text)).alias("text_md5"))
    return read.mapInArrow(sign, f"key {kind}, digest binary, n_shingles long, signature array<int>, text_md5 string")


def _digest(hashes: np.ndarray) -> bytes | None:
    return blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def packed_shingles(text: Column) -> Column:
    """Shingle hashes of a text as binary, and their digest."""

    @F.arrow_udf("struct<payload:binary,digest:binary>")
    def pack(texts: pa.Array) -> pa.Array:
        sets = [shingles(t) for t in texts.to_pylist()]
        columns = [pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([_digest(s) for s in sets], pa.binary())]
        return pa.StructArray.from_arrays(columns, ["payload", "digest"])

    return pack.asNondeterministic()(text)


def jaccard_links(left: list[bytes], right: list[bytes], threshold: float = THRESHOLD) -> np.ndarray:
    """Which sets of the two lists have at least ``threshold`` of their union in common, counted by postings."""
    one = [np.frombuffer(x, dtype=np.uint64) for x in left]
    two = one if right is left else [np.frombuffer(x, dtype=np.uint64) for x in right]
    sizes = np.array([len(x) for x in two])
    owner = np.repeat(np.arange(len(two)), sizes)
    flat = np.concatenate(two)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    linked = np.zeros((len(one), len(two)), dtype=bool)
    for i, own in enumerate(one):
        first = np.searchsorted(flat, own, "left")
        count = np.searchsorted(flat, own, "right") - first
        total = int(count.sum())
        skipped = np.cumsum(count) - count
        postings = owner[np.arange(total) + np.repeat(first - skipped, count)]
        common = np.bincount(postings, minlength=len(two))
        linked[i] = common / (len(own) + sizes - common) >= threshold
    return linked


def _placed(docs: DataFrame, key: str, text: str, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and per digest its component, the component's least key and the number of links."""
    signed = materialise(signatures(docs, key, text), "signatures")
    known = signed.filter("digest is not null and key is not null")
    members = known.groupBy("digest").agg(
        F.min("key").alias("least"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
    )
    members = materialise(members.withColumn("id", F.monotonically_increasing_id()), "members")

    depth = depth_for(recall, threshold)
    prefixes = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda tree: F.xxhash64(tree, F.slice("signature", tree * DEPTH + 1, depth)),
    )
    nodes = members.select("id", F.explode(prefixes).alias("node"))
    shared = nodes.groupBy("node").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    edges = nodes.join(shared, "node").filter("id > first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    groups = connected_components(edges).withColumnRenamed("component", "group")

    candidates = materialise(groups.join(members.drop("signature"), "id"), "candidates")
    # The number of candidates has no bound, so they are never broadcast.
    named = candidates.select("id", F.col("least").alias(key), F.col("digest").alias("_digest")).hint("merge")
    texts = named.join(docs.select(key, text), key)
    packed = texts.withColumn("_packed", packed_shingles(F.col(text))).filter("_packed.digest = _digest")
    payload = packed.select("id", F.col("_packed.payload").alias("payload")).groupBy("id").agg(F.first("payload").alias("payload"))
    compared = linked_members(
        candidates.select("id", "group", "copies", (F.col("n_shingles") * 8).alias("bytes")), payload,
        lambda left, right: jaccard_links(left, right, threshold),
    )
    compared = materialise(compared, "compared")

    placed = members.select("id", "digest", "least", "copies").join(compared, "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    names = placed.groupBy("component").agg(F.min("least").alias("class_id"))
    placed = placed.join(names, "component").select(
        "digest", "component", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return signed, placed


def similar_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """One row per document: key, class_id (least key of its group), n_links.

    Two documents are linked if the Jaccard similarity of their shingles is at
    least ``threshold``; a group is what links connect; n_links counts the
    other documents linked directly, copies included.

    Documents with the same shingles become one member with a number of
    copies. In each tree of the forest the members are put in order of their
    signature, and those under one prefix are candidates. Candidates that hang
    together are compared exactly, all with all, a chunk of members at a time,
    so neither a common prefix nor a large group of near copies becomes pairs
    of rows or one task's load.

    A text without words is linked with nothing. Rows with a NULL key are
    linked with nothing and keep a NULL class. Rows of one key with different
    texts are different members. Other columns are not read.
    """
    signed, placed = _placed(docs, key, text, threshold, recall)
    found = signed.select("key", F.when(F.col("key").isNotNull(), F.col("digest")).alias("digest")).join(placed, "digest", "left")
    return found.select(
        F.col("key").alias(key), F.coalesce("class_id", "key").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, with the columns it came with; rows with a NULL key or without words all stay.

    It is the row with the least key, of several texts under that key the one
    with the least digest, and of rows equal in both any one. Rows are told
    apart by key and text together, so a key with two texts loses only the
    text that has a copy elsewhere.
    """
    signed, placed = _placed(docs, key, text, THRESHOLD, RECALL)
    grouped = signed.filter("digest is not null and key is not null").join(placed.select("digest", "component"), "digest")
    rows = grouped.groupBy("component", "key", "text_md5").agg(F.count("*").alias("n"))
    first = rows.groupBy("component").agg(F.min(F.struct("key", "text_md5")).alias("first"))
    rows = rows.join(first, "component").withColumn("stays", F.struct("key", "text_md5") == F.col("first"))
    rows = materialise(rows.select("key", "text_md5", "n", "stays"), "verdicts")

    its_key, its_text, digest = (free_name(docs.columns, n) for n in ("_key", "_text_md5", "_digest"))
    marked = docs.withColumn(digest, text_digest(F.col(text)))
    same = (F.col(key) == F.col(its_key)) & (F.col(digest) == F.col(its_text))

    def named(condition: str) -> DataFrame:
        return rows.filter(condition).select(F.col("key").alias(its_key), F.col("text_md5").alias(its_text))

    # Rows that go, and rows of which only one stays; the latter are few and taken one by one.
    single = marked.join(named("not stays or n > 1").hint("merge"), same, "left_anti")
    repeated = marked.join(named("stays and n > 1"), same, "left_semi").dropDuplicates([key, digest])
    return single.unionAll(repeated).select(*docs.columns)
