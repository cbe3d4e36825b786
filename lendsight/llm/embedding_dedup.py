"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import logging
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendsight.llm.graph import connected_components, linked_members
from lendsight.session import materialise

THRESHOLD = 0.9
#: Passes that are made at least; more follow until the expected recall of a pair at the threshold is RECALL, or MOST_PASSES with a warning.
PASSES = 32
RECALL = 0.99
MOST_PASSES = 512
#: Passes that are shuffled together.
TOGETHER = 8
BITS = 32
WINDOW = 32
SEED = 11


def hash_planes(dimension: int, passes: int, bits: int, seed: int = SEED) -> np.ndarray:
    """Normals of the hyperplanes whose sides are the hashes, the same in every task."""
    return np.random.default_rng([seed, dimension]).standard_normal((dimension, passes * bits))


def projection_keys(vectors: np.ndarray, passes: int, bits: int, seed: int = SEED) -> np.ndarray:
    """One number per vector and pass: the sides of its hyperplanes, concatenated."""
    sides = (vectors @ hash_planes(vectors.shape[1], passes, bits, seed) > 0).reshape(len(vectors), passes, bits)
    return sides @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


def _valid(vector, dtype: str) -> bytes | None:
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    values = np.array(vector, dtype=dtype) + 0.0
    wide = values.astype(np.float64)
    norm = wide @ wide
    return values.astype(dtype).tobytes() if np.isfinite(norm) and norm > 0 else None


def packed_vectors(vectors: DataFrame, key: str, embedding: str, dtype: str) -> DataFrame:
    """key, payload: the vector's bytes, NULL for one that is NULL, zero, or holds a NULL or non-finite component."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payload = pa.array([_valid(v, dtype) for v in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), payload], ["key", "payload"])

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.select(key, embedding).mapInArrow(pack, f"key {kind}, payload binary")


def cosine_links(left: list[bytes], right: list[bytes], dtype: str, threshold: float) -> np.ndarray:
    """Which vectors of the two lists have a cosine of at least ``threshold``; the lists hold one dimension."""
    one, two = (np.frombuffer(b"".join(x), dtype=dtype).reshape(len(x), -1).astype(np.float64) for x in (left, right))
    norms = np.sqrt((one * one).sum(axis=1))[:, None] * np.sqrt((two * two).sum(axis=1))
    return one @ two.T / norms >= threshold


def _with_keys(members: DataFrame, dtype: str, passes: int, bits: int, seed: int) -> DataFrame:
    """A row for each member and pass: id, payload, pass, sort_key."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payload = batch.column("payload").to_pylist()
            lengths = np.array([len(p) for p in payload])
            keys = np.empty((len(payload), passes), dtype=np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                vectors = np.frombuffer(b"".join([payload[i] for i in rows]), dtype=dtype).reshape(len(rows), -1)
                keys[rows] = projection_keys(vectors.astype(np.float64), passes, bits, seed)
            listed = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), passes).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], [*batch.schema.names, "keys"])

    keyed = members.select("id", "payload").mapInArrow(add, "id long, payload binary, keys array<long>")
    return keyed.select("id", "payload", F.posexplode("keys").alias("pass", "sort_key"))


def _window_edges(dtype: str, window: int, threshold: float, bits: int):
    """Verified pairs among ``window`` neighbours of a sorted partition, as edges to the first of each run of links.

    Besides, for each pass, how many rows (``n``) share how many leading bits
    with the row at the end of their window, if that is no link: neighbours
    that share more bits are inside the window.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("pass", "id", "payload", "sort_key")), strict=True))
            rows, fresh = held + rows, len(held)
            held = rows[-window:]
            if len(rows) > 1:
                yield edges(rows, fresh)

    def edges(rows: list[tuple], fresh: int) -> pa.RecordBatch:
        root = list(range(len(rows)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        shared: Counter = Counter()
        kinds = np.array([p * (1 << 32) + len(v) for p, _, v, _ in rows])
        for run in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(kinds)) + 1):
            vectors = np.frombuffer(b"".join([rows[i][2] for i in run]), dtype=dtype).reshape(len(run), -1).astype(np.float64)
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            for step in range(1, min(window, len(run) - 1) + 1):
                cosine = np.einsum("ij,ij->i", vectors[:-step], vectors[step:]) / (norms[:-step] * norms[step:])
                for i in np.flatnonzero(cosine >= threshold):
                    one, two = find(run[i]), find(run[i + step])
                    root[max(one, two)] = min(one, two)
                if step == window:
                    for i in np.flatnonzero((cosine < threshold) & (run[step:] >= fresh)):
                        apart = rows[run[i]][3] ^ rows[run[i + step]][3]
                        shared[rows[run[i]][0], bits - apart.bit_length()] += 1
        joined = [(rows[i][1], rows[find(i)][1]) for i in range(len(rows)) if find(i) != i]
        found = [(a, b, None, None, None) for a, b in joined] + [(None, None, *key, n) for key, n in shared.items()]
        names = ["a", "b", "pass", "shared", "n"]
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(5)], names)

    return compare


def log_misses(density: list[tuple[int, int, int]], threshold: float) -> np.ndarray:
    """Log of the chance that passes miss a pair at the threshold, for each hundredth of the rows, the densest first.

    ``density``: (pass, leading bits shared with the end of the window, rows).
    A pair whose sides agree on one bit more is inside the window. Rows that
    are dense in one pass are taken to be so in all, which errs to more passes.
    """
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    total = np.zeros(100)
    for own in {p for p, _, _ in density}:
        found = sorted(((shared, n) for p, shared, n in density if p == own), reverse=True)
        upto = np.cumsum([n for _, n in found])
        at = np.searchsorted(upto, (np.arange(100) + 0.5) / 100 * upto[-1])
        total += np.log1p(-np.minimum(agree ** (np.array([x for x, _ in found])[at] + 1.0), 1 - 1e-12))
    return total


def near_duplicate_vectors(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD,
    passes: int = PASSES, bits: int = BITS, window: int = WINDOW, together: int = TOGETHER,
    recall: float = RECALL, most_passes: int = MOST_PASSES,
) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Equal vectors are one member with a number of copies. Each pass sorts the
    members by the concatenated sides of ``bits`` random hyperplanes and
    compares every member with its ``window`` next neighbours; pairs with a
    cosine of at least ``threshold``, in double precision, are united over all
    passes. A bounded window cannot see all links of a dense group, so inside
    each group that the passes have found all members are compared exactly, a
    chunk at a time: links inside a group are complete whatever its size.
    What can be missed is a pair that no pass brings near. A pass brings a pair
    near with a chance of (1 - angle/pi)^b, where b leading bits must agree
    because that many are shared all over a window; b grows with the members
    and with their density and is observed in every pass. After ``passes``
    passes more are made until a pair at the threshold is found with a chance
    of ``recall`` in the densest tenth of the members. If ``most_passes`` do not
    reach it, a warning names the recall that is expected.

    Vectors that are NULL, empty, zero or hold a NULL or non-finite component
    link with nothing; vectors of different length never link. A NULL key has a
    NULL component and is kept. Labels and other columns are not read.
    """
    dtype = "<f8" if "double" in vectors.schema[embedding].dataType.simpleString() else "<f4"
    packed = materialise(packed_vectors(vectors, key, embedding, dtype), "vectors")
    members = packed.filter("payload is not null and key is not null").groupBy("payload").agg(
        F.min("key").cast("long").alias("least"), F.count("*").alias("copies")
    ).select(F.monotonically_increasing_id().alias("id"), "payload", "least", "copies")
    members = materialise(members, "members")

    edges = None
    rows = members.count()
    slices = max(members.sparkSession.sparkContext.defaultParallelism, rows * together // 100_000)
    missed, first = np.zeros(100), 0
    while first < passes or (np.exp(missed[:10]).mean() > 1 - recall and missed.any() and first < most_passes):
        spread = _with_keys(members, dtype, together, bits, SEED + first)
        ordered = spread.repartitionByRange(slices, "pass", "sort_key", "id").sortWithinPartitions("pass", "sort_key", "id")
        found = ordered.select("pass", "id", "payload", "sort_key").mapInArrow(
            _window_edges(dtype, window, threshold, bits), "a long, b long, pass long, shared long, n long"
        )
        found = materialise(found.groupBy("a", "b", "pass", "shared").agg(F.sum("n").alias("n")), "pairs")
        density = found.filter("a is null").select("pass", "shared", "n").collect()
        missed += log_misses([tuple(row) for row in density], threshold)
        found = found.filter("a is not null").select("a", "b")
        edges = found if edges is None else edges.union(found)
        first += together
    if missed.any() and (least := 1 - np.exp(missed[:10]).mean()) < recall:
        logging.getLogger(__name__).warning("%d passes: expected recall in the densest tenth %.4f, below %.4f", first, least, recall)
    groups = connected_components(edges).withColumnRenamed("component", "group")
    candidates = groups.join(members, "id").select(
        "id", "group", "copies", F.octet_length("payload").cast("long").alias("bytes")
    )
    compared = materialise(linked_members(
        candidates, members.select("id", "payload"), lambda left, right: cosine_links(left, right, dtype, threshold)
    ), "compared")

    placed = members.select("id", "payload", "least", "copies").join(compared, "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = placed.join(names, "component").select(
        "payload", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    known = F.when(F.col("key").isNotNull(), F.col("payload"))
    result = packed.withColumn("payload", known).join(placed, "payload", "left")
    component = F.coalesce("component_id", F.col("key").cast("long"))
    return result.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.col("key").cast("long").eqNullSafe(component).alias("kept"),
    )
