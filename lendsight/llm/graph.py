"""Connected components and exact links inside groups, without collecting a group."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendsight.session import materialise

#: Members compared in one task at a time; a larger group is cut into chunks and compared chunk by chunk.
CHUNK_ROWS = 2048
CHUNK_BYTES = 16 << 20


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (columns a, b, both long); the component is its least id.

    Alternating large and small stars: every round is a minimum per node
    (summed on the map side) and a join on the node. A hub with very many
    edges is one skewed join key, which adaptive execution splits; neighbours
    are never collected. Each round is written to the shared scratch folder.
    Self-loops and repeated edges are allowed; no edges give no rows.
    """
    current = materialise(_ordered(edges.select("a", "b")).distinct(), "edges")
    before = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = _ordered(large).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        current = materialise(_ordered(small.union(least)).distinct(), "edges")
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    centres = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).union(centres)


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges from the greater id to the smaller, without loops."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def linked_members(
    members: DataFrame, payload: DataFrame, linked: Callable[[list, list], np.ndarray],
    chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Exact links inside groups of candidates: (id, links, component).

    ``members``: id, group (long), copies (long, rows that the id stands for),
    bytes (long, size of its payload). ``payload``: id, payload (binary).
    ``linked`` takes two lists of payloads and returns the boolean matrix of
    links. ``links`` is the number of copies of linked ids, the id itself left
    out; ``component`` is the least id reachable by links.

    A group of at most ``chunk_rows`` members and ``chunk_bytes`` is compared
    in one task, small groups share tasks. A larger group is dealt into chunks
    by the hash of the id and every pair of chunks is one unit of work, so no
    task holds a group and no pair becomes a row.
    """
    members = materialise(members.select("id", "group", "copies", "bytes"), "members")
    sizes = members.groupBy("group").agg(F.count("*").alias("n"), F.sum("bytes").alias("size"))
    pieces = F.ceil(F.greatest(F.col("n") / chunk_rows, F.col("size") / chunk_bytes)).cast("int")
    sizes = sizes.select("group", F.greatest(pieces, F.lit(1)).alias("pieces"))
    total = members.agg(F.sum("bytes")).first()[0] or 0
    packs = 1 + total // chunk_bytes * 2 + members.sparkSession.sparkContext.defaultParallelism
    placed = members.join(sizes, "group").withColumn("chunk", F.pmod(F.xxhash64("id"), "pieces").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    placed = placed.withColumn("other", other).select(
        "id", "group", "copies", "chunk",
        F.when(F.col("pieces") == 1, -1 - F.pmod(F.xxhash64("group"), F.lit(packs))).otherwise(F.col("group")).alias("unit"),
        F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"),
    )
    units = placed.join(payload.select("id", "payload"), "id").groupBy("unit", "one", "two")
    found = materialise(
        units.applyInArrow(_compare_unit(linked), "id long, links long, root long, whole boolean"), "links"
    )
    split = found.filter("not whole")
    links = found.groupBy("id").agg(
        F.sum("links").alias("links"), F.min("root").alias("root"), F.bool_and("whole").alias("whole")
    )
    if split.isEmpty():
        return links.select("id", "links", F.col("root").alias("component"))
    across = connected_components(split.select(F.col("id").alias("a"), F.col("root").alias("b")))
    return links.join(across, "id", "left").select(
        "id", "links", F.coalesce(F.when(F.col("whole"), F.col("root")), "component", "id").alias("component")
    )


def _compare_unit(linked):
    def compare(key, table):
        unit, one, two = (k.as_py() for k in key)
        ids, copies = table["id"].to_numpy(), table["copies"].to_numpy()
        payload = table["payload"].to_pylist()
        out = []
        if unit < 0 or one == two:
            groups = table["group"].to_numpy()
            order = np.lexsort((ids, groups))
            for rows in np.split(order, np.flatnonzero(np.diff(groups[order])) + 1):
                own = [payload[i] for i in rows]
                matrix = linked(own, own)
                np.fill_diagonal(matrix, False)
                out.append((ids[rows], matrix @ copies[rows], _roots(ids[rows], matrix), unit < 0))
        else:
            chunk = table["chunk"].to_numpy()
            left, right = np.flatnonzero(chunk == one), np.flatnonzero(chunk == two)
            matrix = linked([payload[i] for i in left], [payload[i] for i in right])
            rows = np.concatenate([left, right])
            square = np.zeros((len(rows), len(rows)), dtype=bool)
            square[: len(left), len(left):] = matrix
            square[len(left):, : len(left)] = matrix.T
            out.append((ids[rows], square @ copies[rows], _roots(ids[rows], square), False))
        return pa.table({
            "id": pa.array(np.concatenate([x[0] for x in out]), pa.int64()),
            "links": pa.array(np.concatenate([x[1] for x in out]), pa.int64()),
            "root": pa.array(np.concatenate([x[2] for x in out]), pa.int64()),
            "whole": pa.array(np.concatenate([np.full(len(x[0]), x[3]) for x in out])),
        })

    return compare


def _roots(ids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Least id reachable from each row of a symmetric boolean matrix."""
    roots = ids.copy()
    todo = set(range(len(ids)))
    while todo:
        reached = {todo.pop()}
        front = list(reached)
        while front:
            near = np.flatnonzero(matrix[front].any(axis=0))
            front = [i for i in near.tolist() if i in todo]
            todo.difference_update(front)
            reached.update(front)
        rows = list(reached)
        roots[rows] = ids[rows].min()
    return roots
