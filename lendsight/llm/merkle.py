"""Merkle manifest of a table: one tree a group, a tree over the groups, proofs by octopus multiproofs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendsight.session import materialise

FANOUT = 16
#: Leaves of one leaf partition: some two megabytes of digests and proofs in a worker.
LEAVES = 4096
#: Number of the tree over the subroots; the trees of groups are numbered from 0.
TOP = -1
HEX = 64


def leaf_digest(*values: Column) -> Column:
    """Hash of values, each written as its bytes in UTF-8, a colon and itself, or as a hyphen where it is NULL."""
    texts = [v.cast("string") for v in values]
    written = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*written).cast("binary"), 256)


class Manifest(NamedTuple):
    """leaves: part, tree, size, spot and the given columns; nodes: tree, level, spot, digest; root of all trees."""

    leaves: DataFrame
    nodes: DataFrame
    trees: int


def _numbered_groups(leaves: DataFrame, group: str) -> DataFrame:
    """Groups with their number in byte order, NULL first, and their number of leaves."""
    groups = leaves.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_size"))
    order = F.col("_group").asc_nulls_first()
    slices = materialise(groups.repartitionByRange(order).withColumn("_slice", F.spark_partition_id()), "groups")
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.groupBy("_slice").agg(F.count("*").alias("_n")).select(
        "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    spot = F.row_number().over(Window.partitionBy("_slice").orderBy(order)) - 1 + F.col("_start")
    return slices.join(F.broadcast(starts), "_slice").select("_group", "_size", spot.cast("long").alias("_tree"))


def _placed(leaves: DataFrame, group: str, order: str, leaf: str) -> DataFrame:
    """Leaves with tree, size, spot (place in the tree) and part (place of the leaf partition).

    Leaves are range-partitioned by tree and order into slices. Only one row
    per slice and tree is needed to know where a tree's leaves in a slice
    begin; that table is joined by Spark's size check.
    """
    stored = materialise(leaves.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    groups = materialise(_numbered_groups(stored, group), "numbered-groups")
    named = stored.join(groups, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    keys = [F.col("_tree"), F.col(order).asc_nulls_first(), F.col(leaf), F.col("_row")]
    slices = materialise(named.repartitionByRange(*keys).withColumn("_slice", F.spark_partition_id()), "slices")

    counts = slices.groupBy("_slice", "_tree").agg(F.count("*").alias("_n"))
    in_tree = Window.partitionBy("_tree").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    in_slice = Window.partitionBy("_slice").orderBy("_tree").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("_slice", "_tree", (
        F.coalesce(F.sum("_n").over(in_tree), F.lit(0)) - F.coalesce(F.sum("_n").over(in_slice), F.lit(0))
    ).alias("_shift"))
    at = (F.row_number().over(Window.partitionBy("_slice").orderBy(*keys)) - 1).cast("long")
    counted = slices.withColumn("_at", at).join(shifts, ["_slice", "_tree"])
    part = F.struct(F.col("_slice"), F.floor(F.col("_at") / LEAVES).alias("block"))
    return counted.select(
        part.alias("part"), F.col("_tree").alias("tree"), F.col("_size").alias("size"),
        (F.col("_at") + F.col("_shift")).alias("spot"), *[c for c in leaves.columns],
    )


def _levels(nodes: DataFrame, largest: int) -> Iterator[DataFrame]:
    """Level by level (tree, size, spot, digest) above ``nodes``; trees with one node left do not go on."""
    while largest > 1:
        runs = nodes.filter("size > 1").groupBy("tree", "size", F.floor(F.col("spot") / FANOUT).alias("spot")).agg(
            F.sort_array(F.collect_list(F.struct("spot", "digest"))).alias("run")
        )
        joined = F.array_join(F.transform("run", lambda n: n.digest), "")
        nodes = materialise(runs.select(
            "tree", F.ceil(F.col("size") / FANOUT).alias("size"), "spot", F.sha2(joined.cast("binary"), 256).alias("digest")
        ), "nodes")
        largest = -(-largest // FANOUT)
        yield nodes


def _numbered(levels: list[DataFrame]) -> DataFrame:
    every = None
    for level, nodes in enumerate(levels):
        own = nodes.select("tree", F.lit(level).alias("level"), "spot", "digest")
        every = own if every is None else every.unionAll(own)
    return every


def manifest(leaves: DataFrame, group: str, order: str, leaf: str) -> Manifest:
    """The trees of ``leaves``: per value of ``group``, by ``order`` (NULL first, equal ones by digest).

    Runs of sixteen nodes become the hash of their digests until one node is
    left, the subroot; subroots ordered by group (NULL first, by bytes) become
    the root in the same way. Every level is one aggregation by run whose
    groups hold at most sixteen rows, stored before the next; a hot group is
    spread over all tasks. An empty table has no trees and no nodes. Columns
    of ``leaves`` must not be named part, tree, size, spot or begin with "_".
    """
    placed = materialise(_placed(leaves, group, order, leaf), "placed")
    bounds = placed.agg(F.max("size").alias("largest"), F.count_distinct("tree").alias("trees")).first()
    below = placed.select("tree", "size", "spot", F.col(leaf).alias("digest"))
    source = [below, *_levels(below, bounds.largest or 0)]
    single = None
    for nodes in source:
        own = nodes.filter("size = 1").select("tree", "digest")
        single = own if single is None else single.unionAll(own)
    subroots = materialise(single.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(bounds.trees).cast("long").alias("size"), F.col("tree").alias("spot"), "digest"
    ), "subroots")
    top = [subroots, *_levels(subroots, bounds.trees)]
    return Manifest(placed, _numbered(source).unionAll(_numbered(top)), bounds.trees)


def _runs(known: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs that hold a known node, and all members of these runs."""
    runs = np.unique(known // FANOUT)
    members = (runs[:, None] * FANOUT + np.arange(FANOUT)).ravel()
    return runs, members[members < size]


def _climb(spots: dict[int, tuple[int, np.ndarray]], trees: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(tree, level, known nodes, members of their runs, runs) up to the root; ``spots`` has size and leaves by tree."""
    tops = np.array(sorted(spots), dtype=np.int64)
    for tree, (size, known) in [*sorted(spots.items()), (TOP, (trees, tops))]:
        level, known = 0, np.unique(known)
        while size > 1:
            runs, members = _runs(known, size)
            yield tree, level, known, members, runs
            known, size, level = runs, -(-size // FANOUT), level + 1


def _by_tree(trees: np.ndarray, sizes: np.ndarray, spots: np.ndarray) -> dict[int, tuple[int, np.ndarray]]:
    found = {}
    for tree in np.unique(trees):
        own = trees == tree
        found[int(tree)] = (int(sizes[own][0]), spots[own])
    return found


def _wanted(leaves: DataFrame, trees: int) -> DataFrame:
    """Coordinates a leaf partition cannot derive: members of touched runs that are not above its own leaves."""

    def list_missing(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_numpy() for c in ("tree", "size", "spot")]
        rows = [
            (tree, level, spot)
            for tree, level, known, members, _ in _climb(_by_tree(*columns), trees)
            for spot in members[~np.isin(members, known)].tolist()
        ]
        part = pa.array([table.column("part")[0].as_py()] * len(rows), table.schema.field("part").type)
        fields = list(zip(*rows)) or [(), (), ()]
        return pa.table({
            "part": part, "tree": pa.array(fields[0], pa.int64()), "level": pa.array(fields[1], pa.int32()),
            "spot": pa.array(fields[2], pa.int64()),
        })

    part = leaves.schema["part"].dataType.simpleString()
    return leaves.select("part", "tree", "size", "spot").groupBy("part").applyInArrow(
        list_missing, f"part {part}, tree long, level int, spot long"
    )


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Partition:
    """Digests that one leaf partition knows: its leaves, the fetched nodes, and the interiors derived from both."""

    def __init__(self, spots: dict[int, tuple[int, np.ndarray]], trees: int, digests: dict[tuple[int, int, int], str]) -> None:
        self.spots, self.trees = spots, trees
        #: Concatenated run above a node's children, by coordinate of the parent.
        self.runs: dict[tuple[int, int, int], str] = {}
        self.above: dict[tuple[int, int, int], tuple[str, tuple]] = {}
        for tree, level, _, members, runs in _climb(spots, trees):
            if tree == TOP and level == 0:
                for own in spots:
                    digests.setdefault((TOP, 0, own), digests[self.top_of(own)])
            kept = members.tolist()
            for run in runs.tolist():
                held = [digests[tree, level, s] for s in kept[np.searchsorted(members, run * FANOUT):][:FANOUT] if s // FANOUT == run]
                self.runs[tree, level + 1, run] = "".join(held)
                digests[tree, level + 1, run] = _sha(self.runs[tree, level + 1, run])
        if trees == 1:
            digests.setdefault((TOP, 0, 0), digests[self.top_of(0)])
        self.digests = digests

    @staticmethod
    def _height(size: int) -> int:
        height = 0
        while size > 1:
            size, height = -(-size // FANOUT), height + 1
        return height

    def top_of(self, tree: int) -> tuple[int, int, int]:
        return tree, self._height(self.spots[tree][0]), 0

    def path(self, tree: int, spot: int) -> list[tuple[str, int]]:
        """Run and place in it at every step from a leaf to the root."""
        steps = []
        for own, at, height in ((tree, spot, self._height(self.spots[tree][0])), (TOP, tree, self._height(self.trees))):
            for level in range(height):
                steps.append((self.runs[own, level + 1, at // FANOUT], at % FANOUT * HEX))
                at //= FANOUT
        return steps

    def root(self) -> str:
        return self.digests[TOP, self._height(self.trees), 0]


def fold(leaf: str, steps: list[tuple[str, int]]) -> str:
    """Root that a leaf leads to among the given siblings."""
    for run, at in steps:
        leaf = _sha(run[:at] + leaf + run[at + HEX:])
    return leaf


def proofs(made: Manifest, key: str, leaf: str, claimed: str, siblings: bool = False) -> DataFrame:
    """Every leaf with subroot, root, proof_sha256, folded_root and verified; ``siblings`` adds the proof itself.

    ``claimed`` holds the digest to be verified against the original siblings;
    NULL stands for the leaf's own. Each leaf partition lists the coordinates
    that its own leaves do not determine, once for all its leaves; they are
    fetched by one join with the nodes and meet the leaves again by partition.
    There the interiors are derived once, and the single proofs read off.
    """
    trees, schema = made.trees, made.leaves.schema
    wanted = materialise(_wanted(made.leaves, trees), "wanted")
    fetched = wanted.join(made.nodes, ["tree", "level", "spot"]).select("part", "tree", "level", "spot", "digest")
    leaves = made.leaves.select("part", "tree", "size", "spot", F.col(key).alias("key"), F.col(leaf).alias("leaf"), F.col(claimed).alias("claimed"))

    def expand(own: pa.Table, found: pa.Table) -> pa.Table:
        columns = [own.column(c).to_numpy() for c in ("tree", "size", "spot")]
        at = list(zip(columns[0].tolist(), [0] * own.num_rows, columns[2].tolist()))
        digests = dict(zip(at, own.column("leaf").to_pylist()))
        coordinates = zip(*(found.column(c).to_pylist() for c in ("tree", "level", "spot")))
        digests |= zip(coordinates, found.column("digest").to_pylist())
        known = Partition(_by_tree(*columns), trees, digests)
        root = known.root() if own.num_rows else None
        made_rows = {"subroot": [], "proof": [], "folded_root": []}
        for (tree, _, spot), digest, claim in zip(at, own.column("leaf").to_pylist(), own.column("claimed").to_pylist()):
            steps = known.path(tree, spot)
            made_rows["subroot"].append(digests[known.top_of(tree)])
            made_rows["proof"].append("".join([run[:p] + run[p + HEX:] for run, p in steps]))
            made_rows["folded_root"].append(fold(claim or digest, steps))
        proof = made_rows["proof"]
        result = {
            "key": own.column("key"), "leaf": own.column("leaf"), "subroot": made_rows["subroot"], "root": [root] * own.num_rows,
            "proof_sha256": [_sha(p) for p in proof], "folded_root": made_rows["folded_root"],
            "verified": [folded == root for folded in made_rows["folded_root"]],
        }
        return pa.table(result | ({"siblings": proof} if siblings else {}))

    wide = ", siblings string" if siblings else ""
    result = f"key {schema[key].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean{wide}"
    expanded = leaves.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(expand, result)
    return expanded.withColumnRenamed("key", key)


def documents_manifest(docs: DataFrame) -> DataFrame:
    """Every document as a leaf of its source's tree, verified against a text whose capitals A-Z were lowered.

    Only documents whose id has a crc32 divisible by five are changed (a NULL
    id never is, a NULL text stays NULL). NULL ids sort first, rows of one id
    by their digest; equal rows have equal proofs' content or lie side by
    side. An empty table gives no rows; further columns play no part.
    """
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changes = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        "doc_id", "source", leaf_digest(*others, F.col("text")).alias("leaf"),
        F.when(changes, leaf_digest(*others, lowered)).alias("claimed"),
    )
    return proofs(manifest(leaves, "source", "doc_id", "leaf"), "doc_id", "leaf", "claimed")
