"""Product codes of vectors: sixteen parts each, one codebook a part, nearest entries by Orchard's search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Components saturate here (an x of 65 536), so that every squared distance of up to 8 192 components fits a long.
LIMIT = 2**24


def is_kept(vector: Column) -> Column:
    """True for a vector that is there and whose components are all there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of floor(256 x) in whole numbers, short vectors filled with zeros up to ``width``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.clip(np.floor(np.clip(flat, -LIMIT, LIMIT) * SCALE), -LIMIT, LIMIT).astype(np.int64)
    rows = np.zeros((len(vectors), width), dtype=np.int64)
    rows[np.arange(width)[None, :] < lengths[:, None]] = whole
    return rows


class Orchard:
    """Nearest entry in several codebooks at once.

    Every entry keeps the others in order of their distance from it. A search
    holds its best entry so far and walks down that entry's list; a closer
    entry (or an equally close one of lower index) becomes the best, and its
    list is walked from the top. Entries measured once are marked. By the
    triangle inequality nothing beyond twice the best distance can be closer,
    so the walk ends there; at exactly twice it goes on, as a tie may hide
    there. Squared distances are whole numbers, twice is four times.
    """

    def __init__(self, books: np.ndarray) -> None:
        self.books = books
        gaps = ((books[:, :, None, :] - books[:, None, :, :]) ** 2).sum(axis=3)
        own = np.arange(books.shape[1])
        gaps[:, own, own] = -1
        order = np.argsort(gaps, axis=2, kind="stable")
        self.neighbours = order[:, :, 1:]
        self.gaps = np.take_along_axis(gaps, order, axis=2)[:, :, 1:]

    def search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points as (rows, parts, components); returns entry and squared distance as (rows, parts)."""
        rows, parts, length = points.shape
        flat = points.reshape(rows * parts, length)
        part = np.tile(np.arange(parts), rows)
        best = np.zeros(len(flat), dtype=np.int64)
        distance = ((flat - self.books[part, best]) ** 2).sum(axis=1)
        seen = np.zeros((len(flat), self.books.shape[1]), dtype=bool)
        seen[:, 0] = True
        spot = np.zeros(len(flat), dtype=np.int64)
        walking = np.arange(len(flat))
        last = self.neighbours.shape[2]
        while True:
            walking = walking[spot[walking] < last]
            p, b, s = part[walking], best[walking], spot[walking]
            near = self.gaps[p, b, s] <= 4 * distance[walking]
            walking, p, b, s = walking[near], p[near], b[near], s[near]
            if not len(walking):
                return best.reshape(rows, parts), distance.reshape(rows, parts)
            entry = self.neighbours[p, b, s]
            spot[walking] += 1
            fresh = ~seen[walking, entry]
            at, entry = walking[fresh], entry[fresh]
            seen[at, entry] = True
            found = ((flat[at] - self.books[part[at], entry]) ** 2).sum(axis=1)
            closer = (found < distance[at]) | ((found == distance[at]) & (entry < best[at]))
            at = at[closer]
            best[at], distance[at], spot[at] = entry[closer], found[closer], 0


def _cut(vectors: pa.Array, parts: int, length: int) -> np.ndarray:
    return integers(vectors, parts * length).reshape(len(vectors), parts, length)


def _sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """Sum of components and number of parts for every entry, as (slot, spot, total); spot -1 is the number."""
    parts, entries, length = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(books)
        totals = np.zeros((parts * entries, length + 1), dtype=np.int64)
        for batch in batches:
            points = _cut(batch.column(0), parts, length)
            slots = (search.search(points)[0] + np.arange(parts) * entries).ravel()
            counted = np.concatenate([np.ones((len(slots), 1), dtype=np.int64), points.reshape(len(slots), length)], axis=1)
            np.add.at(totals, slots, counted)
        slot, spot = np.nonzero(totals)
        yield pa.RecordBatch.from_pydict({"slot": slot, "spot": spot - 1, "total": totals[slot, spot]})

    return vectors.mapInArrow(add, "slot long, spot long, total long")


def train(df: DataFrame, key: str, vector: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks as (parts, entries, components).

    They start as the vectors of the smallest keys (equal keys by content,
    NULL keys last). Each round assigns every part to its nearest entry and
    moves an entry to floor(sum / count) of its parts; unused entries stay.
    Sums are added up per task and then by Spark, so the driver only ever
    receives one number per component of a codebook.
    """
    vectors = df.filter(is_kept(F.col(vector))).select(F.col(vector).alias("vector"))
    longest = vectors.agg(F.max(F.size("vector")).alias("n")).first().n or 0
    length = -(-longest // parts)
    keyed = df.filter(is_kept(F.col(vector))).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    first = keyed.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    starts = _cut(first.column("vector"), parts, length)
    books = np.ascontiguousarray(starts.transpose(1, 0, 2))
    for _ in range(rounds if len(first) else 0):
        totals = np.zeros((books.shape[0] * books.shape[1], length + 1), dtype=object)
        for row in _sums(vectors, books).groupBy("slot", "spot").agg(F.sum("total").alias("total")).collect():
            totals[row.slot, row.spot + 1] = row.total
        moved = books.reshape(len(totals), length).copy()
        for slot, (count, *sums) in enumerate(totals):
            if count:
                moved[slot] = [s // count for s in sums]
        books = moved.reshape(books.shape)
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(df: DataFrame, vector: str, books: np.ndarray) -> DataFrame:
    """Rows whose vector is kept, all columns but the vector, with code (two hex digits a part) and error (long).

    Columns named code or error are replaced.
    """
    parts, entries, length = books.shape
    kept = df.filter(is_kept(F.col(vector)))
    others = [f for f in df.schema.fields if f.name not in (vector, "code", "error")]
    made = [StructField("code", StringType()), StructField("error", LongType())]
    digits = np.array([f"{i:02x}" for i in range(max(entries, 1))])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(books) if entries else None
        for batch in batches:
            entry, distance = search.search(_cut(batch.column(0), parts, length))
            codes = ["".join(row) for row in digits[entry]]
            names = [*(f.name for f in others), "code", "error"]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(codes, pa.string()), pa.array(distance.sum(axis=1))], names)

    return kept.select(F.col(vector), *[F.col(f.name) for f in others]).mapInArrow(assign, StructType([*others, *made]))


def decode(code: Column, books: np.ndarray) -> Column:
    """The vector that a code stands for, as the whole numbers of its entries."""
    parts, entries, length = books.shape

    @F.arrow_udf(ArrayType(LongType()))
    def look_up(codes: pa.Array) -> pa.Array:
        found = []
        for text in codes.to_pylist():
            entry = None if text is None else np.frombuffer(bytes.fromhex(text), dtype=np.uint8)
            found.append(None if entry is None else books[np.arange(parts), entry].ravel().tolist())
        return pa.array(found, pa.list_(pa.int64()))

    return look_up(code)


def with_label_error(coded: DataFrame, label: str) -> DataFrame:
    """``coded`` with label_error (long), the errors summed over equal labels, NULL labels together.

    The sums are one row a label; Spark broadcasts them where they are small
    and splits a hot label where they are not. ``coded`` is read twice and
    should be a stored table.
    """
    sums = coded.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("_label_error"))
    kept = [c for c in coded.columns if c != "label_error"]
    joined = coded.join(sums, F.col(label).eqNullSafe(F.col("_label")))
    return joined.select(*kept, F.col("_label_error").alias("label_error"))
