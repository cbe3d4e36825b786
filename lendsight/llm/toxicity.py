"""Toxicity from the nearest labelled examples, found exactly in a block-max inverted index."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lendsight.llm.jaccard_join import shingles
from lendsight.llm.words import Memo, words_of
from lendsight.session import materialise

#: Labelled examples of each class that the index holds at most; the bound of what the driver sees.
EXAMPLES = 4000
#: Examples that a term is in at least, and by how much its rates in the two classes differ at least: neither depends on the number of rows.
LEAST_SUPPORT = 3
LEAST_RATIO = 2.0
NEIGHBOURS = 15
BLOCK = 64
PREFIXES = (4, 5, 6)
MAX_WORDS = 300_000
#: Added to a distance before it divides a vote.
NEAR = 0.05

#: ASCII capitals to small letters, other ASCII signs than letters and digits to spaces.
FOLD = bytes(32 if c < 128 and not chr(c).isalnum() else ord(chr(c).lower()) if c < 128 else c for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    return words_of((text or "").encode().translate(FOLD))


def word_terms(word: bytes) -> tuple[bytes, ...]:
    """A word as a term, and its beginnings: inflected forms share them. A beginning is marked by an asterisk."""
    letters = word.decode("utf-8", "replace")
    return word, *[letters[:n].encode() + b"*" for n in PREFIXES if len(letters) >= n]


def training_rows(labels: DataFrame, key: str, label: str) -> DataFrame:
    """(key, label) of the rows to learn from: those whose crc32 of the key as text leaves no 1 when divided by 3.

    Rows with a NULL key or label are left out; of several labels of a key the highest holds.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    return known.groupBy(F.col(key).alias("key")).agg(F.max(label).alias("label"))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sampled_examples(rows: DataFrame, examples: int = EXAMPLES) -> tuple[DataFrame, dict[int, int]]:
    """At most ``examples`` keys of each class, by a hash of the key; and the rows of each class."""
    counts = {row["label"]: row["n"] for row in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("key"), F.lit(1_000_003)) / 1_000_003
    parts = []
    for label in (0, 1):
        share = min(1.0, 0.95 * examples / max(counts.get(label, 0), 1))
        parts.append(rows.filter((F.col("label") == label) & (place < share)).limit(examples))
    return parts[0].union(parts[1]), {label: counts.get(label, 0) for label in (0, 1)}


def fingerprints(text: Column) -> Column:
    """The least and the greatest hash of a text's shingles: copies share both, most near copies at least one."""

    @F.arrow_udf("struct<least:long,most:long>")
    def ends(texts: pa.Array) -> pa.Array:
        sets = [shingles(t).view(np.int64) for t in texts.to_pylist()]
        columns = [pa.array([int(s[at]) if len(s) else 0 for s in sets], pa.int64()) for at in (0, -1)]
        return pa.StructArray.from_arrays(columns, ["least", "most"])

    return ends.asNondeterministic()(text)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after the other, and for each the place of its range."""
    sizes = high - low
    which = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(which)) + (low - (np.cumsum(sizes) - sizes))[which], which


def _empty(kind: type = int):
    return field(default_factory=lambda: np.empty(0, dtype=kind))


@dataclass
class Index:
    """Examples as unit vectors of weighted terms, by term and by block.

    ``idf`` has the weight of each term. A term's entries, from ``first[row]``
    to ``first[row + 1]``, are the blocks that hold it, each with the greatest
    weight of the term there and the begin of its postings, which are the examples and their weights.
    """

    idf: dict[bytes, float]
    keys: list = field(default_factory=list)
    labels: np.ndarray = _empty()
    rows: dict[bytes, int] = field(default_factory=dict)
    first: np.ndarray = _empty()
    block: np.ndarray = _empty()
    most: np.ndarray = _empty(float)
    begin: np.ndarray = _empty()
    place: np.ndarray = _empty()
    weight: np.ndarray = _empty(float)
    #: Votes of a class count as many rows as an example stands for.
    stands_for: dict[int, float] = field(default_factory=lambda: {0: 1.0, 1: 1.0})
    #: Shares of votes and the probability at each, between which it rises evenly; and that of a text without any term.
    centres: list[float] = field(default_factory=list)
    probability: list[float] = field(default_factory=list)
    without: float = 0.0

    @classmethod
    def build(cls, idf: dict[bytes, float], rows: Iterable[tuple], stands_for: dict[int, float]) -> Index:
        """``rows``: (key, label, counts by term); examples without terms are left out of the index."""
        made = cls(idf, stands_for=stands_for)
        made.rows = {term: row for row, term in enumerate(idf)}
        found = []
        for key, label, counts in rows:
            if vector := made.vector(counts):
                chief = max(vector, key=lambda t: (vector[t], t))
                terms = np.fromiter((made.rows[t] for t in vector), dtype=np.int64, count=len(vector))
                found.append((label, chief, str(key), key, terms, np.fromiter(vector.values(), dtype=float, count=len(vector))))
        found.sort(key=lambda x: x[:3])
        made.keys = [x[3] for x in found]
        made.labels = np.array([x[0] for x in found], dtype=int)
        if not found:
            made.first, made.begin = np.zeros(len(idf) + 1, dtype=int), np.zeros(1, dtype=int)
            return made
        terms, weights = np.concatenate([x[4] for x in found]), np.concatenate([x[5] for x in found])
        places = np.repeat(np.arange(len(found)), [len(x[4]) for x in found])
        order = np.lexsort((places, terms))
        terms, made.place, made.weight = terms[order], places[order], weights[order]
        blocks = made.place // BLOCK
        starts = np.flatnonzero(np.r_[True, (np.diff(terms) != 0) | (np.diff(blocks) != 0)])
        made.block, made.most = blocks[starts], np.maximum.reduceat(made.weight, starts)
        made.begin = np.r_[starts, len(terms)]
        made.first = np.searchsorted(terms[starts], np.arange(len(idf) + 1))
        return made

    def vector(self, counts: dict[bytes, int]) -> dict[bytes, float]:
        weights = {t: (1 + math.log(n)) * self.idf[t] for t, n in counts.items() if t in self.idf}
        norm = sum(w * w for w in weights.values()) ** 0.5
        return {t: w / norm for t, w in weights.items()} if norm else {}

    def nearest(self, vector: dict[bytes, float], k: int = NEIGHBOURS, without: object = None) -> list[tuple[float, int]]:
        """The ``k`` examples of greatest cosine, as (cosine, place); of equals the first places.

        The two blocks of the highest bounds are scored first; their k-th
        cosine is a floor, and only blocks whose bound reaches it are scored
        besides, so the answer is exact.
        """
        terms = [(self.rows[t], w) for t, w in vector.items() if t in self.rows]
        if not terms or not self.keys:
            return []
        rows = np.array([r for r, _ in terms])
        entries, which = _ranges(self.first[rows], self.first[rows + 1])
        weights = np.array([w for _, w in terms])[which]
        bounds = np.bincount(self.block[entries], weights * self.most[entries], minlength=-(-len(self.keys) // BLOCK))
        opened = np.zeros(len(bounds), dtype=bool)
        opened[np.argsort(-bounds, kind="stable")[:2]] = True
        best = self._scored(entries, weights, opened, k, without)
        floor = best[-1][0] if len(best) == k else 0.0
        more = (bounds > 0) & (bounds >= floor - 1e-12)
        return best if not (more & ~opened).any() else self._scored(entries, weights, more | opened, k, without)

    def _scored(self, entries: np.ndarray, weights: np.ndarray, opened: np.ndarray, k: int, without: object) -> list[tuple[float, int]]:
        """The ``k`` best examples of the opened blocks."""
        inside = opened[self.block[entries]]
        entries, weights = entries[inside], weights[inside]
        postings, which = _ranges(self.begin[entries], self.begin[entries + 1])
        scores = np.bincount(self.place[postings], weights[which] * self.weight[postings], minlength=len(self.keys))
        found = np.flatnonzero(scores > 0)
        if without is not None:
            found = found[[self.keys[p] != without for p in found.tolist()]]
        if len(found) > k:
            found = found[scores[found] >= np.partition(scores[found], len(found) - k)[len(found) - k]]
        return sorted(((float(scores[p]), p) for p in found.tolist()), key=lambda x: (-x[0], x[1]))[:k]

    def share(self, near: list[tuple[float, int]]) -> float:
        """Share of the votes for label 1; a vote weighs the more the nearer the example is."""
        votes = [0.0, 0.0]
        for cosine, place in near:
            label = int(self.labels[place])
            votes[label] += self.stands_for[label] / (1 - min(cosine, 1.0) + NEAR)
        return votes[1] / sum(votes)

    def calibrate(self, judged: list[tuple[float | None, int]]) -> None:
        """Fits probabilities to shares of votes: pools of neighbouring shares whose rates never fall, each with a prior row.

        ``judged``: for every example its share of votes without itself, None
        without neighbours, and its label.
        """
        weight = {label: self.stands_for[label] for label in (0, 1)}
        total = [sum(weight[y] for _, y in judged if y == label) for label in (0, 1)]
        base = (total[1] + 1e-9) / (sum(total) + 2e-9) if judged else 0.0
        bare = [sum(weight[y] for s, y in judged if s is None and y == label) for label in (0, 1)]
        self.without = (bare[1] + base) / (sum(bare) + 1)
        by_share: dict[float, list[float]] = {}
        for share, label in judged:
            if share is not None:
                sums = by_share.setdefault(round(share, 9), [0.0, 0.0])
                sums[0] += weight[label] * label
                sums[1] += weight[label]
        pools: list[list[float]] = []  # sums of weight x share, weight x label and weight
        for share, (ones, w) in sorted(by_share.items()):
            pools.append([w * share, ones, w])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
        self.centres = [p[0] / p[2] for p in pools]
        self.probability = [(p[1] + base) / (p[2] + 1) for p in pools]

    def score(self, counts: dict[bytes, int], evidence: int = 3) -> tuple[float, list[tuple[object, float, int]]]:
        near = self.nearest(self.vector(counts)) if counts else []
        if not near or not self.probability:
            return self.without, []
        score = float(np.interp(self.share(near), self.centres, self.probability))
        shown = [(self.keys[place], min(cosine, 1.0), int(self.labels[place])) for cosine, place in near[:evidence]]
        return score, shown


class TermCounter:
    """Counts of the chosen terms in whole texts; what a word holds is looked up once."""

    def __init__(self, terms):
        self.terms = frozenset(terms)
        self.found = Memo(lambda word: tuple(t for t in word_terms(word) if t in self.terms), MAX_WORDS)

    def __call__(self, text: str | None) -> Counter:
        return Counter(chain.from_iterable(map(self.found.__getitem__, plain_words(text))))


def telling_terms(examples: DataFrame, sizes: dict[int, int]) -> dict[bytes, float]:
    """The log of the ratio of a term's rates in the two classes, of every term in ``LEAST_SUPPORT`` examples or more.

    A rate has half an example added to its count. Terms whose rates differ
    by less than ``LEAST_RATIO`` are left out. ``examples`` must be free of
    copies: else the chance words of a copied text would look as if they told
    something. ``sizes``: examples by class.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [Counter(), Counter()]
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                seen[label].update({t for w in set(plain_words(text)) for t in word_terms(w)})
            terms = list(seen[0].keys() | seen[1].keys())
            columns = [pa.array(terms, pa.binary()), *[pa.array([s[t] for t in terms], pa.int64()) for s in seen]]
            yield pa.RecordBatch.from_arrays(columns, ["term", "clean", "toxic"])

    found = examples.select("text", "label").mapInArrow(spread, "term binary, clean long, toxic long")
    clean, toxic = sizes[0], sizes[1]
    if not clean or not toxic:
        return {}
    sums = found.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).filter(F.col("a") + F.col("b") >= LEAST_SUPPORT)
    ratio = F.abs(F.log((F.col("a") + 0.5) / (toxic + 1.0)) - F.log((F.col("b") + 0.5) / (clean + 1.0)))
    told = sums.select("term", ratio.alias("ratio")).filter(F.col("ratio") >= math.log(LEAST_RATIO)).toArrow()
    return dict(sorted(zip(told["term"].to_pylist(), told["ratio"].to_pylist(), strict=True)))


def document_frequencies(docs: DataFrame, text: str, terms: Iterable[bytes]) -> tuple[int, dict[bytes, int]]:
    """Documents of the corpus, and those that hold each of the given terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen, rows = TermCounter(terms), Counter(), 0
        for batch in batches:
            rows += batch.num_rows
            for value in batch.column(0).to_pylist():
                seen.update(counter(value).keys())
        names = [b"", *seen]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([rows, *seen.values()], pa.int64())], ["term", "n"])

    sums = docs.select(text).mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(sums["term"].to_pylist(), sums["n"].to_pylist(), strict=True))
    return found.pop(b"", 0), found


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", examples: int = EXAMPLES) -> Index:
    """Index of examples with calibrated votes.

    Examples are a bounded sample of the labelled rows (``examples`` of each
    class), one of each group of copies; an example stands for as many rows as
    its class has per example. A term weighs its inverse document frequency,
    counted over all of ``docs``, times the square of ``telling_terms``. The
    driver gets the chosen terms, their counts and the vectors of the
    examples, no texts.
    """
    rows, counts = sampled_examples(training_rows(labels, key, label), examples)
    chosen = F.broadcast(materialise(rows, "example-keys"))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(chosen, "key")
    texts = texts.withColumn("ends", fingerprints(F.col("text"))).select("key", "text", "label", "ends.least", "ends.most")
    texts = texts.dropDuplicates(["label", "least"]).dropDuplicates(["label", "most"]).select("key", "text", "label")
    texts = materialise(texts, "examples")
    sizes = {0: 0, 1: 0} | {row["label"]: row["n"] for row in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    stands_for = {c: counts[c] / max(sizes[c], 1) for c in (0, 1)}
    told = telling_terms(texts, sizes)
    terms = list(told)
    size, seen = document_frequencies(docs, text, terms)
    idf = {t: (math.log((size + 1) / (seen.get(t, 0) + 1)) + 1) * ratio**2 for t, ratio in told.items()}
    del told, seen
    names = docs.sparkSession.sparkContext.broadcast(terms)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {t: i for i, t in enumerate(names.value)}
        counter = TermCounter(places)
        for batch in batches:
            counts = [counter(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("key"), batch.column("label").cast(pa.int32()),
                pa.array([[places[t] for t in c] for c in counts], pa.list_(pa.int32())),
                pa.array([list(c.values()) for c in counts], pa.list_(pa.int32())),
            ], ["key", "label", "terms", "counts"])

    kind = texts.schema["key"].dataType.simpleString()
    held = texts.select("key", "label", "text").mapInArrow(vectors, f"key {kind}, label int, terms array<int>, counts array<int>")
    held = materialise(held.dropDuplicates(["key"]), "vectors")

    def given(table: pa.Table) -> Iterator[tuple]:
        for row in (r for batch in table.to_batches(max_chunksize=100) for r in batch.to_pylist()):
            yield row["key"], row["label"], {terms[t]: n for t, n in zip(row["terms"], row["counts"], strict=True)}

    index = Index.build(idf, given(held.toArrow()), stands_for)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares = []
            for own, places, numbers in zip(*(batch.column(c).to_pylist() for c in ("key", "terms", "counts")), strict=True):
                counts = {names.value[t]: n for t, n in zip(places, numbers, strict=True)}
                near = shared.value.nearest(shared.value.vector(counts), without=own)
                shares.append(shared.value.share(near) if near else None)
            yield pa.RecordBatch.from_arrays([pa.array(shares, pa.float64()), batch.column("label")], ["share", "label"])

    judged = held.repartition(docs.sparkSession.sparkContext.defaultParallelism, "key").mapInArrow(judge, "share double, label int")
    index.calibrate([(row["share"], row["label"]) for row in judged.collect()])
    return index


def toxicity(text: Column, index: Index, session) -> Column:
    """Struct of score (0 to 1) and evidence (key, similarity and label of the nearest examples) of a whole text.

    An empty or NULL text, and one without any of the index's terms, has the
    probability that such examples had, and no evidence.
    """
    shared = session.sparkContext.broadcast(index)
    counters: list[TermCounter] = []

    @F.arrow_udf("struct<score:double,evidence:array<struct<key:string,similarity:double,label:int>>>")
    def judge(texts: pa.Array) -> pa.Array:
        if not counters:
            counters.append(TermCounter(shared.value.idf))
        rows = [shared.value.score(counters[0](t)) for t in texts.to_pylist()]
        kind = pa.list_(pa.struct([("key", pa.string()), ("similarity", pa.float64()), ("label", pa.int32())]))
        shown = [[{"key": str(k), "similarity": s, "label": y} for k, s, y in found] for _, found in rows]
        return pa.StructArray.from_arrays(
            [pa.array([score for score, _ in rows], pa.float64()), pa.array(shown, kind)], ["score", "evidence"]
        )

    return judge.asNondeterministic()(text)


def clean_documents(docs: DataFrame, labels: DataFrame, limit: float = 0.7) -> DataFrame:
    """The documents that score below ``limit``, with their own columns; rows are judged one by one."""
    index = fit(docs, labels)
    inner = [f"_c{i}" for i in range(len(docs.columns))]
    named = docs.toDF(*inner)
    judged = named.withColumn("_judged", toxicity(F.col(inner[docs.columns.index("text")]), index, docs.sparkSession))
    return judged.filter(F.col("_judged.score") < limit).select(*inner).toDF(*docs.columns)
