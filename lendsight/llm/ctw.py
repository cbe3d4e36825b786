"""Context-tree weighting over bytes, and a word model to compare it with.

A byte is coded as eight binary decisions; each decision has a context tree of
its own, whose contexts are the bytes before. A node of a tree, (context,
decision), counts the bits seen there; its Krichevsky-Trofimov estimate is
(n1 + 1/2) / (n0 + n1 + 1), and weighting mixes the estimates of all depths,
from no context to ``depth`` bytes. Texts begin with START bytes and close with
an END byte, neither of which UTF-8 uses, so the probabilities of all texts add
up to one.

The tree is a table with a row per node. Weights go up from the deepest nodes
by one aggregation a level, mixed probabilities go down by one join a level.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lendsight.llm.words import words_of
from lendsight.session import materialise

DEPTH = 4
START, END = b"\xfe", b"\xff"
#: The end of a text as a word; no word has white space.
END_WORD = b" "
#: Entries of the tables of frequent words and byte runs that every worker holds; the rest is joined.
FREQUENT_WORDS = 200_000
FREQUENT_RUNS = 1_000_000
#: Longer words are never in the table, which bounds its size.
LONGEST = 64
#: Entries that a task gathers before it sends them on.
GATHERED = 300_000
RUNS_GATHERED = 4_000_000


def held_out(key: Column) -> Column:
    """Rows kept from learning: crc32 of the key as text divides by 10. A NULL key is learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def folded(text: str | None) -> bytes:
    """UTF-8 with A-Z in small letters; empty for NULL."""
    return (text or "").encode().lower()


def byte_runs(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Every byte (and the END) of the texts with its ``depth`` bytes of context as one number, and the texts' borders."""
    data = np.frombuffer(b"".join([START * depth + t + END for t in texts]), dtype=np.uint8).astype(np.int64)
    lengths = np.array([len(t) + 1 for t in texts])
    runs = np.zeros(len(data), dtype=np.int64)
    for back in range(depth, -1, -1):
        runs <<= 8
        runs[back:] |= data[: len(data) - back]
    begins = np.cumsum(lengths + depth) - lengths
    own = np.ones(len(data), dtype=bool)
    for i in range(depth):
        own[begins - 1 - i] = False
    return runs[own], np.concatenate([[0], np.cumsum(lengths)])


def gathered(docs: DataFrame, text: str, depth: int) -> DataFrame:
    """Partial counts over tasks: (word, run, n); n counts training texts only.

    ``docs`` needs the text and ``_held``. Runs of held-out texts come with
    n = 0, so that the model has a probability for every run of the table. A
    task sends its counts on whenever it holds a bounded number of them.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        runs: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [folded(t) for t in part.column(0).to_pylist()]
                held = np.array(part.column(1).to_pylist(), dtype=bool)
                for own, skip in zip(texts, held.tolist(), strict=True):
                    if not skip:
                        words.update(words_of(own))
                        words[END_WORD] += 1
                found, borders = byte_runs(texts, depth)
                taught = np.repeat(~held, np.diff(borders))
                for some, n in ((found[taught], 1), (found[~taught], 0)):
                    keys, counts = np.unique(some, return_counts=True)
                    runs.append((keys, counts * n))
                    size += len(keys)
                if len(words) > GATHERED:
                    yield rows(words, [])
                    words = Counter()
                if size > RUNS_GATHERED:
                    runs = [merged(runs)]
                    size = len(runs[0][0])
                    if size > RUNS_GATHERED // 2:
                        yield rows({}, runs)
                        runs, size = [], 0
        yield rows(words, [merged(runs)] if runs else [])

    def merged(parts):
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

    def rows(words, runs) -> pa.RecordBatch:
        keys = runs[0][0] if runs else np.empty(0, dtype=np.int64)
        counts = runs[0][1] if runs else np.empty(0, dtype=np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array([*words, *[None] * len(keys)], pa.binary()),
            pa.concat_arrays([pa.nulls(len(words), pa.int64()), pa.array(keys)]),
            pa.concat_arrays([pa.array(list(words.values()), pa.int64()), pa.array(counts, pa.int64())]),
        ], ["word", "run", "n"])

    return docs.select(text, "_held").mapInArrow(gather, "word binary, run long, n long")


def _log_gamma(x: Column) -> Column:
    """Stirling's series above 7, reached by the recurrence."""
    z = x + 7
    product = x
    for i in range(1, 7):
        product = product * (x + i)
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3.0))) + 1 / (1260 * F.pow(z, F.lit(5.0)))
    return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + series - F.log(product)


def _log_kt(zeros: Column, ones: Column) -> Column:
    """Log of the Krichevsky-Trofimov probability of a string with these counts: B(n0 + 1/2, n1 + 1/2) / B(1/2, 1/2)."""
    log_pi = 1.1447298858494002
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - log_pi


def context_tree(runs: DataFrame, depth: int) -> DataFrame:
    """(run, log10): the mixed probability of the last byte of each run after the bytes before it.

    ``runs``: run, n (times seen in training, 0 if only in held-out texts). A
    node without counts has no estimate of its own, so there the mix ends with
    the depth above. A context has at most 256 deeper ones, so no key of an
    aggregation or join holds more than that many rows of a level.
    """
    half = -0.6931471805599453
    bits = F.explode(F.sequence(F.lit(0), F.lit(7)))
    context, byte = F.shiftright("run", 8), F.col("run").bitwiseAND(255).cast("int")
    cut = runs.select(context.alias("context"), byte.alias("byte"), "n", bits.alias("i"))
    node = F.expr("shiftleft(1, i) | shiftright(byte, 8 - i)")
    one = F.expr("shiftright(byte, 7 - i) & 1")
    level = cut.select("context", node.alias("node"), F.when(one == 0, F.col("n")).otherwise(0).alias("n0"),
                       F.when(one == 1, F.col("n")).otherwise(0).alias("n1"))
    level = level.groupBy("context", "node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    kt = _log_kt(F.col("n0").cast("double"), F.col("n1").cast("double"))
    levels = [materialise(level.withColumn("own", kt).withColumn("mixed", F.col("own")), "nodes")]
    for length in range(depth - 1, -1, -1):
        shorter = F.col("context").bitwiseAND((1 << 8 * length) - 1)
        up = levels[0].groupBy(shorter.alias("context"), "node").agg(
            F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("mixed").alias("deeper")
        ).withColumn("own", kt)
        apart = -F.abs(F.col("own") - F.col("deeper"))
        up = up.withColumn("mixed", F.greatest("own", "deeper") + half + F.log1p(F.exp(apart))).drop("deeper")
        levels.insert(0, materialise(up, "nodes"))

    seen = (F.col("n0") + F.col("n1")) > 0
    estimate = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
    weight = F.exp(half + F.col("own") - F.col("mixed"))
    above = levels[0].select(
        "context", "node", estimate.alias("here"), (weight * estimate).alias("sum"), (1 - weight).alias("left")
    )
    for length in range(1, depth + 1):
        shorter = F.col("context").bitwiseAND((1 << 8 * (length - 1)) - 1)
        below = levels[length].withColumn("shorter", shorter)
        above = above.select(F.col("context").alias("shorter"), "node", F.col("here").alias("_here"), F.col("sum").alias("_sum"), F.col("left").alias("_left"))
        above = below.join(above, ["shorter", "node"]).select(
            "context", "node",
            F.when(seen, F.col("_sum") + F.col("_left") * estimate).otherwise(F.col("_here")).alias("here"),
            F.when(seen, F.col("_sum") + F.col("_left") * weight * estimate).otherwise(F.col("_here")).alias("sum"),
            F.when(seen, F.col("_left") * (1 - weight)).otherwise(0.0).alias("left"),
        )
    tables = above.groupBy("context").agg(F.map_from_entries(F.collect_list(F.struct("node", "here"))).alias("here"))
    told = runs.select("run", "n", context.alias("context"), byte.alias("byte")).join(tables, "context")
    steps = F.expr("""
        aggregate(sequence(0, 7), 0D, (total, i) -> total + log10(
            if((shiftright(byte, 7 - i) & 1) = 1, here[shiftleft(1, i) | shiftright(byte, 8 - i)],
               1 - here[shiftleft(1, i) | shiftright(byte, 8 - i)])))
    """)
    return told.select("run", "n", steps.alias("log10"))


def _at_least(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` rows reach, from a histogram with four steps to a doubling."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 4)
    found = counts.filter("n > 0").groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.min("n").alias("least")).collect()
    total, least = 0, None
    for row in sorted(found, key=lambda r: -r["step"]):
        total += row["rows"]
        if total > most:
            break
        least = row["least"]
    return least if least is not None else 1 << 62


@dataclass
class Model:
    """Word counts and byte probabilities, as stored tables and as bounded tables of the frequent ones."""

    words: DataFrame
    runs: DataFrame
    depth: int
    tokens: int
    distinct: int
    frequent_words: dict[bytes, int]
    frequent_runs: tuple[np.ndarray, np.ndarray]

    def word_log10(self, count: Column) -> Column:
        return F.log10((F.coalesce(count, F.lit(0)) + 0.1) / F.lit(self.tokens + 0.1 * (self.distinct + 1)))


def learn(docs: DataFrame, key: str, text: str, depth: int = DEPTH) -> Model:
    """Counts over all training texts of ``docs``; one pass over the texts."""
    parts = materialise(gathered(docs.select(text, held_out(F.col(key)).alias("_held")), text, depth), "gathered")
    words = parts.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    words = materialise(words, "words")
    counts = parts.filter("run is not null").groupBy("run").agg(F.sum("n").alias("n"))
    runs = materialise(context_tree(materialise(counts, "runs"), depth), "tree")
    sums = words.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()

    short = words.filter(F.octet_length("word") <= LONGEST)
    common = short.filter(F.col("n") >= _at_least(short, FREQUENT_WORDS)).toArrow()
    frequent = runs.filter(F.col("n") >= _at_least(runs, FREQUENT_RUNS)).select("run", "log10").toArrow()
    order = np.argsort(frequent["run"].to_numpy())
    return Model(
        words, runs, depth, sums["tokens"] or 0, sums["distinct"],
        dict(zip(common["word"].to_pylist(), common["n"].to_pylist(), strict=True)),
        (frequent["run"].to_numpy()[order], frequent["log10"].to_numpy()[order]),
    )


def scored(docs: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, n_bytes, base_score, score (log10 probabilities).

    Frequent words and runs are looked up in the tables that every worker
    has. What a document holds besides is few; it is written with the
    document's row, joined to the stored tables and summed back by row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.frequent_words, model.frequent_runs, model.tokens + 0.1 * (model.distinct + 1))
    )
    depth = model.depth

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (runs, logs), base = shared.value
        scores = {w: float(np.log10((n + 0.1) / base)) for w, n in words.items()}
        end = words.get(END_WORD, 0)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [folded(t) for t in part.column(1).to_pylist()]
                found, borders = byte_runs(texts, depth)
                place = np.minimum(np.searchsorted(runs, found), max(len(runs) - 1, 0))
                hit = runs[place] == found if len(runs) else np.zeros(len(found), dtype=bool)
                model_sum = np.add.reduceat(np.where(hit, logs[place] if len(runs) else 0.0, 0.0), borders[:-1])
                rare_at = np.concatenate([[0], np.cumsum(~hit)])[borders]
                rows = []
                for own in texts:
                    tokens = words_of(own)
                    known = [scores[w] for w in tokens if w in scores]
                    rare = Counter([w for w in tokens if w not in scores]) if len(known) < len(tokens) else {}
                    if not end:
                        rare = Counter(rare) + Counter([END_WORD])
                    rows.append((len(tokens) + 1, len(known) + bool(end), sum(known) + (scores[END_WORD] if end else 0.0), rare))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2),
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()), pa.array([r[2] for r in rows], pa.float64()),
                    pa.array(model_sum, pa.float64()),
                    pa.array([[{"word": w, "n": n} for w, n in r[3].items()] for r in rows], pa.list_(rare_word)),
                    pa.ListArray.from_arrays(pa.array(rare_at.astype(np.int32)), pa.array(found[~hit])),
                ], names)

    rare_word = pa.struct([("word", pa.binary()), ("n", pa.int64())])
    names = ["key", "held_out", "n_tokens", "n_known", "n_bytes", "base_score", "score", "rare_words", "rare_runs"]
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, text, held_out(F.col(key)).alias("_held")).mapInArrow(
        look_up, f"key {kind}, held_out boolean, n_tokens long, n_known long, n_bytes long, base_score double, "
        "score double, rare_words array<struct<word:binary,n:long>>, rare_runs array<long>",
    )
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "looked-up")
    word = rows.select("row", F.explode("rare_words").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    word = word.join(model.words, "word", "left").select(
        "row", (F.col("times") * model.word_log10(F.col("n"))).alias("base"), F.lit(0.0).alias("model"),
        F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("known"),
    )
    run = rows.select("row", F.explode("rare_runs").alias("run")).groupBy("row", "run").agg(F.count("*").alias("times"))
    run = run.join(model.runs, "run").select(
        "row", F.lit(0.0).alias("base"), (F.col("times") * F.col("log10")).alias("model"), F.lit(0).cast("long").alias("known")
    )
    rest = word.unionByName(run).groupBy("row").agg(F.sum("base").alias("base"), F.sum("model").alias("model"), F.sum("known").alias("known"))
    joined = rows.drop("rare_words", "rare_runs").join(rest, "row", "left")
    return joined.select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), "n_bytes",
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("model", F.lit(0.0))).alias("score"),
    )


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """Learns from the training rows of ``docs`` and scores all of them: see ``scored``; with train_tokens and bits_per_byte.

    NULL texts count as empty, and an empty text still has its end. Repeated
    rows are learned and scored each. Without any training row every decision
    has probability 1/2. Other columns are not read.
    """
    model = learn(docs, key, text, depth)
    result = scored(docs, model, key, text)
    bits = -F.col("score") / float(np.log10(2.0)) / (F.col("n_bytes") + 1)
    return result.withColumns({"train_tokens": F.lit(model.tokens).cast("long"), "bits_per_byte": bits})
