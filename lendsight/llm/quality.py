"""Quality rules by document and by host, with host rates shrunk by an empirical beta prior."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lendsight.llm.words import WHITE, free_name, run_ids, words_of
from lendsight.session import materialise

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MEASURES = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long>"

#: Rules a document can fail, over its measures. The first two reject the document by themselves.
RULES = {
    "short": "{m}.n_words < 20",
    "repeats": "100 * {m}.n_repeat_words > 30 * {m}.n_words",
    "symbols": "10 * {m}.n_symbols > {m}.word_chars",
    "dup_lines": "10 * {m}.n_dup_lines > {m}.n_words",
}
HARD = ("short", "repeats")


def text_measures(text: str | None) -> tuple[int, int, int, int, int]:
    """Counts over one whole text; a missing or empty text counts nothing."""
    data = (text or "").encode()
    words = words_of(data)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    chars = len(text or "") - (len(data) - len(data.translate(None, WHITE)))
    earlier, dup_lines = set(), 0
    for line in data.split(b"\n"):
        if line in earlier:
            dup_lines += bool(line.strip(WHITE))
        else:
            earlier.add(line)
    return len(words), chars, symbols, dup_lines, repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of eight words found twice or more in the text."""
    if len(words) <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    ids = run_ids(np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64), WINDOW)
    repeated = np.bincount(ids)[ids] > 1
    if not repeated.any():
        return 0
    starts = np.flatnonzero(repeated)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return int((np.cumsum(change)[:-1] > 0).sum())


def measures(text: Column) -> Column:
    """The five counts of a text as one struct column."""
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    @F.arrow_udf(MEASURES)
    def count(texts: pa.Array) -> pa.Array:
        counted = np.array([text_measures(t) for t in texts.to_pylist()], dtype=np.int64).reshape(-1, 5)
        return pa.StructArray.from_arrays([pa.array(counted[:, i]) for i in range(5)], fields)

    return count.asNondeterministic()(text)


def rule_failures(measured: str) -> dict[str, Column]:
    return {name: F.expr(rule.format(m=measured)) for name, rule in RULES.items()}


def host_verdicts(measured: DataFrame, host: str, column: str, reject_rate: float = 0.5) -> DataFrame:
    """One row per host: host, and ``host_bad``, true if a shrunk failure rate is over ``reject_rate``.

    For each rule the failure rate of a host is a draw from a beta
    distribution fitted to the hosts themselves: mean m = all failures / all
    documents, v = the variance of the host rates weighted by documents, and
    strength s = m(1-m)/v - 1, kept within 1 to 1000. The shrunk rate is
    (failures + s m) / (documents + s). Documents without a host form one host.
    """
    failures = rule_failures(column)
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), *[F.sum(rule.cast("long")).alias(name) for name, rule in failures.items()]
    )
    hosts = materialise(hosts, "hosts")
    mean = {r: F.sum(r) / F.sum("n") for r in failures}
    square = {r: F.sum(F.col(r) * F.col(r) / F.col("n")) / F.sum("n") for r in failures}
    priors = hosts.agg(F.struct(
        *[mean[r].alias(f"m_{r}") for r in failures], *[(square[r] - mean[r] * mean[r]).alias(f"v_{r}") for r in failures]
    ).alias("prior")).scalar()
    priced = hosts.withColumn("prior", priors)

    def shrunk(rule: str) -> Column:
        m, v = F.col(f"prior.m_{rule}"), F.col(f"prior.v_{rule}")
        raw = F.when(v > 1e-12, m * (1 - m) / v - 1).otherwise(F.lit(1000.0))
        strength = F.least(F.greatest(raw, F.lit(1.0)), F.lit(1000.0))
        return (F.col(rule) + strength * m) / (F.col("n") + strength)

    rates = {r: shrunk(r) for r in failures}
    bad = F.greatest(*rates.values()) > reject_rate
    return priced.select("host", "n", *[rates[r].alias(f"rate_{r}") for r in failures], bad.alias("host_bad"))


def with_verdicts(
    measured: DataFrame, verdicts: DataFrame, host: str, column: str, names: tuple[str, str] = ("base_failed", "kept"),
    rates: tuple[str, ...] = (),
) -> DataFrame:
    """``measured`` with base_failed and kept: no hard rule failed and the host is not bad.

    ``rates`` names rules whose shrunk rate of the host comes along as a column
    ``rate_`` and the name of the rule.

    ``verdicts`` should be a stored table: Spark then sees its size and
    broadcasts it only below its threshold. Columns of the new ``names`` are
    replaced.
    """
    failures = rule_failures(column)
    hard = failures[HARD[0]] | failures[HARD[1]]
    its_host, bad = (free_name([*measured.columns, *names], n) for n in ("_verdict_host", "_host_bad"))
    shrunk = [f"rate_{rule}" for rule in rates]
    measured = measured.drop(*shrunk)
    named = verdicts.select(F.col("host").alias(its_host), F.col("host_bad").alias(bad), *shrunk)
    joined = measured.join(named, F.col(host).eqNullSafe(F.col(its_host)), "left")
    kept = ~hard & ~F.coalesce(bad, F.lit(False))
    return joined.withColumns({names[0]: hard, names[1]: kept}).drop(its_host, bad)


def quality_documents(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass, with the columns they came with.

    Two passes: the measures are cheap to take again, and writing every text
    a second time is not. An empty or NULL text has no words and fails. Every
    row is judged by itself, so repeated rows fare alike. Columns of any name
    come through as they are.
    """
    column, failed, kept = (free_name(docs.columns, n) for n in ("_measures", "_failed", "_kept"))
    measured = docs.select(F.col(host), measures(F.col(text)).alias(column))
    verdicts = materialise(host_verdicts(measured, host, column), "verdicts")
    judged = with_verdicts(docs.withColumn(column, measures(F.col(text))), verdicts, host, column, (failed, kept))
    return judged.filter(F.col(kept)).select(*docs.columns)
