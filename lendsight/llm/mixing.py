"""Mixing a corpus to target shares by iterative proportional fitting; DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lendsight.session import materialise

#: The class of languages and topics without a target.
OTHER = "other"
#: Sampling numbers are this many hexadecimal digits of a digest.
DIGITS = 13


@dataclass(frozen=True)
class Targets:
    """Shares of tokens wanted.

    ``lang`` and ``topic`` name shares that add up to at most 1; what is left
    goes to all other values as one class. A source is to get its tokens to the
    power of ``source_power``, relative to the sum over sources. ``keep`` is
    the share of all tokens that the sample should hold.
    """

    lang: dict[str, float]
    topic: dict[str, float]
    source_power: float = 0.5
    keep: float = 0.75


def token_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for a NULL text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def text_form(text: Column, tokens: Column) -> Column:
    """A topic for tables that have none: what form the text has."""
    bars = F.length(text) - F.length(F.translate(text, "|", ""))
    marks = F.length(text) - F.length(F.translate(text, "#*$%&<>", ""))
    return (
        F.when(tokens == 0, "empty").when(bars * 4 > tokens, "table").when(marks * 2 > tokens, "symbols")
        .when(tokens < 100, "short").when(tokens < 1000, "prose").otherwise("long")
    )


def classed(column: str, targets: dict[str, float]) -> Column:
    """The value if it has a target, else OTHER; NULL is no value."""
    return F.when(F.col(column).isin(list(targets)), F.col(column)).otherwise(F.lit(OTHER))


def calibrated_cells(docs: DataFrame, targets: Targets, tolerance: float = 1e-12, most_sweeps: int = 60) -> DataFrame:
    """One row per (source, lang class, topic class) with tokens: source, lang, topic, weight, probability.

    ``docs`` needs source, lang, topic and n_tokens. ``weight`` is the wanted
    share of a cell over its share of all tokens, raked to the three margins;
    ``probability`` is min(1, scale x weight), with the scale that keeps the
    wanted share of tokens in expectation. Where cells reach 1 the margins are
    as near as they can be without repeating documents.

    Tokens are summed to cells before anything else, so a hot source is a few
    rows. A source's cells are one row (languages and topics with a target are
    parameters, so they are few), and raking the sources needs no shuffle; the
    other two margins come from one matrix of languages by topics, whose size
    the parameters bound, once a sweep. A class with a target but no tokens is
    left out and the rest is scaled up. No tokens at all give no cells.
    """
    cells = docs.groupBy("source", classed("lang", targets.lang).alias("lang"), classed("topic", targets.topic).alias("topic"))
    cells = cells.agg(F.sum("n_tokens").alias("tokens")).filter("tokens > 0")
    by_source = cells.groupBy("source").agg(
        F.sum("tokens").alias("tokens"), F.collect_list(F.struct("lang", "topic", "tokens")).alias("cells")
    )
    by_source = materialise(by_source, "cells")
    totals = by_source.agg(
        F.sum("tokens").alias("tokens"), F.sum(F.pow("tokens", F.lit(targets.source_power))).alias("tempered")
    ).first()
    matrix = by_source.select(F.explode("cells").alias("c")).groupBy("c.lang", "c.topic").agg(F.sum("c.tokens").alias("tokens")).collect()
    if not matrix:
        return by_source.select("source", F.explode("cells").alias("c")).select(
            "source", "c.lang", "c.topic", F.lit(0.0).alias("weight"), F.lit(0.0).alias("probability")
        )
    pairs = [(row["lang"], row["topic"]) for row in matrix]
    lang = _wanted(targets.lang, {one for one, _ in pairs})
    topic = _wanted(targets.topic, {two for _, two in pairs})
    wanted = F.pow("tokens", F.lit(targets.source_power)) / F.lit(totals["tempered"])
    by_lang, by_topic = dict.fromkeys(lang, 1.0), dict.fromkeys(topic, 1.0)

    def share(c: Column) -> Column:
        return c["tokens"] / F.lit(float(totals["tokens"]))

    def factor(c: Column) -> Column:
        table = {(one, two): by_lang[one] * by_topic[two] for one, two in pairs}
        listed = F.create_map(*[x for (one, two), v in table.items() for x in (F.lit(f"{one}\x00{two}"), F.lit(v))])
        return F.element_at(listed, F.concat_ws("\x00", c["lang"], c["topic"]))

    def raked() -> DataFrame:
        """Cells with the factor of their source for the present factors of language and topic."""
        margin = F.aggregate("cells", F.lit(0.0), lambda total, c: total + share(c) * factor(c))
        return by_source.withColumn("_source", wanted / margin).select("source", "_source", F.explode("cells").alias("c"))

    for _ in range(most_sweeps):
        sums = raked().groupBy("c.lang", "c.topic").agg(F.sum(F.col("_source") * share(F.col("c"))).alias("mass")).collect()
        mass = {(row["lang"], row["topic"]): row["mass"] for row in sums}
        off = max(
            *(abs(sum(m * by_lang[one] * by_topic[two] for (one, two), m in mass.items() if one == x) - lang[x]) for x in lang),
            *(abs(sum(m * by_lang[one] * by_topic[two] for (one, two), m in mass.items() if two == x) - topic[x]) for x in topic),
        )
        if off < tolerance:
            break
        by_lang = {x: lang[x] / sum(m * by_topic[two] for (one, two), m in mass.items() if one == x) for x in lang}
        by_topic = {x: topic[x] / sum(m * by_lang[one] for (one, two), m in mass.items() if two == x) for x in topic}

    weighted = materialise(raked().select(
        "source", "c.lang", "c.topic", share(F.col("c")).alias("share"), (F.col("_source") * factor(F.col("c"))).alias("weight")
    ), "weights")
    scale = _scale(weighted, targets.keep)
    return weighted.select("source", "lang", "topic", "weight", F.least(F.lit(1.0), scale * F.col("weight")).alias("probability"))


def _wanted(shares: dict[str, float], present: set[str]) -> dict[str, float]:
    full = {**shares, OTHER: max(0.0, 1 - sum(shares.values()))}
    found = {x: full[x] for x in sorted(present)}
    # A class that is there but wants nothing keeps a trace, else no margin could be met.
    found = {x: max(v, 1e-6) for x, v in found.items()}
    return {x: v / sum(found.values()) for x, v in found.items()}


def _scale(weighted: DataFrame, keep: float) -> float:
    """The factor on weights for which min(1, factor x weight) keeps the wanted share of tokens."""
    scale = keep
    for _ in range(50):
        full = F.lit(scale) * F.col("weight") >= 1
        sums = weighted.agg(
            F.sum(F.when(full, F.col("share")).otherwise(0.0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("share") * F.col("weight"))).alias("open"),
        ).first()
        if not sums["open"] or sums["full"] >= keep:
            return scale
        better = (keep - sums["full"]) / sums["open"]
        if better <= scale * (1 + 1e-12):
            return scale
        scale = better
    return scale


def sampling_number(key: str) -> Column:
    """A number in 0..1 that depends on the key alone, the same whenever a task runs again."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)


def mixed_documents(docs: DataFrame, targets: Targets, key: str = "doc_id") -> DataFrame:
    """``docs`` with lang_class, topic_class, weight, probability and sampled; columns of these names are replaced.

    ``docs`` needs the key, source, lang, topic and n_tokens. A document
    without tokens has no weight and is not sampled. NULL sources are one
    source. Repeated rows of a key are sampled together. The cells are stored
    before the join, so Spark broadcasts them only below its threshold.
    """
    cells = calibrated_cells(docs, targets).select(
        F.col("source").alias("_source"), F.col("lang").alias("_lang"), F.col("topic").alias("_topic"),
        F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"),
    )
    cells = materialise(cells, "calibrated")
    plain = docs.drop("weight", "probability", "sampled", "lang_class", "topic_class")
    plain = plain.withColumns({"lang_class": classed("lang", targets.lang), "topic_class": classed("topic", targets.topic)})
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("lang_class") == F.col("_lang")) & (F.col("topic_class") == F.col("_topic"))
    joined = plain.join(cells, same & (F.col("n_tokens") > 0), "left").drop("_source", "_lang", "_topic")
    return joined.withColumns({
        "weight": F.coalesce("weight", F.lit(0.0)), "probability": F.coalesce("probability", F.lit(0.0)),
    }).withColumn("sampled", sampling_number(key) < F.col("probability"))


def sampled_documents(docs: DataFrame, targets: Targets, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The sampled documents with their own columns; the form of the text is the topic."""
    inner = [f"_c{i}" for i in range(len(docs.columns))]
    named = docs.toDF(*inner)
    by_name = dict(zip(docs.columns, inner, strict=True))
    body = F.col(by_name[text])
    known = named.withColumns({"key": F.col(by_name[key]), "source": F.col(by_name["source"]), "lang": F.col(by_name["lang"]), "n_tokens": token_count(body)})
    known = known.withColumn("topic", text_form(body, F.col("n_tokens")))
    return mixed_documents(known, targets, "key").filter("sampled").select(*inner).toDF(*docs.columns)
