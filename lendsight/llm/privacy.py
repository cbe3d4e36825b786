"""Personal data in texts, and the words that give it away, found and replaced by DataFrame functions alone.

Protected entities are e-mail addresses, IP addresses, card and phone numbers.
A term (a word without letter case) tells of an entity as much as its
pointwise mutual information with it, PMI(t, e) = log p(t, e) / (p(t) p(e)),
against all there is to tell, the entity's own information IC(e) = -log p(e).
Probabilities are shares of the lines of the corpus that hold t, e or both. A
term whose disclosure PMI / IC reaches ``THRESHOLD`` is generalised where it
stands beside the entity, and removed where it never stands without it.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from lendsight.session import materialise

#: Share of an entity's information from which on a term discloses it.
THRESHOLD = 0.9

# The four kinds in the order of their spans. Runs are possessive and start where no run goes on, or
# where the match before ended: what is found is the same as without, but a long run without a match is read once.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
PATTERNS = {
    "email": EMAIL,
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
#: What a text must hold for a kind to be looked for at all.
SIGNS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPAN = "array<struct<kind:string,start:bigint,stop:bigint,value:string>>"
BLOCK = 256
#: Bits of the sieve that keeps words without any pair from being shuffled: four megabytes where all rows are there.
SIEVE = 2**24


def running_sums(lengths: Column) -> Column:
    """Sum of an array of longs up to and with each element.

    In blocks, so that an array of n takes n * BLOCK + (n / BLOCK)^2 copies of
    a number and not n^2. ``lengths`` is used several times and should be a
    plain column.
    """
    none = F.array().cast("array<bigint>")
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))

    def block(b: Column) -> Column:
        return F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))

    def add(so_far: Column, x: Column) -> Column:
        total = so_far["total"] + x
        return F.struct(total.alias("total"), F.concat(so_far["sums"], F.array(total)).alias("sums"))

    def start(total: Column) -> Column:
        return F.struct(total.cast("long").alias("total"), none.alias("sums"))

    whole = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0).cast("long"), lambda a, x: a + x))
    ends = F.aggregate(whole, start(F.lit(0)), add)["sums"]
    before = F.concat(F.array(F.lit(0).cast("long")), ends)
    inner = F.transform(F.arrays_zip(blocks.alias("b"), F.slice(before, 1, F.size(blocks)).alias("from")), lambda z: F.aggregate(
        block(z["b"]), start(z["from"]), add
    )["sums"])
    return F.when(F.size(lengths) > 0, F.flatten(inner)).otherwise(none)


def _located(df: DataFrame, text: str, pattern: Column | str, sign: Column, name: str) -> DataFrame:
    """``df`` with array column ``name`` of (start, stop, value) of the matches of a pattern in code points."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    none = F.array().cast("array<string>")
    matched, steps, ends = f"_{name}_matched", f"_{name}_steps", f"_{name}_ends"
    df = df.withColumn(matched, F.when(sign, F.regexp_extract_all(F.col(text), pattern, F.lit(0))).otherwise(none))
    between = F.slice(F.split(F.col(text), pattern, -1), 1, F.size(matched))
    measured = F.zip_with(F.col(matched), between, lambda m, gap: (F.length(m) + F.length(gap)).cast("long"))
    df = df.withColumn(steps, F.when(F.size(matched) > 0, measured).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn(ends, running_sums(F.col(steps)))
    placed = F.zip_with(F.col(matched), F.col(ends), lambda m, end: F.struct(
        (end - F.length(m)).alias("start"), end.alias("stop"), m.alias("value")
    ))
    return df.withColumn(name, placed).drop(matched, steps, ends)


def _luhn(digits: Column) -> Column:
    def weighed(d: Column, i: Column) -> Column:
        value = F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2)
        return F.when(value > 9, value - 9).otherwise(value)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def _named(kind: str, span: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), span["start"].alias("start"), span["stop"].alias("stop"), span["value"].alias("value"))


def _passes(kind: str, span: Column) -> Column:
    value = span["value"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _entity(span: Column) -> Column:
    """What two spellings of one entity share: small letters of an address, digits of a number."""
    digits = F.regexp_replace(span["value"], "[^0-9]", "")
    same = F.when(span["kind"] == "email", F.translate(span["value"], CAPITALS, SMALL)).when(span["kind"] == "ip", span["value"])
    return F.concat(span["kind"], F.lit(":"), same.otherwise(digits))


def with_base_spans(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with array column ``name`` of (kind, start, stop, value): leftmost matches of each kind that pass its check."""
    parts = []
    for kind, pattern in PATTERNS.items():
        part = f"_{name}_{kind}"
        sign = F.contains(F.col(text), F.lit(SIGNS[kind])) if SIGNS[kind] else F.col(text).rlike("[0-9]")
        df = _located(df, text, pattern, sign, part)
        passed = F.filter(F.col(part), partial(_passes, kind))
        df = df.withColumn(part, F.transform(passed, partial(_named, kind)))
        parts.append(part)
    return df.withColumn(name, F.concat(*parts).cast(SPAN)).drop(*parts)


def masked(text: Column) -> Column:
    """Small letters, and as many spaces in the place of each address: what terms are read from."""
    blank = F.zip_with(
        F.split(text, EMAIL, -1), F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)),
        lambda gap, m: F.concat(gap, F.coalesce(F.repeat(F.lit(" "), F.length(m)), F.lit(""))),
    )
    plain = F.when(F.contains(text, F.lit("@")), F.array_join(blank, "")).otherwise(text)
    return F.translate(plain, CAPITALS, SMALL)


def terms(line: Column) -> Column:
    """Different words of a masked line, but for mere numbers."""
    words = F.array_distinct(F.regexp_extract_all(line, F.lit(f"{WORD}+"), F.lit(0)))
    return F.filter(words, lambda w: ~w.rlike("^[0-9]+$"))


def disclosure(both: Column, entity: Column, term: Column, lines: int) -> Column:
    """PMI(t, e) / IC(e) from numbers of lines; NULL for an entity that stands in every line."""
    ratio = (both * F.lit(lines)).cast("double") / (entity * term)
    information = F.log(F.lit(float(lines)) / entity)
    return F.when(information > 0, F.log(ratio) / information)


def _place() -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(SIEVE))


def _sieve(candidates: DataFrame) -> DataFrame:
    """(slot, mask): one bit for the hash of every term; at most SIEVE / 64 rows, whatever the number of terms."""
    marked = candidates.select("term").withColumn("place", _place())
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    return marked.groupBy(F.floor(F.col("place") / 64).alias("slot")).agg(F.bit_or(bit).alias("mask"))


def disclosing_terms(passages: DataFrame, docs: DataFrame, text: str, lines: int, threshold: float = THRESHOLD) -> DataFrame:
    """(entity, term, disclosure) of the pairs over the threshold.

    ``passages`` are the lines with an entity: text_hash, entities, words. A
    pair must be seen in two different texts at least, which the least and the
    greatest hash of its texts show; so every count is a sum of partial sums
    and a hot entity or word is folded before it is shuffled. Words that the
    passages alone show to be too frequent go first. The corpus is then counted
    for words that a sieve of fixed size lets through; it spares the shuffle of
    most others and loses none, and the join with the pairs drops the rest.
    """
    seen = F.col("text_hash")
    twice = F.min(seen) != F.max(seen)
    entities = passages.select("text_hash", F.explode("entities").alias("entity")).groupBy("entity").agg(
        F.count("*").alias("n_entity"), twice.alias("twice")
    ).filter("twice").drop("twice")
    entities = materialise(entities, "entities")
    beside = passages.select("text_hash", F.explode("entities").alias("entity"), "words").join(entities, "entity")
    pairs = beside.select("entity", "n_entity", "text_hash", F.explode("words").alias("term")).groupBy("entity", "n_entity", "term").agg(
        F.count("*").alias("n_both"), twice.alias("twice")
    ).filter("twice").drop("twice")
    here = passages.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n_here"))
    most = disclosure(F.col("n_both"), F.col("n_entity"), F.col("n_here"), lines)
    candidates = materialise(pairs.join(here, "term").filter(most >= threshold).drop("n_here"), "candidates")

    sieve = F.broadcast(materialise(_sieve(candidates), "sieve"))
    every = docs.select(F.explode(F.split(F.col(text), "\n")).alias("line"))
    spoken = every.select(F.explode(terms(F.translate(
        F.when(F.contains("line", F.lit("@")), F.regexp_replace("line", EMAIL, " ")).otherwise(F.col("line")), CAPITALS, SMALL
    ))).alias("term")).withColumn("place", _place())
    sifted = spoken.join(sieve, F.floor(F.col("place") / 64) == F.col("slot")).filter(F.getbit("mask", F.col("place") % 64) == 1)
    counts = sifted.groupBy("term").agg(F.count("*").alias("n_term"))
    told = disclosure(F.col("n_both"), F.col("n_entity"), F.col("n_term"), lines)
    return candidates.join(counts, "term").select("entity", "term", told.alias("disclosure")).filter(F.col("disclosure") >= threshold)


def _term_spans(passages: DataFrame, flagged: DataFrame) -> DataFrame:
    """(digest, marks): for each text the places of its disclosing terms, line by line."""
    beside = passages.select("digest", "line_no", F.explode("entities").alias("entity"), "words")
    beside = beside.select("digest", "line_no", "entity", F.explode("words").alias("term"))
    told = beside.join(flagged, ["entity", "term"]).groupBy("digest", "line_no", "term").agg(F.max("disclosure").alias("disclosure"))
    told = told.groupBy("digest", "line_no").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("told"))
    lines = passages.select("digest", "line_no", "line").join(told, ["digest", "line_no"]).dropDuplicates(["digest", "line_no"])
    # Terms hold no character with a meaning in a pattern.
    pattern = F.concat(F.lit(f"(?<!{WORD})(?:"), F.array_join(F.map_keys("told"), "|"), F.lit(f")(?!{WORD})"))
    lines = _located(lines.withColumn("pattern", pattern), "line", F.col("pattern"), F.lit(True), "found")
    marked = F.transform("found", lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"), F.col("told")[s["value"]].alias("disclosure")
    ))
    return lines.groupBy("digest").agg(F.collect_list(F.struct("line_no", marked.alias("found"))).alias("marks"))


def _replaced(text: Column, spans: Column) -> Column:
    """The text with a name for each span in its place; a span that begins inside another goes with it."""

    def step(so_far: Column, s: Column) -> Column:
        kind = F.when(s["kind"] != "term", s["kind"]).when(s["disclosure"] > 1 - 1e-9, F.lit("removed")).otherwise(
            F.when(s["value"].rlike("[0-9]"), F.lit("code")).otherwise(F.lit("term"))
        )
        between = F.substring(text, so_far["at"] + 1, (s["start"] - so_far["at"]).cast("int"))
        grown = F.concat(so_far["made"], between, F.lit("["), kind, F.lit("]"))
        inside = s["start"] < so_far["at"]
        return F.struct(
            F.greatest(so_far["at"], s["stop"].cast("int")).alias("at"),
            F.when(inside, so_far["made"]).otherwise(grown).alias("made"),
        )

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("made"))
    return F.aggregate(spans, first, step, lambda end: F.concat(end["made"], F.substring(text, end["at"] + 1, F.length(text))))


def sanitised(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD, texts: bool = True) -> DataFrame:
    """``docs`` with the text sanitised and ``found``, the spans (kind, start, stop, value, disclosure) of the text given.

    Spans are in code points, end exclusive, by kind and then start; terms
    come last and stand in a line with the entity they disclose. A NULL text
    counts as empty and has none. Rows are treated alike whether repeated or
    not; copies count in the shares of lines, but what one text alone shows is
    no evidence, however many copies it has. ``texts=False`` leaves the text of rows without a span NULL,
    which spares writing them. A column of ``docs`` named found is replaced.
    No entity is ever collected: all tables are joined as they are, small
    ones broadcast by Spark's size check.
    """
    columns = [c for c in docs.columns if c not in (text, "found")]
    kept = F.struct(*columns).alias("kept") if columns else F.lit(0).alias("kept")
    read = docs.select(kept, F.coalesce(F.col(text), F.lit("")).alias("text"))
    scanned = with_base_spans(read, "text", "base")
    held = F.col("text") if texts else F.when(F.size("base") > 0, F.col("text"))
    n_lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n_lines")
    scanned = materialise(scanned.select("kept", held.alias("text"), "base", n_lines), "scanned")
    lines = scanned.agg(F.sum("n_lines")).first()[0] or 0

    hits = scanned.filter(F.size("base") > 0).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    apart = with_base_spans(hits.select("digest", F.posexplode(F.split("text", "\n")).alias("line_no", "line")), "line", "spans")
    apart = apart.filter(F.size("spans") > 0).withColumn("plain", masked(F.col("line")))
    passages = materialise(apart.select(
        "digest", "line_no", F.xxhash64("digest").alias("text_hash"), F.col("plain").alias("line"),
        F.array_distinct(F.transform("spans", _entity)).alias("entities"), terms(F.col("plain")).alias("words"),
    ), "passages")
    flagged = materialise(disclosing_terms(passages, read, "text", lines, threshold), "flagged")
    marks = materialise(_term_spans(passages, flagged), "marks")

    told = hits.join(marks, "digest", "left").drop("digest")
    told = told.withColumn("lengths", F.transform(F.split("text", "\n"), lambda line: (F.length(line) + 1).cast("long")))
    told = told.withColumn("ends", running_sums(F.col("lengths")))
    told = told.withColumn("starts", F.concat(F.array(F.lit(0).cast("long")), F.col("ends")))

    def shifted(mark: Column) -> Column:
        at = F.get("starts", mark["line_no"])
        return F.transform(mark["found"], lambda s: F.struct(
            F.lit("term").alias("kind"), (s["start"] + at).alias("start"), (s["stop"] + at).alias("stop"),
            s["value"].alias("value"), s["disclosure"].alias("disclosure"),
        ))

    whole = "array<struct<kind:string,start:bigint,stop:bigint,value:string,disclosure:double>>"
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"), F.lit(None).cast("double").alias("disclosure")))
    added = F.sort_array(F.flatten(F.transform("marks", shifted)))
    told = told.withColumn("found", F.concat(base, F.coalesce(added, F.array().cast(whole))).cast(whole))
    in_order = F.array_sort("found", lambda a, b: (a["start"] - b["start"]).cast("int"))
    told = told.withColumn("in_order", in_order)
    replaced = told.select("kept", _replaced(F.col("text"), F.col("in_order")).alias("text"), "found")
    clean = scanned.filter(F.size("base") == 0).select("kept", "text", F.array().cast(whole).alias("found"))
    every = replaced.unionAll(clean)
    return every.select(*([F.col("kept")[c].alias(c) for c in columns]), F.col("text").alias(text), "found")


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _is(kind: str, span: Column) -> Column:
    return span["kind"] == kind


def found_in_documents(docs: DataFrame) -> DataFrame:
    """One row per document: the number of spans of each kind, the digest of the base spans, and all spans."""
    found = sanitised(docs.select("doc_id", "text"), texts=False)
    counts = [F.size(F.filter("found", partial(_is, kind))).cast("long").alias(f"n_{kind}") for kind in (*KINDS, "term")]
    base = F.filter("found", lambda s: s["kind"] != "term")
    return found.select("doc_id", *counts, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))
