"""SQL for DuckDB that states again what a query of this subpackage computes."""

from __future__ import annotations

from lendsight.llm.mixing import Targets

_HOST_RULES = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "dup_lines": "10 * n_dup_lines > n_words",
}


def quality_sql() -> str:
    """Measures, host rates shrunk by the beta prior of each rule, verdicts."""
    sums = ", ".join(f"sum(({rule})::BIGINT)::DOUBLE AS f_{name}" for name, rule in _HOST_RULES.items())
    priors = ", ".join(
        f"sum(f_{r}) / sum(n) AS m_{r}, sum(f_{r} * f_{r} / n) / sum(n) - (sum(f_{r}) / sum(n)) * (sum(f_{r}) / sum(n)) AS v_{r}"
        for r in _HOST_RULES
    )
    strengths = ", ".join(
        f"least(greatest(CASE WHEN v_{r} > 1e-12 THEN m_{r} * (1 - m_{r}) / v_{r} - 1 ELSE 1000.0 END, 1.0), 1000.0) AS s_{r}, m_{r}"
        for r in _HOST_RULES
    )
    bad = ", ".join(f"(f_{r} + s_{r} * m_{r}) / (n + s_{r})" for r in _HOST_RULES)
    rates = ", ".join(f"round((f_{r} + s_{r} * m_{r}) / (n + s_{r}), 9) AS rate_{r}" for r in _HOST_RULES)
    return f"""
WITH split AS (
    SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words, coalesce(text, '') AS text
    FROM documents
),
counted AS (
    SELECT doc_id, source, len(words) AS n_words,
           coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols
    FROM split
),
lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
    GROUP BY doc_id
),
windows AS (
    SELECT doc_id, spot, array_to_string(words[spot: spot + 7], ' ') AS run
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS spot FROM split WHERE len(words) >= 8)
),
twice AS (
    SELECT doc_id, spot FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1
),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM (SELECT doc_id, unnest(range(spot, spot + 8)) AS place FROM twice) GROUP BY doc_id
),
measured AS (
    SELECT doc_id, source, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM counted LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
),
hosts AS (SELECT source, count(*) AS n, {sums} FROM measured GROUP BY source),
priors AS (SELECT {priors} FROM hosts),
strengths AS (SELECT {strengths} FROM priors),
verdicts AS (SELECT source, greatest({bad}) > 0.5 AS bad, {rates} FROM hosts, strengths)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT bad AS kept,
       {", ".join(f"rate_{r}" for r in _HOST_RULES)}
FROM measured m JOIN verdicts v ON v.source IS NOT DISTINCT FROM m.source
"""


def mixing_sql(targets: Targets, sweeps: int = 40, rounds: int = 12) -> str:
    """The raking written out sweep by sweep on the table of cells, then the scale round by round."""

    def shares(column: str, wanted: dict[str, float]) -> str:
        full = {**wanted, "other": 1 - sum(wanted.values())}
        rows = ", ".join(f"('{name}', {share!r}::DOUBLE)" for name, share in full.items())
        return (
            f"{column}_targets AS (SELECT name, share / sum(share) OVER () AS share FROM (VALUES {rows}) t(name, share) "
            f"WHERE name IN (SELECT {column} FROM cells))"
        )

    listed = {c: ", ".join(f"'{x}'" for x in w) for c, w in (("lang", targets.lang), ("topic", targets.topic))}
    steps = []
    for i in range(sweeps):
        steps.append(f"""
s{i} AS MATERIALIZED (SELECT source, lang, topic, share, wanted, w * wanted / sum(w) OVER (PARTITION BY source) AS w FROM r{i}),
l{i} AS MATERIALIZED (SELECT s.* REPLACE (w * t.share / sum(w) OVER (PARTITION BY lang) AS w) FROM s{i} s JOIN lang_targets t ON t.name = s.lang),
r{i + 1} AS MATERIALIZED (SELECT l.* REPLACE (w * t.share / sum(w) OVER (PARTITION BY topic) AS w) FROM l{i} l JOIN topic_targets t ON t.name = l.topic)""")
    scales = [f"c0 AS MATERIALIZED (SELECT {targets.keep!r}::DOUBLE AS scale)"]
    for i in range(rounds):
        scales.append(f"""
c{i + 1} AS MATERIALIZED (
    SELECT CASE WHEN open = 0 OR filled >= {targets.keep!r} THEN scale ELSE greatest(scale, ({targets.keep!r} - filled) / open) END AS scale
    FROM (SELECT any_value(scale) AS scale, sum(CASE WHEN scale * weight >= 1 THEN share ELSE 0 END) AS filled,
                 sum(CASE WHEN scale * weight >= 1 THEN 0 ELSE share * weight END) AS open FROM weights, c{i})
)""")
    return f"""
WITH counted AS (
    SELECT doc_id, source, lang, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents
),
known AS (
    SELECT doc_id, source, lang, n_tokens,
           CASE WHEN n_tokens = 0 THEN 'empty' WHEN 4 * (length(text) - length(replace(text, '|', ''))) > n_tokens THEN 'table'
                WHEN 2 * length(regexp_replace(text, '[^#*$%&<>]', '', 'g')) > n_tokens THEN 'symbols'
                WHEN n_tokens < 100 THEN 'short' WHEN n_tokens < 1000 THEN 'prose' ELSE 'long' END AS topic
    FROM counted
),
docs AS (
    SELECT *, CASE WHEN lang IN ({listed['lang']}) THEN lang ELSE 'other' END AS lang_class,
           CASE WHEN topic IN ({listed['topic']}) THEN topic ELSE 'other' END AS topic_class
    FROM known
),
cells AS MATERIALIZED (
    SELECT source, lang_class AS lang, topic_class AS topic, sum(n_tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL HAVING sum(n_tokens) > 0
),
sources AS (SELECT source, pow(sum(tokens), {targets.source_power!r}) AS part FROM cells GROUP BY source),
{shares('lang', targets.lang)},
{shares('topic', targets.topic)},
r0 AS MATERIALIZED (
    SELECT c.source, lang, topic, tokens / (SELECT sum(tokens) FROM cells) AS share, part / (SELECT sum(part) FROM sources) AS wanted,
           tokens / (SELECT sum(tokens) FROM cells) AS w
    FROM cells c JOIN sources s ON s.source IS NOT DISTINCT FROM c.source
),{','.join(steps)},
weights AS MATERIALIZED (SELECT source, lang, topic, share, w / share AS weight FROM r{sweeps}),
{','.join(scales)},
final AS (SELECT source, lang, topic, round(weight, 6) AS weight, round(least(1.0, scale * weight), 6) AS probability FROM weights, c{rounds})
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, coalesce(f.weight, 0.0::DOUBLE) AS weight, coalesce(f.probability, 0.0::DOUBLE) AS probability,
       ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / pow(16.0::DOUBLE, 13) < coalesce(f.probability, 0) AS sampled
FROM docs d LEFT JOIN final f
  ON f.source IS NOT DISTINCT FROM d.source AND f.lang = d.lang_class AND f.topic = d.topic_class AND d.n_tokens > 0
"""


def vector_codes_sql(parts: int, entries: int, rounds: int) -> str:
    """Every part against every entry, round by round; ties by the number of the entry."""
    gap = "list_sum(list_transform(list_zip(c.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (
    SELECT vec_id, label, part, x, min(gap) AS gap, arg_min(entry, gap * {entries} + entry) AS entry
    FROM (SELECT c.vec_id, c.label, c.part, c.x, b.entry, {gap} AS gap FROM cut c JOIN book{i} b ON b.part = c.part)
    GROUP BY ALL
)""")
        if i < rounds:
            steps.append(f"""
sums{i} AS (
    SELECT part, entry, spot, sum(value)::BIGINT AS total, count(*) AS n
    FROM (SELECT part, entry, unnest(x) AS value, generate_subscripts(x, 1) AS spot FROM near{i}) GROUP BY ALL
),
means{i} AS (
    SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY spot) AS x FROM sums{i} GROUP BY ALL
),
book{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN means{i} m USING (part, entry))""")
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
cut AS MATERIALIZED (
    SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x
    FROM (SELECT *, unnest(range({parts})) AS part FROM kept)
),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries})),
book0 AS MATERIALIZED (SELECT part, entry, x FROM cut JOIN first USING (vec_id)),{','.join(steps)},
coded AS (
    SELECT vec_id, label, string_agg(lower(lpad(hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(gap)::BIGINT AS error
    FROM near{rounds} GROUP BY vec_id, label
),
books AS (
    SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, books
"""


def manifest_sql(fanout: int, levels: int) -> str:
    """Runs of every level written out up to ``levels``, of the trees of the sources and of the tree above them."""

    def field(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    def tree(name: str) -> str:
        made = []
        for k in range(levels):
            made.append(f"""
{name}_run{k} AS MATERIALIZED (
    SELECT tree, spot // {fanout} AS spot, string_agg(digest, '' ORDER BY spot) AS run, (n + {fanout - 1}) // {fanout} AS n
    FROM {name}{k} WHERE n > 1 GROUP BY tree, spot // {fanout}, n
),
{name}{k + 1} AS (SELECT tree, spot, n, sha256(run) AS digest FROM {name}_run{k})""")
        return ",".join(made)

    def climb(before: str, name: str, start: str) -> str:
        made = []
        for k in range(levels):
            place = f"(p.step % {fanout}) * 64"
            below = start if k == 0 else f"{name}_way{k - 1}"
            made.append(f"""
{name}_way{k} AS (
    SELECT p.* REPLACE (
        p.step // {fanout} AS step,
        CASE WHEN r.run IS NULL THEN p.proof ELSE p.proof || left(r.run, {place}) || substr(r.run, {place} + 65) END AS proof,
        CASE WHEN r.run IS NULL THEN p.folded ELSE sha256(left(r.run, {place}) || p.folded || substr(r.run, {place} + 65)) END AS folded
    )
    FROM {below} p LEFT JOIN {name}_run{k} r ON r.tree = p.{before} AND r.spot = p.step // {fanout}
)""")
        return ",".join(made)

    crc = (
        "xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
        "lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END))"
    )
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    top = " UNION ALL ".join(f"SELECT tree, digest FROM sub{k} WHERE n = 1" for k in range(levels + 1))
    peak = " UNION ALL ".join(f"SELECT digest FROM top{k} WHERE n = 1" for k in range(levels + 1))
    return f"""
WITH sources AS (SELECT source AS name, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, n FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)),
leaves AS MATERIALIZED (
    SELECT doc_id, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST) - 1 AS spot, {leaf('text')} AS leaf,
           CASE WHEN {crc} % 5 = 0 THEN {leaf(lowered)} ELSE {leaf('text')} END AS claimed
    FROM documents d JOIN sources s ON s.name IS NOT DISTINCT FROM d.source
),
sub0 AS (SELECT tree, spot, n, leaf AS digest FROM leaves),{tree('sub')},
subroots AS MATERIALIZED ({top}),
top0 AS (SELECT 0 AS tree, tree AS spot, (SELECT count(*) FROM sources) AS n, digest FROM subroots),{tree('top')},
peak AS ({peak}),
start AS (SELECT *, 0 AS above, spot AS step, '' AS proof, claimed AS folded FROM leaves),{climb('tree', 'sub', 'start')},
middle AS (SELECT * REPLACE (tree AS step) FROM sub_way{levels - 1}),{climb('above', 'top', 'middle')}
SELECT doc_id, leaf, s.digest AS subroot, k.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = k.digest AS verified
FROM top_way{levels - 1} w JOIN subroots s ON s.tree = w.tree, peak k
"""


def privacy_sql(threshold: float) -> str:
    """Matches line by line with their places, shares of lines, and the places of the disclosing terms."""
    # The four patterns as they are defined.
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN reverse({digits})[i]::INT "
        f"WHEN reverse({digits})[i]::INT > 4 THEN 2 * reverse({digits})[i]::INT - 9 ELSE 2 * reverse({digits})[i]::INT END)) % 10 = 0"
    )
    checks = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS INT), 0) > 255)) = 0",
        "card": f"length({digits}) BETWEEN 13 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
    }
    entities = {"email": "lower(m)", "ip": "m", "card": digits, "phone": digits}

    def placed(source: str, text: str, start: str, pattern: str) -> str:
        return f"""
    SELECT * EXCLUDE (ms, gaps, i), ms[i] AS m,
           from_here + list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS at_start
    FROM (SELECT *, {start} AS from_here, regexp_extract_all({text}, '{pattern}') AS ms, string_split_regex({text}, '{pattern}') AS gaps,
                 unnest(range(1, len(regexp_extract_all({text}, '{pattern}')) + 1)) AS i FROM {source})"""

    kinds = " UNION ALL ".join(
        f"SELECT row, no, line, {k} AS kind_no, '{kind}' AS kind, at_start AS start, at_start + length(m) AS stop, '{kind}:' || {entities[kind]} AS entity "
        f"FROM ({placed('lines', 'line', 'line_start', patterns[kind])}) WHERE {checks[kind]}"
        for k, kind in enumerate(patterns)
    )
    told = "ln((n_both * n_lines)::DOUBLE / (n_entity * n_term)) / ln(n_lines::DOUBLE / n_entity)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in (*patterns, "term"))
    listed = "string_agg(kind || ':' || start::BIGINT::VARCHAR || ':' || stop::BIGINT::VARCHAR, ',' ORDER BY kind_no, start)"
    return f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT row, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM docs),
lines AS MATERIALIZED (
    SELECT row, no, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY row ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_start FROM cut
),
total AS (SELECT count(*) AS n_lines FROM lines),
base AS MATERIALIZED ({kinds}),
spoken AS MATERIALIZED (
    SELECT DISTINCT row, no, line, term FROM (
        SELECT row, no, line, unnest(regexp_extract_all(translate(regexp_replace(line, '{patterns["email"]}', ' ', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}')) AS term FROM lines
    ) WHERE NOT regexp_full_match(term, '[0-9]+')
),
held AS MATERIALIZED (SELECT DISTINCT row, no, entity, md5(text) AS digest FROM base JOIN docs USING (row)),
entities AS (SELECT entity, count(*) AS n_entity FROM held GROUP BY entity HAVING count(DISTINCT digest) > 1),
words AS (SELECT term, count(*) AS n_term FROM spoken GROUP BY term),
pairs AS (
    SELECT entity, term, count(*) AS n_both FROM held JOIN entities USING (entity) JOIN spoken USING (row, no)
    GROUP BY entity, term HAVING count(DISTINCT digest) > 1
),
flagged AS MATERIALIZED (
    SELECT entity, term FROM pairs JOIN entities USING (entity) JOIN words USING (term), total WHERE n_entity < n_lines AND {told} >= {threshold!r}
),
marked AS MATERIALIZED (SELECT DISTINCT row, no, term FROM held JOIN flagged USING (entity)),
told_lines AS (SELECT * FROM lines WHERE (row, no) IN (SELECT (row, no) FROM marked)),
pieces AS (
    SELECT row, no, gap, piece_start FROM (
        SELECT row, no, gaps[i] AS gap, line_start + coalesce(list_sum(list_transform(gaps[1:i - 1], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS piece_start
        FROM (SELECT *, string_split_regex(line, '{patterns["email"]}') AS gaps, regexp_extract_all(line, '{patterns["email"]}') AS ms,
                     unnest(range(1, len(string_split_regex(line, '{patterns["email"]}')) + 1)) AS i FROM told_lines)
    )
),
uttered AS ({placed('pieces', 'gap', 'piece_start', word)}),
spans AS (
    SELECT row, kind_no, kind, start, stop FROM base
    UNION ALL
    SELECT u.row, 4 AS kind_no, 'term' AS kind, at_start AS start, at_start + length(m) AS stop
    FROM uttered u JOIN marked k ON k.row = u.row AND k.no = u.no AND k.term = translate(m, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
),
folded AS (
    SELECT row, {counts}, sha256(coalesce({listed} FILTER (kind_no < 4), '')) AS base_sha256, {listed} AS spans FROM spans GROUP BY row
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in (*patterns, "term"))},
       coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN folded USING (row)
"""
